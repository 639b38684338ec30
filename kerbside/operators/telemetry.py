"""Waypoints: telemetry points matched to the trips during which they were sent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kerbside.functions.columns import EXACT_TYPE, LATITUDE, LONGITUDE, check_bad, coordinate, is_bad, location_axis
from kerbside.operators.trips import of_system
from kerbside.period import ReportPeriod

QUARTER_HOUR_MS = 900_000
# Each bucket level is this much wider than the one below, so a trip spans at most
# LEVEL_FACTOR + 1 buckets of its own level, however long it is.
LEVEL_FACTOR = 16
LEVELS = 8


def waypoints(
    spans: DataFrame,
    telemetry: DataFrame,
    period: ReportPeriod,
    system_id: str | None = None,
    bucket_ms: int = QUARTER_HOUR_MS,
    bad_coordinates: str = "fail",
    bad_counts: Observation | None = None,
) -> DataFrame:
    """``trip_id, lat, lon, time``: location points sent during valid trips begun in the period.

    A point on the border of two trips belongs to both. Trips are first reduced to one row
    per device: its first start, last end and the levels its trips' lengths call for.
    Points meet that row before their JSON is read, so devices without trips cost neither
    parsing nor the second exchange, and a trip that was never closed widens only its own
    device. Points then match by device and time bucket, so a busy device spreads over
    many tasks; a trip is listed under the few buckets it spans at its level, and a point
    once at each level of its device. AQE splits what is still too large.

    Impossible coordinates fail the query, or with ``bad_coordinates="null"`` become NULL;
    :func:`location_overflows` counts them. So does ``bad_counts``, while the points are
    written; parts that Spark computes again after a loss may count again.
    """
    check_bad(bad_coordinates)
    widths = F.array(*[F.lit(bucket_ms * LEVEL_FACTOR**level).cast("long") for level in range(LEVELS)])
    trips = _begun(spans, period, system_id).withColumn("level", _level(bucket_ms))
    covers = trips.withColumn("width", F.element_at(widths, F.col("level") + 1)).select(
        F.col("rental_id").alias("trip_id"),
        "identifier",
        "started_at_ms",
        "ended_at_ms",
        "level",
        F.explode(F.sequence(F.expr("started_at_ms div width"), F.expr("ended_at_ms div width"))).alias("bucket"),
    )
    located = _during(telemetry, trips, period)
    if bad_counts is not None:
        located = located.select("deviceid", "ts_ms", "fields", "levels").observe(bad_counts, *_bad_locations())
    points = (
        located.select(
            "deviceid",
            "ts_ms",
            *[
                coordinate(
                    location_axis(F.col("fields"), axis), limit, bad_coordinates, location_axis(F.col("fields"), axis, EXACT_TYPE)
                ).alias(name)
                for name, axis, limit in (("lat", 1, LATITUDE), ("lon", 0, LONGITUDE))
            ],
            F.explode("levels").alias("level"),
        )
        .withColumn("width", F.element_at(widths, F.col("level") + 1))
        .withColumn("bucket", F.expr("ts_ms div width"))
        .drop("width")
    )
    during = (
        (points["deviceid"] == covers["identifier"])
        & (points["level"] == covers["level"])
        & (points["bucket"] == covers["bucket"])
        & points["ts_ms"].between(covers["started_at_ms"], covers["ended_at_ms"])
    )
    return points.join(covers, during).select(
        "trip_id",
        "lat",
        "lon",
        # Whole seconds, as the epoch is divided by integer division.
        F.timestamp_seconds(F.expr("ts_ms div 1000")).alias("time"),
    )


def location_overflows(
    spans: DataFrame, telemetry: DataFrame, period: ReportPeriod, system_id: str | None = None
) -> DataFrame:
    """One row: impossible coordinates among the points of devices with trips, between their first and last."""
    trips = _begun(spans, period, system_id).withColumn("level", F.lit(0))
    return _during(telemetry, trips, period).agg(*_bad_locations())


def _bad_locations() -> list[Column]:
    return [
        F.count_if(is_bad(location_axis(F.col("fields"), axis), limit)).alias(name)
        for name, axis, limit in (("lat", 1, LATITUDE), ("lon", 0, LONGITUDE))
    ]


def _begun(spans: DataFrame, period: ReportPeriod, system_id: str | None) -> DataFrame:
    """Valid trips that began in the period."""
    return of_system(spans, system_id).where(
        (F.col("is_valid_rental") == 1)
        & (F.col("started_at_ms") >= period.start_ms)
        & (F.col("started_at_ms") < period.end_ms)
        & (F.col("ended_at_ms") >= F.col("started_at_ms"))
    )


def _during(telemetry: DataFrame, trips: DataFrame, period: ReportPeriod) -> DataFrame:
    """Location points between the first start and the last end of their device's trips, with its ``levels``."""
    devices = trips.groupBy(F.col("identifier").alias("deviceid")).agg(
        F.min("started_at_ms").alias("first_ms"),
        F.max("ended_at_ms").alias("last_ms"),
        F.collect_set("level").alias("levels"),
    )
    # The lower bound reaches the scan; each device's own limits follow in the join.
    located = telemetry.where((F.col("msgcode") == "location") & (F.col("ts_ms") >= period.start_ms))
    return located.join(devices, "deviceid").where(F.col("ts_ms").between(F.col("first_ms"), F.col("last_ms")))


def _level(bucket_ms: int) -> Column:
    """The lowest level at which the trip spans at most LEVEL_FACTOR + 1 buckets."""
    level = None
    for number in range(LEVELS - 1):
        width = bucket_ms * LEVEL_FACTOR**number
        fits = F.expr(f"ended_at_ms div {width}L - started_at_ms div {width}L <= {LEVEL_FACTOR}")
        level = F.when(fits, number) if level is None else level.when(fits, number)
    return level.otherwise(LEVELS - 1)
