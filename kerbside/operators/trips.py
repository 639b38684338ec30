"""Operators on trips: the valid-trip rule, period filter, length statistics, totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kerbside.functions.columns import LATITUDE, LONGITUDE, METERS_PER_MILE, coordinate, is_bad, miles, moment_like
from kerbside.period import ReportPeriod

# Fixed values.
UNCHARGED_STATES = ("canceled", "refunded")
SHORTEST_TRIP_SECONDS = 120

# Error of the rank sketch: one row in this many.
RANK_ACCURACY = 10_000
# Groups of up to so many lengths are held whole by their sketch.
EXACT_ROWS = RANK_ACCURACY // 2 - 1
# Bounds lie so many times the error away from the middle.
BOUND_RANKS = 3
# Parts in which a large group's trips meet its bounds; few beside its EXACT_ROWS trips.
SALTS = 64

# Exported name: source column and the largest degrees there are.
COORDINATES = {
    "start_lat": ("start_point_lat", LATITUDE),
    "start_lon": ("start_point_lon", LONGITUDE),
    "end_lat": ("end_point_lat", LATITUDE),
    "end_lon": ("end_point_lon", LONGITUDE),
}


def of_system(df: DataFrame, system_id: str | None) -> DataFrame:
    """Rows of one city; ``None`` keeps every city."""
    return df if system_id is None else df.where(F.col("system_id") == system_id)


def valid_trips(trips: DataFrame, system_id: str | None = None) -> DataFrame:
    """Trips that count: paid, moved, two minutes or longer, not canceled or refunded.

    A NULL charge state counts as paid.
    """
    # Written with isNull rather than coalesce, so that the test reaches the parquet scan.
    charged = F.col("charge_state").isNull() | ~F.col("charge_state").isin(*UNCHARGED_STATES)
    return of_system(trips, system_id).where(
        (F.col("price_before_discount") > 0)
        & (F.col("distance_in_meters") > 0)
        & (F.col("billable_duration_in_seconds") >= SHORTEST_TRIP_SECONDS)
        & charged
    )


def in_period(df: DataFrame, column: str, period: ReportPeriod) -> DataFrame:
    """Rows whose ``column`` lies in the period: a half-open range, so scans can skip data."""
    return df.where(_within(df, column, period))


def _within(df: DataFrame, column: str, period: ReportPeriod) -> Column:
    return (F.col(column) >= moment_like(df, column, period.start)) & (F.col(column) < moment_like(df, column, period.end))


def trip_stats(
    valid: DataFrame,
    keys: list[str],
    meters_per_mile: float = METERS_PER_MILE,
    median_meters_per_mile: float | None = None,
) -> DataFrame:
    """Count, mean, exact median and sample deviation of trip length in miles per ``keys``.

    ``length_count`` counts the trips that have a length. A NULL key forms a group, but
    its median is NULL. NaN is left out of the median and makes mean and deviation NaN;
    an infinite length is a length.
    """
    rows = valid.select(*keys, "id", F.col("distance_in_meters").alias("meters"))
    return length_stats(rows, keys).select(*keys, *in_miles(meters_per_mile, median_meters_per_mile))


def in_miles(meters_per_mile: float = METERS_PER_MILE, median_meters_per_mile: float | None = None) -> list[Column]:
    """The statistics' columns in miles, from those of :func:`length_stats`."""
    lower, upper = (miles(F.col(name), median_meters_per_mile or meters_per_mile) for name in ("lower_meters", "upper_meters"))
    return [
        F.col("num_trips"),
        F.col("length_count"),
        miles(F.col("mean_meters"), meters_per_mile).alias("mean_trip_length"),
        ((lower + upper) / 2).alias("median_trip_length"),
        miles(F.col("std_meters"), meters_per_mile).alias("std_trip_length"),
    ]


def report_stats(trips: DataFrame, period: ReportPeriod, system_id: str | None = None) -> DataFrame:
    """The statistics of three reports from one scan of the trips: ``report, key`` and :func:`length_stats`.

    ``report`` is ``users``, ``vehicles`` (trips without a vehicle left out) or ``total``,
    ``key`` the user's or vehicle's id as text, NULL for the total, which has no median. A
    trip counts for users and vehicles by its date, for the total by its start.
    """
    valid = valid_trips(trips, system_id)
    dated, started = (_within(trips, column, period) for column in ("system_date", "system_started_at"))
    member = [
        F.when(dated, F.struct(F.lit("users").alias("report"), F.col("user_id").cast("string").alias("key"))),
        F.when(
            dated & F.col("vehicle_id").isNotNull(),
            F.struct(F.lit("vehicles").alias("report"), F.col("vehicle_id").cast("string").alias("key")),
        ),
        F.when(started, F.struct(F.lit("total").alias("report"), F.lit(None).cast("string").alias("key"))),
    ]
    rows = valid.where(dated | started).select(
        F.inline(F.array_compact(F.array(*member))), "id", F.col("distance_in_meters").alias("meters")
    )
    return length_stats(rows, ["report", "key"])


def length_stats(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per ``keys``: ``num_trips, length_count, mean_meters, std_meters, lower_meters, upper_meters``.

    ``rows`` has the keys, ``id`` and ``meters``; the last two results are the two middle
    lengths (one and the same of an odd number), NULL where a key is.

    One aggregation gives counts, moments and a mergeable sketch of ranks. The sketch of a
    group of up to ``EXACT_ROWS`` lengths holds them all, so its middle is exact. That of a
    larger group gives two bounds between which its middle must lie; the group's trips
    below them are counted, and only those between them are ranked. Trips meet their bounds
    in ``SALTS`` parts per group, so that a group of any size spreads. Before that they
    meet the list of parts, which is empty if no group is large: then the adaptive plan
    drops the second look before it has read anything.
    """
    low, high = 0.5 - BOUND_RANKS / RANK_ACCURACY, 0.5 + BOUND_RANKS / RANK_ACCURACY
    present = " AND ".join(f"`{key}` IS NOT NULL" for key in keys)
    # One SQL text, as building it column by column takes longer than small inputs do.
    # A struct is never NULL, and equal where its fields are, NULLs included. So no join on
    # it adds a filter that would part one use of the aggregation from the other.
    return rows.sparkSession.sql(
        f"""
        WITH lengths AS (
          SELECT struct({", ".join(f"`{key}`" for key in keys)}) AS key, id, meters,
                 CASE WHEN NOT isnan(meters) AND {present} THEN meters END AS length
          FROM {{rows}}
        ),
        sketched AS (
          -- The condition is always true. It needs all results, so that both uses have one plan.
          SELECT * FROM (
            SELECT key, count(id) AS num_trips, count(meters) AS length_count, avg(meters) AS mean_meters,
                   stddev_samp(meters) AS std_meters, count(length) AS ranked,
                   -- Just above a half is the upper of two middle ranks.
                   percentile_approx(length, array({low}D, 0.5D, 0.5D + 1e-9D, {high}D), {RANK_ACCURACY}) AS at
            FROM lengths GROUP BY key
          ) WHERE num_trips + length_count >= 0
              AND (mean_meters IS NULL OR mean_meters + coalesce(std_meters, 0D) IS NOT NULL)
              AND (at IS NULL OR size(at) = 4)
        ),
        bounds AS (
          SELECT key AS of, at[0] AS low, at[3] AS high, ranked, explode(sequence(0, {SALTS - 1})) AS of_salt
          FROM sketched WHERE ranked > {EXACT_ROWS}
        ),
        gate AS (
          -- The parts, if any group is large: at most {SALTS} rows.
          SELECT explode(sequence(0, {SALTS - 1})) AS gate_salt FROM (SELECT count(*) AS n FROM bounds) WHERE n > 0
        ),
        gated AS (
          SELECT /*+ BROADCAST(gate) */ key, length, salt
          FROM (SELECT key, length, cast(pmod(xxhash64(id, meters), {SALTS}) AS int) AS salt FROM lengths)
          JOIN gate ON salt = gate_salt
        ),
        between AS (
          -- All lengths below the bounds count as one, which is NULL.
          -- Merged whatever the sizes: the number of large groups has no bound, so they are never broadcast.
          SELECT /*+ MERGE(bounds) */ of, CASE WHEN length >= low THEN length END AS length, ranked, count(*) AS n
          FROM gated JOIN bounds ON key = of AND salt = of_salt
          WHERE length <= high GROUP BY 1, 2, 3
        ),
        middles AS (
          SELECT of, min(length) FILTER (WHERE through > (ranked - 1) div 2) AS lower,
                 min(length) FILTER (WHERE through > ranked div 2) AS upper,
                 coalesce(max(n) FILTER (WHERE length IS NULL), 0) <= max((ranked - 1) div 2) AS above_low
          FROM (SELECT *, sum(n) OVER (PARTITION BY of ORDER BY length NULLS FIRST) AS through FROM between)
          GROUP BY of
        ),
        found AS (
          -- The sketch's error is bounded; should it be larger, no wrong median is given.
          SELECT *, CASE WHEN ranked > {EXACT_ROWS} AND (upper IS NULL OR NOT above_low)
                         THEN raise_error('the bounds of a median do not hold it') END AS missed
          FROM sketched LEFT JOIN middles ON key = of
        )
        SELECT key.*, num_trips, length_count, mean_meters, std_meters,
               CASE WHEN ranked > {EXACT_ROWS} THEN coalesce(missed, lower) ELSE at[1] END AS lower_meters,
               CASE WHEN ranked > {EXACT_ROWS} THEN coalesce(missed, upper) ELSE at[2] END AS upper_meters
        FROM found
        """,
        rows=rows,
    )


def total_trips(trips: DataFrame, period: ReportPeriod, system_id: str | None = None) -> DataFrame:
    """One row: valid trips that started in the period."""
    started = in_period(valid_trips(trips, system_id), "system_started_at", period)
    return started.agg(F.count("id").alias("total_trips"))


def trip_export(
    trips: DataFrame,
    vehicles: DataFrame,
    period: ReportPeriod,
    system_id: str | None = None,
    bad_coordinates: str = "fail",
    bad_counts: Observation | None = None,
) -> DataFrame:
    """Valid trips that started in the period, row by row, with rounded coordinates.

    Trips of unknown vehicles are left out. Impossible coordinates fail the query, or with
    ``bad_coordinates="null"`` become NULL; :func:`coordinate_overflows` counts them. So does
    ``bad_counts``, while the export is written; parts that Spark computes again after a loss
    may count again. No join hint: Spark broadcasts the vehicles while they are small and
    otherwise shuffles, splitting skewed partitions.
    """
    started = in_period(valid_trips(trips, system_id), "system_started_at", period)
    if bad_counts is not None:
        sources = [source for source, _ in COORDINATES.values()]
        needed = ["id", "vehicle_id", *sources, "system_started_at", "system_ended_at", "distance_in_meters"]
        started = started.select(*needed).observe(bad_counts, *_bad_coordinates())
    identities = vehicles.select(F.col("id").alias("vehicle_id"), "chassis_number")
    return started.join(identities, "vehicle_id").select(
        F.col("id").alias("trip_id"),
        F.col("chassis_number").alias("vehicle_id"),
        *[
            coordinate(F.col(source), limit, bad_coordinates).alias(name)
            for name, (source, limit) in COORDINATES.items()
        ],
        F.col("system_started_at").cast("timestamp").alias("start_time"),
        F.col("system_ended_at").cast("timestamp").alias("end_time"),
        miles(F.col("distance_in_meters")).alias("trip_length"),
    )


def coordinate_overflows(trips: DataFrame, period: ReportPeriod, system_id: str | None = None) -> DataFrame:
    """One row: how many impossible coordinates of each column the export would hold."""
    started = in_period(valid_trips(trips, system_id), "system_started_at", period)
    return started.agg(*_bad_coordinates())


def _bad_coordinates() -> list[Column]:
    return [F.count_if(is_bad(F.col(source), limit)).alias(name) for name, (source, limit) in COORDINATES.items()]
