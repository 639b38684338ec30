"""All seven report files of one city and period."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession

from kerbside.functions.columns import check_bad
from kerbside.operators import states
from kerbside.operators.areas import service_area
from kerbside.operators.telemetry import waypoints
from kerbside.operators.trips import report_stats, trip_export
from kerbside.period import ReportPeriod
from kerbside.plans import reports
from kerbside.schemas import INPUTS
from kerbside.session import configure
from kerbside.sinks.files import write_csv_report, write_feature_collection
from kerbside.sinks.publication import Publication
from kerbside.sources.tables import load_table


def load_inputs(spark: SparkSession, sources: Mapping[str, object]) -> dict[str, DataFrame]:
    """Read every input table; ``sources`` maps a table name to its source, ``*`` is the default."""
    return {name: load_table(spark, name, sources.get(name, sources.get("*"))) for name in INPUTS}


def write_monthly_reports(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    period: ReportPeriod,
    system_id: str,
    path: str,
    semantics: str = "reference",
    bad_coordinates: str = "fail",
) -> dict[str, str]:
    """Write the reports below ``path`` and return where each one is.

    All of them replace those of an earlier run together; if one fails, the earlier ones stay.

    Impossible coordinates stop the job. With ``bad_coordinates="null"`` they are written as
    empty fields, and one more file, ``bad_coordinates``, counts them.
    """
    check_bad(bad_coordinates)
    configure(spark)
    # Two reports need the city's blocked periods of the month: few rows, computed once.
    blocked = states.blocked_periods(
        tables["transitions"], tables["systems"], tables["vehicles"], period, system_id, semantics
    ).persist(StorageLevel.MEMORY_AND_DISK)
    # Three reports need the trips' statistics: a row per user and vehicle, from one read of the trips.
    stats = report_stats(tables["trips"], period, system_id).persist(StorageLevel.MEMORY_AND_DISK)
    users = reports.user_trip_report(tables["trips"], period, system_id, stats)
    vehicles = reports.vehicle_report(
        tables["trips"], tables["transitions"], tables["vehicles"], blocked, period, system_id, semantics, stats
    )
    # Bad coordinates are counted while the reports are written.
    bad_trips, bad_points = (Observation(), Observation()) if bad_coordinates == "null" else (None, None)
    exported = trip_export(tables["trips"], tables["vehicles"], period, system_id, bad_coordinates, bad_trips)
    points = waypoints(
        tables["rental_spans"],
        tables["telemetry"],
        period,
        system_id,
        bad_coordinates=bad_coordinates,
        bad_counts=bad_points,
    )
    summary = reports.monthly_summary(
        tables["trips"], blocked, tables["constants"], period, system_id, semantics, stats
    )
    try:
        with Publication(spark, path, period.label, (f"{period.label}_bad_coordinates",)) as aside:
            written = {
                "users": write_csv_report(users, aside, period, "users"),
                "vehicles": write_csv_report(reports.vehicle_rows(vehicles, semantics), aside, period, "vehicles"),
                "trips": write_csv_report(exported, aside, period, "trips"),
                "waypoints": write_csv_report(points, aside, period, "waypoints"),
                "summary": write_csv_report(summary, aside, period, "summary", single_file=True),
                "service_area": write_feature_collection(service_area(tables["systems"], system_id), aside, period),
                "safety": write_csv_report(
                    reports.incident_template(spark), aside, period, "safety", single_file=True, index=True
                ),
            }
            if bad_coordinates == "null":
                counts = {**bad_trips.get, **{f"waypoint_{axis}": n for axis, n in bad_points.get.items()}}
                row = spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} long" for name in counts))
                written["bad_coordinates"] = write_csv_report(row, aside, period, "bad_coordinates", single_file=True)
        return {name: place.replace(aside, path.rstrip("/"), 1) for name, place in written.items()}
    finally:
        blocked.unpersist()
        stats.unpersist()
