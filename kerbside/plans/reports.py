"""The reports, composed from the operators. Column order is part of each report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.columns import METERS_PER_MILE, VEHICLE_METERS_PER_MILE
from kerbside.operators import states
from kerbside.operators.trips import in_miles, in_period, of_system, total_trips, trip_stats, valid_trips
from kerbside.period import CORRECTED, ReportPeriod, check_semantics
from kerbside.schemas import CONSTANTS, INCIDENTS

USER_COLUMNS = ["user_id", "num_trips", "mean_trip_length", "median_trip_length", "std_trip_length"]

SUMMARY_COLUMNS = [
    "total_trips",
    "total_vehicles",
    "nonoperational_LS",
    "nonoperational_M",
    "M_lights",
    "M_wheeltire",
    "M_seat",
    "M_brakes",
    "M_frame",
    "M_gearsystem",
    "M_lock",
    "M_battery",
    "M_otherrepair",
]


def user_trip_report(
    trips: DataFrame, period: ReportPeriod, system_id: str | None = None, stats: DataFrame | None = None
) -> DataFrame:
    """Trip count and length statistics per user.

    ``stats``, here and below, is the result of :func:`kerbside.operators.trips.report_stats`
    for the same trips, period and city; with it, the trips are not read again.
    """
    if stats is not None:
        return _of_report(stats, "users", "user_id", trips).select("user_id", *in_miles()).select(*USER_COLUMNS)
    valid = in_period(valid_trips(trips, system_id), "system_date", period)
    return trip_stats(valid, ["user_id"]).select(*USER_COLUMNS)


def _of_report(stats: DataFrame, report: str, key: str, trips: DataFrame) -> DataFrame:
    """One report's rows of the shared statistics, the key in its own type again."""
    return stats.where(F.col("report") == report).withColumn(key, F.col("key").cast(trips.schema[key].dataType))


def vehicle_service(
    transitions: DataFrame,
    period: ReportPeriod,
    system_id: str | None = None,
    semantics: str = "reference",
) -> DataFrame:
    """``vehicle_id, transition_count, first_operational, ..., num_days_in_service`` per vehicle."""
    return states.service(transitions, period, system_id, semantics)


def vehicle_report(
    trips: DataFrame,
    transitions: DataFrame,
    vehicles: DataFrame,
    periods: DataFrame,
    period: ReportPeriod,
    system_id: str | None = None,
    semantics: str = "reference",
    stats: DataFrame | None = None,
) -> DataFrame:
    """Trip statistics, days in service and maintenance per vehicle.

    ``periods`` is the result of :func:`kerbside.operators.states.state_periods`, or of
    :func:`kerbside.operators.states.blocked_periods`, which reads less. The result starts with ``fleet_id``, the internal vehicle id, which the sink sorts by and
    drops (:func:`vehicle_rows`).

    Every input is reduced to one row per vehicle before it is joined. The reference joins
    trips to transitions first, which repeats each of n trips k times. Mean and minimum do
    not notice; the sample deviation becomes sqrt(k * SS / (k * n - 1)), with SS the sum of
    squared differences. A vehicle without transitions shows its median and maintenance only.
    """
    corrected = check_semantics(semantics) == CORRECTED
    mile = METERS_PER_MILE if corrected else VEHICLE_METERS_PER_MILE
    if stats is None:
        valid = in_period(valid_trips(trips, system_id), "system_date", period).where(F.col("vehicle_id").isNotNull())
        by_vehicle = trip_stats(valid, ["vehicle_id"], mile, METERS_PER_MILE)
    else:
        by_vehicle = _of_report(stats, "vehicles", "vehicle_id", trips).select("vehicle_id", *in_miles(mile, METERS_PER_MILE))
    service = vehicle_service(transitions, period, system_id, semantics)
    # A vehicle id listed more than once multiplies its trips again, per plate and chassis.
    identities = (
        vehicles.groupBy(F.col("id").alias("vehicle_id"), "license_plate", "chassis_number")
        .agg(F.count(F.lit(1)).alias("listings"))
        .withColumn("is_listed", F.lit(True))
    )
    maintenance = states.maintenance_counts(periods, period, system_id, semantics)

    known = F.col("transition_count").isNotNull()
    n = F.col("length_count")
    copies = F.col("transition_count") * F.coalesce("listings", F.lit(1))
    squares = F.coalesce(F.pow("std_trip_length", F.lit(2.0)), F.lit(0.0)) * (n - 1)
    repeated_std = F.when(copies * n > 1, F.sqrt(copies * squares / (copies * n - 1)))
    # Only vehicles with transitions meet their listing in the reference's join.
    rows = (
        by_vehicle.join(service, "vehicle_id", "left")
        .withColumn("listed_id", F.when(known, F.col("vehicle_id")))
        .join(identities.withColumnRenamed("vehicle_id", "listed_id"), "listed_id", "left")
        .join(maintenance, "vehicle_id", "left")
    )
    return rows.select(
        F.col("vehicle_id").alias("fleet_id"),
        F.col("chassis_number").alias("vehicle_id"),
        F.upper("license_plate").alias("DC_vehicle_id"),
        F.col("first_operational").cast("timestamp").alias("entered_service"),
        "num_days_in_service",
        F.when(known, F.col("mean_trip_length")).alias("mean_trip_length"),
        "median_trip_length",
        F.when(known, F.col("std_trip_length") if corrected else repeated_std).alias("std_trip_length"),
        (F.coalesce("maintenance", F.lit(0)) if corrected else F.col("maintenance")).alias("maintenance"),
        F.lit(None).cast("double").alias("exit_service"),
    )


def vehicle_rows(report: DataFrame, semantics: str = "reference") -> DataFrame:
    """The vehicle report as written: ordered by internal id, which is not shown.

    The reference's counts of maintenance may be missing, which makes them fractions (4.0).
    """
    if check_semantics(semantics) != CORRECTED:
        report = report.withColumn("maintenance", F.col("maintenance").cast("double"))
    return report.orderBy("fleet_id").drop("fleet_id")


def monthly_summary(
    trips: DataFrame,
    periods: DataFrame,
    constants: DataFrame,
    period: ReportPeriod,
    system_id: str | None = None,
    semantics: str = "reference",
    stats: DataFrame | None = None,
) -> DataFrame:
    """One row: trips, vehicles in maintenance, and the hand-kept counts in ``constants``.

    Constants with a ``month`` (as 2020-09) or a ``system_id`` are those of the period's
    first month and of the city. Anything but one row of them fails the query.
    """
    of = constants
    if "month" in constants.columns:
        of = of.where(F.col("month") == period.start.strftime("%Y-%m"))
    if "system_id" in constants.columns:
        of = of.where(F.col("system_id").eqNullSafe(F.lit(system_id)))
    names = CONSTANTS.fieldNames()
    counted = of.agg(F.count(F.lit(1)).alias("rows"), *[F.first(name).alias(name) for name in names])
    one = F.col("rows") == 1
    wrong = F.raise_error(F.concat(F.lit("constants must have one row for the period, found "), F.col("rows").cast("string")))
    if stats is None:
        total = total_trips(trips, period, system_id)
    else:
        total = stats.where(F.col("report") == "total").agg(F.coalesce(F.sum("num_trips"), F.lit(0)))
    return counted.select(
        *[F.when(one, F.col(name)).otherwise(wrong).alias(name) for name in names],
        total.scalar().alias("total_trips"),
        states.vehicles_in_maintenance(periods, period, system_id, semantics).scalar().alias("nonoperational_M"),
    ).select(*SUMMARY_COLUMNS)


def incident_template(spark: SparkSession) -> DataFrame:
    """An empty incident table with the columns a city fills in."""
    return spark.createDataFrame([], INCIDENTS)
