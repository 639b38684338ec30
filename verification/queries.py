"""Every registered query: an operator or report applied to the whole sample tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, DoubleType, TimestampNTZType, TimestampType

from kerbside.functions.columns import VEHICLE_METERS_PER_MILE
from kerbside.operators import areas, periods, states, telemetry, trips
from kerbside.plans import reports
from kerbside.session import configure
from verification import bindings as b

# Small enough to cut the sample tables' keys, so that the oracle checks the split paths.
SMALL_SPLIT = 40
CITY = "S1"
FAR_CITY = "S2"


def plain(df: DataFrame) -> DataFrame:
    """Values as both engines print them: rounded doubles, moments as text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, DoubleType):
            # Seven places: whole seconds in days never end in a tie there.
            column = F.round(column, 7)
        elif isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _changes(spark: SparkSession, sf: str, **options) -> DataFrame:
    return states.state_changes(
        b.transitions(spark, sf), b.systems(spark, sf), b.vehicles(spark, sf), b.FLEET_PERIOD, **options
    )


def _periods(spark: SparkSession, sf: str, semantics: str = "reference", **options) -> DataFrame:
    return states.state_periods(_changes(spark, sf, semantics=semantics, **options))


def _blocked(spark: SparkSession, sf: str, system_id: str | None = None, semantics: str = "reference") -> DataFrame:
    return states.blocked_periods(
        b.transitions(spark, sf), b.systems(spark, sf), b.vehicles(spark, sf), b.FLEET_PERIOD, system_id, semantics
    )


def _vehicle_report(spark: SparkSession, sf: str, semantics: str = "reference", system_id: str | None = None) -> DataFrame:
    return reports.vehicle_report(
        b.trips24(spark, sf),
        b.transitions(spark, sf),
        b.vehicles(spark, sf),
        _blocked(spark, sf, system_id, semantics),
        b.FLEET_PERIOD,
        system_id,
        semantics,
    )


def valid_trips(spark, sf):
    return trips.valid_trips(b.trips(spark, sf)).drop("system_ended_at")


def valid_trips_of_city(spark, sf):
    return trips.valid_trips(b.trips(spark, sf), CITY).select("id", "user_id", "vehicle_id", "system_id")


def trips_in_period(spark, sf):
    return trips.in_period(b.trips(spark, sf), "system_date", b.USER_PERIOD).select(
        "id", "user_id", "vehicle_id", "system_date"
    )


def trip_stats_by_vehicle(spark, sf):
    return trips.trip_stats(trips.valid_trips(b.trips(spark, sf)), ["vehicle_id"], VEHICLE_METERS_PER_MILE)


def trip_stats_by_city_split(spark, sf):
    """Few, large groups."""
    return trips.trip_stats(trips.valid_trips(b.trips(spark, sf)), ["system_id"])


def user_trip_report(spark, sf):
    return reports.user_trip_report(b.trips(spark, sf), b.USER_PERIOD)


def user_trip_report_split(spark, sf):
    """Trips in another order."""
    return reports.user_trip_report(b.trips(spark, sf).repartition("id"), b.USER_PERIOD)


def user_trip_report_of_city(spark, sf):
    return reports.user_trip_report(b.trips(spark, sf), b.USER_PERIOD, CITY)


def report_stats(spark, sf):
    """Users, vehicles and the total from one scan."""
    return trips.report_stats(b.trips(spark, sf), b.USER_PERIOD)


def report_stats_of_city(spark, sf):
    return trips.report_stats(b.trips(spark, sf), b.USER_PERIOD, CITY)


def user_stats_by_period(spark, sf):
    """Eight periods, of which some overlap, some leave gaps, and one spans a year."""
    return periods.user_stats_by_period(b.trips(spark, sf), b.TRIP_PERIODS)


def time_out_by_period(spark, sf):
    """Seven periods of a few days each."""
    return periods.time_out_by_period(b.transitions(spark, sf), b.STATE_PERIODS)


def time_out_by_period_corrected(spark, sf):
    return periods.time_out_by_period(b.transitions(spark, sf), b.STATE_PERIODS, semantics="corrected")


def first_operational(spark, sf):
    return states.first_operational(b.transitions(spark, sf))


def possible_days(spark, sf):
    return states.possible_days(states.first_operational(b.transitions(spark, sf)), b.FLEET_PERIOD).select(
        "vehicle_id", "possible_days"
    )


def state_category(spark, sf):
    return b.transitions(spark, sf).select(
        "id",
        states.state_category(states.SPAN_LABELS).alias("operationality_cleaned"),
        states.state_category(states.CHANGE_LABELS).alias("operationality_category"),
    )


def clamped_spans(spark, sf):
    return states.clamp_spans(b.transitions(spark, sf), b.FLEET_PERIOD)


def clamped_spans_corrected(spark, sf):
    return states.clamp_spans(b.transitions(spark, sf), b.FLEET_PERIOD, semantics="corrected")


def time_out_days(spark, sf):
    return states.time_out(states.clamp_spans(b.transitions(spark, sf), b.FLEET_PERIOD))


def days_in_service(spark, sf):
    log = b.transitions(spark, sf)
    possible = states.possible_days(states.first_operational(log), b.FLEET_PERIOD)
    out = states.time_out(states.clamp_spans(log, b.FLEET_PERIOD))
    return states.days_in_service(possible, out).select("vehicle_id", "num_days_in_service")


def vehicle_service(spark, sf):
    """The same in one pass."""
    return reports.vehicle_service(b.transitions(spark, sf), b.FLEET_PERIOD).select(
        "vehicle_id", "transition_count", "num_days_in_service"
    )


def state_changes(spark, sf):
    return _changes(spark, sf).drop("time_cell", "changes_before", "changes_all")


def state_changes_split(spark, sf):
    return _changes(spark, sf, cell_rows=SMALL_SPLIT).drop("time_cell", "changes_before", "changes_all")


def state_periods(spark, sf):
    return _periods(spark, sf)


def state_periods_split(spark, sf):
    """Vehicles above and below the split size in one result."""
    return _periods(spark, sf, cell_rows=SMALL_SPLIT)


def maintenance_counts(spark, sf):
    return states.maintenance_counts(_blocked(spark, sf), b.FLEET_PERIOD)


def vehicles_in_maintenance(spark, sf):
    return states.vehicles_in_maintenance(_blocked(spark, sf), b.FLEET_PERIOD)


def maintenance_counts_of_city(spark, sf):
    return states.maintenance_counts(_blocked(spark, sf, CITY), b.FLEET_PERIOD, CITY)


def vehicles_in_maintenance_of_city(spark, sf):
    return states.vehicles_in_maintenance(_blocked(spark, sf, CITY), b.FLEET_PERIOD, CITY)


def vehicle_report(spark, sf):
    return _vehicle_report(spark, sf)


def vehicle_report_of_city(spark, sf):
    return _vehicle_report(spark, sf, system_id=CITY)


def vehicle_report_corrected(spark, sf):
    return _vehicle_report(spark, sf, semantics="corrected")


def trip_export(spark, sf):
    return trips.trip_export(b.trips(spark, sf), b.vehicles(spark, sf), b.USER_PERIOD)


def trip_export_of_city(spark, sf):
    """A city beyond 100 degrees of longitude."""
    return trips.trip_export(b.trips(spark, sf), b.vehicles(spark, sf), b.USER_PERIOD, FAR_CITY)


def trip_waypoints_of_city(spark, sf):
    """A city beyond 100 degrees of longitude."""
    return telemetry.waypoints(b.rental_spans(spark, sf), b.telemetry(spark, sf), b.MONTH, FAR_CITY)


def trip_waypoints(spark, sf):
    return telemetry.waypoints(b.rental_spans(spark, sf), b.telemetry(spark, sf), b.MONTH)


def trip_waypoints_bucketed(spark, sf):
    """One-minute buckets, so that trips of several levels occur."""
    return telemetry.waypoints(b.rental_spans(spark, sf), b.telemetry(spark, sf), b.MONTH, bucket_ms=60_000)


def total_trips(spark, sf):
    return trips.total_trips(b.trips(spark, sf), b.USER_PERIOD)


def total_trips_of_city(spark, sf):
    return trips.total_trips(b.trips(spark, sf), b.USER_PERIOD, CITY)


def _monthly_summary(spark, sf, system_id=None):
    # The sample trips and states lie in different years, so the dates are moved together.
    moved = b.trips24(spark, sf).withColumn("system_started_at", F.col("system_date").cast("timestamp_ntz"))
    return reports.monthly_summary(moved, _blocked(spark, sf, system_id), b.constants(spark), b.FLEET_PERIOD, system_id)


def monthly_summary(spark, sf):
    return _monthly_summary(spark, sf)


def monthly_summary_of_city(spark, sf):
    return _monthly_summary(spark, sf, CITY)


def service_area_features(spark, sf):
    return _service_area(spark, sf)


def service_area_of_city(spark, sf):
    return _service_area(spark, sf, CITY)


def geometry_collections(spark, sf):
    """Every city's geofence within two collections; those of odd cities lack the last point of a ring."""
    broken = F.regexp_replace("geofence_geojson", r",\[-7[78]\.\d+25,3[78]\.[58]\]\]", "]")
    member = F.when(F.substring("id", 2, 1).cast("int") % 2 == 1, broken).otherwise(F.col("geofence_geojson"))
    inner = F.concat(F.lit('{"type":"GeometryCollection","geometries":['), member, F.lit("]}"))
    outer = F.concat(F.lit('{"type":"GeometryCollection","geometries":[{"type":"Point","coordinates":[1,2]},'), inner, F.lit("]}"))
    cities = b.systems(spark, sf).select("id", F.parse_json(outer).alias("geometry"))
    return cities.select(
        F.col("id").alias("system_id"),
        areas.is_geometry(F.col("geometry")).alias("is_geometry"),
        F.try_variant_get("geometry", "$.geometries[1].geometries[0].type", "string").alias("member_type"),
    )


def _service_area(spark, sf, system_id=None):
    """The geometry's whole list of positions as text, without blanks."""
    geometry = F.col("geometry")
    return areas.service_area(b.systems(spark, sf), system_id).select(
        "system_id",
        "geofence_geojson",
        F.try_variant_get(geometry, "$.type", "string").alias("geometry_type"),
        F.to_json(F.try_variant_get(geometry, "$.coordinates", "variant")).alias("positions"),
    )


_QUERIES = [
    valid_trips,
    valid_trips_of_city,
    trips_in_period,
    trip_stats_by_vehicle,
    trip_stats_by_city_split,
    user_trip_report,
    user_trip_report_split,
    user_trip_report_of_city,
    report_stats,
    report_stats_of_city,
    user_stats_by_period,
    time_out_by_period,
    time_out_by_period_corrected,
    first_operational,
    possible_days,
    state_category,
    clamped_spans,
    clamped_spans_corrected,
    time_out_days,
    days_in_service,
    vehicle_service,
    state_changes,
    state_changes_split,
    state_periods,
    state_periods_split,
    maintenance_counts,
    vehicles_in_maintenance,
    maintenance_counts_of_city,
    vehicles_in_maintenance_of_city,
    vehicle_report,
    vehicle_report_of_city,
    vehicle_report_corrected,
    trip_export,
    trip_export_of_city,
    trip_waypoints,
    trip_waypoints_bucketed,
    trip_waypoints_of_city,
    total_trips,
    total_trips_of_city,
    monthly_summary,
    monthly_summary_of_city,
    service_area_features,
    service_area_of_city,
    geometry_collections,
]


def _registered(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(query(configure(spark), sf_dir))

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: _registered(query) for query in _QUERIES}
