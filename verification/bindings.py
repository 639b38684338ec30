"""The library's input tables, derived from the driver's sample tables (see FIXTURES.md)."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.period import ReportPeriod
from kerbside.schemas import conform

USER_PERIOD = ReportPeriod(date(1998, 3, 1), date(1998, 6, 1), datetime(1998, 6, 10), "1998-03")
FLEET_PERIOD = ReportPeriod(date(2024, 1, 10), date(2024, 1, 20), datetime(2024, 2, 10), "2024-01")
MONTH = ReportPeriod(date(2024, 1, 1), date(2024, 2, 1), datetime(2024, 2, 10), "2024-01")


def _period(start: date, end: date) -> ReportPeriod:
    return ReportPeriod(start, end, datetime(2024, 2, 10), f"{start}/{end}")


TRIP_PERIODS = [
    *[_period(date(1997, month, 1), date(1997, month + 1, 1)) for month in range(1, 6)],
    _period(date(1997, 2, 15), date(1997, 4, 10)),
    _period(date(1995, 12, 31), date(1996, 1, 1)),
    _period(date(1994, 1, 1), date(1995, 1, 1)),
]
STATE_PERIODS = [
    *[_period(date(2024, 1, day), date(2024, 1, day + 5)) for day in range(1, 27, 5)],
    _period(date(2023, 12, 20), date(2024, 2, 10)),
]

# Stated, so that building a query starts no job that looks for the schema.
SAMPLE_SCHEMAS = {
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,
                   l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,
                   l_shipdate TIMESTAMP_NTZ""",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "region": "r_regionkey INT, r_name STRING",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SAMPLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table, as the trip facts are; the scan shows which filters reach it."""
    rows = _read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 8 + l_linenumber AS id",
        "l_partkey div 10 AS user_id",
        "l_suppkey AS vehicle_id",
        "concat('S', cast(l_partkey % 5 AS string)) AS system_id",
        "l_extendedprice - 2000D AS distance_in_meters",
        "l_extendedprice * (1D - l_discount) - 5000D AS price_before_discount",
        "cast(l_quantity * 60 AS int) AS billable_duration_in_seconds",
        "CASE l_returnflag WHEN 'R' THEN 'refunded' WHEN 'A' THEN 'paid' END AS charge_state",
        "cast(l_shipdate AS date) AS system_date",
        "l_shipdate AS system_started_at",
        "timestampadd(SECOND, cast(l_quantity * 60 AS int), l_shipdate) AS system_ended_at",
        "38.8D + l_discount AS start_point_lat",
        # Two cities lie beyond 100 degrees, one of them in the west.
        "CASE l_partkey % 5 WHEN 2 THEN 139.7D WHEN 4 THEN -122.4D ELSE -77.0D END - l_tax AS start_point_lon",
        "38.8D - l_discount AS end_point_lat",
        "CASE l_partkey % 5 WHEN 2 THEN 139.7D WHEN 4 THEN -122.4D ELSE -77.0D END + l_tax AS end_point_lon",
    )
    return conform(rows, "trips")


def trips24(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips with their dates moved into January 2024, where the events are."""
    moved = F.expr("date_add(date'2024-01-01', datediff(system_date, date'1995-01-01') % 30)")
    return trips(spark, sf_dir).withColumn("system_date", moved)


def transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "events").selectExpr(
        "event_id AS id",
        "user_id + 3 AS vehicle_id",
        # Every seventh state was in the next city.
        "concat('S', cast((user_id + cast(event_id % 7 = 0 AS int)) % 5 AS string)) AS system_id",
        "ts AS started_at",
        "CASE WHEN value >= 2 THEN timestampadd(SECOND, cast(floor(value * 360) AS int), ts) END AS ended_at",
        "CASE WHEN event_type IN ('error', 'click') THEN 'nonoperational' ELSE 'operational' END AS operationality",
        """CASE WHEN event_type = 'error' THEN array('blocked', 'battery_discharged')
                WHEN event_type = 'click' AND value > 20 THEN array('battery_discharged')
                WHEN event_type = 'click' THEN array('blocked') END AS operationality_reason""",
    )
    return conform(rows, "transitions")


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS id",
        "lower(s_name) AS license_plate",
        "concat('VIN', cast(s_suppkey AS string)) AS chassis_number",
        "CASE WHEN s_nationkey % 2 = 0 THEN 'Niu' ELSE 'Other' END AS vehicle_kind_name",
    )
    return conform(rows, "vehicles")


def systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "region").selectExpr(
        "concat('S', cast(r_regionkey AS string)) AS id",
        """CASE r_regionkey WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'Europe/Paris'
                WHEN 2 THEN 'Asia/Tokyo' ELSE 'UTC' END AS time_zone""",
        """CASE WHEN r_regionkey % 2 = 0
                THEN concat('{"type":"Polygon","coordinates":[[[-77.', r_regionkey, '25,38.8],[-77,39],[-76.5,38.8],[-77.',
                            r_regionkey, '25,38.8]]]}')
                ELSE concat('{"type":"MultiPolygon","coordinates":[[[[-78.', r_regionkey, '25,37.5],[-78,38],[-77.5,37.5],[-78.',
                            r_regionkey, '25,37.5]]],[[[1.5,2.5],[2,3],[3,2],[1.5,2.5]]]]}') END AS geofence_geojson""",
    )
    return conform(rows, "systems")


def rental_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "events").selectExpr(
        "event_id AS rental_id",
        "user_id AS identifier",
        "unix_millis(cast(ts AS timestamp)) AS started_at_ms",
        "unix_millis(cast(ts AS timestamp)) + cast(floor(value * 600000) AS bigint) AS ended_at_ms",
        "concat('S', cast(user_id % 5 AS string)) AS system_id",
        "CASE WHEN event_type = 'signup' AND event_id % 7 <> 0 THEN 1 ELSE 0 END AS is_valid_rental",
    )
    return conform(rows, "rental_spans")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points whose location is an array, a string holding an array, or malformed text."""
    rows = (
        _read(spark, sf_dir, "events")
        .withColumn(
            "place",
            F.expr(
                "concat(CASE user_id % 5 WHEN 2 THEN '[139.' WHEN 4 THEN '[-122.' ELSE '[-77.' END, lpad(cast(cast(floor(value * 100) AS bigint) AS string), 5, '0'), cast(event_id % 10 AS string),"
                " ',38.', lpad(cast(cast(floor(value * 100) AS bigint) AS string), 5, '0'), cast(event_id % 10 AS string), ']')"
            ),
        )
        .selectExpr(
            "user_id AS deviceid",
            "unix_millis(cast(ts AS timestamp)) AS ts_ms",
            "CASE WHEN event_type = 'view' THEN 'location' ELSE event_type END AS msgcode",
            """CASE WHEN event_id % 11 = 0 THEN '{"location":['
                    WHEN event_id % 5 = 0 THEN concat('{"location":"', place, '","speed":1}')
                    ELSE concat('{"location":', place, '}') END AS fields""",
        )
    )
    return conform(rows, "telemetry")


def constants(spark: SparkSession) -> DataFrame:
    """One month's hand-kept counts (fixed values)."""
    counts = {
        "total_vehicles": 407,
        "nonoperational_LS": 0,
        "M_lights": 33,
        "M_wheeltire": 1,
        "M_seat": 5,
        "M_brakes": 7,
        "M_frame": 19,
        "M_gearsystem": 0,
        "M_lock": 0,
        "M_battery": 13,
        "M_otherrepair": 0,
    }
    return spark.range(1).select(*[F.lit(count).alias(name) for name, count in counts.items()])
