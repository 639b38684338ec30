"""Small literal frames for the unit tests."""

from datetime import date, datetime

from kerbside import schemas
from kerbside.period import ReportPeriod

# September 2020, seen on 5 October.
SEPTEMBER = ReportPeriod(date(2020, 9, 1), date(2020, 10, 1), datetime(2020, 10, 5), "2020-09")


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def _frame(spark, schema, rows, defaults):
    names = schema.fieldNames()
    return spark.createDataFrame([tuple({**defaults, **row}.get(name) for name in names) for row in rows], schema)


def trips(spark, *rows):
    defaults = dict(
        id=1,
        user_id=1,
        vehicle_id=1,
        system_id="city",
        distance_in_meters=1609.34,
        price_before_discount=1.0,
        billable_duration_in_seconds=120,
        charge_state="paid",
        system_date=date(2020, 9, 10),
        system_started_at=at("2020-09-10 10:00:00"),
        system_ended_at=at("2020-09-10 10:10:00"),
        start_point_lat=38.9,
        start_point_lon=-77.0,
        end_point_lat=38.8,
        end_point_lon=-77.1,
    )
    return _frame(spark, schemas.TRIPS, rows, defaults)


def transitions(spark, *rows):
    defaults = dict(id=1, vehicle_id=1, system_id="city", operationality="operational")
    return _frame(spark, schemas.TRANSITIONS, rows, defaults)


def vehicles(spark, *rows):
    defaults = dict(license_plate="ab1", chassis_number="VIN", vehicle_kind_name="Niu")
    return _frame(spark, schemas.VEHICLES, rows, defaults)


def systems(spark, *rows):
    defaults = dict(id="city", time_zone="America/New_York")
    return _frame(spark, schemas.SYSTEMS, rows or ({},), defaults)


def spans(spark, *rows):
    defaults = dict(rental_id=1, identifier=7, system_id="city", is_valid_rental=1)
    return _frame(spark, schemas.RENTAL_SPANS, rows, defaults)


def telemetry(spark, *rows):
    defaults = dict(deviceid=7, msgcode="location", fields='{"location":[-77.0,38.9]}')
    return _frame(spark, schemas.TELEMETRY, rows, defaults)


def records(df, *columns):
    """Rows as a sorted list of tuples."""
    names = columns or df.columns
    return sorted((tuple(row) for row in df.select(*names).collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
