"""Explicit schemas of every input table and of the incident template."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

_LONG, _INT, _DOUBLE, _TEXT = LongType(), IntegerType(), DoubleType(), StringType()
_LOCAL = TimestampNTZType()


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


TRIPS = _schema(
    id=_LONG,
    user_id=_LONG,
    vehicle_id=_LONG,
    system_id=_TEXT,
    distance_in_meters=_DOUBLE,
    price_before_discount=_DOUBLE,
    billable_duration_in_seconds=_INT,
    charge_state=_TEXT,
    system_date=DateType(),
    system_started_at=_LOCAL,
    system_ended_at=_LOCAL,
    start_point_lat=_DOUBLE,
    start_point_lon=_DOUBLE,
    end_point_lat=_DOUBLE,
    end_point_lon=_DOUBLE,
)

# ``id`` only breaks ties between states that start at the same instant.
TRANSITIONS = _schema(
    id=_LONG,
    vehicle_id=_LONG,
    system_id=_TEXT,
    started_at=_LOCAL,
    ended_at=_LOCAL,
    operationality=_TEXT,
    operationality_reason=ArrayType(_TEXT),
)

VEHICLES = _schema(id=_LONG, license_plate=_TEXT, chassis_number=_TEXT, vehicle_kind_name=_TEXT)

SYSTEMS = _schema(id=_TEXT, time_zone=_TEXT, geofence_geojson=_TEXT)

RENTAL_SPANS = _schema(
    rental_id=_LONG,
    identifier=_LONG,
    started_at_ms=_LONG,
    ended_at_ms=_LONG,
    system_id=_TEXT,
    is_valid_rental=_INT,
)

TELEMETRY = _schema(deviceid=_LONG, ts_ms=_LONG, msgcode=_TEXT, fields=_TEXT)

CONSTANTS = _schema(
    total_vehicles=_INT,
    nonoperational_LS=_INT,
    M_lights=_INT,
    M_wheeltire=_INT,
    M_seat=_INT,
    M_brakes=_INT,
    M_frame=_INT,
    M_gearsystem=_INT,
    M_lock=_INT,
    M_battery=_INT,
    M_otherrepair=_INT,
)

# The template lists names only; these types are the ones its columns have elsewhere.
INCIDENTS = _schema(
    trip_id=_LONG,
    vehicle_id=_TEXT,
    incident_severity=_TEXT,
    electrical_vehicle_check=_TEXT,
    police_report_number=_TEXT,
    incident_notes=_TEXT,
    incident_lat=_DOUBLE,
    incident_lon=_DOUBLE,
    vehicle_incident_path=_TEXT,
    incident_time=TimestampType(),
)

INPUTS = {
    "trips": TRIPS,
    "transitions": TRANSITIONS,
    "vehicles": VEHICLES,
    "systems": SYSTEMS,
    "rental_spans": RENTAL_SPANS,
    "telemetry": TELEMETRY,
    "constants": CONSTANTS,
}


# Key columns whose ids some warehouses keep as text; they stay text then.
TEXT_IDS = {"user_id", "deviceid", "identifier"}

# Which month and city the counts in ``constants`` are for. A table without them serves any.
CONSTANTS_OF = _schema(month=_TEXT, system_id=_TEXT)


def conform(df: DataFrame, name: str) -> DataFrame:
    """Check ``df`` against the named input schema and keep exactly its columns.

    Types that hold less are widened: smaller integers, floats and decimals where a double
    is expected, and a moment where its date is. A missing column or any other type is an error raised before
    any job runs.
    """
    expected = list(INPUTS[name].fields)
    found = {field.name: field.dataType for field in df.schema.fields}
    if name == "constants":
        expected += [field for field in CONSTANTS_OF.fields if field.name in found]
    problems, columns = [], []
    for field in expected:
        column = F.col(f"`{field.name}`")
        if field.name not in found:
            problems.append(f"{field.name}: missing")
        elif _compatible(found[field.name], field.dataType) or (
            field.name in TEXT_IDS and isinstance(found[field.name], StringType)
        ):
            columns.append(column)
        elif isinstance(found[field.name], _NARROWER.get(type(field.dataType), ())):
            columns.append(column.cast(field.dataType).alias(field.name))
        else:
            problems.append(
                f"{field.name}: expected {field.dataType.simpleString()}, "
                f"found {found[field.name].simpleString()}"
            )
    if problems:
        raise ValueError(f"table {name!r} does not match its schema: " + "; ".join(problems))
    return df.select(*columns)


_SMALL = (ByteType, ShortType, IntegerType)
_NARROWER = {
    IntegerType: (ByteType, ShortType),
    LongType: _SMALL,
    DoubleType: (*_SMALL, FloatType, DecimalType),
    DateType: (TimestampType, TimestampNTZType),
}


def _compatible(found, expected) -> bool:
    # Nullability of array elements differs between sources and does not matter here.
    if isinstance(expected, ArrayType):
        return isinstance(found, ArrayType) and found.elementType == expected.elementType
    return found == expected
