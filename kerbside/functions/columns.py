"""Column expressions shared by the operators. All are Spark built-ins."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values. The vehicle report divides by 1607.34, everything else by 1609.34.
METERS_PER_MILE = 1609.34
VEHICLE_METERS_PER_MILE = 1607.34

DAY_MICROS = 86_400_000_000

# The largest degrees there are.
LATITUDE, LONGITUDE = 90.0, 180.0
COORDINATE_TYPE = "decimal(8,5)"
EXACT_TYPE = "decimal(38,20)"


def local_time(moment: date | datetime) -> Column:
    """A zoneless timestamp literal. ``F.lit(datetime)`` is zoned and would block pushdown."""
    return F.lit(str(moment)).cast("timestamp_ntz")


def moment_like(df: DataFrame, column: str, moment: date | datetime) -> Column:
    """A literal of the column's own type, so comparing never casts the column."""
    return F.lit(str(moment)).cast(df.schema[column].dataType)


def micros(column: Column) -> Column:
    """Microseconds since the epoch of a zoneless or zoned timestamp (session zone UTC)."""
    return F.unix_micros(column.cast("timestamp"))


def days_between(start: Column, end: Column) -> Column:
    """``end - start`` as fractional days."""
    return (micros(end) - micros(start)) / F.lit(float(DAY_MICROS))


def miles(meters: Column, meters_per_mile: float = METERS_PER_MILE) -> Column:
    return meters / F.lit(float(meters_per_mile))


def coordinate(column: Column, limit: float, bad: str = "fail", exact: Column | None = None) -> Column:
    """Degrees to five places, rounding half away from zero; ``exact`` has digits a double has not.

    Degrees beyond ``limit`` either way, and NaN, fail the query; with ``bad="null"`` they
    become NULL. No valid degree is lost: ``decimal(8,5)`` holds 180.
    """
    check_bad(bad)
    known = F.abs(column) <= F.lit(limit)
    rounded = F.when(known, (column if exact is None else exact).cast(COORDINATE_TYPE))
    if bad == "null":
        return rounded
    message = F.concat(F.lit(f"degrees beyond {limit:g}: "), column.cast("string"))
    return F.when(column.isNull() | known, rounded).otherwise(F.raise_error(message))


def is_bad(column: Column, limit: float) -> Column:
    """Whether the degrees are there and :func:`coordinate` does not take them."""
    return column.isNotNull() & ~(F.abs(column) <= F.lit(limit))


def check_bad(bad: str) -> str:
    if bad not in ("fail", "null"):
        raise ValueError(f"bad must be 'fail' or 'null', got {bad!r}")
    return bad


def location_axis(fields: Column, axis: int, kind: str = "double") -> Column:
    """Element ``axis`` of ``location`` (0 longitude, 1 latitude) in telemetry JSON text.

    ``location`` is an array, or a string that holds an array. Malformed JSON and a missing
    key or element give NULL.
    """
    document = F.try_parse_json(fields)
    nested = F.try_parse_json(F.try_variant_get(document, "$.location", "string"))
    return F.coalesce(
        F.try_variant_get(document, f"$.location[{axis}]", kind),
        F.try_variant_get(nested, f"$[{axis}]", kind),
    )
