"""Report files. Each report is a directory named after the period's label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, TimestampNTZType, TimestampType

from kerbside.operators.areas import feature_collection
from kerbside.period import ReportPeriod

# Whole seconds as 2020-09-01 12:00:00+00:00; six more digits where there is a fraction.
SECONDS_FORMAT = "yyyy-MM-dd HH:mm:ss"
MICROS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def report_path(path: str, period: ReportPeriod, name: str) -> str:
    return f"{path.rstrip('/')}/{period.label}_{name}"


def write_csv_report(
    df: DataFrame,
    path: str,
    period: ReportPeriod,
    name: str,
    single_file: bool = False,
    index: bool = False,
) -> str:
    """Write ``df`` as CSV with a header line; NULL and NaN are empty fields.

    Doubles and decimals are written as data frames write them (:func:`number_text`).

    Executors write their parts side by side, each with the header. ``single_file`` is for
    results of a fixed number of rows: it puts everything through one task. ``index`` adds
    the unnamed leading column of the incident template.
    """
    target = report_path(path, period, name)
    rows = _as_text(df)
    if index:
        rows = rows.select(F.lit(None).cast("string").alias(""), "*")
    if single_file:
        rows = rows.coalesce(1)
    options = {
        "header": True,
        "encoding": "UTF-8",
        # Empty names and texts are written as nothing, not as a pair of quotes.
        "emptyValue": "",
        # Text is written as it is: blanks stay, quotes are doubled.
        "escape": '"',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    rows.write.mode("overwrite").options(**options).csv(target)
    return target


def write_feature_collection(features: DataFrame, path: str, period: ReportPeriod, name: str = "service_area.geojson") -> str:
    """Write one FeatureCollection of all cities given, which is empty if there are none.

    One row, as a geofence is a city's master data and not its activity.
    """
    target = report_path(path, period, name)
    feature_collection(features).write.mode("overwrite").text(target)
    return target


def _as_text(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            offset = "xxx" if isinstance(field.dataType, TimestampType) else ""
            fraction = F.date_format(column, "SSSSSS") != "000000"
            column = F.when(fraction, F.date_format(column, MICROS_FORMAT + offset)).otherwise(
                F.date_format(column, SECONDS_FORMAT + offset)
            )
        elif isinstance(field.dataType, (DoubleType, DecimalType)):
            column = number_text(f"cast(`{field.name}` AS double)")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def number_text(number: str) -> Column:
    """The shortest text that gives the double ``number`` (an SQL expression) back.

    Whole numbers end in ``.0``; below 0.0001 and from 1e16 on there is an exponent of two
    digits or more; infinities are ``inf`` and ``-inf``; NaN is NULL. Numbers below 2.3e-308,
    which a double holds with fewer digits, may get more digits than they need.
    """
    # Spark's own text is the same for most numbers between 0.001 and ten million.
    usual = f"cast({number} AS string)"
    # Else digits and exponent: fifteen digits, or as many more as it takes.
    # Of sixteen, also the one below, as the formatter rounds digits that were rounded before.
    digits = [f"format_string('%.{more}e', {number})" for more in (14, 15, 16)]
    digits.insert(2, f"regexp_replace({digits[2]}, '[0-9](e.*)$', '$1')")
    tried = " ".join(f"WHEN cast({text} AS double) = {number} THEN {text}" for text in digits[:3])
    shortest = f"CASE {tried} ELSE {digits[3]} END"
    parts = f"""transform(array({shortest}), text -> named_struct(
        'sign', if({number} < 0, '-', ''),
        'digits', trim(TRAILING '0' FROM regexp_replace(split(text, 'e')[0], '[-.]', '')),
        'power', cast(split(text, 'e')[1] AS int)))"""
    placed = f"""transform({parts}, n -> concat(n.sign, CASE
        WHEN n.power BETWEEN 0 AND 15 THEN
          concat(rpad(left(n.digits, n.power + 1), n.power + 1, '0'), '.', coalesce(nullif(substr(n.digits, n.power + 2), ''), '0'))
        WHEN n.power BETWEEN -4 AND -1 THEN concat('0.', repeat('0', -n.power - 1), n.digits)
        ELSE concat(left(n.digits, 1), if(length(n.digits) > 1, concat('.', substr(n.digits, 2)), ''),
                    if(n.power < 0, 'e-', 'e+'), if(abs(n.power) < 10, '0', ''), abs(n.power)) END))[0]"""
    return F.expr(
        f"""CASE WHEN {number} IS NULL OR isnan({number}) THEN cast(NULL AS string)
                 WHEN abs({number}) = double('infinity') THEN if({number} > 0, 'inf', '-inf')
                 WHEN {number} = 0 OR (NOT contains({usual}, 'E') AND length({usual}) <= 16) THEN {usual}
                 ELSE {placed} END"""
    )
