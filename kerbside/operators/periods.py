"""Several reporting periods in one pass: rows and spans dealt to the periods they belong to.

A period is listed under every calendar month it touches, a row under the month of its
moment, a span under the months that can make it count. So rows and periods meet by an
equi-join on the month, and the exact limits follow as a condition; the input is read once,
however many periods there are and whether or not they overlap. The table of periods has a
row per period and month, so Spark broadcasts it by its own measure.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.columns import DAY_MICROS, METERS_PER_MILE, local_time, micros, moment_like
from kerbside.operators.states import SPAN_LABELS, state_category
from kerbside.operators.trips import in_miles, length_stats, of_system, valid_trips
from kerbside.period import CORRECTED, ReportPeriod, check_semantics


def period_months(spark: SparkSession, periods: Sequence[ReportPeriod], semantics: str = "reference") -> DataFrame:
    """``period, starts, ends, cutoff, month``: one row per period and calendar month it touches.

    ``period`` is the label; two periods with one label count as an error.
    """
    labels = [period.label for period in periods]
    if not labels or len(set(labels)) < len(labels):
        raise ValueError(f"periods need labels of their own, got {labels}")
    rows = [(p.label, p.start, p.end, p.cutoff(semantics)) for p in periods]
    table = spark.createDataFrame(rows, "period string, starts date, ends date, cutoff date")
    months = F.sequence(F.trunc("starts", "month"), F.trunc(F.date_sub("ends", 1), "month"), F.expr("interval 1 month"))
    return table.withColumn("month", F.explode(months))


def by_period(rows: DataFrame, column: str, periods: Sequence[ReportPeriod]) -> DataFrame:
    """``rows`` with ``period``: each once for every period in which ``column`` lies."""
    first, last = min(p.start for p in periods), max(p.end for p in periods)
    months = period_months(rows.sparkSession, periods).select("period", "starts", "ends", F.col("month").alias("period_month"))
    moment = F.col(column)
    kind = rows.schema[column].dataType
    # The outermost limits reach the scan.
    within = rows.where((moment >= moment_like(rows, column, first)) & (moment < moment_like(rows, column, last)))
    inside = (moment >= F.col("starts").cast(kind)) & (moment < F.col("ends").cast(kind))
    dealt = within.join(months, (F.trunc(moment, "month") == F.col("period_month")) & inside)
    return dealt.drop("starts", "ends", "period_month")


def user_stats_by_period(trips: DataFrame, periods: Sequence[ReportPeriod], system_id: str | None = None) -> DataFrame:
    """The user report's columns for every period, which comes first: one scan of the trips."""
    valid = by_period(valid_trips(trips, system_id), "system_date", periods)
    rows = valid.select("period", "user_id", "id", F.col("distance_in_meters").alias("meters"))
    stats = length_stats(rows, ["period", "user_id"])
    return stats.select("period", "user_id", *in_miles(METERS_PER_MILE)).drop("length_count")


def clamped_by_period(
    transitions: DataFrame, periods: Sequence[ReportPeriod], system_id: str | None = None, semantics: str = "reference"
) -> DataFrame:
    """:func:`kerbside.operators.states.clamp_spans` for every period: ``period`` and its columns.

    The reference rule counts a span where it starts or ends, so it is listed under those two
    months; ``corrected`` counts it where it overlaps, so it is listed under all its months
    within the outermost limits. A span meets a period once: by its start, else by its end;
    or in the first month that they share.
    """
    corrected = check_semantics(semantics) == CORRECTED
    first, last = min(p.start for p in periods), max(p.cutoff(semantics) for p in periods)
    low, high = local_time(first), local_time(last)
    started, ended = F.col("started_at"), F.col("ended_at")
    starts, cutoff = F.col("starts").cast("timestamp_ntz"), F.col("cutoff").cast("timestamp_ntz")
    log = of_system(transitions, system_id)
    if corrected:
        log = log.where((started < high) & (ended.isNull() | (ended > low)))
        from_month, to_month = _month(F.greatest(started, low)), _month(F.least(F.coalesce(ended, high), high))
        listed = F.transform(F.sequence(from_month, to_month, F.expr("interval 1 month")), lambda m: F.struct(m.alias("month")))
        counts = (started < cutoff) & (ended.isNull() | (ended > starts))
        once = F.col("at.month") == F.greatest(F.trunc("starts", "month"), _month(F.greatest(started, low)))
        meets = counts & once
    else:
        begins, ends = started.between(low, high), ended.between(low, high)
        log = log.where(begins | ends)
        listed = F.array_compact(
            F.array(
                *[
                    F.when(known, F.struct(_month(moment).alias("month"), F.lit(by_end).alias("by_end")))
                    for known, moment, by_end in ((begins, started, False), (ends, ended, True))
                ]
            )
        )
        begins_here = F.coalesce(started.between(starts, cutoff), F.lit(False))
        meets = F.when(F.col("at.by_end"), ended.between(starts, cutoff) & ~begins_here).otherwise(begins_here)
    months = period_months(transitions.sparkSession, periods, semantics)
    dealt = log.withColumn("at", F.explode(listed)).join(months, (F.col("at.month") == F.col("month")) & meets)
    return dealt.select(
        "period",
        "vehicle_id",
        F.when(started < starts, starts).otherwise(started).alias("start_block"),
        F.when((ended > cutoff) | ended.isNull(), cutoff).otherwise(ended).alias("end_block"),
        state_category(SPAN_LABELS).alias("operationality_cleaned"),
    )


def time_out_by_period(
    transitions: DataFrame, periods: Sequence[ReportPeriod], system_id: str | None = None, semantics: str = "reference"
) -> DataFrame:
    """``period, vehicle_id, time_out_days``: blocked time of every vehicle and period, from one scan of the log."""
    blocked = clamped_by_period(transitions, periods, system_id, semantics).where(F.col("operationality_cleaned").ilike("blocked"))
    span = micros(F.col("end_block")) - micros(F.col("start_block"))
    return blocked.groupBy("period", "vehicle_id").agg(
        (F.coalesce(F.sum(span), F.lit(0)) / F.lit(float(DAY_MICROS))).alias("time_out_days")
    )


def _month(moment: Column) -> Column:
    return F.trunc(moment, "month")
