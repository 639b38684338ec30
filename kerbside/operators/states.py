"""Operators on the vehicle state log: labels, clamped spans, time out, merged periods."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.columns import DAY_MICROS, days_between, local_time, micros
from kerbside.functions.skew import CELL_ROWS, cell_sql, cuts_sql
from kerbside.operators.trips import of_system
from kerbside.period import CORRECTED, ReportPeriod, check_semantics

# Fixed values. The two reports label the same states differently.
SPAN_LABELS = {"battery_discharged": "Battery Discharged", "blocked": "Blocked"}
CHANGE_LABELS = {"battery_discharged": "battery_discharged", "blocked": "blocked"}
NEW_VEHICLE = "new vehicle"
REPORTED_KIND = "Niu"


def first_operational(transitions: DataFrame) -> DataFrame:
    """``vehicle_id, transition_count, first_operational``: earliest operational start, or NULL."""
    operational = F.col("operationality") == "operational"
    return transitions.groupBy("vehicle_id").agg(
        F.count(F.lit(1)).alias("transition_count"),
        F.min(F.when(operational, F.col("started_at"))).alias("first_operational"),
    )


def possible_days(first_op: DataFrame, period: ReportPeriod, semantics: str = "reference") -> DataFrame:
    """Add ``possible_days``: days from entering service, or from period start, to the cutoff."""
    entered = F.col("first_operational")
    start, end = local_time(period.start), local_time(period.end)
    cutoff = local_time(period.cutoff(semantics))
    # NULL first_operational fails the test and gets the whole period.
    entered_in_period = (entered >= start) & (entered < end)
    return first_op.withColumn(
        "possible_days",
        F.when(entered_in_period, days_between(entered, cutoff)).otherwise(days_between(start, cutoff)),
    )


def state_category(labels: Mapping[str, str] = CHANGE_LABELS) -> Column:
    """The state of a transition: why it is out of service, else its operationality.

    An unknown reason (NULL array, or no match beside a NULL element) falls through.
    """
    out = F.col("operationality") == "nonoperational"
    discharged = F.array_contains("operationality_reason", "battery_discharged")
    blocked = F.array_contains("operationality_reason", "blocked")
    return (
        F.when(out & discharged & ~blocked, F.lit(labels["battery_discharged"]))
        .when(out & blocked, F.lit(labels["blocked"]))
        .otherwise(F.col("operationality"))
    )


def touches(period: ReportPeriod, semantics: str = "reference") -> Column:
    """Whether a span counts for the period.

    The reference rule keeps a span if its start or its end lies in the period, which
    drops spans that cover all of it; ``corrected`` keeps every overlapping span.
    """
    started, ended = F.col("started_at"), F.col("ended_at")
    start, cutoff = local_time(period.start), local_time(period.cutoff(semantics))
    if semantics == CORRECTED:
        return (started < cutoff) & (ended.isNull() | (ended > start))
    return started.between(start, cutoff) | ended.between(start, cutoff)


def _cut(period: ReportPeriod, semantics: str) -> tuple[Column, Column]:
    """A span's start and end, cut to the period."""
    started, ended = F.col("started_at"), F.col("ended_at")
    start, cutoff = local_time(period.start), local_time(period.cutoff(semantics))
    return (
        F.when(started < start, start).otherwise(started),
        F.when((ended > cutoff) | ended.isNull(), cutoff).otherwise(ended),
    )


def clamp_spans(
    transitions: DataFrame,
    period: ReportPeriod,
    system_id: str | None = None,
    semantics: str = "reference",
) -> DataFrame:
    """Spans touching the period, cut to it: ``vehicle_id, start_block, end_block, operationality_cleaned``."""
    start, end = _cut(period, semantics)
    return (
        of_system(transitions, system_id)
        .where(touches(period, semantics))
        .select(
            "vehicle_id",
            start.alias("start_block"),
            end.alias("end_block"),
            state_category(SPAN_LABELS).alias("operationality_cleaned"),
        )
    )


def time_out(clamped: DataFrame) -> DataFrame:
    """``vehicle_id, time_out_days``: total length of a vehicle's blocked spans."""
    # Summed as whole microseconds, so the result does not depend on the order of rows.
    span = micros(F.col("end_block")) - micros(F.col("start_block"))
    return (
        clamped.where(F.col("operationality_cleaned").ilike("blocked"))
        .groupBy("vehicle_id")
        .agg((F.coalesce(F.sum(span), F.lit(0)) / F.lit(float(DAY_MICROS))).alias("time_out_days"))
    )


def days_in_service(possible: DataFrame, out: DataFrame, semantics: str = "reference") -> DataFrame:
    """Add ``num_days_in_service``: possible days less time out (``corrected``: at least zero)."""
    days = F.col("possible_days") - F.coalesce(F.col("time_out_days"), F.lit(0.0))
    if check_semantics(semantics) == CORRECTED:
        days = F.greatest(F.lit(0.0), days)
    return possible.join(out, "vehicle_id", "left").withColumn("num_days_in_service", days)


def service(
    transitions: DataFrame,
    period: ReportPeriod,
    system_id: str | None = None,
    semantics: str = "reference",
) -> DataFrame:
    """:func:`first_operational`, :func:`possible_days`, :func:`time_out` and :func:`days_in_service` in one pass.

    The reference rule looks for the first operational state in all cities but for time
    out of service in one; ``corrected`` looks in one for both.
    """
    log = of_system(transitions, system_id) if check_semantics(semantics) == CORRECTED else transitions
    here = F.lit(True) if system_id is None else F.col("system_id") == system_id
    start, end = _cut(period, semantics)
    out = here & touches(period, semantics) & state_category(SPAN_LABELS).ilike("blocked")
    counted = log.groupBy("vehicle_id").agg(
        F.count(F.lit(1)).alias("transition_count"),
        F.min(F.when(F.col("operationality") == "operational", F.col("started_at"))).alias("first_operational"),
        F.sum(F.when(out, micros(end) - micros(start))).alias("out_micros"),
    )
    lasting = F.coalesce("out_micros", F.lit(0)) / F.lit(float(DAY_MICROS))
    days = F.col("possible_days") - lasting
    return possible_days(counted, period, semantics).select(
        "vehicle_id",
        "transition_count",
        "first_operational",
        "possible_days",
        (F.greatest(F.lit(0.0), days) if semantics == CORRECTED else days).alias("num_days_in_service"),
    )


def state_changes(
    transitions: DataFrame,
    systems: DataFrame,
    vehicles: DataFrame,
    period: ReportPeriod,
    semantics: str = "reference",
    kind: str = REPORTED_KIND,
    cell_rows: int = CELL_ROWS,
    whole_log: DataFrame | None = None,
) -> DataFrame:
    """Each transition with its category and the category the vehicle had before.

    Open transitions end at ``period.as_of`` in their city's local time. The previous
    category looks across cities; ``corrected`` looks within one, like the period counter.

    A vehicle's log is cut in time after every ``cell_rows`` transitions or so (``time_cell``;
    NULL where there is no cut; ``whole_log`` may give more rows than ``transitions`` to find
    cuts in). Windows run per cell, and a summary with one row per cell and city is carried
    over the cuts: the category before the cell, and per city the number of changes
    (``changes_before``) and that of all cells (``changes_all``), which states without a
    start share.
    """
    unit = _lag_unit(semantics)
    u = ", ".join(unit)
    whole_log = transitions if whole_log is None else whole_log
    categories = transitions.select(
        "id", "vehicle_id", "system_id", "operationality", "started_at", "ended_at", state_category(CHANGE_LABELS).alias("category")
    )
    # A total order up to equal rows: the summary and the windows must see the same one.
    in_order = f"(PARTITION BY {u}, time_cell ORDER BY started_at NULLS LAST, id, category)"
    # One SQL text, as building it step by step takes longer than small inputs do.
    return transitions.sparkSession.sql(
        f"""
        WITH {cuts_sql("{whole_log}", "vehicle_id", "started_at", "id", cell_rows)},
        placed AS (
          -- The one exchange all windows use. Stated, because a shuffled join on vehicle_id
          -- would satisfy the windows too and leave a large vehicle in one task.
          SELECT /*+ REPARTITION({u}, time_cell) */ log.id, vehicle_id, log.system_id, operationality, time_zone, category, started_at,
                 coalesce(ended_at, convert_timezone('UTC', time_zone, timestamp_ntz'{period.as_of}')) AS ended_at,
                 {cell_sql("started_at", "log.id")} AS time_cell
          FROM {{log}} AS log LEFT JOIN cuts ON vehicle_id = cut_key
          JOIN (SELECT id, time_zone FROM {{systems}}) AS here ON log.system_id = here.id
          JOIN (SELECT id FROM {{vehicles}} WHERE vehicle_kind_name = '{kind}') AS fleet ON vehicle_id = fleet.id
        ),
        within AS (
          SELECT *, lag(false, 1, true) OVER {in_order} AS opens_cell, lag(category) OVER {in_order} AS previous_category FROM placed
        ),
        per_city AS (
          SELECT {u}, time_cell, system_id AS city,
                 count_if(NOT opens_cell AND coalesce(previous_category, '{NEW_VEHICLE}') != category) AS changes,
                 max(CASE WHEN opens_cell THEN struct(category) END) AS opening,
                 max(struct(started_at IS NULL AS undated, started_at, id, category)) AS closing
          FROM within WHERE time_cell IS NOT NULL
          GROUP BY {u}, time_cell, system_id
        ),
        per_cell AS (
          SELECT {u}, time_cell, max(closing).category AS closing_category, max(opening) AS opening,
                 max(city) FILTER (WHERE opening IS NOT NULL) AS opening_city,
                 collect_list(struct(city, changes)) AS cities
          FROM per_city GROUP BY {u}, time_cell
        ),
        linked AS (
          SELECT *, lag(closing_category) OVER (PARTITION BY {u} ORDER BY time_cell) AS category_before
          FROM per_cell
        ),
        counted AS (
          SELECT {u}, time_cell, category_before, c.city,
                 c.changes + CASE WHEN c.city = opening_city
                                   AND coalesce(category_before, '{NEW_VEHICLE}') != opening.category
                                  THEN 1 ELSE 0 END AS changes
          FROM linked LATERAL VIEW explode(cities) AS c
        ),
        accumulated AS (
          SELECT *, coalesce(sum(changes) OVER (PARTITION BY vehicle_id, city ORDER BY time_cell
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                 sum(changes) OVER (PARTITION BY vehicle_id, city) AS total
          FROM counted
        ),
        carried AS (
          SELECT {u}, time_cell, first(category_before) AS category_before,
                 map_from_entries(collect_list(struct(city, before))) AS changes_before,
                 map_from_entries(collect_list(struct(city, total))) AS changes_all
          FROM accumulated GROUP BY {u}, time_cell
        )
        SELECT id, vehicle_id, system_id, operationality, time_zone, category AS operationality_category,
               coalesce(CASE WHEN opens_cell THEN category_before ELSE previous_category END, '{NEW_VEHICLE}')
                 AS last_operationality_category,
               started_at, ended_at, time_cell, changes_before, changes_all
        FROM within LEFT JOIN carried USING ({u}, time_cell)
        """,
        log=categories,
        whole_log=whole_log,
        systems=systems,
        vehicles=vehicles,
    )


def numbered_changes(changes: DataFrame) -> DataFrame:
    """Add ``period``: how often the vehicle has changed category in its city so far.

    Transitions that start at one instant share the number.
    """
    return changes.sparkSession.sql(_NUMBERED, changes=changes)


# The default RANGE frame, which includes all rows of the same instant.
_NUMBERED = """
  SELECT * EXCEPT (number),
         CASE WHEN started_at IS NULL THEN coalesce(try_element_at(changes_all, system_id), number) ELSE number END AS period
  FROM (
    SELECT *, coalesce(try_element_at(changes_before, system_id), 0L)
              + sum(CASE WHEN last_operationality_category != operationality_category THEN 1L ELSE 0L END)
                OVER (PARTITION BY vehicle_id, time_cell, system_id ORDER BY started_at NULLS LAST) AS number
    FROM {changes}
  )"""


def state_periods(changes: DataFrame) -> DataFrame:
    """Consecutive transitions of one category merged into one period with its first start and last end."""
    return changes.sparkSession.sql(
        f"""
        SELECT vehicle_id, system_id, time_zone, operationality_category, period,
               min(started_at) AS started_at, max(ended_at) AS ended_at
        FROM ({_NUMBERED}) GROUP BY vehicle_id, system_id, time_zone, operationality_category, period
        """,
        changes=changes,
    )


def _begins(period: ReportPeriod, semantics: str) -> Column:
    started = F.col("started_at")
    start, cutoff = local_time(period.start), local_time(period.cutoff(semantics))
    if semantics == CORRECTED:
        return (started >= start) & (started < cutoff)
    return started.between(start, cutoff)


def blocked_in_period(
    periods: DataFrame,
    period: ReportPeriod,
    system_id: str | None = None,
    semantics: str = "reference",
) -> DataFrame:
    """Merged periods of category ``blocked`` that begin between period start and cutoff."""
    begins = _begins(period, semantics)
    return of_system(periods, system_id).where(begins & (F.col("operationality_category") == "blocked"))


def blocked_periods(
    transitions: DataFrame,
    systems: DataFrame,
    vehicles: DataFrame,
    period: ReportPeriod,
    system_id: str | None = None,
    semantics: str = "reference",
    **options,
) -> DataFrame:
    """:func:`blocked_in_period` of the log, which is pruned before its windows run.

    A merged period that begins in the report period has a blocked state that starts
    there, so other vehicles are left out; and states that start after the cutoff change
    neither the number nor the start of an earlier period. ``ended_at`` is that of the
    states kept.
    """
    blocked = _begins(period, semantics) & (state_category(CHANGE_LABELS) == "blocked")
    asked = of_system(transitions, system_id).where(blocked).select("vehicle_id").distinct()
    until = local_time(period.cutoff(semantics))
    early = F.col("started_at") < until if semantics == CORRECTED else F.col("started_at") <= until
    kept = transitions.where(early).join(asked, "vehicle_id", "left_semi")
    periods = state_periods(state_changes(kept, systems, vehicles, period, semantics, whole_log=transitions, **options))
    return blocked_in_period(periods, period, system_id, semantics)


def maintenance_counts(
    periods: DataFrame,
    period: ReportPeriod,
    system_id: str | None = None,
    semantics: str = "reference",
) -> DataFrame:
    """``vehicle_id, maintenance``: a vehicle's blocked periods that begin in the report period.

    Period numbers run per city, so over all cities a period is its city and number.
    """
    return (
        blocked_in_period(periods, period, system_id, semantics)
        .groupBy("vehicle_id")
        .agg(F.count_distinct("system_id", "period").alias("maintenance"))
    )


def vehicles_in_maintenance(
    periods: DataFrame,
    period: ReportPeriod,
    system_id: str | None = None,
    semantics: str = "reference",
) -> DataFrame:
    """One row: vehicles with at least one blocked period that begins in the report period."""
    return blocked_in_period(periods, period, system_id, semantics).agg(
        F.count_distinct("vehicle_id").alias("nonoperational_M")
    )


def _lag_unit(semantics: str) -> list[str]:
    return ["vehicle_id", "system_id"] if check_semantics(semantics) == CORRECTED else ["vehicle_id"]
