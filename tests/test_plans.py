"""What the physical plans must and must not contain."""

import contextlib
import io
import re
from collections import Counter

import pytest
from frames import SEPTEMBER, spans, systems, telemetry, transitions, trips, vehicles

from kerbside.operators import states
from kerbside.operators.telemetry import waypoints
from kerbside.operators.trips import in_period, trip_export, valid_trips
from kerbside.plans.reports import user_trip_report
from verification.queries import registry


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def scans(text):
    """Pushed filters and read columns of each parquet scan."""
    return [
        (pushed, schema)
        for pushed, schema in re.findall(r"PushedFilters: \[(.*?)\]\nReadSchema: struct<(.*?)>\n", text)
    ]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    frames = dict(
        trips=trips(spark, {}),
        transitions=transitions(spark, {}),
        vehicles=vehicles(spark, dict(id=1)),
        systems=systems(spark),
        spans=spans(spark, dict(started_at_ms=0, ended_at_ms=1)),
        telemetry=telemetry(spark, dict(ts_ms=0)),
    )
    for name, frame in frames.items():
        frame.write.parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in frames}


def test_trip_filters_reach_the_scan_and_columns_are_pruned(stored):
    df = in_period(valid_trips(stored["trips"], "city"), "system_date", SEPTEMBER).select("user_id")
    pushed, schema = scans(plan(df))[0]
    for part in (
        "EqualTo(system_id,city)",
        "GreaterThan(price_before_discount,0.0)",
        "GreaterThan(distance_in_meters,0.0)",
        "GreaterThanOrEqual(billable_duration_in_seconds,120)",
        "Or(IsNull(charge_state),Not(In(charge_state, [canceled",
        "GreaterThanOrEqual(system_date,2020-09-01)",
        "LessThan(system_date,2020-10-01)",
    ):
        assert part in pushed, part
    assert "start_point_lat" not in schema and "vehicle_id" not in schema


def test_zoneless_period_reaches_the_scan(stored):
    text = plan(trip_export(stored["trips"], stored["vehicles"], SEPTEMBER, "city"))
    assert "GreaterThanOrEqual(system_started_at,2020-09-01T00:00)" in text
    assert "LessThan(system_started_at,2020-10-01T00:00)" in text


def test_telemetry_scan_is_limited_in_time(stored):
    text = plan(waypoints(stored["spans"], stored["telemetry"], SEPTEMBER, "city"))
    assert f"GreaterThanOrEqual(ts_ms,{SEPTEMBER.start_ms})" in text
    assert "EqualTo(msgcode,location)" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def reads(df) -> list[str]:
    """The files scanned by the plan that ran, subqueries included, one entry for each scan."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    # Of every adaptive plan, the final one; the initial one follows it.
    final = re.sub(r"(?ms)== Initial Plan ==.*?(?=== Final Plan ==|\Z)", "", text)
    return re.findall(r"FileScan parquet.*?Location: \w+\(\d+ paths?\)\[.*?/([\w.]+)\]", final)


SAMPLES = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    ("query", "tables"),
    [
        ("user_trip_report", {"lineitem": 1}),
        ("trip_stats_by_vehicle", {"lineitem": 1}),
        ("report_stats", {"lineitem": 1}),
        ("user_stats_by_period", {"lineitem": 1}),
        ("time_out_by_period", {"events": 1}),
        ("time_out_by_period_corrected", {"events": 1}),
        ("trip_export", {"lineitem": 1, "supplier": 1}),
        ("trip_waypoints", {"events": 3}),  # spans twice, telemetry once
        ("time_out_days", {"events": 1}),
    ],
)
def test_how_often_tables_are_read(spark, query, tables):
    assert Counter(name.removesuffix(".parquet") for name in reads(registry()[query](spark, SAMPLES))) == tables


def exchanges(df) -> int:
    """Shuffles of the plan that ran; a reused one does not count again."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = re.sub(r"(?ms)== Initial Plan ==.*?(?=== Final Plan ==|\Z)", "", text)
    return len(re.findall(r"(?<![A-Za-z])Exchange (?:hash|range|Single|RoundRobin)", final))


@pytest.mark.parametrize("query", ["user_trip_report", "trip_stats_by_vehicle", "report_stats", "user_stats_by_period"])
def test_statistics_take_one_exchange_and_one_scan(spark, query):
    """No group is too large for its sketch here, so the second look is dropped."""
    df = registry()[query](spark, SAMPLES)
    assert reads(df) == ["lineitem.parquet"]
    assert exchanges(df) == 1


def test_large_groups_take_a_second_look_in_parts(spark, stored):
    """Trips meet their group's bounds by group and part; the aggregation is shared."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(user_trip_report(stored["trips"], SEPTEMBER, "city"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = re.findall(r"(?ms)^\(\d+\) SortMergeJoin.*?Left keys \[\d\]: \[(.*?)\]\n", text)
    assert sorted(re.sub(r"#\d+L?", "", keys) for keys in joins) == ["key", "key, salt"]
    df = registry()["trip_stats_by_city_split"](spark, "/root/testdata/sf0.01")
    assert reads(df) == ["lineitem.parquet"] * 2


def test_placing_states_never_shuffles_rows_by_their_large_key(spark, stored):
    """Dimensions by their own key before the placement, the summary by cell after it.

    The cuts meet the log by vehicle, but their limit makes them small to the planner, so that
    they are broadcast at any threshold that broadcasts at all.
    """
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        changes = states.state_changes(stored["transitions"], stored["systems"], stored["vehicles"], SEPTEMBER)
        assert re.search(r"BroadcastHashJoin .*cut_key", plan(changes).replace("\n", " "))
        assert not re.search(r"SortMergeJoin .{0,200}cut_key", plan(changes).replace("\n", " "))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        changes = states.state_changes(stored["transitions"], stored["systems"], stored["vehicles"], SEPTEMBER)
        text = plan(states.state_periods(changes)).split("===== Subqueries")[0]
        joins = re.findall(r"(?ms)^\(\d+\) SortMergeJoin.*?Left keys \[\d\]: \[(.*?)\]", text)
        assert sorted(re.sub(r"#\d+L?", "", keys) for keys in joins) == sorted(
            ["vehicle_id, time_cell"] + ["system_id", "vehicle_id", "vehicle_id"] * 2
        )
        assert text.count("REPARTITION_BY_COL") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_both_state_windows_share_one_exchange(stored):
    changes = states.state_changes(stored["transitions"], stored["systems"], stored["vehicles"], SEPTEMBER)
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        states.numbered_changes(changes).explain()
    lines = text.getvalue().splitlines()
    # From the root down the left spine: sum window, lag window, then the placement.
    spine = [line.replace(":", " ") for line in lines if re.match(r"^(\s|:)*(\+-|:-)?.*(Window|Exchange hash)", line)]
    kinds = ["Exchange" if "Exchange" in line else "Window" for line in spine][:3]
    assert kinds == ["Window", "Window", "Exchange"]
    assert "REPARTITION_BY_COL" in spine[2]


def test_no_query_runs_python_or_a_cross_join(spark):
    for name, query in registry().items():
        text = plan(query(spark, "/root/testdata/sf0.001"))
        for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in text, (name, node)
