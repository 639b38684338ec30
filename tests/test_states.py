import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from frames import SEPTEMBER, at, records, systems, transitions, vehicles
from pyspark.sql import functions as F

from kerbside.functions import skew
from kerbside.functions.skew import with_time_cells
from kerbside.operators import states
from kerbside.period import ReportPeriod

BLOCKED = dict(operationality="nonoperational", operationality_reason=["blocked"])
DISCHARGED = dict(operationality="nonoperational", operationality_reason=["battery_discharged"])


def test_category_branches_and_unknowns(spark):
    cases = [
        (dict(operationality="operational", operationality_reason=["blocked"]), "operational"),
        (BLOCKED, "blocked"),
        (DISCHARGED, "battery_discharged"),
        (dict(operationality="nonoperational", operationality_reason=["battery_discharged", "blocked"]), "blocked"),
        (dict(operationality="nonoperational", operationality_reason=["lost"]), "nonoperational"),
        (dict(operationality="nonoperational", operationality_reason=[]), "nonoperational"),
        (dict(operationality="nonoperational", operationality_reason=None), "nonoperational"),
        # No match beside a NULL element is unknown, a match is not.
        (dict(operationality="nonoperational", operationality_reason=["battery_discharged", None]), "nonoperational"),
        (dict(operationality="nonoperational", operationality_reason=[None, "blocked"]), "blocked"),
        (dict(operationality=None, operationality_reason=["blocked"]), None),
    ]
    df = transitions(spark, *[dict(id=i, **row) for i, (row, _) in enumerate(cases)])
    found = dict(records(df.select("id", states.state_category().alias("c"))))
    assert found == {i: expected for i, (_, expected) in enumerate(cases)}
    labelled = transitions(spark, dict(id=1, **BLOCKED), dict(id=2, **DISCHARGED)).select(
        "id", states.state_category(states.SPAN_LABELS).alias("c")
    )
    assert records(labelled) == [(1, "Blocked"), (2, "Battery Discharged")]


def _span(number, started, ended, **more):
    return dict(
        id=number,
        vehicle_id=number,
        started_at=started and at(started),
        ended_at=ended and at(ended),
        **{**BLOCKED, **more},
    )


def test_spans_are_cut_to_the_period(spark):
    df = transitions(
        spark,
        _span(1, "2020-08-20 00:00:00", "2020-09-03 12:00:00"),
        _span(2, "2020-09-29 00:00:00", "2020-10-09 00:00:00"),
        _span(3, "2020-09-10 00:00:00", None),
        _span(4, "2020-09-10 00:00:00", "2020-09-11 00:00:00"),
        _span(5, "2020-08-01 00:00:00", "2020-10-20 00:00:00"),
        _span(6, "2020-08-01 00:00:00", None),
        _span(7, "2020-09-30 00:00:00", "2020-09-30 06:00:00"),
        _span(8, "2020-09-30 00:00:01", "2020-09-30 06:00:00"),
        _span(9, "2020-08-01 00:00:00", "2020-08-31 23:59:59"),
        _span(10, None, "2020-09-10 00:00:00"),
        _span(11, "2020-09-10 00:00:00", "2020-09-11 00:00:00", system_id="elsewhere"),
    )
    days = lambda semantics: dict(
        records(states.time_out(states.clamp_spans(df, SEPTEMBER, "city", semantics)))
    )
    # Spans over the whole month (5, 6) drop out, and so does the last day.
    assert days("reference") == {1: 2.5, 2: 1.0, 3: 20.0, 4: 1.0, 7: 0.0, 10: 0.0}
    assert days("corrected") == {1: 2.5, 2: 2.0, 3: 21.0, 4: 1.0, 5: 30.0, 6: 30.0, 7: 0.25, 8: pytest.approx(0.25 - 1 / 86400)}


def test_time_out_counts_blocked_only_in_any_case(spark):
    rows = [(1, "Blocked"), (1, "blocked"), (1, "Battery Discharged"), (2, "operational"), (3, None)]
    df = spark.createDataFrame(
        [(v, at("2020-09-01 00:00:00"), at("2020-09-02 00:00:00"), c) for v, c in rows],
        "vehicle_id long, start_block timestamp_ntz, end_block timestamp_ntz, operationality_cleaned string",
    )
    assert records(states.time_out(df)) == [(1, 2.0)]


def test_possible_days_and_days_in_service(spark):
    df = transitions(
        spark,
        dict(id=1, vehicle_id=1, started_at=at("2020-05-01 00:00:00")),
        dict(id=2, vehicle_id=2, started_at=at("2020-09-20 12:00:00")),
        dict(id=3, vehicle_id=3, started_at=at("2020-09-30 12:00:00")),
        dict(id=4, vehicle_id=4, started_at=at("2020-09-05 00:00:00"), **BLOCKED),
        dict(id=5, vehicle_id=1, started_at=at("2020-04-01 00:00:00"), **BLOCKED),
        dict(id=6, vehicle_id=5, started_at=at("2020-10-01 00:00:00")),
    )
    first = states.first_operational(df)
    assert records(first, "vehicle_id", "transition_count") == [(1, 2), (2, 1), (3, 1), (4, 1), (5, 1)]
    assert dict(records(first, "vehicle_id", "first_operational"))[4] is None
    days = lambda s: dict(records(states.possible_days(first, SEPTEMBER, s), "vehicle_id", "possible_days"))
    assert days("reference") == {1: 29.0, 2: 9.5, 3: -0.5, 4: 29.0, 5: 29.0}
    assert days("corrected") == {1: 30.0, 2: 10.5, 3: 0.5, 4: 30.0, 5: 30.0}

    out = spark.createDataFrame([(2, 20.0)], "vehicle_id long, time_out_days double")
    service = lambda s: dict(
        records(
            states.days_in_service(states.possible_days(first, SEPTEMBER, s), out, s), "vehicle_id", "num_days_in_service"
        )
    )
    assert service("reference")[2] == -10.5 and service("reference")[1] == 29.0
    assert service("corrected")[2] == 0.0


def _changes(spark, rows, fleet=(1,), cities=({},), **options):
    return states.state_changes(
        transitions(spark, *rows),
        systems(spark, *cities),
        vehicles(spark, *[dict(id=v) for v in fleet]),
        SEPTEMBER,
        **options,
    )


SPLITS = [1, 2, 1_000_000]


@pytest.mark.parametrize("cell_rows", SPLITS)
def test_equal_states_merge_into_periods(spark, cell_rows):
    hours = lambda h: at("2020-09-10 00:00:00") + timedelta(hours=h)
    kinds = [{}, {}, BLOCKED, BLOCKED, DISCHARGED, BLOCKED, {}]
    rows = [dict(id=i, started_at=hours(i), ended_at=hours(i + 1), **kind) for i, kind in enumerate(kinds)]
    periods = states.state_periods(_changes(spark, rows, cell_rows=cell_rows))
    assert records(periods, "period", "operationality_category", "started_at", "ended_at") == [
        (1, "operational", hours(0), hours(2)),
        (2, "blocked", hours(2), hours(4)),
        (3, "battery_discharged", hours(4), hours(5)),
        (4, "blocked", hours(5), hours(6)),
        (5, "operational", hours(6), hours(7)),
    ]


@pytest.mark.parametrize("cell_rows", SPLITS)
def test_open_state_ends_now_in_the_citys_time(spark, cell_rows):
    row = dict(id=1, started_at=at("2020-09-10 00:00:00"))
    changes = _changes(spark, [row], cell_rows=cell_rows)
    assert records(changes, "last_operationality_category", "ended_at") == [("new vehicle", at("2020-10-04 20:00:00"))]


@pytest.mark.parametrize("cell_rows", SPLITS)
def test_unknown_category_does_not_count_but_the_next_one_does(spark, cell_rows):
    rows = [
        dict(id=1, started_at=at("2020-09-10 01:00:00")),
        dict(id=2, started_at=at("2020-09-10 02:00:00"), operationality=None),
        dict(id=3, started_at=at("2020-09-10 03:00:00")),
    ]
    numbered = states.numbered_changes(_changes(spark, rows, cell_rows=cell_rows))
    assert records(numbered, "id", "period", "last_operationality_category") == [
        (1, 1, "new vehicle"),
        (2, 1, "operational"),
        (3, 2, "new vehicle"),
    ]
    assert len(records(states.state_periods(_changes(spark, rows, cell_rows=cell_rows)))) == 3


@pytest.mark.parametrize("cell_rows", SPLITS)
def test_states_that_start_together_share_a_number(spark, cell_rows):
    together = at("2020-09-10 02:00:00")
    rows = [
        dict(id=1, started_at=at("2020-09-10 01:00:00")),
        dict(id=3, started_at=together),
        dict(id=2, started_at=together, **BLOCKED),
        dict(id=4, started_at=None, **BLOCKED),
    ]
    numbered = states.numbered_changes(_changes(spark, rows, cell_rows=cell_rows))
    # By id within the instant: blocked (changed), operational (changed); both get 3.
    # No start sorts last.
    assert records(numbered, "id", "period") == [(1, 1), (2, 3), (3, 3), (4, 4)]


@pytest.mark.parametrize("cell_rows", SPLITS)
def test_vehicle_that_moves_between_cities(spark, cell_rows):
    rows = [
        dict(id=1, started_at=at("2020-09-10 01:00:00")),
        dict(id=2, started_at=at("2020-09-10 02:00:00"), system_id="other"),
        dict(id=3, started_at=at("2020-09-10 03:00:00"), system_id="other", **BLOCKED),
        dict(id=4, started_at=at("2020-09-10 04:00:00"), **BLOCKED),
    ]
    cities = ({}, dict(id="other", time_zone="UTC"))
    numbers = lambda semantics: records(
        states.numbered_changes(
            _changes(spark, rows, cities=cities, semantics=semantics, cell_rows=cell_rows)
        ),
        "id",
        "period",
    )
    assert numbers("reference") == [(1, 1), (2, 0), (3, 1), (4, 1)]
    assert numbers("corrected") == [(1, 1), (2, 1), (3, 2), (4, 2)]


def test_only_known_cities_and_reported_vehicles_count(spark):
    rows = [
        dict(id=1, started_at=at("2020-09-10 01:00:00")),
        dict(id=2, started_at=at("2020-09-10 01:00:00"), system_id="unknown"),
        dict(id=3, started_at=at("2020-09-10 01:00:00"), vehicle_id=2),
        dict(id=4, started_at=at("2020-09-10 01:00:00"), vehicle_id=3),
        dict(id=5, started_at=at("2020-09-10 01:00:00"), vehicle_id=None),
    ]
    fleet = vehicles(spark, dict(id=1), dict(id=2, vehicle_kind_name="Other"))
    for cell_rows in (1, 100):
        changes = states.state_changes(
            transitions(spark, *rows), systems(spark), fleet, SEPTEMBER, cell_rows=cell_rows
        )
        assert records(changes, "id") == [(1,)]


def test_maintenance_counts_periods_and_vehicles(spark):
    def period(vehicle, number, started, category="blocked", system="city"):
        return (vehicle, system, "UTC", category, number, at(started), at(started))

    df = spark.createDataFrame(
        [
            period(1, 1, "2020-09-01 00:00:00"),
            period(1, 3, "2020-09-30 00:00:00"),
            period(1, 5, "2020-09-30 00:00:01"),
            period(1, 7, "2020-08-31 23:59:59"),
            period(2, 1, "2020-09-02 00:00:00"),
            period(3, 1, "2020-09-02 00:00:00", "battery_discharged"),
            period(4, 1, "2020-09-02 00:00:00", system="other"),
        ],
        """vehicle_id long, system_id string, time_zone string, operationality_category string,
           period long, started_at timestamp_ntz, ended_at timestamp_ntz""",
    )
    assert records(states.maintenance_counts(df, SEPTEMBER, "city")) == [(1, 2), (2, 1)]
    assert records(states.maintenance_counts(df, SEPTEMBER, "city", "corrected")) == [(1, 3), (2, 1)]
    assert records(states.vehicles_in_maintenance(df, SEPTEMBER, "city")) == [(2,)]
    assert records(states.vehicles_in_maintenance(df, SEPTEMBER)) == [(3,)]
    nobody = ReportPeriod(date(2019, 1, 1), date(2019, 2, 1), datetime(2019, 2, 2), "x")
    assert records(states.vehicles_in_maintenance(df, nobody)) == [(0,)]


def _random_log(seed):
    """Ties, missing starts, unknown categories, several cities, one vehicle with a third of all rows."""
    rng = random.Random(seed)
    rows = []
    for number in range(600):
        vehicle = 1 if rng.random() < 0.35 else rng.randint(2, 12)
        kind = rng.choice([{}, {}, BLOCKED, DISCHARGED, dict(operationality=None)])
        start = at("2020-09-01 00:00:00") + timedelta(minutes=rng.choice([rng.randint(0, 40000), 500, 501]))
        rows.append(
            dict(
                id=number,
                vehicle_id=vehicle,
                system_id=rng.choice(["city", "city", "other"]),
                started_at=None if rng.random() < 0.02 else start,
                ended_at=None if rng.random() < 0.1 else start + timedelta(minutes=5),
                **kind,
            )
        )
    return rows


def _expected_numbers(rows, by_city):
    """The window definitions, spelled out over sorted lists."""
    label = lambda r: (
        "blocked" if r.get("operationality_reason") == ["blocked"]
        else "battery_discharged" if r.get("operationality_reason")
        else r.get("operationality", "operational")
    )
    order = lambda r: (r["started_at"] is None, r["started_at"] or datetime.min, r["id"])
    flags, last = {}, {}
    for row in sorted(rows, key=order):
        unit = (row["vehicle_id"], row["system_id"] if by_city else None)
        previous = last.get(unit) or "new vehicle"
        flags[row["id"]] = int(label(row) is not None and previous != label(row))
        last[unit] = label(row)
    numbers = {}
    for row in rows:
        instant = order(row)[:2]
        numbers[row["id"]] = sum(
            flags[other["id"]]
            for other in rows
            if (other["vehicle_id"], other["system_id"]) == (row["vehicle_id"], row["system_id"])
            and order(other)[:2] <= instant
        )
    return numbers


@pytest.mark.parametrize("semantics", ["reference", "corrected"])
@pytest.mark.parametrize("seed", [1, 2])
def test_numbers_equal_brute_force_however_vehicles_are_split(spark, seed, semantics):
    rows = _random_log(seed)
    expected = sorted(_expected_numbers(rows, semantics == "corrected").items())
    periods = []
    for cell_rows in (10, 60, 1_000_000):
        changes = _changes(
            spark,
            rows,
            fleet=range(1, 13),
            cities=({}, dict(id="other", time_zone="Asia/Tokyo")),
            semantics=semantics,
            cell_rows=cell_rows,
        )
        numbered = states.numbered_changes(changes)
        assert sorted((r.id, r.period) for r in numbered.select("id", "period").collect()) == expected
        periods.append(Counter(tuple(r) for r in states.state_periods(changes).collect()))
    assert periods[0] == periods[1] == periods[2]


@pytest.mark.parametrize("semantics", ["reference", "corrected"])
@pytest.mark.parametrize("city", [None, "city", "other"])
def test_pruning_the_log_changes_no_blocked_period(spark, semantics, city):
    rows = _random_log(3)
    cities = [dict(id="city", time_zone="America/New_York"), dict(id="other", time_zone="Asia/Tokyo")]
    tables = transitions(spark, *rows), systems(spark, *cities), vehicles(spark, *[dict(id=v) for v in range(1, 13)])
    days = sorted(row["started_at"].date() for row in rows if row.get("started_at"))
    middle = ReportPeriod(days[len(days) // 5], days[4 * len(days) // 5] + timedelta(days=2), datetime(2020, 10, 5), "x")
    whole = states.state_periods(states.state_changes(*tables, middle, semantics))
    shown = ["vehicle_id", "system_id", "period", "started_at"]
    expected = Counter(map(tuple, states.blocked_in_period(whole, middle, city, semantics).select(*shown).collect()))
    found = Counter(map(tuple, states.blocked_periods(*tables, middle, city, semantics).select(*shown).collect()))
    assert found == expected and (city == "other" or found)


def test_a_large_vehicle_is_cut_into_small_cells(spark):
    start = at("2020-09-01 00:00:00")
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("vehicle_id"),
        "id",
        (F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") % 20_000).cast("int"))).alias("at"),
    )
    cells = with_time_cells(df, "vehicle_id", "at", "id", cell_rows=100)
    per_cell = cells.where("vehicle_id = 0").groupBy("time_cell").count().collect()
    assert sum(r["count"] for r in per_cell) == 10_000
    assert max(r["count"] for r in per_cell) <= 250
    assert cells.where("vehicle_id <> 0 AND time_cell IS NOT NULL").count() == 0
    assert cells.count() == 30_000
    # However few rows a cell may hold, there are only so many cells.
    cells = with_time_cells(df, "vehicle_id", "at", "id", cell_rows=1)
    per_cell = cells.where("vehicle_id = 0").groupBy("time_cell").count().collect()
    assert 100 <= len(per_cell) <= 129 and max(r["count"] for r in per_cell) <= 100


def test_odd_times_do_not_fill_a_cell(spark):
    """One state in 1970, one in 9999, a tenth without a start, and a tenth at one moment."""
    start = at("2020-09-01 00:00:00")
    even = F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") % 20_000).cast("int"))
    odd = F.when(F.col("id") == 0, F.lit("1970-01-01")).when(F.col("id") == 1, F.lit("9999-12-31"))
    odd = odd.when(F.col("id") % 10 == 7, F.lit("2020-09-03"))
    moment = F.when(F.col("id") % 10 != 5, F.coalesce(odd.cast("timestamp_ntz"), even))
    df = spark.range(20_000).select(F.lit(0).alias("vehicle_id"), "id", moment.alias("at"))
    cells = with_time_cells(df, "vehicle_id", "at", "id", 200)
    sizes = sorted(r["count"] for r in cells.groupBy("time_cell").count().collect())
    # What shares a moment shares a cell; the others stay small.
    assert sum(sizes) == 20_000 and 2000 <= sizes[-1] <= 2500 and sizes[-2] <= 500
    # Cells follow each other in time, and rows without a start come after all others.
    spans = cells.groupBy("time_cell").agg(F.min("at").alias("a"), F.max("at").alias("b"), F.min("id").alias("c")).orderBy("time_cell")
    rows = spans.collect()
    assert all(x.b < y.a for x, y in zip(rows, rows[1:]) if x.b and y.a)
    assert [r.a is None for r in rows] == sorted(r.a is None for r in rows)


def test_only_the_largest_keys_are_cut(spark, monkeypatch):
    monkeypatch.setattr(skew, "CUT_KEYS", 2)
    rows = spark.range(900).select(F.when(F.col("id") < 500, 0).when(F.col("id") < 800, 1).otherwise(2).alias("vehicle_id"), "id")
    df = rows.withColumn("at", F.timestamp_seconds("id").cast("timestamp_ntz"))
    cells = with_time_cells(df, "vehicle_id", "at", "id", 10)
    assert {r.vehicle_id for r in cells.where("time_cell IS NOT NULL").select("vehicle_id").distinct().collect()} == {0, 1}


@pytest.mark.parametrize("semantics", ["reference", "corrected"])
def test_states_without_a_start_share_a_number_when_split(spark, semantics):
    rng = random.Random(4)
    rows = [
        dict(
            id=i,
            vehicle_id=rng.choice([1, 1, 2]),
            system_id=rng.choice(["city", "other"]),
            started_at=None if i % 3 == 0 else at("2020-09-01 00:00:00") + timedelta(hours=rng.randrange(500)),
            **rng.choice([BLOCKED, DISCHARGED, {}]),
        )
        for i in range(150)
    ]
    found = []
    for cell_rows in (4, 1_000_000):
        changes = _changes(
            spark, rows, fleet=(1, 2), cities=({}, dict(id="other", time_zone="Asia/Tokyo")), semantics=semantics, cell_rows=cell_rows
        )
        numbered = states.numbered_changes(changes).select("id", "last_operationality_category", "period")
        found.append(sorted(map(tuple, numbered.collect())))
    assert found[0] == found[1]


def test_repeated_rows_with_one_id_give_the_same_numbers_when_split(spark):
    start = at("2020-09-01 00:00:00")
    rows = [
        dict(id=i % 7, started_at=start + timedelta(hours=i // 6), **(BLOCKED if i % 3 else DISCHARGED if i % 2 else {}))
        for i in range(90)
    ]
    found = [
        Counter(tuple(r) for r in states.state_periods(_changes(spark, rows, cell_rows=n)).collect())
        for n in (1, 5, 1_000_000)
    ]
    assert found[0] == found[1] == found[2]
