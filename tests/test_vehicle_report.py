import random
import statistics
from datetime import timedelta

import pytest
from frames import SEPTEMBER, at, systems, transitions, trips, vehicles

from kerbside.operators import states
from kerbside.plans.reports import monthly_summary, vehicle_report, vehicle_rows

BLOCKED = dict(operationality="nonoperational", operationality_reason=["blocked"])
MILE, VEHICLE_MILE = 1609.34, 1607.34


def _report(spark, trip_rows, transition_rows, fleet, semantics="reference"):
    log = transitions(spark, *transition_rows)
    dimension = vehicles(spark, *fleet)
    periods = states.state_periods(states.state_changes(log, systems(spark), dimension, SEPTEMBER, semantics))
    return vehicle_report(trips(spark, *trip_rows), log, dimension, periods, SEPTEMBER, "city", semantics)


def _log(vehicle, *starts, **more):
    return [
        dict(id=vehicle * 100 + i, vehicle_id=vehicle, started_at=at(s), ended_at=at(s) + timedelta(hours=1), **more)
        for i, s in enumerate(starts)
    ]


def test_columns_and_one_plain_vehicle(spark):
    report = _report(
        spark,
        [dict(id=1, distance_in_meters=VEHICLE_MILE), dict(id=2, distance_in_meters=3 * VEHICLE_MILE)],
        _log(1, "2020-08-01 10:00:00")
        + [dict(id=5, started_at=at("2020-09-10 00:00:00"), ended_at=at("2020-09-12 00:00:00"), **BLOCKED)],
        [dict(id=1, license_plate="ab12", chassis_number="VIN1")],
    )
    assert vehicle_rows(report).columns == [
        "vehicle_id",
        "DC_vehicle_id",
        "entered_service",
        "num_days_in_service",
        "mean_trip_length",
        "median_trip_length",
        "std_trip_length",
        "maintenance",
        "exit_service",
    ]
    row = report.collect()[0]
    assert (row.fleet_id, row.vehicle_id, row.DC_vehicle_id) == (1, "VIN1", "AB12")
    assert row.num_days_in_service == 27.0
    assert row.mean_trip_length == pytest.approx(2.0)
    assert row.median_trip_length == pytest.approx(2 * VEHICLE_MILE / MILE)
    # Two transitions repeat each trip twice: deviation of 1, 1, 3, 3.
    assert row.std_trip_length == pytest.approx(statistics.stdev([1, 1, 3, 3]))
    assert row.maintenance == 1 and row.exit_service is None


def test_one_trip_has_deviation_zero_once_repeated(spark):
    report = _report(
        spark,
        [dict(id=1, vehicle_id=1), dict(id=2, vehicle_id=2)],
        _log(1, "2020-08-01 10:00:00") + _log(2, "2020-08-01 10:00:00", "2020-08-02 10:00:00"),
        [dict(id=1), dict(id=2)],
    )
    rows = {r.fleet_id: r for r in report.collect()}
    assert rows[1].std_trip_length is None
    assert rows[2].std_trip_length == 0.0


def test_vehicle_without_transitions_keeps_only_its_median(spark):
    report = _report(spark, [dict(id=1), dict(id=2), dict(id=3, vehicle_id=None)], _log(9, "2020-08-01 10:00:00"),
                     [dict(id=1), dict(id=9)])
    rows = report.collect()
    assert [r.fleet_id for r in rows] == [1]
    assert rows[0].median_trip_length == pytest.approx(1.0)
    assert rows[0].asDict() | {"fleet_id": None, "median_trip_length": None} == dict.fromkeys(report.columns)


def test_unlisted_vehicle_and_vehicle_listed_twice(spark):
    rng = random.Random(3)
    lengths = {v: [rng.uniform(1, 9) for _ in range(5)] for v in (1, 2, 3)}
    trip_rows = [
        dict(id=v * 10 + i, vehicle_id=v, distance_in_meters=x * VEHICLE_MILE)
        for v, values in lengths.items()
        for i, x in enumerate(values)
    ]
    log = [row for v in lengths for row in _log(v, "2020-08-01 10:00:00", "2020-08-02 10:00:00")]
    fleet = [
        dict(id=2, license_plate="p", chassis_number="A"),
        dict(id=2, license_plate="q", chassis_number="B"),
        dict(id=3, license_plate="r", chassis_number="C"),
        dict(id=3, license_plate="r", chassis_number="C"),
    ]
    rows = _report(spark, trip_rows, log, fleet).collect()
    found = {(r.fleet_id, r.vehicle_id): r.std_trip_length for r in rows}
    assert len(rows) == 4
    assert found[1, None] == pytest.approx(statistics.stdev(lengths[1] * 2))
    assert found[2, "A"] == found[2, "B"] == pytest.approx(statistics.stdev(lengths[2] * 2))
    assert found[3, "C"] == pytest.approx(statistics.stdev(lengths[3] * 4))


def test_closed_form_deviation_equals_the_repeated_rows(spark):
    rng = random.Random(11)
    trip_rows, log, expected = [], [], {}
    for v in range(1, 9):
        n, k = rng.randint(1, 6), rng.randint(1, 5)
        values = [rng.uniform(0.1, 20) for _ in range(n)]
        trip_rows += [dict(id=v * 10 + i, vehicle_id=v, distance_in_meters=x * VEHICLE_MILE) for i, x in enumerate(values)]
        log += _log(v, *[f"2020-08-{day:02d} 10:00:00" for day in range(1, k + 1)])
        expected[v] = statistics.stdev(values * k) if n * k > 1 else None
    rows = _report(spark, trip_rows, log, [dict(id=v) for v in range(1, 9)]).collect()
    for row in rows:
        assert row.std_trip_length == (expected[row.fleet_id] and pytest.approx(expected[row.fleet_id], abs=1e-9))


def test_corrected_report(spark):
    log = _log(1, "2020-08-01 10:00:00") + [
        dict(id=5, started_at=at("2020-08-20 00:00:00"), ended_at=at("2020-10-12 00:00:00"), **BLOCKED),
        dict(id=6, started_at=at("2020-07-01 00:00:00"), ended_at=at("2020-07-02 00:00:00"), system_id="elsewhere"),
    ]
    trip_rows = [dict(id=1, distance_in_meters=MILE), dict(id=2, distance_in_meters=3 * MILE)]
    reference = _report(spark, trip_rows, log, [dict(id=1)]).collect()[0]
    corrected = _report(spark, trip_rows, log, [dict(id=1)], "corrected").collect()[0]
    assert reference.num_days_in_service == 29.0 and corrected.num_days_in_service == 0.0
    assert reference.maintenance is None and corrected.maintenance == 0
    assert str(reference.entered_service) == "2020-07-01 00:00:00"
    assert str(corrected.entered_service) == "2020-08-01 10:00:00"
    assert corrected.mean_trip_length == pytest.approx(2.0)
    assert corrected.std_trip_length == pytest.approx(statistics.stdev([1, 3]))
    assert reference.std_trip_length != pytest.approx(corrected.std_trip_length)


def test_summary_joins_counts_and_constants(spark):
    log = transitions(spark, dict(id=1, started_at=at("2020-09-10 00:00:00"), **BLOCKED))
    periods = states.state_periods(
        states.state_changes(log, systems(spark), vehicles(spark, dict(id=1)), SEPTEMBER)
    )
    constants = spark.createDataFrame(
        [tuple(range(11))],
        "total_vehicles int, nonoperational_LS int, M_lights int, M_wheeltire int, M_seat int, M_brakes int,"
        "M_frame int, M_gearsystem int, M_lock int, M_battery int, M_otherrepair int",
    )
    row = monthly_summary(trips(spark, {}, dict(id=2)), periods, constants, SEPTEMBER, "city").collect()
    assert [tuple(r) for r in row] == [(2, 0, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10)]
