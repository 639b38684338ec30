"""Exact medians, means and deviations of groups of every shape."""

import math
import random
import statistics

import numpy as np
import pandas as pd
import pytest

from kerbside.operators import trips
from kerbside.operators.trips import EXACT_ROWS, trip_stats


def _stats(spark, rows):
    frame = spark.createDataFrame(rows, "key string, id long, distance_in_meters double")
    return {r.key: r for r in trip_stats(frame, ["key"], meters_per_mile=1.0).collect()}


def _check(spark, groups):
    rows = [(key, 1, value) for key, values in groups.items() for value in values]
    random.Random(1).shuffle(rows)
    found = _stats(spark, rows)
    assert found.keys() == groups.keys()
    for key, values in groups.items():
        row = found[key]
        assert (row.num_trips, row.length_count) == (len(values), len(values))
        assert row.median_trip_length == pytest.approx(statistics.median(values), rel=1e-12), key
        assert row.mean_trip_length == pytest.approx(statistics.fmean(values), rel=1e-12), key
        if len(values) == 1:
            assert row.std_trip_length is None
        elif 1e-100 < max(map(abs, values)) < 1e100 or max(values) == 0:  # whose square a double holds
            spread = statistics.stdev(values)
            assert row.std_trip_length == pytest.approx(spread, rel=1e-9, abs=1e-9 * max(map(abs, values))), key


def test_shapes_of_data(spark):
    rng = random.Random(7)
    _check(
        spark,
        {
            "one": [3.5],
            "two": [1.0, 2.0],
            "far apart": [1e-9, 1e9],
            "far apart, odd": [1e-9, 5.0, 1e300],
            "all equal": [2.5] * 101,
            "equal in the middle": [1.0, 2.0, 2.0, 2.0, 9.0, 10.0],
            "middle between runs": [1.0] * 50 + [3.0] * 50,
            "close together": [1.0 + i * 2.0**-50 for i in range(200)],
            "uniform": [rng.uniform(0.001, 50) for _ in range(2001)],
            "heavy tail": [rng.lognormvariate(0, 4) for _ in range(2000)],
            "tiny": [rng.uniform(1e-300, 1e-299) for _ in range(300)],
        },
    )


@pytest.mark.parametrize("seed", range(3))
def test_random_groups(spark, seed):
    rng = random.Random(seed)
    groups = {}
    for number in range(40):
        size = rng.choice([1, 2, 3, 10, 101, 400])
        step = rng.choice([0.01, 0.5, 1e-6])
        groups[f"g{number}"] = [step * rng.randint(1, rng.choice([3, 1000, 10**6])) for _ in range(size)]
    _check(spark, groups)


def test_absent_lengths_are_not_counted(spark):
    found = _stats(spark, [("a", 1, 1.0), ("a", 1, None), ("a", None, 3.0), ("b", 1, None), (None, 1, 2.0), (None, 1, 4.0)])
    shown = {k: (r.num_trips, r.length_count, r.mean_trip_length, r.median_trip_length) for k, r in found.items()}
    assert shown == {"a": (2, 2, 2.0, 2.0), "b": (1, 0, None, None), None: (2, 2, 3.0, None)}


def test_zero_and_negative_lengths(spark):
    _check(spark, {"mixed": [-5.0, -1e-9, 0.0, 0.0, 1e-9, 7.0], "below": [-3.0, -2.0], "zero": [0.0] * 4})


def test_nan_and_infinity(spark):
    """As data frames take them: a NaN is no length for the median, infinity is one."""
    inf, nan = float("inf"), float("nan")
    groups = {"nan": [nan, 5.0, 7.0], "only": [nan, nan], "inf": [1.0, 2.0, inf], "infs": [1.0, inf, inf], "both": [-inf, inf]}
    found = _stats(spark, [(key, 1, value) for key, values in groups.items() for value in values])
    assert {key: r.median_trip_length for key, r in found.items() if key != "both"} == {"nan": 6.0, "only": None, "inf": 2.0, "infs": inf}
    frame = pd.DataFrame([(key, value) for key, values in groups.items() for value in values], columns=["key", "value"])
    with np.errstate(invalid="ignore"):
        medians = frame.groupby("key")["value"].median()
    assert all(str(found[key].median_trip_length or nan) == str(medians[key]) for key in groups)
    assert [found[key].mean_trip_length for key in ("inf", "infs")] == [inf, inf]
    assert all(math.isnan(found[key].mean_trip_length) for key in ("nan", "only", "both"))
    assert [found[key].num_trips for key in groups] == [3, 2, 3, 3, 2]


@pytest.mark.parametrize("size", [EXACT_ROWS - 1, EXACT_ROWS, EXACT_ROWS + 1, 4 * EXACT_ROWS + 1])
def test_around_the_size_that_a_sketch_holds(spark, size):
    rng = random.Random(size)
    _check(
        spark,
        {
            "distinct": [rng.lognormvariate(0, 2) for _ in range(size)],
            "few values": [float(rng.randint(1, 3)) for _ in range(size)],
            "two halves": [1.0] * (size // 2) + [2.0] * (size - size // 2),
            "in order": [float(i) for i in range(size)],
            "small": [3.0, 4.0],
        },
    )


@pytest.mark.parametrize("size", [9, 10])
def test_every_group_ranked_between_its_bounds(spark, monkeypatch, size):
    """A coarse sketch and no group taken whole, so that the second look decides all."""
    monkeypatch.setattr(trips, "RANK_ACCURACY", 20)
    monkeypatch.setattr(trips, "EXACT_ROWS", 0)
    rng = random.Random(size)
    groups = {f"g{i}": [rng.choice([0.5, 1.0, rng.random()]) for _ in range(size ** rng.randint(1, 3))] for i in range(12)}
    _check(spark, groups | {"one": [2.0], "two": [1.0, 4.0]})


def test_a_third_of_all_trips_has_one_key(spark):
    rng = random.Random(5)
    groups = {"hot": [rng.lognormvariate(7, 1) for _ in range(4000)], "same": [1609.34] * 4000}
    groups |= {f"g{i}": [rng.lognormvariate(7, 1) for _ in range(10)] for i in range(400)}
    _check(spark, groups)
