"""Ranges for reading a large table over several connections."""

import random

import pytest
from pyspark.sql import functions as F

from kerbside.sources.tables import JdbcSource, even_borders, range_predicates


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_every_key_meets_one_condition_and_ranges_are_even(spark, parts):
    rng = random.Random(parts)
    # Most keys lie in a thousandth of their range, where equally wide ranges would not part them.
    keys = [rng.randint(0, 1000) if rng.random() < 0.9 else rng.randint(-(10**6), 10**6) for _ in range(4000)]
    df = spark.createDataFrame([(k,) for k in [*keys, *[None] * 50]], "id long")
    borders = even_borders(df, "id", parts)
    conditions = range_predicates("id", borders)
    met = df.select(*[F.coalesce(F.expr(c), F.lit(False)).cast("int").alias(f"c{i}") for i, c in enumerate(conditions)])
    rows = met.collect()
    assert all(sum(row) == 1 for row in rows)
    sizes = [sum(column) for column in zip(*rows, strict=True)]
    assert sizes[-1] == 50 and sum(sizes) == 4050
    assert len(sizes) == parts + 1 and max(sizes[:-1]) <= 1.3 * 4000 / parts + 10


def test_few_or_no_keys(spark):
    df = spark.createDataFrame([(5,), (5,), (None,)], "id long")
    assert even_borders(df, "id", 4) == [5]
    assert range_predicates("id", [5]) == ["id < 5", "id >= 5", "id IS NULL"]
    assert even_borders(df.where("id IS NULL"), "id", 4) == []
    assert range_predicates("id", []) == ["id IS NOT NULL", "id IS NULL"]
    for bad in ([3, 1], [1, 1]):
        with pytest.raises(ValueError, match="must grow"):
            range_predicates("id", bad)
    with pytest.raises(ValueError, match="positive"):
        even_borders(df, "id", 0)


def test_a_table_has_one_way_of_being_parted():
    with pytest.raises(ValueError, match="both partitioning and predicates: trips"):
        JdbcSource({"url": "jdbc:x"}, partitioning={"trips": {}}, predicates={"trips": ["1 = 1"]})
