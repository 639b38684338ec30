"""Every registered query against its DuckDB SQL, on the smallest sample tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from verification import bindings
from verification.compare import difference
from verification.oracles import ORACLES
from verification.queries import registry

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    assert registry().keys() == ORACLES.keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", sorted(registry()))
def test_query_equals_its_sql(spark, name):
    assert difference(spark, SF_DIR, driver.queries()[name], driver.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() == 10


def test_sample_vehicles_move_between_cities(spark):
    cities = bindings.transitions(spark, SF_DIR).groupBy("vehicle_id").agg(F.count_distinct("system_id").alias("cities"))
    assert cities.where("cities > 1").count() > 0
