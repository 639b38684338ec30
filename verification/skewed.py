"""Run the operators on sample tables in which one key holds a third of all rows.

    python -m verification.skewed /root/testdata/sf0.1 <work folder> [copies]

Writes an enlarged copy of the tables below the work folder, compares the results with
DuckDB, and prints the longest task and the most shuffled rows any task read, from Spark's
event log. Large keys are cut at the library's own settings if ``copies`` brings
them above kerbside.functions.skew.CELL_ROWS rows.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import time

import duckdb
from pyspark.sql import functions as F

from kerbside.operators import states
from kerbside.operators.telemetry import waypoints
from kerbside.operators.trips import trip_stats, valid_trips
from kerbside.session import build_session
from verification import bindings as b
from verification.oracles import ORACLES

HOT = 1


def _enlarge(spark, sf_dir: str, root: str, copies: int) -> None:
    """Distinct copies of events (three times as many) and line items; every third row goes to HOT."""

    def skewed(name, key, identity, copies):
        copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
        rows = spark.read.parquet(f"{sf_dir}/{name}.parquet").select("*", copy).repartition(16)
        hot = F.xxhash64(*identity, "copy") % 3 == 0
        return rows.withColumn(key, F.when(hot, F.lit(HOT)).otherwise(F.col(key)).cast("long"))

    skewed("events", "user_id", ["event_id"], 3 * copies).select(
        (F.col("event_id") * (3 * copies) + F.col("copy")).alias("event_id"),
        # Spread over the hour after the original, so that copies differ in time.
        F.expr("timestampadd(MICROSECOND, cast(pmod(xxhash64(event_id, copy), 3600000000) AS bigint), ts)").alias("ts"),
        "user_id",
        "event_type",
        (F.col("value") / (3 * copies)).alias("value"),
        "props",
    ).write.mode("overwrite").parquet(f"{root}/events.parquet")
    skewed("lineitem", "l_suppkey", ["l_orderkey", "l_linenumber", "l_partkey"], copies).withColumn(
        "l_extendedprice", F.col("l_extendedprice") + F.col("copy") / 1000
    ).drop("copy").write.mode("overwrite").parquet(f"{root}/lineitem.parquet")
    for name in ("supplier", "region"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.mode("overwrite").parquet(f"{root}/{name}.parquet")


def _digest(df, key: str, *numbers: str) -> tuple:
    row = df.agg(F.count(F.lit(1)), F.sum(key), *[F.sum(F.round(F.col(n).cast("double"), 7)) for n in numbers]).collect()[0]
    return tuple(float(value) for value in row)


def _oracle_digest(con, sql: str, key: str, *numbers: str) -> tuple:
    # The SQL rounds to seven places itself; rounding again to fewer would differ.
    sums = "".join(f", sum(CAST({n} AS DOUBLE))" for n in numbers)
    return tuple(float(v) for v in con.execute(f"SELECT count(*), sum({key}){sums} FROM ({sql})").fetchall()[0])


def main() -> None:
    sf_dir, work = sys.argv[1], sys.argv[2]
    copies = int(sys.argv[3]) if len(sys.argv) > 3 else 14
    log, root = f"{work}/events-log", f"{work}/tables"
    os.makedirs(log, exist_ok=True)
    spark = build_session(
        "skewed",
        "local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="32",
        spark__driver__memory="12g",
        spark__eventLog__enabled="true",
        spark__eventLog__dir=log,
        spark__eventLog__rolling__enabled="false",
        spark__eventLog__compress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    _enlarge(spark, sf_dir, root, copies)
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in ("events", "lineitem", "supplier", "region"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet/*.parquet'")

    cases = {
        "trip_stats_by_vehicle": (
            lambda: trip_stats(valid_trips(b.trips(spark, root)), ["vehicle_id"], 1607.34),
            ("vehicle_id", "num_trips", "median_trip_length", "std_trip_length"),
        ),
        "state_periods": (
            lambda: states.state_periods(
                states.state_changes(
                    b.transitions(spark, root), b.systems(spark, root), b.vehicles(spark, root), b.FLEET_PERIOD
                )
            ),
            ("vehicle_id", "period"),
        ),
        "trip_waypoints": (
            lambda: waypoints(b.rental_spans(spark, root), b.telemetry(spark, root), b.MONTH),
            ("trip_id", "lat", "lon"),
        ),
    }
    spans = {}
    for name, (build, columns) in cases.items():
        began = time.time()
        found = _digest(build(), *columns)
        spans[name] = (began, time.time())
        expected = _oracle_digest(con, ORACLES[name], *columns)
        close = all(abs(x - y) <= 1e-9 * max(1.0, abs(y)) for x, y in zip(found, expected, strict=True))
        print(f"{'ok  ' if close else 'FAIL'} {name} {spans[name][1] - began:.1f}s {found} {expected}", flush=True)
    application = spark.sparkContext.applicationId
    spark.stop()

    with open(glob.glob(f"{log}/{application}*")[0]) as lines:
        tasks = [json.loads(line) for line in lines if '"SparkListenerTaskEnd"' in line]
    for name, (began, ended) in spans.items():
        inside = [t for t in tasks if began <= t["Task Info"]["Launch Time"] / 1000 <= ended]
        longest = max(t["Task Metrics"]["Executor Run Time"] for t in inside)
        most = max(t["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"] for t in inside)
        print(f"{name}: {len(inside)} tasks, longest {longest} ms, most shuffled rows read by one {most:,}")


if __name__ == "__main__":
    main()
