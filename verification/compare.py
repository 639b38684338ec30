"""Run registered queries and their DuckDB SQL on one directory and compare the rows."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events"
    " documents embeddings pages benchmark labels conversations"
).split()


def _row(values) -> tuple:
    return tuple("NULL" if v is None else repr(float(v)) if isinstance(v, float) else str(v) for v in values)


def spark_rows(df) -> Counter:
    names = sorted(df.columns)
    return Counter(_row(row[name] for name in names) for row in df.collect())


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(_row(row[i] for i in order) for row in result.fetchall())


def difference(spark: SparkSession, sf_dir: str, query, sql: str) -> str | None:
    """None if equal, else what differs."""
    df = query(spark, sf_dir)
    names, expected = oracle_rows(sf_dir, sql)
    if sorted(df.columns) != names:
        return f"columns {sorted(df.columns)} != {names}"
    actual = spark_rows(df)
    if actual == expected:
        return None
    missing, extra = expected - actual, actual - expected
    return (
        f"{sum(actual.values())} rows, expected {sum(expected.values())}; "
        f"missing {list(missing.items())[:3]}; extra {list(extra.items())[:3]}"
    )


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from kerbside.session import build_session
    from verification.oracles import ORACLES
    from verification.queries import registry

    sf_dir = sys.argv[1]
    spark = build_session(
        "compare",
        "local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[2:] or list(registry())
    for name in wanted:
        began = time.time()
        try:
            problem = difference(spark, sf_dir, registry()[name], ORACLES[name])
        except Exception as error:  # noqa: BLE001 - report and go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - began:6.2f}s {name} {problem or ''}", flush=True)


if __name__ == "__main__":
    main()
