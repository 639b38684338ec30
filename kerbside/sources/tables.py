"""Readers for the input tables. Connections and paths always come from the caller."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.schemas import INPUTS, conform


@dataclass(frozen=True)
class ParquetSource:
    """Tables as parquet directories or files ``<root>/<table>``; ``paths`` overrides single ones."""

    root: str
    paths: Mapping[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self.paths.get(name, f"{self.root}/{name}"))


@dataclass(frozen=True)
class JdbcSource:
    """Tables in a database reached over JDBC.

    ``options`` holds url, user, password and driver. ``tables`` maps a table name to
    the database's own. ``partitioning`` maps a table name to partitionColumn,
    lowerBound, upperBound and numPartitions, so that executors read ranges of a large
    table side by side; without it Spark reads a table through one connection. Those ranges
    are equally wide; ``predicates`` maps a table name to conditions, one connection each,
    such as :func:`range_predicates` makes for ranges that are equally full.
    """

    options: Mapping[str, str]
    tables: Mapping[str, str] = field(default_factory=dict)
    partitioning: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    predicates: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        both = sorted(set(self.partitioning) & set(self.predicates))
        if both:
            raise ValueError(f"tables with both partitioning and predicates: {', '.join(both)}")

    def reader_options(self, name: str) -> dict[str, str]:
        merged = dict(self.options)
        merged["dbtable"] = self.tables.get(name, name)
        # Zoneless database columns stay zoneless.
        merged.setdefault("preferTimestampNTZ", "true")
        merged.update(self.partitioning.get(name, {}))
        return merged

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        options = self.reader_options(name)
        if name not in self.predicates:
            return spark.read.format("jdbc").options(**options).load()
        url, table = options.pop("url"), options.pop("dbtable")
        return spark.read.jdbc(url, table, predicates=list(self.predicates[name]), properties=options)


def even_borders(keys: DataFrame, column: str, parts: int) -> list[int]:
    """Borders between ``parts`` ranges of a whole-number column that hold about equally many rows.

    ``keys`` is any table of the keys as they are now, such as an earlier copy or a sample;
    at most ``parts - 1`` numbers come to the driver.
    """
    if parts < 1:
        raise ValueError(f"parts must be positive, got {parts}")
    if parts == 1:
        return []
    fractions = [number / parts for number in range(1, parts)]
    found = keys.agg(F.percentile_approx(F.col(column), F.lit(fractions), 100 * parts)).first()[0]
    return sorted(set(found or []))


def range_predicates(column: str, borders: Sequence[int]) -> list[str]:
    """Conditions of which every row meets exactly one: the ranges between the borders, and NULL."""
    if list(borders) != sorted(set(borders)):
        raise ValueError(f"borders must grow, got {borders}")
    if not borders:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(borders, borders[1:], strict=False)]
    return [f"{column} < {borders[0]}", *inner, f"{column} >= {borders[-1]}", f"{column} IS NULL"]


def load_table(spark: SparkSession, name: str, source: ParquetSource | JdbcSource) -> DataFrame:
    """Read one input table and check it against its schema."""
    if name not in INPUTS:
        raise KeyError(f"unknown table {name!r}; known: {', '.join(INPUTS)}")
    return conform(source.read(spark, name), name)
