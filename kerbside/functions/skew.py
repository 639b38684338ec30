"""Helpers that keep one very large key from landing in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame

# A key's rows are cut in time after about this many, ...
CELL_ROWS = 100_000
# ... but into no more cells than this,
CELLS_PER_KEY = 128
# and only so many keys are cut, the largest. By the pigeonhole any other key holds at most
# one in this many of all rows, whatever their number; one task can own it.
CUT_KEYS = 512
# Sampled rows to a cell.
SAMPLED = 16


def with_time_cells(
    df: DataFrame, key: str, at: str, id_column: str, cell_rows: int = CELL_ROWS, basis: DataFrame | None = None
) -> DataFrame:
    """Add ``time_cell``: NULL for a key without cuts, else a number that grows with ``at``.

    One rule for all keys: a cut after every ``cell_rows`` rows of a key or so; short keys
    have none. Rows without a time come last and are cut by ``id_column``. Equal times share
    a cell. Cuts come from a sample of ``basis`` (default: ``df``; it may hold more rows)
    that a hash of key, time and id chooses, so the same rows always give the same cuts.
    Where they lie changes no result, only how rows spread. The sample reads three columns;
    the cuts are at most ``CUT_KEYS`` rows of ``CELLS_PER_KEY`` places, which the planner
    knows from the limit on them.
    """
    return df.sparkSession.sql(
        f"""
        WITH {cuts_sql("{basis}", key, at, id_column, cell_rows)}
        SELECT df.*, {cell_sql(at, id_column)} AS time_cell FROM {{df}} AS df LEFT JOIN cuts ON `{key}` = cut_key
        """,
        df=df,
        basis=df if basis is None else basis,
    )


def cell_sql(at: str, id_column: str) -> str:
    """SQL of a row's cell, where it meets its key's row of ``cuts``."""
    return f"CASE WHEN cuts IS NOT NULL THEN size(filter(cuts, cut -> cut < {_place(at, id_column)})) END"


def _place(at: str, id_column: str) -> str:
    """SQL of a row's place in its key: dated rows by time, after them undated ones by id."""
    value = f"coalesce(unix_micros(cast({at} AS timestamp)), cast({id_column} AS long), {-(2**63) + 1}L)"
    return f"struct({at} IS NULL AS undated, {value} AS value)"


def cuts_sql(basis: str, key: str, at: str, id_column: str, cell_rows: int) -> str:
    """SQL of a common table ``cuts`` (``cut_key, cuts``): the places after which a key is cut, in order."""
    if cell_rows < 1:
        raise ValueError(f"cell_rows must be positive, got {cell_rows}")
    rate = max(1, cell_rows // SAMPLED)
    return f"""cut_places AS (
          -- Rows of one place count together, however many they are.
          SELECT cut_key, place, count(*) AS n FROM (
            SELECT `{key}` AS cut_key, {_place(at, id_column)} AS place, xxhash64(`{key}`, `{at}`, `{id_column}`) AS hash
            FROM {basis} WHERE `{key}` IS NOT NULL
          )
          WHERE pmod(hash, {rate}) = 0 GROUP BY cut_key, place
        ),
        cut_counts AS (
          SELECT cut_key, place, n, through, whole, greatest({cell_rows / rate}D, whole / {CELLS_PER_KEY}D) AS step
          FROM (SELECT *, sum(n) OVER (PARTITION BY cut_key ORDER BY place) AS through,
                       sum(n) OVER (PARTITION BY cut_key) AS whole FROM cut_places)
        ),
        cuts AS (
          SELECT cut_key, cuts FROM (
            SELECT cut_key, max(whole) AS whole, array_sort(collect_list(place)) AS cuts FROM cut_counts
            WHERE through < whole AND floor(through / step) > floor((through - n) / step) GROUP BY cut_key
          ) ORDER BY whole DESC, cut_key LIMIT {CUT_KEYS}
        )"""
