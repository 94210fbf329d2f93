"""Query registry and helpers shared by the catalogue modules.

Each registered query takes ``(spark, sf_dir)`` and returns a DataFrame
built from the harness tables (payloads are derived from them inside the
query, so the work grows with the tables).  ``sql`` is the DuckDB oracle
over the same parquet tables, with identical column names and types; it
is ``None`` where the result is not expressible in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Fixed moment every time-dependent query is evaluated at (never ``now()``).
AS_OF = "2024-06-30 12:00:00"
# Bounded page / list sizes of the payloads built from the tables.
PAGE_ROWS = 100
LIST_ROWS = 1024


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def bounded_chunk(size: int = LIST_ROWS) -> Column:
    """A chunk id that bounds every group it is part of to ``size`` rows.

    ``monotonically_increasing_id`` is unique and dense within a partition
    and is recomputed identically when a task re-runs over the same input
    split, so grouping by ``(key, chunk)`` never builds an unbounded list
    even for a key that holds a third of all rows.
    """
    return F.floor(F.monotonically_increasing_id() / F.lit(size))


def xml_escape(c: Column) -> Column:
    c = F.replace(c.cast("string"), F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))


def xml_elem(name: str, value: Column) -> Column:
    """``<name>value</name>`` (escaped); a null value gives an empty element."""
    return F.concat(F.lit(f"<{name}>"), F.coalesce(xml_escape(value), F.lit("")), F.lit(f"</{name}>"))


def text(c: Column) -> Column:
    """Text form of a value as an API would send it."""
    return c.cast("string")


def line_uuid(*cols: Column) -> Column:
    """A deterministic uuid from integer columns (md5, lower 8-4-4-4-12)."""
    h = F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


LINE_UUID_SQL = ("lower(substr(md5(concat_ws('|', {c})),1,8) || '-' || substr(md5(concat_ws('|', {c})),9,4) || '-' || "
                 "substr(md5(concat_ws('|', {c})),13,4) || '-' || substr(md5(concat_ws('|', {c})),17,4) || '-' || "
                 "substr(md5(concat_ws('|', {c})),21,12))")
LINE_KEY_COLS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def line_key_cols() -> list[Column]:
    return [F.col(c) for c in LINE_KEY_COLS] + [
        F.round(F.col("l_quantity") * 100).cast("long"),
        F.round(F.col("l_extendedprice") * 100).cast("long")]


LINE_KEY_SQL = ", ".join(list(LINE_KEY_COLS) + ["CAST(round(l_quantity * 100) AS BIGINT)",
                                                "CAST(round(l_extendedprice * 100) AS BIGINT)"])
LINE_ID_SQL = LINE_UUID_SQL.format(c=LINE_KEY_SQL)
