"""Incremental extraction predicates (B12-B14) as Column builders.

The reference pushes these to the remote API; here they are ordinary
filters that Catalyst pushes into the parquet scan (``PushedFilters``).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WATERMARK_PATTERN = "%Y-%m-%dT%H:%M:%S"


def parse_watermark(wm: str | datetime) -> datetime:
    return wm if isinstance(wm, datetime) else datetime.strptime(wm, WATERMARK_PATTERN)


def _ntz(value: datetime) -> Column:
    # A text literal cast to timestamp_ntz: zone-free (a Python datetime literal
    # would pass through the driver's local zone) and pushable into the scan.
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def _ts_literal(wm: str | datetime) -> Column:
    return _ntz(parse_watermark(wm))


def modified_since(col: str, watermark: str | datetime) -> Column:
    """``col >= watermark`` (``Modified ge datetime'...'``, operator type 2)."""
    return F.col(col) >= _ts_literal(watermark)


def modified_since_day(col: str, watermark: str | datetime) -> Column:
    """The watermark floored to 00:00:00 of its day."""
    wm = parse_watermark(watermark)
    return F.col(col) >= _ntz(wm.replace(hour=0, minute=0, second=0, microsecond=0))


def at_least(col: str, value) -> Column:
    """``ReportingYear ge y``, ``FinancialYear ge y``, ``InvoiceDate ge d`` ..."""
    return F.col(col) >= F.lit(value)


def predicate_for(kind: str, col: str | None, watermark=None, reporting_year=None,
                  window_start=None) -> Column | None:
    """The filter of one catalogue entry (see ``schemas.CATALOGUE``)."""
    if kind == "none" or col is None:
        return None
    if kind == "modified":
        return modified_since(col, watermark)
    if kind == "modified_day":
        return modified_since_day(col, watermark)
    if kind == "reporting_year":
        return at_least(col, int(reporting_year))
    if kind == "window_date":
        return F.col(col) >= F.lit(str(window_start)).cast("timestamp_ntz")
    if kind == "window_year":
        return at_least(col, int(str(window_start)[:4]))
    raise ValueError(f"unknown filter kind {kind}")


def extract(df: DataFrame, columns: list[str] | None = None, predicate: Column | None = None,
            expand: list[str] | None = None) -> DataFrame:
    """``$select`` (projection, nested fields allowed) plus the incremental filter.

    ``expand`` names nested line columns to keep whole (``$expand``).
    The filter is applied before the projection so it can reference
    columns that are not selected; Catalyst still pushes both into the scan.
    """
    if predicate is not None:
        df = df.filter(predicate)
    if columns:
        keep = list(columns) + [c for c in (expand or []) if c not in columns]
        df = df.select(*[F.col(c) for c in keep])
    return df


def projected(df: DataFrame, columns: list[str], line_column: str | None = None, line_fields: list[str] | None = None,
              results: str | None = "results") -> DataFrame:
    """B14 over a nested landing (parquet): the declared header fields and, for documents, one row per line with its declared
    fields as ``<line column>_<field>`` (a document without lines gives none).

    The line fields are taken out of the array one by one and zipped, instead of exploding whole lines: that way the scan
    reads only the listed leaves of the array of structs (see ``ReadSchema``), however wide lines are.  ``results`` is the
    field of the line column that holds the array (OData), none if it is the array itself."""
    if not line_column:
        return df.select(*columns)
    lines = F.col(f"{line_column}.{results}" if results else line_column)
    zipped = F.arrays_zip(*[lines[f].alias(f) for f in line_fields])
    out = df.select(*columns, F.explode(zipped).alias("_l"))
    return out.select(*columns, *[F.col("_l").getField(f).alias(f"{line_column}_{f}") for f in line_fields])
