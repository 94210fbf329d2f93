"""Header/line flattening.

Two input forms exist:

* nested documents (D1-D3): a header row carries its lines as
  ``<LineColumn>.results``; one ``explode`` emits a row per line with the
  header fields copied on (inner: a header without lines is dropped);
* interleaved rows (D4-D6): headers and lines arrive as separate rows in
  arrival order ``seq``; each line takes the fields of the latest header
  before it, and the header rows are removed.

The forward fill must never put a whole tenant into one window partition:
rows are cut into fixed ``seq`` buckets, the last header of all *earlier*
buckets is taken from a small per-bucket summary (one row per bucket) and put
in front of the bucket's rows, and each bucket is filled by a running
``last(..., ignorenulls)`` window.  The rows move once.  The result equals the
unbucketed window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import NESTED, NestedDocument


class FlattenError(ValueError):
    pass


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


# --------------------------------------------------------------------- D1-D3
def explode_lines(df: DataFrame, doc: NestedDocument, missing_header: str = "error",
                  keep: list[str] | None = None) -> DataFrame:
    """One row per line with the document's header fields.

    The header ``Description`` becomes ``<Prefix>_Description``; absent header
    fields are null (``missing_header='null'``, order documents) or an error;
    absent line fields are null; a line field wins over an equal header name.
    """
    if doc.line_column not in df.columns:
        raise FlattenError(f"line column {doc.line_column} missing")
    header: dict[str, Column] = {}
    for f in doc.header_fields:
        name = f"{doc.prefix}_Description" if f == "Description" else f
        if f in df.columns:
            header[name] = _c(f)
        elif missing_header == "null":
            header[name] = F.lit(None).cast("string")
        else:
            raise FlattenError(f"header field {f} missing")
    lines_t = df.schema[doc.line_column].dataType["results"].dataType.elementType
    present = set(lines_t.names)
    keep = [k for k in (keep or []) if k not in header]
    exploded = df.select(*[_c(k) for k in keep], *[c.alias(n) for n, c in header.items()],
                         F.explode(F.col(f"`{doc.line_column}`.results")).alias("_l"))
    out = {k: _c(k) for k in keep}
    out.update({n: _c(n) for n in header})
    for f in doc.line_fields:
        out[f] = F.col(f"_l.`{f}`") if f in present else F.lit(None).cast("string")
    return exploded.select(*[c.alias(n) for n, c in out.items()])


# --------------------------------------------------------------------- D4-D6
def forward_fill_lines(df: DataFrame, id_col: str, header_cols: list[str], seq: str,
                       partition_cols: list[str], bucket_rows: int = 1 << 20) -> DataFrame:
    """Give every line the header fields of the latest header before it.

    ``id_col`` non-null marks a header row (it must be one of ``header_cols``);
    ``seq`` is the arrival order (numeric, unique per row or tied only among
    lines); ``partition_cols`` separate independent streams (tenant, table).
    A header overwrites the line's columns of the same names, nulls included;
    lines before any header keep their own values.  Header rows are removed.
    """
    if id_col not in header_cols:
        header_cols = [id_col] + list(header_cols)
    parts = [_c(p) for p in partition_cols]
    is_header = _c(id_col).isNotNull()
    hdr = F.when(is_header, F.struct(*[_c(h).alias(h) for h in header_cols]))
    bucketed = df.withColumn("_fb", F.floor(_c(seq) / F.lit(bucket_rows)).cast("long"))

    # One row per bucket with its own last header, and from these the last header of all earlier
    # buckets.  Only the header columns are read here.
    summary = bucketed.groupBy(*parts, "_fb").agg(F.max_by(hdr, F.when(is_header, F.struct(_c(seq)))).alias("_bh"))
    w_carry = (Window.partitionBy(*parts).orderBy(F.col("_fb"))
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = (summary.select(*parts, "_fb", F.last("_bh", ignorenulls=True).over(w_carry).alias("_fc"))
             .filter(F.col("_fb").isNotNull() & F.col("_fc").isNotNull()))

    # The carried header leads its bucket as a row of its own, so the rows are dealt once and nothing is
    # joined back; the header structs are built behind the exchange.
    rows = bucketed.withColumn("_fc", F.lit(None).cast(carry.schema["_fc"].dataType))
    dealt = rows.unionByName(carry, allowMissingColumns=True).repartition(*parts, "_fb")
    w_local = (Window.partitionBy(*parts, F.col("_fb")).orderBy(F.col("_led"), _c(seq))
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = (dealt.select(*[_c(c) for c in df.columns], "_fb", F.col("_fc").isNull().alias("_led"), F.coalesce(F.col("_fc"), hdr).alias("_fhdr"))
              .withColumn("_fill", F.last("_fhdr", ignorenulls=True).over(w_local))
              .filter(F.col("_fhdr").isNull()))
    out = []
    for c in df.columns:
        if c in header_cols:
            out.append(F.when(F.col("_fill").isNotNull(), F.col(f"_fill.`{c}`"))
                       .otherwise(_c(c)).alias(c))
        else:
            out.append(_c(c))
    return filled.select(*out)


FORWARD_FILL_IDS = {"Verkoopfacturen": "InvoiceID", "VerkoopOrders": "OrderID", "Offertes": "QuotationID"}


def forward_fill_document(df: DataFrame, table: str, seq: str, partition_cols: list[str],
                          bucket_rows: int = 1 << 20) -> DataFrame:
    """D4 (invoices), D5 (orders), D6 (quotations) with the document's header fields.

    The header's ``Description`` becomes ``<Prefix>_Description``; the line's own stays.
    """
    doc = NESTED[table]
    id_col = FORWARD_FILL_IDS[table]
    renamed = f"{doc.prefix}_Description"
    if "Description" in df.columns and "Description" in doc.header_fields and renamed not in df.columns:
        is_header = _c(id_col).isNotNull()
        df = df.withColumn(renamed, F.when(is_header, _c("Description")))
    names = [renamed if h == "Description" else h for h in doc.header_fields]
    return forward_fill_lines(df, id_col, [h for h in names if h in df.columns], seq, partition_cols, bucket_rows)


# ------------------------------------------------------------------------- D7
def flatten_for_table(df: DataFrame, table: str, keep: list[str] | None = None, seq: str | None = None,
                      partition_cols: list[str] | None = None) -> DataFrame:
    """The three sales documents flatten, every other table passes through.

    A document with a line list is exploded (D1-D3); interleaved header and line
    rows, which carry the arrival order ``seq``, are filled forward (D4-D6).
    Unlike the reference (which returns the input unchanged on error), a
    failure here fails the table.
    """
    doc = NESTED.get(table)
    if doc is None:
        return df
    if doc.line_column not in df.columns and seq is not None and seq in df.columns:
        return forward_fill_document(df, table, seq, list(partition_cols or []))
    return explode_lines(df, doc, missing_header="null" if table == "VerkoopOrders" else "error",
                         keep=keep)


def line_struct_type(fields, dtype: T.DataType = T.StringType()) -> T.StructType:
    """``struct<results: array<struct<fields...>>>`` for building nested payloads."""
    return T.StructType([T.StructField("results", T.ArrayType(
        T.StructType([T.StructField(f, dtype) for f in fields])))])
