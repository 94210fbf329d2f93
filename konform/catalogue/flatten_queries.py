"""Header/line flattening queries.

Orders are the document headers and line items their lines.  Every header
and line field is one SQL expression over ``orders o`` / ``lineitem l`` that
both engines evaluate.  Spark nests the lines into the documents, lands the
documents as OData pages, and runs unwrap -> flatten -> map -> coerce; the
oracle joins ``orders`` and ``lineitem`` and converts each field to its
target type directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import ACCOUNTING, coerce_table
from ..operators import flatten, mapping
from ..schemas import NESTED, column_mapping, target_types
from ..sources import payloads
from ._base import LINE_ID_SQL, bounded_chunk, line_key_cols, line_uuid, load, query

# Shared field expressions (valid Spark SQL and DuckDB SQL).
_DIV = "CAST(substr(o_orderpriority, 1, 1) AS INT)"
# ``@MS:<col>``: the column as OData ``/Date(<epoch ms>)/`` text.
_DATE_MS = "@MS:o_orderdate"
_SHIP_MS = "@MS:l_shipdate"
_ORDER_ID = "'ORD-' || CAST(o_orderkey AS STRING)"

LINE_COMMON = {
    "AmountDC": "l_extendedprice", "CostCenterDescription": "'CC-' || l_returnflag",
    "CostUnitDescription": "'CU-' || l_linestatus", "Description": "l_returnflag || l_linestatus",
    "Discount": "l_discount", "ID": "@LINE_ID", "Item": "CAST(l_partkey AS STRING)",
    "LineNumber": "l_linenumber", "Quantity": "l_quantity",
}

DOCS = {
    "Verkoopfacturen": {
        "header": {"Currency": "'EUR'", "DeliverTo": "CAST(o_custkey AS STRING)", "Description": "o_orderpriority",
                   "Division": _DIV, "InvoiceDate": _DATE_MS, "InvoiceID": _ORDER_ID,
                   "InvoiceNumber": "o_orderkey", "InvoiceTo": "CAST(o_custkey AS STRING)",
                   "OrderDate": "o_orderdate", "OrderedBy": "CAST(o_custkey AS STRING)",
                   "PaymentConditionDescription": "'30 days'", "Remarks": "'  ' || o_orderstatus || '  '",
                   "ShippingMethodDescription": "'Post'", "StatusDescription": "o_orderstatus",
                   "YourRef": "'REF-' || CAST(o_orderkey AS STRING)",
                   "StarterSalesInvoiceStatusDescription": "o_orderstatus"},
        "line": {**LINE_COMMON, "DeliveryDate": _SHIP_MS, "EmployeeFullName": "'Employee ' || CAST(l_suppkey AS STRING)",
                 "GLAccount": "CAST(l_suppkey AS STRING)", "SalesOrder": "CAST(l_orderkey AS STRING)",
                 "SalesOrderLine": "CAST(l_linenumber AS STRING)", "UnitDescription": "'pcs'",
                 "UnitPrice": "l_extendedprice", "VATAmountDC": "l_tax", "VATPercentage": "l_tax"},
    },
    "VerkoopOrders": {
        # ApproverFullName and Remarks are absent from the payload: order headers
        # tolerate missing fields (null), unlike invoices and quotations.
        "header": {"ApprovalStatusDescription": "o_orderstatus", "Approved": "o_orderdate",
                   "Created": _DATE_MS, "CreatorFullName": "'Creator ' || CAST(o_custkey AS STRING)",
                   "Currency": "'EUR'", "DeliverTo": "CAST(o_custkey AS STRING)", "Description": "o_orderpriority",
                   "Division": _DIV, "InvoiceStatusDescription": "o_orderstatus",
                   "InvoiceTo": "CAST(o_custkey AS STRING)", "OrderDate": "o_orderdate",
                   "OrderedBy": "CAST(o_custkey AS STRING)", "OrderID": _ORDER_ID, "OrderNumber": "o_orderkey",
                   "ShippingMethodDescription": "'Post'", "StatusDescription": "o_orderstatus",
                   "YourRef": "'REF-' || CAST(o_orderkey AS STRING)"},
        "line": {**LINE_COMMON, "CostPriceFC": "l_extendedprice", "DeliveryDate": _SHIP_MS,
                 "VATAmount": "l_tax", "VATPercentage": "l_tax"},
    },
    "Offertes": {
        "header": {"QuotationID": _ORDER_ID, "QuotationNumber": "o_orderkey", "VersionNumber": "1",
                   "SalesPersonFullName": "'Sales ' || CAST(o_custkey AS STRING)", "Currency": "'EUR'",
                   "Description": "o_orderpriority", "StatusDescription": "o_orderstatus",
                   "OrderAccount": "CAST(o_custkey AS STRING)", "Opportunity": "CAST(o_orderkey AS STRING)",
                   "QuotationDate": "o_orderdate", "ClosingDate": _DATE_MS, "CloseDate": "o_orderdate",
                   "DeliveryDate": "o_orderdate", "Remarks": "o_orderpriority",
                   "YourRef": "'REF-' || CAST(o_orderkey AS STRING)"},
        "line": {**LINE_COMMON, "UnitDescription": "'pcs'", "UnitPrice": "l_extendedprice",
                 "VATAmountFC": "l_tax", "VATPercentage": "l_tax"},
    },
}


def _spark_expr(sql: str):
    if sql == "@LINE_ID":
        return line_uuid(*line_key_cols())
    if sql.startswith("@MS:"):
        ms = F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col(sql[4:]))
        return F.concat(F.lit("/Date("), ms.cast("string"), F.lit(")/"))
    return F.expr(sql)


def _duck_expr(sql: str) -> str:
    if sql.startswith("@MS:"):
        return sql[4:]
    return LINE_ID_SQL if sql == "@LINE_ID" else sql


def landed_documents(spark, sf: str, table: str, orders: DataFrame | None = None,
                     header_overrides: dict[str, str] | None = None) -> tuple[DataFrame, T.StructType]:
    """OData pages of nested documents built from orders and their line items.

    A page holds one document with at most ``LIST_ROWS`` lines (a larger order comes
    in several documents with the same header).  Lines are dealt by order key and nested there; the
    header joins each document once, on the same partitioning.
    """
    spec, doc = DOCS[table], NESTED[table]
    header_spec = {**spec["header"], **(header_overrides or {})}
    o = orders if orders is not None else load(spark, sf, "orders")
    li = load(spark, sf, "lineitem").withColumn("_chunk", bounded_chunk())
    # The table's columns move, not the longer texts made of them, once for all versions: lines of other
    # orders end behind the exchange (a semi join would be pushed below it).
    lines = li.withColumn("_k", F.col("l_orderkey")).repartition("_k")
    if orders is not None:
        lines = lines.join(orders.select(F.col("o_orderkey").alias("_k")).distinct(), "_k")
    # Record structs are built in a projection (whole-stage codegen): the list aggregate
    # evaluates its input without codegen.
    lines = lines.select("_k", "_chunk", F.struct(*[_spark_expr(e).alias(f) for f, e in spec["line"].items()]).alias("_line"))
    nested = lines.groupBy("_k", "_chunk").agg(F.collect_list("_line").alias("_lines"))
    docs = nested.join(o, F.col("_k") == F.col("o_orderkey"))
    pages = docs.select(F.expr(_DIV).alias("tenant"), F.col("o_orderkey").alias("page_no"), F.to_json(F.struct(F.struct(F.array(F.struct(
        *[_spark_expr(e).alias(f) for f, e in header_spec.items()],
        F.struct(F.col("_lines").alias("results")).alias(doc.line_column))).alias("results")).alias("d"))).alias("body"))
    schema = T.StructType([T.StructField(f, T.StringType()) for f in doc.header_fields] +
                          [T.StructField(doc.line_column, flatten.line_struct_type(doc.line_fields))])
    return pages, schema


def conformed_lines(spark, sf: str, table: str, orders: DataFrame | None = None,
                    header_overrides: dict[str, str] | None = None) -> DataFrame:
    """Landed pages -> A1 -> D7 (D1-D3) -> B1 -> C, in the target's column order."""
    pages, schema = landed_documents(spark, sf, table, orders=orders, header_overrides=header_overrides)
    rows = payloads.odata_rows(pages, schema, keep=["tenant"])
    types, headers = target_types("accounting", table), header_types(table)
    # header fields are coerced once per document, before its lines are exploded; that also keeps the generated
    # methods below the size that the JVM compiles
    typed = coerce_table(rows, [(f, t) for f, (_, t) in headers.items()], ACCOUNTING)
    flat = flatten.flatten_for_table(typed, table, keep=["tenant"])
    # Documents without a Division field get their page's tenant.
    mapped = mapping.map_keep(flat, column_mapping("accounting", table), "Division", F.col("tenant"))
    done = {c for c, _ in headers.values()}
    return mapping.conform(coerce_table(mapped, [(c, t) for c, t in types if c not in done], ACCOUNTING), types)


def header_types(table: str) -> dict[str, tuple[str, str]]:
    """Header field -> (target column, type) of the fields whose conversion cannot fail the table: a document without lines
    must not.  A header field that a line field of the same name replaces is left to the line."""
    doc, targets, rename = NESTED[table], dict(target_types("accounting", table)), dict(column_mapping("accounting", table))
    out = {}
    for f in doc.header_fields:
        name = f"{doc.prefix}_Description" if f == "Description" else f
        target = rename.get(name, name)
        if name not in doc.line_fields and targets.get(target) in ("int", "nvarchar", "bit", "date", "datetime"):
            out[f] = (target, targets[target])
    return out


def _duck_convert(expr: str, ref_type: str) -> str:
    if ref_type == "int":
        return f"CAST({expr} AS BIGINT)"
    if ref_type == "decimal":
        return f"CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,10))"
    if ref_type == "date":
        return f"CAST({expr} AS DATE)"
    if ref_type == "uniqueidentifier":
        return f"lower({expr})"
    return f"trim(CAST({expr} AS VARCHAR))"


def oracle_for(table: str, where: str = "") -> str:
    """The oracle SELECT of a flattened document table (inner join of headers and lines)."""
    spec, doc = DOCS[table], NESTED[table]
    source_expr = {}
    for f in doc.header_fields:
        name = f"{doc.prefix}_Description" if f == "Description" else f
        source_expr[name] = spec["header"].get(f)
    for f in doc.line_fields:
        source_expr[f] = spec["line"].get(f)
    source_expr.setdefault("Division", _DIV)
    rename = dict(column_mapping("accounting", table))
    cols = []
    for target, ref_type in target_types("accounting", table):
        src = next((s for s, t in rename.items() if t == target), target)
        expr = source_expr.get(src)
        if expr is None:
            sql_type = {"int": "BIGINT", "decimal": "DECIMAL(38,10)", "date": "DATE"}.get(ref_type, "VARCHAR")
            cols.append(f"CAST(NULL AS {sql_type}) AS {target}")
        else:
            cols.append(f"{_duck_convert(_duck_expr(expr), ref_type)} AS {target}")
    return (f"SELECT {', '.join(cols)} FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey"
            + (f" WHERE {where}" if where else ""))


@query("lines_invoice", oracle_for("Verkoopfacturen"))
def lines_invoice(spark, sf):
    return conformed_lines(spark, sf, "Verkoopfacturen")


@query("lines_order", oracle_for("VerkoopOrders"))
def lines_order(spark, sf):
    return conformed_lines(spark, sf, "VerkoopOrders")


@query("lines_quotation", oracle_for("Offertes"))
def lines_quotation(spark, sf):
    return conformed_lines(spark, sf, "Offertes")


# ----------------------------------------------------------------- D4-D6
_TENANT = "CAST(floor({k} / 2000) AS BIGINT)"
#: every seventh stream has no tenant: a stream of its own
_STREAM = "CASE WHEN {t} % 7 = 3 THEN NULL ELSE {t} END".format(t=_TENANT)


def _header_of(table: str) -> dict[str, str]:
    """Header fields as Spark / DuckDB expressions over orders; the key marks a header row."""
    doc, spec = NESTED[table], DOCS[table]["header"]
    out = {f: spec.get(f) for f in doc.header_fields if spec.get(f) is not None}
    out[flatten.FORWARD_FILL_IDS[table]] = "o_orderkey"
    out["Description"] = "'HEAD-' || CAST(o_orderkey AS STRING)"
    return out


def _fill_parts(table: str):
    doc = NESTED[table]
    header = {f: e for f, e in _header_of(table).items() if not e.startswith("@")}
    line = {f: e for f, e in DOCS[table]["line"].items() if e is not None and not e.startswith("@MS:")}
    line["Description"] = "l_returnflag || l_linestatus"
    return doc, header, {f: e for f, e in line.items() if f == "Description" or f not in header}


def _fill_oracle(table: str) -> str:
    doc, header, line = _fill_parts(table)
    cols = [f"{_STREAM.format(k='o.o_orderkey')} AS tenant"]
    cols += [f"CAST({_duck_expr(e)} AS VARCHAR) AS {f}" for f, e in line.items()]
    cols += [f"CAST({e} AS VARCHAR) AS {f + '' if f != 'Description' else doc.prefix + '_Description'}" for f, e in header.items()]
    return f"SELECT {', '.join(cols)} FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey".replace("AS STRING", "AS VARCHAR")


def _fill(spark, sf, table: str) -> DataFrame:
    """Interleaved rows: a header row (with a Description of its own) is followed by its lines in arrival
    order, ``seq`` = 2 * key (+ 1 for lines); some streams have a null tenant.  Buckets of 4096
    numbers put some headers and their lines into different buckets."""
    doc, header, line = _fill_parts(table)
    names = [*line, *[f for f in header if f not in line]]
    null = F.lit(None).cast("string")
    hdr_rows = load(spark, sf, "orders").select(
        F.expr(_STREAM.format(k="o_orderkey")).alias("tenant"), (F.col("o_orderkey") * 2).alias("seq"),
        *[(F.expr(header[f]).cast("string") if f in header else null).alias(f) for f in names])
    line_rows = load(spark, sf, "lineitem").select(
        F.expr(_STREAM.format(k="l_orderkey")).alias("tenant"), (F.col("l_orderkey") * 2 + 1).alias("seq"),
        *[(_spark_expr(line[f]).cast("string") if f in line else null).alias(f) for f in names])
    filled = flatten.flatten_for_table(hdr_rows.unionByName(line_rows), table, seq="seq", partition_cols=["tenant"])
    return filled.drop("seq")


@query("fill_invoice", _fill_oracle("Verkoopfacturen"))
def fill_invoice(spark, sf):
    return _fill(spark, sf, "Verkoopfacturen")


@query("fill_order", _fill_oracle("VerkoopOrders"))
def fill_order(spark, sf):
    return _fill(spark, sf, "VerkoopOrders")


@query("fill_quotation", _fill_oracle("Offertes"))
def fill_quotation(spark, sf):
    return _fill(spark, sf, "Offertes")


QUOTE_HEADER = {"QuotationID": "o_orderkey", "QuotationNumber": "o_orderkey", "VersionNumber": "1",
                "SalesPersonFullName": "'Sales ' || CAST(o_custkey AS STRING)", "Currency": "'EUR'",
                "StatusDescription": "o_orderstatus", "OrderAccount": "o_custkey",
                "Opportunity": "CAST(NULL AS STRING)", "QuotationDate": "o_orderdate",
                "ClosingDate": "o_orderdate", "CloseDate": "CAST(NULL AS DATE)",
                "DeliveryDate": "o_orderdate", "Remarks": "o_orderpriority",
                "YourRef": "'REF-' || CAST(o_orderkey AS STRING)"}
QUOTE_LINE = {"AmountDC": ("l_extendedprice", "o_totalprice"), "CostCenterDescription": ("'CC-' || l_returnflag", "'CC'"),
              "CostUnitDescription": ("'CU-' || l_linestatus", "'CU'"),
              "Description": ("l_returnflag || l_linestatus", "o_orderpriority"),
              "Discount": ("l_discount", "CAST(0 AS DOUBLE)"), "ID": ("@LINE_ID", "CAST(NULL AS STRING)"),
              "Item": ("l_partkey", "CAST(NULL AS BIGINT)"), "LineNumber": ("l_linenumber", "0"),
              "Quantity": ("l_quantity", "CAST(1 AS DOUBLE)"), "UnitDescription": ("'pcs'", "'pcs'"),
              "UnitPrice": ("l_extendedprice", "o_totalprice"), "VATAmountFC": ("l_tax", "CAST(0 AS DOUBLE)"),
              "VATPercentage": ("l_tax", "CAST(0 AS DOUBLE)")}


@query("lines_forward_fill", "SELECT " + ", ".join(
    [f"{_TENANT.format(k='o.o_orderkey')} AS tenant"] +
    [f"{_duck_expr(line)} AS {f}" for f, (line, _) in QUOTE_LINE.items()] +
    [f"{e} AS {f}" for f, e in QUOTE_HEADER.items()]) +
    " FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey")
def lines_forward_fill(spark, sf):
    """D6 over interleaved rows: a header row (with line values of its own) is
    followed by its lines in arrival order; ``seq`` = 2*key (+1 for lines).
    Buckets of 4096 sequence numbers put some headers and their lines in
    different buckets, so both the local and the carried-header path run
    (tests cover bucket sizes down to one row)."""
    o = load(spark, sf, "orders")
    li = load(spark, sf, "lineitem")
    hdr_rows = o.select(F.expr(_TENANT.format(k="o_orderkey")).alias("tenant"),
                        (F.col("o_orderkey") * 2).alias("seq"),
                        *[_spark_expr(h).alias(f) for f, (_, h) in QUOTE_LINE.items()],
                        *[F.expr(e).alias(f) for f, e in QUOTE_HEADER.items()])
    types = dict(hdr_rows.dtypes)
    line_rows = li.select(F.expr(_TENANT.format(k="l_orderkey")).alias("tenant"),
                          (F.col("l_orderkey") * 2 + 1).alias("seq"),
                          *[_spark_expr(ln).cast(types[f]).alias(f) for f, (ln, _) in QUOTE_LINE.items()],
                          *[F.lit(None).cast(types[f]).alias(f) for f in QUOTE_HEADER])
    interleaved = hdr_rows.unionByName(line_rows)
    filled = flatten.forward_fill_lines(interleaved, "QuotationID", list(QUOTE_HEADER), "seq", ["tenant"],
                                        bucket_rows=1 << 12)
    return filled.drop("seq")
