"""Queries over whole runs and their control data: outcomes, metadata-driven sync, projections, control scans, delimited
samples (A9, A12, A15, B4, B9, B14, B15, C12, C14, E5, G1, W12, W13, W17).

Customers play the administrations, nations the customers of the service; pages are built from the tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.coerce import datetime_text
from ..functions.predicates import projected
from ..operators import mapping, write
from ..plans import outcomes
from ..plans.metadata_run import metadata_work, run_metadata
from ..plans.publish import read_current
from ..session import scratch_path
from ..sources import control, payloads
from ._base import AS_OF, PAGE_ROWS, bounded_chunk, load, query, text, xml_elem

# ------------------------------------------------------------------ G1, G4
_TABLES = ("Relaties", "Budget", "Onbekend")


@query("run_outcomes", """
WITH plan AS (SELECT n_name AS customer, CAST(c_custkey AS VARCHAR) AS tenant, t.table_name
              FROM customer JOIN nation ON n_nationkey = c_nationkey CROSS JOIN (VALUES ('Relaties'), ('Budget'), ('Onbekend')) AS t(table_name)
              WHERE NOT (t.table_name = 'Onbekend' AND c_custkey % 10 <> 1) AND c_custkey % 17 <> 3),
     q AS (SELECT CAST(c_custkey AS VARCHAR) AS tenant, t.table_name, c_custkey % 13 <> 5 AS usable, CASE WHEN c_custkey % 13 = 5 THEN 1 ELSE 0 END AS bad
           FROM customer CROSS JOIN (VALUES ('Relaties'), ('Budget')) AS t(table_name) WHERE c_custkey % 11 <> 7),
     j AS (SELECT p.customer, coalesce(p.tenant, q.tenant) AS tenant, coalesce(p.table_name, q.table_name) AS table_name, p.tenant IS NOT NULL AS planned,
                  q.tenant IS NOT NULL AS landed, q.usable, q.bad
           FROM plan p FULL JOIN q ON p.tenant = q.tenant AND p.table_name = q.table_name),
     e AS (SELECT *, CASE WHEN NOT planned THEN 'not planned' WHEN table_name = 'Onbekend' THEN 'no write configuration' WHEN NOT landed THEN 'no page landed'
                          WHEN NOT usable THEN 'unreadable or missing pages (' || bad || ' unreadable)'
                          WHEN table_name = 'Budget' AND 'broke' <> '' THEN 'broke' END AS error FROM j),
     c AS (SELECT customer, bool_and(error IS NULL) AS customer_ok FROM e WHERE planned GROUP BY customer)
SELECT e.customer, tenant, table_name, planned, landed, CASE WHEN planned THEN error IS NULL END AS ok, error, customer_ok
FROM e LEFT JOIN c ON c.customer = e.customer
""")
def run_outcomes(spark, sf):
    """One outcome per customer, tenant and table, from what was planned, landed and written: tenants without a page, with a broken
    page, unplanned ones, a table nobody configured and a table whose job failed."""
    c = load(spark, sf, "customer").join(load(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
    plan = (c.select(F.col("n_name").alias("customer"), F.col("c_custkey").alias("tenant"), F.explode(F.array(*map(F.lit, _TABLES))).alias("table_name"))
            .filter("not (table_name = 'Onbekend' and tenant % 10 <> 1) and tenant % 17 <> 3").withColumn("configured", F.col("table_name") != "Onbekend"))
    pages = (c.select(F.col("c_custkey").alias("tenant"), F.explode(F.array(*map(F.lit, _TABLES[:2]))).alias("table"))
             .filter("tenant % 11 <> 7").select("tenant", "table", F.lit(0).cast("long").alias("page_no"), F.lit(None).cast("string").alias("next_token"),
                                               F.when(F.col("tenant") % 13 == 5, "<html>").otherwise('{"d":{"results":[]}}').alias("body")))
    quality = payloads.page_quality(pages, ["table", "tenant"]).withColumnRenamed("table", "table_name")
    written = spark.createDataFrame([("Relaties", None), ("Budget", "broke"), ("Onbekend", None)], "table_name string, error string")
    items = outcomes.run_outcomes(plan, quality, written)
    own = outcomes.customer_outcomes(items).select("customer", F.col("ok").alias("customer_ok"))
    return items.join(own, "customer", "left")


# ---------------------------------------------------------------------- A9
@query("element_union", """
SELECT CAST(p_partkey AS VARCHAR) AS "Key", p_brand AS "Brand", CASE WHEN p_size > 25 THEN CAST(p_size AS VARCHAR) END AS "Size",
       CASE WHEN p_partkey % 97 = 5 THEN 'odd </Part> & <b>' END AS "Note"
FROM part
""")
def element_union(spark, sf):
    """Records that carry different fields: the columns are the union of what occurs anywhere, markup in CDATA included."""
    p = load(spark, sf, "part")
    rec = F.concat(F.lit("<Part>"), xml_elem("Key", text(F.col("p_partkey"))), xml_elem("Brand", F.col("p_brand")),
                   F.when(F.col("p_size") > 25, xml_elem("Size", text(F.col("p_size")))).otherwise(F.lit("<!-- <Size>0</Size> -->")),
                   F.when(F.col("p_partkey") % 97 == 5, F.lit("<Note><![CDATA[odd </Part> & <b>]]></Note>")).otherwise(F.lit("")), F.lit("</Part>"))
    pages = (p.select(F.floor(F.col("p_partkey") / PAGE_ROWS).alias("page_no"), rec.alias("rec")).groupBy("page_no")
             .agg(F.concat(F.lit('<Envelope xmlns="urn:x"><Body><List>'), F.concat_ws("", F.collect_list("rec")), F.lit("</List></Body></Envelope>")).alias("body")))
    return payloads.element_union_rows(pages, "Part")


# --------------------------------------------------------------------- B14
_HEADER, _LINE = ["OrderID", "OrderNumber", "OrderDate", "StatusDescription"], ["ID", "LineNumber", "Quantity", "AmountDC"]


@query("projected_lines", """
SELECT CAST(o_orderkey AS VARCHAR) AS "OrderID", o_orderkey AS "OrderNumber", o_orderdate AS "OrderDate", o_orderstatus AS "StatusDescription",
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS "SalesOrderLines_ID", l_linenumber AS "SalesOrderLines_LineNumber",
       l_quantity AS "SalesOrderLines_Quantity", l_extendedprice AS "SalesOrderLines_AmountDC"
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
""")
def projected_lines(spark, sf):
    """A wide nested landing of orders, of which the scan reads the declared header and line fields only."""
    line = load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("_o"),
        F.struct(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("ID"), F.col("l_linenumber").alias("LineNumber"),
                 F.col("l_quantity").alias("Quantity"), F.col("l_extendedprice").alias("AmountDC"), F.col("l_discount").alias("Discount"), F.col("l_tax").alias("VATPercentage"),
                 F.col("l_comment" if "l_comment" in load(spark, sf, "lineitem").columns else "l_returnflag").alias("Description")).alias("_l"))
    lines = line.groupBy("_o").agg(F.struct(F.collect_list("_l").alias("results")).alias("SalesOrderLines"))        # lines of one order
    o = load(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("OrderID"), F.col("o_orderkey").alias("OrderNumber"), F.col("o_orderdate").alias("OrderDate"),
                                         F.col("o_orderstatus").alias("StatusDescription"), F.col("o_totalprice").alias("AmountFC"), F.col("o_orderkey").alias("_o"))
    path = scratch_path(spark, f"nested-orders-{uuid.uuid4().hex}")
    o.join(lines, "_o").drop("_o").write.parquet(path)
    return projected(spark.read.parquet(path), _HEADER, "SalesOrderLines", _LINE)


# ------------------------------------------------- A4, B15, B4, C14, W12, W13
_MAPPING = [(1, "c_custkey", "KlantID", "int"), (1, "c_name", "Naam", "nvarchar(100)"), (1, "c_acctbal", "Saldo", "decimal(18,2)"), (1, "niet_aanwezig", "Extra", "nvarchar"),
            (2, "p_partkey", "ArtikelID", "bigint"), (2, "p_brand", "Merk", "nvarchar(50)")]


@query("metadata_sync", """
SELECT 'Klanten' AS tabel, CAST(c_custkey AS BIGINT) AS sleutel,
       CASE WHEN c_custkey % 3 = 0 THEN upper(c_name) ELSE c_name END AS naam,
       CAST(CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS DECIMAL(18, 2)) AS saldo
FROM customer
UNION ALL
SELECT 'Artikelen', p_partkey, p_brand, NULL FROM part WHERE p_partkey % 4 <> 0 OR p_partkey % 2 = 1
""")
def metadata_sync(spark, sf):
    """Two runs from mapping rows alone.  Klanten has a key: the second run changes a third of its rows (W12).  Artikelen has none: the
    second run replaces the rows of the one administration whose pages landed whole (W13), the other keeps its own."""
    root = scratch_path(spark, f"metadata-{uuid.uuid4().hex}")
    administrations = spark.createDataFrame([(1, "A", 10, True), (2, "B", 10, True), (3, "C", 10, False)], control.ADMINISTRATIE)
    links = spark.createDataFrame([(a, t, n, True) for a in (1, 2) for t, n in ((1, "Klanten"), (2, "Artikelen"))], control.TABEL_ADMIN_KOPPELING)
    tables = spark.createDataFrame([(1, "fin", "Klanten", "/v1/klant/"), (2, "fin", "Artikelen", "/v1/artikel"), (9, "ander", "Klanten", "/x")], control.TABELLEN)
    mapping_table = spark.createDataFrame(_MAPPING, control.TABELLEN_MAPPING)
    work = metadata_work(administrations, links, tables, "fin")
    customer, part = load(spark, sf, "customer"), load(spark, sf, "part")

    def pages(df, table, key, resource, cols):
        paged = df.select((F.col(key) % 2 + 1).cast("string").alias("tenant"), F.floor(F.col(key) / PAGE_ROWS).alias("page_no"), F.to_json(F.struct(*cols)).alias("rec"))
        bodies = paged.groupBy("tenant", "page_no").agg(F.concat(F.lit(f'{{"{resource}":['), F.concat_ws(",", F.collect_list("rec")), F.lit("]}")).alias("body"))
        ends = bodies.groupBy("tenant").agg(F.max("page_no").alias("_last"))
        return bodies.join(ends, "tenant").select("tenant", F.lit(table).alias("table"), "page_no", "body",
                                                  F.when(F.col("page_no") < F.col("_last"), "offset").alias("next_token"))

    cols = ["c_custkey", "c_name", "c_acctbal", F.lit("x").alias("zonder_mapping")]
    first = pages(customer, "Klanten", "c_custkey", "klant", cols).unionByName(pages(part, "Artikelen", "p_partkey", "artikel", ["p_partkey", "p_brand"]))
    run_metadata(spark, first, work, mapping_table, {"Klanten": ["KlantID"]}, root, AS_OF)
    third = customer.filter("c_custkey % 3 = 0").select("c_custkey", F.upper("c_name").alias("c_name"), (F.col("c_acctbal") + 1).alias("c_acctbal"))
    kept = part.filter("p_partkey % 4 <> 0")
    second = pages(third, "Klanten", "c_custkey", "klant", ["c_custkey", "c_name", "c_acctbal"]).unionByName(
        # administration 2 (odd keys) lands an error page instead of its articles
        pages(kept, "Artikelen", "p_partkey", "artikel", ["p_partkey", "p_brand"]).withColumn("body", F.when(F.col("tenant") == "2", "<html>502</html>").otherwise(F.col("body"))))
    run_metadata(spark, second, work, mapping_table, {"Klanten": ["KlantID"]}, root, AS_OF)
    k, a = read_current(spark, f"{root}/Klanten"), read_current(spark, f"{root}/Artikelen")
    return (k.select(F.lit("Klanten").alias("tabel"), F.col("KlantID").cast("long").alias("sleutel"), F.col("Naam").alias("naam"), F.col("Saldo").alias("saldo"))
            .unionByName(a.select(F.lit("Artikelen").alias("tabel"), F.col("ArtikelID").alias("sleutel"), F.col("Merk").alias("naam"),
                                  F.lit(None).cast("decimal(18,2)").alias("saldo"))))


# ---------------------------------------------------------------- A12, B15
@query("control_scans", """
SELECT CAST(c_custkey AS INTEGER) AS "AdministratieID", 'tabel' || (t.i) AS "TabelNaam", '/v1/tabel' || (t.i) AS "Endpoint", 'kolom' || (m.j) AS "Doelkolom"
FROM customer CROSS JOIN (VALUES (1), (2), (3), (4)) AS t(i) JOIN (VALUES (1), (2), (3)) AS m(j) ON m.j <= t.i
WHERE c_nationkey = 7 AND c_acctbal >= 0 AND c_custkey = (SELECT min(c_custkey) FROM customer WHERE c_nationkey = 7 AND c_acctbal >= 0)
  AND t.i % 2 = 0 AND (c_custkey + t.i) % 3 <> 0 AND t.i = 2
""")
def control_scans(spark, sf):
    """The equality scans of a run, one after the other: a customer's active administrations, the application's tables, an administration's
    active links, a table's mapping and endpoint."""
    c = load(spark, sf, "customer")
    adm = c.select(F.col("c_custkey").cast("int").alias("AdministratieID"), F.col("c_name").alias("AdministratieCode"), F.col("c_nationkey").cast("int").alias("KlantID"),
                   (F.col("c_acctbal") >= 0).alias("Actief"))
    tables = spark.createDataFrame([(i, "fin" if i % 2 == 0 else "ander", f"tabel{i}", f"/v1/tabel{i}") for i in range(1, 5)], control.TABELLEN)
    links = adm.select("AdministratieID", F.explode(F.array(*map(F.lit, range(1, 5)))).alias("TabelID")).withColumn(
        "TabelNaam", F.concat(F.lit("tabel"), F.col("TabelID").cast("string"))).withColumn("Actief", (F.col("AdministratieID") + F.col("TabelID")) % 3 != 0)
    maps = spark.createDataFrame([(i, f"bron{j}", f"kolom{j}", "int") for i in range(1, 5) for j in range(1, 4) if j <= i], control.TABELLEN_MAPPING)
    first = control.administrations_for(adm, 7).agg(F.min("AdministratieID").alias("AdministratieID"))
    chosen = first.join(control.administrations_for(adm, 7), "AdministratieID")
    number = first.first()["AdministratieID"]                                       # one row of a control table
    on = control.links_for_administration(links, number if number is not None else -1).join(control.tables_for_application(tables, "fin").select("TabelID"), "TabelID")
    return (chosen.select("AdministratieID").join(on, "AdministratieID").join(control.mapping_for_table(maps, 2), "TabelID")
            .join(control.endpoint_for(tables, "tabel2"), "TabelNaam").select("AdministratieID", "TabelNaam", "Endpoint", "Doelkolom"))


# --------------------------------------------------------------------- A15
@query("delimited_rows", """
SELECT s_suppkey, s_name, CASE WHEN s_nationkey % 2 = 0 THEN s_nationkey END AS s_nationkey, s_acctbal FROM supplier
""")
def delimited_rows(spark, sf):
    """A delimited sample with a header, quoted fields and empty values, read under its declared schema."""
    s = load(spark, sf, "supplier").select("s_suppkey", "s_name", F.when(F.col("s_nationkey") % 2 == 0, F.col("s_nationkey")).alias("s_nationkey"), "s_acctbal")
    path = scratch_path(spark, f"delimited-{uuid.uuid4().hex}")
    s.write.option("header", True).option("sep", ";").option("quoteAll", True).csv(path)
    return control.read_delimited(spark, path, s.schema, sep=";")


# ---------------------------------------------------------------------- C12
@query("datetime_texts", """
SELECT o_orderkey, strftime(CAST(o_orderdate AS TIMESTAMP) + to_seconds(CAST(o_orderkey % 86400 AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS moment
FROM orders
""")
def datetime_texts(spark, sf):
    o = load(spark, sf, "orders")
    moment = F.timestamp_add("SECOND", (F.col("o_orderkey") % 86400).cast("int"), F.col("o_orderdate").cast("timestamp_ntz"))
    return o.select("o_orderkey", datetime_text(moment).alias("moment"))


# ------------------------------------------------------------------ B9, W17
@query("write_validation", """
SELECT CAST(c_nationkey AS BIGINT) AS tenant, count(*) AS n_rows, CASE WHEN c_nationkey % 5 = 4 THEN 'key columns missing' WHEN c_nationkey % 5 = 3 THEN 'nothing to write'
       ELSE 'accepted' END AS verdict
FROM customer WHERE c_nationkey < 10 GROUP BY c_nationkey
""")
def write_validation(spark, sf):
    """The checks before a write, for the rows of ten tenants: rows with their key column, an empty frame that carries the columns
    (B9), and rows whose key column is missing."""
    c = load(spark, sf, "customer").select(F.col("c_nationkey").cast("long").alias("tenant"), "c_custkey", "c_name")
    sizes = {r["tenant"]: r["n"] for r in c.filter("tenant < 10").groupBy("tenant").agg(F.count(F.lit(1)).alias("n")).collect()}      # ten numbers
    out = []
    for tenant, n in sizes.items():
        rows = c.filter(F.col("tenant") == tenant)
        frame = mapping.empty_frame(spark, rows.schema) if tenant % 5 == 3 else rows.drop("c_custkey") if tenant % 5 == 4 else rows
        try:
            verdict = "accepted" if write.validate_write(frame, "T", ["c_custkey"]) else "nothing to write"
        except write.WriteError:
            verdict = "key columns missing"
        out.append((tenant, n, verdict))
    return spark.createDataFrame(out, "tenant long, n_rows long, verdict string")
