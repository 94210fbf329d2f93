"""Queries over landed payloads.

Each query lands a harness table as API pages (JSON envelopes or XML) in
bounded pages, then reads it back with the ``sources.payloads`` readers;
a correct reader reproduces the table, which the oracle reads directly.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import PAYROLL, coerce_table, ACCOUNTING
from ..operators.mapping import add_constant, map_select
from ..schemas import column_mapping, target_types
from ..sources import chains, payloads
from ._base import PAGE_ROWS, bounded_chunk, load, query, text, xml_elem

CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


# --------------------------------------------------------------- A1 + A2
@query("odata_unwrap", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
""")
def odata_unwrap(spark, sf):
    c = load(spark, sf, "customer").select(*CUSTOMER_COLS)
    rec = F.to_json(F.struct(*CUSTOMER_COLS))
    paged = c.select(F.floor(F.col("c_custkey") / PAGE_ROWS).alias("page_no"), rec.alias("rec"))
    # Every fourth page arrives record by record as bare objects (no "d").
    singles = paged.filter(F.col("page_no") % 4 == 3).select(F.col("page_no"), F.col("rec").alias("body"))
    grouped = (paged.filter(F.col("page_no") % 4 != 3).groupBy("page_no")
               .agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list("rec")), F.lit("]")).alias("items")))
    nxt = F.concat(F.lit("/api/customers?$skiptoken="), (F.col("page_no") + 1).cast("string"))
    body = (F.when(F.col("page_no") % 4 == 0,
                   F.concat(F.lit('{"d":{"results":'), F.col("items"), F.lit(',"__next":"'), nxt, F.lit('"}}')))
            .when(F.col("page_no") % 4 == 1, F.concat(F.lit('{"d":'), F.col("items"), F.lit("}")))
            .otherwise(F.col("items")))
    # A "d" object without "results" (a bare continuation) carries no records;
    # one follows every results page (emitted beside it, no second aggregation).
    trailer = F.lit('{"d":{"__count":"0"}}')
    bodies = F.when(F.col("page_no") % 4 == 0, F.array(body, trailer)).otherwise(F.array(body))
    pages = grouped.select("page_no", F.explode(bodies).alias("body"))
    landed = pages.unionByName(singles)
    return payloads.odata_rows(landed, c.schema).select(*CUSTOMER_COLS)


# ---------------------------------------------------------------------- A3
@query("row_envelope", """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
""")
def row_envelope(spark, sf):
    s = load(spark, sf, "supplier")
    cols = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]
    pages = (s.select(F.floor(F.col("s_suppkey") / 50).alias("page_no"), F.struct(*cols).alias("rec"))
             .groupBy("page_no")
             .agg(F.to_json(F.struct(F.collect_list("rec").alias("rows"))).alias("body")))
    return payloads.envelope_rows(pages, s.select(*cols).schema).select(*cols)


# ------------------------------------------------------------- A4 + A11
@query("keyed_envelope", """
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part
""")
def keyed_envelope(spark, sf):
    p = load(spark, sf, "part")
    cols = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
    pg = p.withColumn("page_no", F.floor(F.col("p_partkey") / 200))
    # Half of the pages come from the administrations endpoint (key "admdat").
    resource = F.when(F.col("page_no") % 2 == 0, F.lit("Part")).otherwise(F.lit("admdat"))
    pages = (pg.select("page_no", F.struct(*cols).alias("rec"))
             .groupBy("page_no").agg(F.collect_list("rec").alias("recs"))
             .select("page_no",
                     F.concat(F.lit("/api/v1/"), resource, F.lit("?offset_rowid="),
                              F.col("page_no").cast("string")).alias("endpoint"),
                     F.to_json(F.create_map(resource, F.col("recs"))).alias("body")))
    return payloads.keyed_rows(pages, p.select(*cols).schema,
                               payloads.resource_of(F.col("endpoint"))).select(*cols)


# ----------------------------------------------------------------- A5 + A7
@query("atom_entries", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(NULL AS VARCHAR) AS c_comment
FROM customer
""")
def atom_entries(spark, sf):
    c = load(spark, sf, "customer")
    # A control character reference is slipped into every name (A7 removes it).
    name = F.regexp_replace(F.col("c_name"), "#", "&#x1F;#")
    props = F.concat(
        F.lit("<m:properties>"),
        F.concat(F.lit("<d:c_custkey>"), text(F.col("c_custkey")), F.lit("</d:c_custkey>")),
        F.concat(F.lit("<d:c_name>"), name, F.lit("</d:c_name>")),
        F.concat(F.lit("<d:c_nationkey>"), text(F.col("c_nationkey")), F.lit("</d:c_nationkey>")),
        F.concat(F.lit("<d:c_acctbal>"), text(F.col("c_acctbal")), F.lit("</d:c_acctbal>")),
        xml_elem("d:c_mktsegment", F.col("c_mktsegment")),
        F.lit("<d:c_comment></d:c_comment></m:properties>"))
    entry = F.concat(F.lit("<entry><id>"), text(F.col("c_custkey")), F.lit("</id><content type=\"application/xml\">"),
                     props, F.lit("</content></entry>"))
    pages = (c.select(F.floor(F.col("c_custkey") / PAGE_ROWS).alias("page_no"), entry.alias("entry"))
             .groupBy("page_no")
             .agg(F.concat(
                 F.lit('<feed xmlns="http://www.w3.org/2005/Atom" '
                       'xmlns:m="http://schemas.microsoft.com/ado/2007/08/dataservices/metadata" '
                       'xmlns:d="http://schemas.microsoft.com/ado/2007/08/dataservices">'
                       '<title>Customers</title><link rel="next" href="/api/customers?page='),
                 (F.col("page_no") + 1).cast("string"), F.lit('"/>'),
                 F.concat_ws("", F.collect_list("entry")), F.lit("</feed>")).alias("body")))
    rows = payloads.atom_rows(pages, ["c_custkey", "c_name", "c_nationkey", "c_acctbal",
                                      "c_mktsegment", "c_comment"])
    return rows.select(F.col("c_custkey").try_cast("bigint").alias("c_custkey"), "c_name",
                       F.col("c_nationkey").try_cast("int").alias("c_nationkey"),
                       F.col("c_acctbal").try_cast("double").alias("c_acctbal"),
                       "c_mktsegment", "c_comment")


# ---------------------------------------------------------------------- A6
@query("extra_fields", """
SELECT event_id AS ItemID, ts AS Modified, CAST(json_extract(props, '$.k') AS BIGINT) AS Number,
       event_type AS Description, CAST(CAST(value AS VARCHAR) AS DECIMAL(38,10)) AS Value
FROM events
""")
def extra_fields(spark, sf):
    from ..functions.coerce import to_datetime, to_decimal, to_int
    e = load(spark, sf, "events")
    pad = F.lit("  ")
    elem = F.concat(
        F.lit("<element>"),
        F.concat(F.lit("<ItemID>"), pad, text(F.col("event_id")), pad, F.lit("</ItemID>")),
        F.concat(F.lit("<Modified>"), text(F.col("ts")), F.lit("</Modified>")),
        F.concat(F.lit("<Number> "), F.get_json_object("props", "$.k"), F.lit(" </Number>")),
        F.concat(F.lit("<Description>"), pad, F.col("event_type"), pad, F.lit("</Description>")),
        F.concat(F.lit("<Value>"), text(F.col("value")), F.lit("</Value>")),
        F.lit("</element>"))
    pages = (e.select(F.floor(F.col("event_id") / 500).alias("page_no"), elem.alias("elem")).groupBy("page_no")
             .agg(F.concat(F.lit("<ItemExtraFields>"), F.concat_ws("", F.collect_list("elem")),
                           F.lit("</ItemExtraFields>")).alias("body")))
    rows = payloads.extra_field_rows(pages)
    return rows.select(to_int(F.col("ItemID")).alias("ItemID"),
                       to_datetime(F.col("Modified")).alias("Modified"),
                       to_int(F.col("Number")).alias("Number"),
                       F.col("Description"),
                       to_decimal(F.col("Value")).alias("Value"))


# ---------------------------------------------------------------------- A8
@query("wage_report", """
SELECT CAST(n.n_nationkey AS BIGINT) AS BedrijfID, CAST(n.n_regionkey AS BIGINT) AS Bedrijfsnummer,
       n.n_name AS Bedrijfsnaam, c.c_custkey AS WerknemerID, c.c_custkey AS Werknemer_nummer,
       o.o_orderkey AS LooncomponentID, o.o_custkey AS Looncomponent_nummer,
       o.o_orderpriority AS Looncomponentnaam, CAST(CAST(o.o_totalprice AS VARCHAR) AS DECIMAL(38,10)) AS Looncomponentwaarde,
       CAST(month(o.o_orderdate) AS BIGINT) AS Periode, CAST(2025 AS BIGINT) AS Jaar, CAST(1 AS BIGINT) AS Run
FROM nation n JOIN customer c ON c.c_nationkey = n.n_nationkey JOIN orders o ON o.o_custkey = c.c_custkey
""")
def wage_report(spark, sf):
    n = load(spark, sf, "nation")
    c = load(spark, sf, "customer")
    o = load(spark, sf, "orders")
    component = F.concat(
        F.lit("<WageComponents>"), xml_elem("ComponentGuid", F.col("o_orderkey")),
        xml_elem("ComponentNumber", F.col("o_custkey")), xml_elem("ComponentName", F.col("o_orderpriority")),
        xml_elem("CumulativeValue", F.col("o_totalprice")),
        F.lit("<Values><Value>"), xml_elem("ComponentValue", F.col("o_totalprice")),
        xml_elem("Period", F.month("o_orderdate")), F.lit("<Run>1</Run></Value></Values></WageComponents>"))
    co = c.join(o, c.c_custkey == o.o_custkey, "left")
    # A report holds at most 1000 orders: chunk on the (unique) order key; a
    # customer without orders is an employee without wage components.
    co = co.select("c_nationkey", "c_custkey", "c_name",
                   F.coalesce(F.floor(F.col("o_orderkey") / 1000),
                              -1 - F.floor(F.col("c_custkey") / 1000)).alias("chunk"),
                   F.when(F.col("o_orderkey").isNotNull(), component).alias("component"))
    employees = (co.groupBy("c_nationkey", "chunk", "c_custkey", "c_name")
                 .agg(F.concat_ws("", F.collect_list("component")).alias("components"))
                 .select("c_nationkey", "chunk", F.concat(
                     F.lit("<Employees>"), xml_elem("EmployeeID", F.col("c_custkey")),
                     xml_elem("EmployeeName", F.col("c_name")), xml_elem("EmployeeNumber", F.col("c_custkey")),
                     F.lit("<WageComponentsList>"), F.col("components"), F.lit("</WageComponentsList></Employees>"))
                     .alias("employee")))
    reports = (employees.groupBy("c_nationkey", "chunk")
               .agg(F.concat_ws("", F.collect_list("employee")).alias("employees"))
               .join(n, F.col("c_nationkey") == n.n_nationkey)
               .select(F.concat(F.lit("<CompanyEmployeeWageComponentsResult>"),
                                xml_elem("CompanyID", F.col("n_nationkey")),
                                xml_elem("CompanyName", F.col("n_name")),
                                xml_elem("CompanyNumber", F.col("n_regionkey")),
                                F.lit("<PeriodType>1</PeriodType><EmployeesList>"), F.col("employees"),
                                F.lit("</EmployeesList></CompanyEmployeeWageComponentsResult>")).alias("body")))
    rows = payloads.wage_report_rows(reports)
    rows = add_constant(rows, "Jaar", 2025)
    mapped = map_select(rows, column_mapping("payroll", "Looncomponenten"))
    return coerce_table(mapped, target_types("payroll", "Looncomponenten"), PAYROLL)


# ---------------------------------------------------------------------- A9
@query("element_rows", """
SELECT s_suppkey AS BedrijfID, CAST(s_nationkey AS BIGINT) AS Bedrijfsnummer, s_name AS Bedrijfsnaam
FROM supplier
""")
def element_rows(spark, sf):
    s = load(spark, sf, "supplier")
    company = F.concat(F.lit("<Company>"), xml_elem("ID", F.col("s_suppkey")),
                       xml_elem("Number", F.col("s_nationkey")), xml_elem("Name", F.col("s_name")),
                       F.lit("<Active>true</Active></Company>"))
    pages = (s.select(F.floor(F.col("s_suppkey") / 50).alias("page_no"), company.alias("company"))
             .groupBy("page_no")
             .agg(F.concat(
                 F.lit("\ufeff<soap:Envelope xmlns:soap=\"http://schemas.xmlsoap.org/soap/envelope/\">"
                       "<soap:Body><List_GetAllResponse xmlns=\"https://api.example/soap/CompanyService/\">"
                       "<List_GetAllResult>"),
                 F.concat_ws("", F.collect_list("company")),
                 F.lit("</List_GetAllResult></List_GetAllResponse></soap:Body></soap:Envelope>")).alias("body")))
    rows = payloads.element_rows(pages, ["Body", "List_GetAllResponse", "List_GetAllResult", "Company"],
                                 ["ID", "Number", "Name", "Active"])
    mapped = map_select(rows, column_mapping("payroll", "Bedrijven"))
    return coerce_table(mapped, target_types("payroll", "Bedrijven"), PAYROLL)


# --------------------------------------------------------------------- A10
@query("list_unnest", """
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
       l.l_partkey AS line_l_partkey, l.l_suppkey AS line_l_suppkey, l.l_linenumber AS line_l_linenumber,
       l.l_quantity AS line_l_quantity, l.l_extendedprice AS line_l_extendedprice
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
""")
def list_unnest(spark, sf):
    o = load(spark, sf, "orders")
    li = load(spark, sf, "lineitem")
    fields = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    # The join deals both sides by order key; nesting (order, chunk) lists needs no further shuffle, and a chunk
    # bounds every list however many lines an order has.
    joined = o.join(li.select("l_orderkey", bounded_chunk().alias("chunk"), F.struct(*fields).alias("rec")),
                    F.col("o_orderkey") == F.col("l_orderkey"), "left")
    docs = (joined.groupBy("o_orderkey", "chunk").agg(F.any_value(F.struct(*[F.col(c) for c in o.columns if c != "o_orderkey"])).alias("_o"),
                                                      F.collect_list("rec").alias("line"))
            .select("o_orderkey", "_o.*", "line"))
    return payloads.unnest_list(docs, "line")


# ---------------------------------------------------------------------- A2
@query("page_chain_complete", """
WITH p AS (SELECT c_nationkey AS tenant, CAST(floor(c_custkey / 50) AS BIGINT) AS page_no
           FROM customer GROUP BY 1, 2),
     m AS (SELECT tenant, max(page_no) AS mx FROM p GROUP BY 1),
     t AS (SELECT p.tenant, p.page_no,
                  CASE WHEN p.page_no = m.mx AND p.tenant <> 7 THEN NULL ELSE 'next' END AS next_token
           FROM p JOIN m USING (tenant))
SELECT tenant, count(*) AS n_pages, max(page_no) AS last_page,
       count(*) FILTER (WHERE next_token IS NULL) AS n_final,
       (count(*) FILTER (WHERE next_token IS NULL) = 1 AND arg_max(next_token IS NULL, page_no)
        AND count(*) = max(page_no) - min(page_no) + 1) AS complete
FROM t GROUP BY tenant
""")
def page_chain_complete(spark, sf):
    c = load(spark, sf, "customer")
    pages = (c.select(F.col("c_nationkey").alias("tenant"),
                      F.floor(F.col("c_custkey") / 50).cast("long").alias("page_no"),
                      F.struct("c_custkey", "c_name").alias("rec"))
             .groupBy("tenant", "page_no").agg(F.to_json(F.collect_list("rec")).alias("body")))
    last = pages.groupBy("tenant").agg(F.max("page_no").alias("mx"))
    # The landing of tenant 7 was cut: its last page still announces a next page.
    landed = (pages.join(last, "tenant")
              .withColumn("next_token", F.when((F.col("page_no") == F.col("mx")) & (F.col("tenant") != 7),
                                               F.lit(None).cast("string")).otherwise(F.lit("next")))
              .drop("mx"))
    return payloads.chain_status(landed, ["tenant"]).select(
        "tenant", "n_pages", "last_page", "n_final", "complete")


# --------------------------------------------------------------------- A14
@query("tenant_projection", """
SELECT c_name AS Entiteit, c_custkey AS Division, CAST(c_nationkey AS BIGINT) AS CustomerCode,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS CustomerName,
       c_mktsegment AS CompanySizeDescription, CAST(NULL AS VARCHAR) AS State,
       'NL' AS City, CAST(c_custkey * 10 AS VARCHAR) AS HID
FROM customer
""")
def tenant_projection(spark, sf):
    c = load(spark, sf, "customer")
    rec = F.struct(F.col("c_custkey").alias("Code"), F.col("c_name").alias("Description"),
                   F.col("c_mktsegment").alias("CompanySizeDescription"),
                   F.lit(None).cast("string").alias("State"), F.lit(" NL ").alias("City"),
                   (F.col("c_custkey") * 10).cast("string").alias("Hid"),
                   F.col("c_nationkey").cast("string").alias("CustomerCode"),
                   F.when(F.col("c_acctbal") >= 0, F.struct(F.col("c_mktsegment").alias("Description")))
                   .alias("Class_02"))
    pages = (c.select(F.floor(F.col("c_custkey") / PAGE_ROWS).alias("page_no"), F.to_json(rec).alias("rec"))
             .groupBy("page_no")
             .agg(F.concat(F.lit('{"d":{"results":['), F.concat_ws(",", F.collect_list("rec")),
                           F.lit("]}}")).alias("body")))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in
                           ["Code", "Description", "CompanySizeDescription", "State", "City", "Hid",
                            "CustomerCode"]] +
                          [T.StructField("Class_02", T.StructType([T.StructField("Description", T.StringType())]))])
    rows = payloads.division_projection(payloads.odata_rows(pages, schema))
    return coerce_table(rows, target_types("accounting", "Divisions"), ACCOUNTING)


# ------------------------------------------------- A3 -> B7 -> B10 -> C (ERP)
_ERP_WM = "2024-01-10T00:00:00"
_GUID = "md5(CAST(user_id AS STRING))"


@query("erp_roosters", f"""
SELECT CAST(7 AS BIGINT) AS OmgevingID, user_id AS Administratie_Code,
       'user ' || CAST(user_id AS VARCHAR) AS Medewerker_Naam,
       lower(substr({_GUID},1,8) || '-' || substr({_GUID},9,4) || '-' || substr({_GUID},13,4) || '-' ||
             substr({_GUID},17,4) || '-' || substr({_GUID},21,12)) AS Medewerker_GUID,
       event_type AS Type, CAST(ts AS DATE) AS Datum,
       CAST(CAST(value AS VARCHAR) AS DECIMAL(38,10)) AS Uren,
       CAST(NULL AS DECIMAL(38,10)) AS FTE, CAST(NULL AS DECIMAL(38,10)) AS Parttime_Percentage,
       '' AS Afdeling_Code, ts AS Gewijzigd_Op, event_type = 'view' AS Pro_forma
FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'
""")
def erp_roosters(spark, sf):
    """ERP rows arrive in ``{"rows": [...]}`` envelopes with target names already;
    the environment id is added (B7), absent columns get their type's default
    (B10), values are typed by the ERP policy (untrimmed text, lenient uuid,
    offsets dropped), and the catalogue's filter on ``Gewijzigd_Op`` applies."""
    from ..functions.predicates import predicate_for
    from ..plans.table_sync import conform_records
    from ..schemas import CATALOGUE_ENTRIES
    e = load(spark, sf, "events")
    rec = F.struct(
        F.col("user_id").cast("string").alias("Administratie_Code"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("Medewerker_Naam"),
        F.concat(F.lit("{"), F.upper(F.md5(F.col("user_id").cast("string"))), F.lit("}")).alias("Medewerker_GUID"),
        F.col("event_type").alias("Type"),
        F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("T00:00:00")).alias("Datum"),
        F.col("value").cast("string").alias("Uren"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+01:00")).alias("Gewijzigd_Op"),
        F.when(F.col("event_type") == "view", "True").otherwise("0").alias("Pro_forma"))
    pages = (e.select(F.floor(F.col("event_id") / 500).alias("page_no"), rec.alias("rec"))
             .groupBy("page_no").agg(F.to_json(F.struct(F.collect_list("rec").alias("rows"))).alias("body")))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in
                           ["Administratie_Code", "Medewerker_Naam", "Medewerker_GUID", "Type", "Datum", "Uren",
                            "Gewijzigd_Op", "Pro_forma"]])
    rows = payloads.envelope_rows(pages, schema)
    typed = conform_records(rows, "erp", "Roosters", tenant=F.lit(7))
    entry = next(c for c in CATALOGUE_ENTRIES if (c.source, c.mode, c.table) == ("erp", "regular", "Roosters"))
    return typed.filter(predicate_for(entry.filter_kind, entry.filter_column, watermark=_ERP_WM))


# ------------------------------------- A1 -> B1 (with the B5 swap) -> C (accounting)
_REL_VALUES = {  # source field -> (Spark expression builder, oracle expression for the typed target)
    "ID": (lambda: F.concat(F.lit("{"), F.upper(F.md5(F.col("c_custkey").cast("string"))), F.lit("}")), "@UUID"),
    "Division": (lambda: F.col("c_nationkey"), "CAST(c_nationkey AS BIGINT)"),
    "Code": (lambda: F.concat(F.lit("  "), F.col("c_custkey").cast("string"), F.lit(" ")),
             "CAST(c_custkey AS VARCHAR)"),
    "CustomerSince": (lambda: F.concat(F.lit("/Date("), (F.col("c_custkey") * 86400000).cast("string"), F.lit(")/")),
                      "DATE '1970-01-01' + CAST(c_custkey AS INTEGER)"),
    "Name": (lambda: F.col("c_name"), "c_name"),
    "City": (lambda: F.col("c_mktsegment"), "c_mktsegment"),
    "IsPurchase": (lambda: F.col("c_acctbal") > 0, "c_acctbal > 0"),
    "IsSupplier": (lambda: F.when(F.col("c_acctbal") > 5000, 1).otherwise(0), "c_acctbal > 5000"),
    "Status": (lambda: F.lit(" A"), "'A'"),
}
_H_REL = "md5(CAST(c_custkey AS VARCHAR))"
_UUID_REL = (f"lower(substr({_H_REL},1,8) || '-' || substr({_H_REL},9,4) || '-' || substr({_H_REL},13,4) || '-' || "
             f"substr({_H_REL},17,4) || '-' || substr({_H_REL},21,12))")


def _relaties_oracle() -> str:
    rename = dict(column_mapping("accounting", "Relaties"))
    back = {t: s for s, t in rename.items()}
    sql_type = {"nvarchar": "VARCHAR", "uniqueidentifier": "VARCHAR", "int": "BIGINT", "date": "DATE",
                "bit": "BOOLEAN", "decimal": "DECIMAL(38,10)"}
    cols = []
    for target, ref_type in target_types("accounting", "Relaties"):
        src = back[target]
        if src in _REL_VALUES:
            e = _REL_VALUES[src][1]
            cols.append(f"{_UUID_REL if e == '@UUID' else e} AS {target}")
        elif ref_type == "bit":
            cols.append(f"false AS {target}")
        else:
            cols.append(f"CAST(NULL AS {sql_type[ref_type]}) AS {target}")
    return f"SELECT {', '.join(cols)} FROM customer"


@query("accounting_relaties", _relaties_oracle())
def accounting_relaties(spark, sf):
    """Relations through the real accounting mapping: the strict map keeps the
    ``IsPurchase``/``IsSupplier`` swap simultaneous, text is trimmed, the id
    is a strict uuid, ``/Date(ms)/`` becomes a date; absent fields are null."""
    from ..plans.table_sync import conform_records
    c = load(spark, sf, "customer")
    sources = [s for s, _ in column_mapping("accounting", "Relaties")]
    rec = F.to_json(F.struct(*[_REL_VALUES[s][0]().alias(s) for s in sources if s in _REL_VALUES]))
    pages = (c.select(F.floor(F.col("c_custkey") / PAGE_ROWS).alias("page_no"), rec.alias("rec"))
             .groupBy("page_no")
             .agg(F.concat(F.lit('{"d":{"results":['), F.concat_ws(",", F.collect_list("rec")), F.lit("]}}"))
                  .alias("body")))
    schema = T.StructType([T.StructField(s, T.StringType()) for s in sources])
    return conform_records(payloads.odata_rows(pages, schema), "accounting", "Relaties")


# ------------------------------------------------------ pages a run can rely on
_LANDED_BODY = """CASE WHEN c_custkey % 307 = 7 THEN '<html>502</html>'
 WHEN c_custkey % 211 = 5 THEN '{"d":{"results":[{"c_custkey":' || CAST(c_custkey AS STRING) || '}'
 ELSE repeat(' ', CAST(c_custkey % 97 AS INT)) || '{"d":' || repeat(' ', CAST(c_custkey % 89 AS INT)) || '{"results":[{"c_custkey":'
      || CAST(c_custkey AS STRING) || '}]}}' END"""


def landed_customers(spark, sf):
    """One page per customer, chained per tenant: some bodies are error pages or cut off, all others start behind
    blanks; of every five tenants one names a page that never came, one lost a page in the middle, and one landed
    a page twice."""
    c = load(spark, sf, "customer")
    last = c.groupBy(F.col("c_custkey") % 25).agg(F.max("c_custkey").alias("_last")).toDF("_n", "_last")
    c = (c.withColumns({"tenant": (F.col("c_custkey") % 25).cast("long"), "page_no": F.floor(F.col("c_custkey") / 25).cast("long")})
         .filter("not (tenant % 5 = 4 and page_no = 3)")
         .withColumn("_copy", F.explode(F.when(F.expr("tenant % 5 = 3 and page_no = 2"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))))
    return (c.join(last, F.col("tenant") == F.col("_n"))
            .select("tenant", "page_no", F.expr(_LANDED_BODY).alias("body"),
                    F.when((F.col("c_custkey") < F.col("_last")) | (F.col("tenant") % 5 == 2), "next").alias("next_token")))


@query("page_quality", """
WITH p AS (SELECT CAST(c_custkey % 25 AS BIGINT) AS tenant, c_custkey // 25 AS page_no, c_custkey % 307 = 7 OR c_custkey % 211 = 5 AS bad,
                  CASE WHEN c_custkey % 25 % 5 = 3 AND c_custkey // 25 = 2 THEN 2 ELSE 1 END AS copies
           FROM customer WHERE NOT (c_custkey % 25 % 5 = 4 AND c_custkey // 25 = 3)),
     g AS (SELECT tenant, sum(copies) AS n_pages, sum(CASE WHEN bad THEN copies ELSE 0 END) AS n_bad, sum(CASE WHEN bad THEN 0 ELSE 1 END) AS n_good,
                  tenant % 5 <> 2 AND count(*) = max(page_no) - min(page_no) + 1 AS whole
           FROM p GROUP BY tenant)
SELECT tenant, CAST(n_pages AS BIGINT) AS n_pages, CAST(n_bad AS BIGINT) AS n_unreadable, whole AS complete, whole AND n_bad = 0 AS usable,
       CAST(n_good AS BIGINT) AS n_rows
FROM g
""")
def page_quality(spark, sf):
    pages = landed_customers(spark, sf)
    quality = payloads.page_quality(pages, ["tenant"])
    once = chains.landed_once(pages, ["tenant"], ["page_no"])
    n = payloads.odata_rows(once, "c_custkey long", keep=["tenant"]).groupBy("tenant").agg(F.count("c_custkey").alias("n_rows"))
    return quality.join(n, "tenant", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0).cast("long")))


# ------------------------------------------------------------- A2 by links
_CHAIN_SQL = """
WITH c AS (SELECT c_custkey AS k, c_custkey % 40 AS chain, c_custkey // 40 AS i FROM customer),
     m AS (SELECT chain, max(i) AS mx, min(i) AS mn FROM c GROUP BY chain),
     -- what a landing of each chain holds: own link, next link, body
     p AS (SELECT chain, CASE WHEN i > mn THEN 'p' || i END AS own,
                  CASE WHEN chain % 8 = 2 AND i = mx THEN 'p' || (mn + 1)                      -- back into the chain
                       WHEN chain % 8 = 3 AND i = mx - 1 THEN 'p' || (mn + 1)                  -- a branch: two pages name one
                       WHEN i < mx THEN 'p' || (i + 1) END AS nxt, k AS body, i
           FROM c JOIN m USING (chain)
           WHERE NOT (chain % 8 = 1 AND i = mn + 1)                                            -- a page in the middle is lost
           UNION ALL
           SELECT chain, 'p' || i, CASE WHEN i < mx THEN 'p' || (i + 1) END, CASE WHEN chain % 8 = 5 THEN -k ELSE k END, i
           FROM c JOIN m USING (chain) WHERE chain % 8 IN (4, 5) AND i = mn + 1),              -- landed twice, equal or not
"""


@query("page_chain_links", _CHAIN_SQL.replace("WITH c AS", "WITH RECURSIVE c AS", 1) + """
     d AS (SELECT chain, coalesce(own, '') AS own, count(*) AS copies, count(DISTINCT (body, coalesce(nxt, ''))) > 1 AS conflict, max(nxt) AS nxt
           FROM p GROUP BY 1, 2),
     n AS (SELECT chain, sum(copies) AS n_pages, count(*) AS n_distinct, sum(CASE WHEN conflict THEN 1 ELSE 0 END) AS n_conflicts FROM d GROUP BY 1),
     walk AS (SELECT chain, nxt, 1 AS steps FROM d WHERE own = ''
              UNION ALL
              SELECT d.chain, d.nxt, steps + 1 FROM walk JOIN d ON d.chain = walk.chain AND d.own = walk.nxt JOIN n ON n.chain = d.chain WHERE steps <= n_distinct),
     r AS (SELECT chain, max(steps) AS reached FROM walk WHERE nxt IS NULL GROUP BY 1)
SELECT CAST(chain AS BIGINT) AS chain, CAST(n_pages AS BIGINT) AS n_pages, n_distinct, CAST(n_conflicts AS BIGINT) AS n_conflicts,
       CAST(coalesce(reached, 0) AS BIGINT) AS n_reached, n_conflicts = 0 AND coalesce(reached, 0) = n_distinct AS complete
FROM n LEFT JOIN r USING (chain)
""")
def page_chain_links(spark, sf):
    """Shuffled pages in chains of links: whole ones, and ones with a gap, a loop, a branch, an equal and an unequal repeat.
    Half of the chains are linked by the row offset sent and received (``offset_rowid``)."""
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("k"), (F.col("c_custkey") % 40).cast("long").alias("chain"),
                                           F.floor(F.col("c_custkey") / 40).alias("i"))
    m = c.groupBy("chain").agg(F.min("i").alias("mn"), F.max("i").alias("mx"))
    c = c.join(m, "chain")
    link = lambda x: F.concat(F.when(F.col("chain") % 2 == 0, F.lit("https://api/x?$skiptoken=")).otherwise(F.lit("offset_rowid:")), x.cast("string"))
    own, straight = F.when(F.col("i") > F.col("mn"), link(F.col("i"))), F.when(F.col("i") < F.col("mx"), link(F.col("i") + 1))
    back = (F.expr("chain % 8 = 2 and i = mx") | F.expr("chain % 8 = 3 and i = mx - 1"))
    first = c.filter("not (chain % 8 = 1 and i = mn + 1)").select("chain", own.alias("own"), F.when(back, link(F.col("mn") + 1)).otherwise(straight).alias("nxt"),
                                                                 F.col("k").cast("string").alias("body"))
    again = c.filter("chain % 8 in (4, 5) and i = mn + 1").select("chain", link(F.col("i")).alias("own"), straight.alias("nxt"),
                                                                 F.expr("case when chain % 8 = 5 then -k else k end").cast("string").alias("body"))
    return chains.chain_report(first.unionByName(again), ["chain"])


@query("observed_fields", """
SELECT CAST(c_nationkey AS BIGINT) AS tenant, f.field, count(*) AS n
FROM customer JOIN (VALUES ('c_custkey'), ('c_name'), ('c_acctbal')) AS f(field)
  ON f.field <> 'c_acctbal' OR c_acctbal < 0 GROUP BY ALL
""")
def observed_fields(spark, sf):
    """Which fields the API sent, per tenant: the balance only comes where it is negative."""
    rec = F.to_json(F.struct("c_custkey", "c_name", F.when(F.col("c_acctbal") < 0, F.col("c_acctbal")).alias("c_acctbal")))
    pages = load(spark, sf, "customer").select(F.col("c_nationkey").cast("long").alias("tenant"),
                                               F.concat(F.lit('{"d":['), rec, F.lit("]}")).alias("body"))
    return payloads.observed_fields(pages, keep=["tenant"])
