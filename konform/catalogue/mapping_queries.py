"""Queries for column mapping, constants, defaults and incremental predicates
(B1-B14, C14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.coerce import metadata_cast
from ..functions.predicates import extract, modified_since, modified_since_day
from ..operators import mapping
from ..sources.control import TABELLEN_MAPPING
from ._base import load, query

CUSTOMER_MAP = [("c_custkey", "ID"), ("c_name", "KlantNaam"), ("c_nationkey", "AdministratieCode"),
                ("c_acctbal", "Saldo")]
_CUSTOMER_SQL = "c_custkey AS ID, c_name AS KlantNaam, c_nationkey AS AdministratieCode, c_acctbal AS Saldo"


@query("map_keep", f"SELECT {_CUSTOMER_SQL}, c_mktsegment FROM customer")
def map_keep(spark, sf):
    return mapping.map_keep(load(spark, sf, "customer"), CUSTOMER_MAP)


@query("map_project", f"SELECT {_CUSTOMER_SQL} FROM customer")
def map_project(spark, sf):
    return mapping.map_project(load(spark, sf, "customer"), CUSTOMER_MAP)


@query("map_select", f"SELECT {_CUSTOMER_SQL} FROM customer")
def map_select(spark, sf):
    return mapping.map_select(load(spark, sf, "customer"), CUSTOMER_MAP)


def _mapping_table(spark, rows):
    return spark.createDataFrame(rows, TABELLEN_MAPPING)


@query("map_lenient", "SELECT c_custkey AS ID, c_name AS KlantNaam, c_acctbal AS Saldo FROM customer")
def map_lenient(spark, sf):
    # Mapping rows are metadata (one per column); a mapped column the data
    # lacks (c_phone) and an unmapped one (c_mktsegment) both disappear.
    rows = _mapping_table(spark, [(3, "c_custkey", "ID", None), (3, "c_name", "KlantNaam", None),
                                  (3, "c_phone", "Telefoon", None), (3, "c_acctbal", "Saldo", None),
                                  (4, "c_nationkey", "Land", None)])
    m = [(s, t) for s, t, _ in mapping.mapping_rows(rows, table_id=3)]
    return mapping.map_lenient(load(spark, sf, "customer"), m)


@query("map_swap", """
SELECT o_orderkey, o_custkey, o_orderpriority AS o_orderstatus, o_totalprice, o_orderdate,
       o_orderstatus AS o_orderpriority
FROM orders
""")
def map_swap(spark, sf):
    swap = [("o_orderstatus", "o_orderpriority"), ("o_orderpriority", "o_orderstatus")]
    return mapping.map_keep(load(spark, sf, "orders"), swap)


@query("constants_and_defaults", """
SELECT s_suppkey, s_name, s_nationkey, 1 AS Division, 7 AS OmgevingID,
       CAST(NULL AS DECIMAL(38,10)) AS s_acctbal, '' AS s_phone, false AS s_active,
       CAST(0 AS BIGINT) AS s_rank, CAST(0 AS SMALLINT) AS s_level, CAST(NULL AS DATE) AS s_since,
       CAST(NULL AS VARCHAR) AS s_guid, CAST(NULL AS TIMESTAMP) AS s_changed
FROM supplier
""")
def constants_and_defaults(spark, sf):
    s = load(spark, sf, "supplier").select(
        "s_suppkey", "s_name", "s_nationkey",
        F.struct(F.concat(F.lit("/api/suppliers("), F.col("s_suppkey").cast("string"), F.lit(")")).alias("uri"))
        .alias("__metadata"))
    s = mapping.drop_technical(s)                                   # B8
    s = mapping.add_constant_if_absent(s, "Division", 1)            # B6
    s = mapping.add_constant_if_absent(s, "s_nationkey", 99)        # B6: present, untouched
    s = mapping.add_constant(s, "OmgevingID", 7)                    # B7
    declared = [("s_suppkey", "int"), ("s_name", "nvarchar"), ("s_acctbal", "decimal"),
                ("s_phone", "nvarchar"), ("s_active", "bit"), ("s_rank", "int"), ("s_level", "tinyint"),
                ("s_since", "date"), ("s_guid", "uniqueidentifier"), ("s_changed", "datetime")]
    return mapping.fill_missing(s, declared)                        # B10


EVENT_COLS = ["event_id", "ts", "user_id", "event_type"]
WATERMARK = "2024-01-15T10:30:00"


@query("incremental_ge", f"""
SELECT event_id, ts, user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-15 10:30:00'
""")
def incremental_ge(spark, sf):
    return extract(load(spark, sf, "events"), EVENT_COLS, modified_since("ts", WATERMARK))


@query("incremental_day", f"""
SELECT event_id, ts, user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'
""")
def incremental_day(spark, sf):
    return extract(load(spark, sf, "events"), EVENT_COLS, modified_since_day("ts", WATERMARK))


@query("metadata_cast", """
SELECT l_orderkey AS OrderID, l_linenumber AS Regel, CAST(l_extendedprice AS DECIMAL(18,2)) AS Bedrag,
       CAST(l_shipdate AS DATE) AS Verzenddatum, l_returnflag AS Retour, l_discount AS Korting
FROM lineitem
""")
def metadata_cast_query(spark, sf):
    rows = _mapping_table(spark, [
        (9, "l_orderkey", "OrderID", "bigint"), (9, "l_linenumber", "Regel", "int"),
        (9, "l_extendedprice", "Bedrag", "decimal(18,2)"), (9, "l_shipdate", "Verzenddatum", "date"),
        (9, "l_returnflag", "Retour", "nvarchar(1)"), (9, "l_discount", "Korting", None),
        (9, "l_comment", "Opmerking", "nvarchar")])
    m = mapping.mapping_rows(rows, table_id=9)
    mapped = mapping.map_lenient(load(spark, sf, "lineitem"), [(s, t) for s, t, _ in m])
    return metadata_cast(mapped, {t: dt for _, t, dt in m})
