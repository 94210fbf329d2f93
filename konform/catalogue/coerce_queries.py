"""Type-coercion queries.

The raw text of every order is produced by one SQL expression that both
engines evaluate (Spark through ``F.expr``, DuckDB in the oracle), so the
inputs are identical; the key's remainder only chooses which text form a
row carries (every row is kept).  Spark then applies the coercion Column
builders, the oracle an independent SQL formulation of the same rule.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import coerce as C
from ._base import load, query

# Raw text forms, one SQL expression per input column (Spark SQL and DuckDB).
RAW_INT = """CASE o_orderkey % 7
  WHEN 0 THEN CAST(o_custkey AS STRING) || '.' || CAST(o_orderkey % 10 AS STRING)
  WHEN 1 THEN 'n/a'
  WHEN 2 THEN NULL
  WHEN 3 THEN ' ' || CAST(o_custkey AS STRING) || ' '
  WHEN 4 THEN '-' || CAST(o_custkey AS STRING) || '.9'
  WHEN 5 THEN CAST(o_orderkey % 5 AS STRING) || 'e2'
  ELSE CAST(o_custkey AS STRING) END"""
RAW_TINY = """CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN o_custkey
  WHEN 2 THEN o_orderkey % 300 ELSE -(o_orderkey % 50) END"""
RAW_DEC = """CASE o_orderkey % 5
  WHEN 0 THEN NULL
  WHEN 1 THEN CAST(o_custkey AS STRING) || '.' || lpad(CAST(o_orderkey % 100 AS STRING), 2, '0')
  WHEN 2 THEN '-0'
  WHEN 3 THEN ' 12.5 '
  ELSE CAST(o_orderkey % 9 AS STRING) || 'e3' END"""
RAW_BIT = """CASE o_orderkey % 6 WHEN 0 THEN 'True' WHEN 1 THEN '1' WHEN 2 THEN 'FALSE'
  WHEN 3 THEN '0' WHEN 4 THEN NULL ELSE 'yes' END"""
RAW_STR = """CASE o_orderkey % 3 WHEN 0 THEN '  ' || o_orderpriority || ' ' WHEN 1 THEN NULL
  ELSE o_orderstatus END"""
_HEX = "md5(CAST(o_orderkey AS STRING))"
RAW_UUID = f"""CASE o_orderkey % 6
  WHEN 0 THEN substr({_HEX},1,8) || '-' || substr({_HEX},9,4) || '-' || substr({_HEX},13,4) || '-' || substr({_HEX},17,4) || '-' || substr({_HEX},21,12)
  WHEN 1 THEN '{{' || upper({_HEX}) || '}}'
  WHEN 2 THEN 'urn:uuid:' || {_HEX}
  WHEN 3 THEN {_HEX}
  WHEN 4 THEN 'not-a-uuid-' || CAST(o_orderkey AS STRING)
  ELSE NULL END"""
_D = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
_DMY = ("lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || '-' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0')"
        " || '-' || CAST(year(o_orderdate) AS STRING)")
RAW_TS = f"""CASE o_orderkey % 9
  WHEN 0 THEN '/Date(' || CAST(o_orderkey * 86400000 + 3600000 * (o_orderkey % 24) AS STRING) || ')/'
  WHEN 1 THEN {_D} || 'T' || lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') || ':15:30'
  WHEN 2 THEN {_D} || ' 08:00:00.' || lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0')
  WHEN 3 THEN {_D} || 'T23:30:00+02:00'
  WHEN 4 THEN {_D} || 'T06:45:10.5Z'
  WHEN 5 THEN {_DMY} || ' 17:05:00'
  WHEN 6 THEN {_DMY}
  WHEN 7 THEN CAST(year(o_orderdate) AS STRING) || '-02-31'
  ELSE NULL END"""


def _raw(spark, sf, **forms):
    o = load(spark, sf, "orders")
    return o.select("o_orderkey", *[F.expr(sql).alias(name) for name, sql in forms.items()])


# ------------------------------------------------------------------ oracles
_ISO = r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([T ][0-9]{1,2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?(Z|[+-][0-9]{2}(:?[0-9]{2})?)?)?"
_OFF = r"^(.*[T ][0-9]{1,2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?)(Z|[+-][0-9]{2}(:?[0-9]{2})?)$"
_DMYRE = r"([0-9]{1,2})-([0-9]{1,2})-([0-9]{4})( [0-9]{1,2}:[0-9]{2}:[0-9]{2})?"
_MSRE = r"/Date\((-?[0-9]+)\)/"
ORACLE_TS = (f"COALESCE("
             f"CASE WHEN regexp_full_match(trim(r), '{_MSRE}') THEN epoch_ms(CAST(regexp_extract(trim(r), '{_MSRE}', 1) AS BIGINT)) END, "
             f"CASE WHEN regexp_full_match(trim(r), '{_ISO}') THEN TRY_CAST(regexp_replace(trim(r), '{_OFF}', '\\1') AS TIMESTAMP) END, "
             f"CASE WHEN regexp_full_match(trim(r), '{_DMYRE}') THEN TRY_CAST(regexp_replace(trim(r), '^{_DMYRE}$', '\\3-\\2-\\1\\4') AS TIMESTAMP) END)")
ORACLE_DATE = (f"COALESCE(CASE WHEN regexp_full_match(trim(r), '{_MSRE}') THEN "
               f"DATE '1970-01-01' + CAST(floor(CAST(regexp_extract(trim(r), '{_MSRE}', 1) AS BIGINT) / 86400000) AS INTEGER) END, "
               f"CAST({ORACLE_TS} AS DATE))")
ORACLE_INT = ("COALESCE(CASE WHEN regexp_full_match(r, '\\s*[+-]?[0-9]+\\s*') THEN TRY_CAST(trim(r) AS BIGINT) END, "
              "TRY_CAST(trunc(TRY_CAST(trim(r) AS DOUBLE)) AS BIGINT), CAST(0 AS BIGINT))")
_H = "replace(regexp_replace(replace(replace(r, 'urn:', ''), 'uuid:', ''), '^[{}]+|[{}]+$', '', 'g'), '-', '')"
ORACLE_UUID = (f"CASE WHEN regexp_full_match({_H}, '[0-9a-fA-F]{{32}}') THEN lower(substr({_H},1,8) || '-' || "
               f"substr({_H},9,4) || '-' || substr({_H},13,4) || '-' || substr({_H},17,4) || '-' || substr({_H},21,12)) END")


def _oracle(raw_sql: str, conv_sql: str, name: str) -> str:
    return (f"SELECT o_orderkey, r AS raw, {conv_sql} AS {name} "
            f"FROM (SELECT o_orderkey, {raw_sql} AS r FROM orders)")


@query("coerce_int", _oracle(RAW_INT, ORACLE_INT, "value"))
def coerce_int(spark, sf):
    return _raw(spark, sf, raw=RAW_INT).withColumn("value", C.to_int(F.col("raw")))


@query("coerce_tinyint", "SELECT o_orderkey, r AS raw, CAST(((COALESCE(r, 0) % 256) + 256) % 256 AS SMALLINT) AS value "
                         f"FROM (SELECT o_orderkey, {RAW_TINY} AS r FROM orders)")
def coerce_tinyint(spark, sf):
    return _raw(spark, sf, raw=RAW_TINY).withColumn("value", C.to_tinyint(F.col("raw")))


@query("coerce_decimal", _oracle(RAW_DEC, "TRY_CAST(trim(r) AS DECIMAL(38,10))", "value"))
def coerce_decimal(spark, sf):
    return _raw(spark, sf, raw=RAW_DEC).withColumn("value", C.to_decimal(F.col("raw")))


@query("coerce_bit", _oracle(RAW_BIT, "COALESCE(lower(r) IN ('true', '1'), false)", "value"))
def coerce_bit(spark, sf):
    return _raw(spark, sf, raw=RAW_BIT).withColumn("value", C.to_bit(F.col("raw")))


@query("coerce_string", f"SELECT o_orderkey, r AS raw, trim(r) AS trimmed, r AS kept "
                        f"FROM (SELECT o_orderkey, {RAW_STR} AS r FROM orders)")
def coerce_string(spark, sf):
    return (_raw(spark, sf, raw=RAW_STR)
            .withColumn("trimmed", C.to_string(F.col("raw"), trim=True))
            .withColumn("kept", C.to_string(F.col("raw"))))


@query("coerce_uuid", _oracle(RAW_UUID, ORACLE_UUID, "value"))
def coerce_uuid(spark, sf):
    return _raw(spark, sf, raw=RAW_UUID).withColumn("value", C.to_uuid(F.col("raw"), strict=False))


@query("coerce_date", _oracle(RAW_TS, ORACLE_DATE, "value"))
def coerce_date(spark, sf):
    return _raw(spark, sf, raw=RAW_TS).withColumn("value", C.to_date(F.col("raw")))


@query("coerce_datetime", f"""
SELECT o_orderkey, r AS raw, {ORACLE_TS} AS value, epoch_ms(o_orderkey * 1000003) AS from_number
FROM (SELECT o_orderkey, {RAW_TS} AS r FROM orders)
""")
def coerce_datetime(spark, sf):
    return (_raw(spark, sf, raw=RAW_TS)
            .withColumn("value", C.to_datetime(F.col("raw")))
            .withColumn("from_number", C.to_datetime(F.col("o_orderkey") * 1000003, numeric_input=True)))


AUDIT_TYPES = [("c_int", "int"), ("c_bit", "bit"), ("c_uuid", "uniqueidentifier"), ("c_date", "date"),
               ("c_datetime", "datetime"), ("c_decimal", "decimal")]


@query("coerce_audit", f"""
SELECT count(*) FILTER (WHERE c_int IS NOT NULL AND i IS NULL) AS c_int,
       count(*) FILTER (WHERE c_bit IS NOT NULL AND NOT (lower(c_bit) IN ('true','1','false','0'))) AS c_bit,
       count(*) FILTER (WHERE c_uuid IS NOT NULL AND u IS NULL) AS c_uuid,
       count(*) FILTER (WHERE c_date IS NOT NULL AND d IS NULL) AS c_date,
       count(*) FILTER (WHERE c_datetime IS NOT NULL AND t IS NULL) AS c_datetime,
       count(*) FILTER (WHERE c_decimal IS NOT NULL AND TRY_CAST(trim(c_decimal) AS DECIMAL(38,10)) IS NULL) AS c_decimal
FROM (
  SELECT c_int, c_bit, c_uuid, c_date, c_datetime, c_decimal,
         COALESCE(CASE WHEN regexp_full_match(c_int, '\\s*[+-]?[0-9]+\\s*') THEN TRY_CAST(trim(c_int) AS BIGINT) END,
                  TRY_CAST(trunc(TRY_CAST(trim(c_int) AS DOUBLE)) AS BIGINT)) AS i,
         {ORACLE_UUID.replace('(r,', '(c_uuid,').replace(' r)', ' c_uuid)')} AS u,
         {ORACLE_DATE.replace('(r)', '(c_date)')} AS d,
         {ORACLE_TS.replace('(r)', '(c_datetime)')} AS t
  FROM (SELECT {RAW_INT} AS c_int, {RAW_BIT} AS c_bit, {RAW_UUID} AS c_uuid, {RAW_TS} AS c_date,
               {RAW_TS} AS c_datetime, CASE WHEN o_orderkey % 11 = 0 THEN 'x' || CAST(o_orderkey AS STRING)
               ELSE CAST(o_custkey AS STRING) END AS c_decimal FROM orders))
""")
def coerce_audit(spark, sf):
    raw = _raw(spark, sf, c_int=RAW_INT, c_bit=RAW_BIT, c_uuid=RAW_UUID, c_date=RAW_TS, c_datetime=RAW_TS,
               c_decimal="CASE WHEN o_orderkey % 11 = 0 THEN 'x' || CAST(o_orderkey AS STRING) "
                         "ELSE CAST(o_custkey AS STRING) END")
    return C.audit(raw, AUDIT_TYPES, C.ACCOUNTING)


_BAD = {"amount": ("decimal", "CASE WHEN o_orderkey % 13 = 0 THEN 'x' || CAST(o_orderkey % 5 AS STRING) WHEN o_orderkey % 17 = 1 THEN '1.12345678901'"
                              " WHEN o_orderkey % 19 = 2 THEN NULL ELSE CAST(o_orderkey AS STRING) || '.50' END", "o_orderkey % 13 = 0 OR o_orderkey % 17 = 1"),
        "count": ("int", "CASE WHEN o_orderkey % 11 = 3 THEN 'n/a' ELSE CAST(o_custkey AS STRING) END", "o_orderkey % 11 = 3"),
        "paid": ("bit", "CASE WHEN o_orderkey % 7 = 1 THEN 'maybe' ELSE 'TRUE' END", "o_orderkey % 7 = 1")}


@query("audit_values", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS type_name, {e.replace('STRING', 'VARCHAR')} AS value, count(*) AS n FROM orders WHERE {bad} GROUP BY ALL"
    for c, (t, e, bad) in _BAD.items()))
def audit_values(spark, sf):
    """Every distinct value that does not convert, with its count."""
    from ..functions import coerce

    rows = load(spark, sf, "orders").select(*[F.expr(e).alias(c) for c, (_, e, _) in _BAD.items()])
    return coerce.audit_values(rows, [(c, t) for c, (t, _, _) in _BAD.items()])
