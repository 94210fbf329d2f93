"""Delete / append / upsert queries.

The target is the orders table with a tenant column (``AdministratieCode``,
the priority class) and a reporting year.  The "previous sync" holds the
orders dated before 2000-01-01; the "new extraction" the orders dated from
1999-07-01 (the overlap is what an upsert updates), with a changed price.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import write
from ._base import load, query

_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate"
_TENANT_SQL = "CAST(substr(o_orderpriority, 1, 1) AS INTEGER)"
_TARGET_SQL = f"SELECT {_COLS}, {_TENANT_SQL} AS AdministratieCode, CAST(year(o_orderdate) AS INTEGER) AS ReportingYear FROM orders"
OLD = "o_orderdate < TIMESTAMP '2000-01-01 00:00:00'"
NEW = "o_orderdate >= TIMESTAMP '1999-07-01 00:00:00'"


def _target(spark, sf):
    o = load(spark, sf, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                    F.expr(_TENANT_SQL).alias("AdministratieCode"),
                    F.year("o_orderdate").alias("ReportingYear"))


def _old(spark, sf):
    return _target(spark, sf).filter(F.expr(OLD))


def _new(spark, sf, tenant_moves: bool = False):
    s = _target(spark, sf).filter(F.expr(NEW)).withColumn("o_totalprice", F.col("o_totalprice") + 1.0)
    if tenant_moves:
        # Orders with status P moved to administration 9 at the source.
        s = s.withColumn("AdministratieCode",
                         F.when(F.col("o_orderstatus") == "P", 9).otherwise(F.col("AdministratieCode")))
    return s


@query("delete_tenant", f"SELECT * FROM ({_TARGET_SQL}) WHERE AdministratieCode IS DISTINCT FROM 3")
def delete_tenant(spark, sf):
    return write.delete_where(_target(spark, sf), write.tenant_predicate("AdministratieCode", 3))


@query("delete_year", f"SELECT * FROM ({_TARGET_SQL}) "
                      "WHERE NOT COALESCE(ReportingYear >= 1999 AND AdministratieCode = 2, false)")
def delete_year(spark, sf):
    return write.delete_where(_target(spark, sf),
                              write.year_window_predicate("ReportingYear", 1999, "AdministratieCode", 2))


@query("delete_window", f"SELECT * FROM ({_TARGET_SQL}) "
                        "WHERE NOT COALESCE(o_orderdate >= TIMESTAMP '2000-01-01 00:00:00' AND AdministratieCode = 1, false)")
def delete_window(spark, sf):
    return write.delete_where(_target(spark, sf),
                              write.date_window_predicate("o_orderdate", "2000-01-01 00:00:00",
                                                          "AdministratieCode", 1))


@query("delete_company_year", f"SELECT * FROM ({_TARGET_SQL}) "
                              "WHERE NOT COALESCE(AdministratieCode = 4 AND ReportingYear = 1998, false)")
def delete_company_year(spark, sf):
    return write.delete_where(_target(spark, sf),
                              write.company_year_predicate("AdministratieCode", 4, "ReportingYear", 1998))


@query("append_rows", _TARGET_SQL)
def append_rows(spark, sf):
    t = _target(spark, sf)
    return write.append(t.filter(F.col("o_orderstatus").eqNullSafe("F")), t.filter(~F.col("o_orderstatus").eqNullSafe("F")))


_UPSERT_SQL = f"""
WITH t AS (SELECT * FROM ({_TARGET_SQL}) WHERE {OLD}),
     s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice, o_orderdate,
                  {{tenant}} AS AdministratieCode, ReportingYear
           FROM ({_TARGET_SQL}) WHERE {NEW})
SELECT COALESCE(s.o_orderkey, t.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.AdministratieCode ELSE t.AdministratieCode END AS AdministratieCode,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.ReportingYear ELSE t.ReportingYear END AS ReportingYear
FROM t FULL OUTER JOIN s ON {{on}}
"""


@query("upsert", _UPSERT_SQL.format(tenant="AdministratieCode", on="s.o_orderkey = t.o_orderkey"))
def upsert(spark, sf):
    return write.upsert(_old(spark, sf), _new(spark, sf), ["o_orderkey"])


@query("upsert_tenant", _UPSERT_SQL.format(
    tenant="CASE WHEN o_orderstatus = 'P' THEN 9 ELSE AdministratieCode END",
    on="s.o_orderkey = t.o_orderkey AND s.AdministratieCode = t.AdministratieCode"))
def upsert_tenant(spark, sf):
    keys = write.upsert_keys(["o_orderkey"], "AdministratieCode")
    return write.upsert(_old(spark, sf), _new(spark, sf, tenant_moves=True), keys)


_NOTE_T = "CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderstatus END"
_NOTE_S = "CASE WHEN o_orderstatus = 'O' THEN '' ELSE o_orderstatus END"
_PRICE_S = "CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1.0 ELSE o_totalprice END"


@query("upsert_changed", f"""
WITH t AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, {_NOTE_T} AS note FROM orders WHERE {OLD}),
     s AS (SELECT o_orderkey, o_custkey, {_PRICE_S} AS o_totalprice, o_orderdate, {_NOTE_S} AS note
           FROM orders WHERE {NEW}),
     j AS (SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey, t.o_orderkey IS NOT NULL AS in_t,
                  s.o_orderkey IS NOT NULL AS in_s,
                  (t.o_custkey IS DISTINCT FROM s.o_custkey OR t.o_totalprice IS DISTINCT FROM s.o_totalprice
                   OR t.o_orderdate IS DISTINCT FROM s.o_orderdate
                   OR COALESCE(t.note, '') <> COALESCE(s.note, '')) AS changed,
                  t.o_custkey AS tc, t.o_totalprice AS tp, t.o_orderdate AS td, t.note AS tn,
                  s.o_custkey AS sc, s.o_totalprice AS sp, s.o_orderdate AS sd, s.note AS sn
           FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey),
     a AS (SELECT *, CASE WHEN in_t AND in_s AND changed THEN 'update' WHEN in_t AND in_s THEN 'unchanged'
                          WHEN in_s THEN 'insert' ELSE 'keep' END AS action FROM j)
SELECT o_orderkey,
       CASE WHEN action IN ('insert', 'update') THEN sc ELSE tc END AS o_custkey,
       CASE WHEN action IN ('insert', 'update') THEN sp ELSE tp END AS o_totalprice,
       CASE WHEN action IN ('insert', 'update') THEN sd ELSE td END AS o_orderdate,
       CASE WHEN action IN ('insert', 'update') THEN sn ELSE tn END AS note,
       action
FROM a
""")
def upsert_changed(spark, sf):
    o = load(spark, sf, "orders")
    t = o.filter(F.expr(OLD)).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                                     F.expr(_NOTE_T).alias("note"))
    s = o.filter(F.expr(NEW)).select("o_orderkey", "o_custkey", F.expr(_PRICE_S).alias("o_totalprice"),
                                     "o_orderdate", F.expr(_NOTE_S).alias("note"))
    return write.upsert_changed(t, s, ["o_orderkey"])


@query("replace_all", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def replace_all(spark, sf):
    p = load(spark, sf, "part")
    return write.replace_all(p.filter(F.col("p_size") < 10), p)


_DIV_T = ("SELECT c_custkey AS Division, c_name AS Entiteit, CAST(c_nationkey AS BIGINT) AS CustomerCode, "
          "CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 2 END AS Status, "
          "CASE WHEN c_nationkey < 5 THEN 1 ELSE 0 END AS Volledige_sync FROM customer WHERE c_acctbal >= 0")
_DIV_S = ("SELECT c_custkey AS Division, upper(c_name) AS Entiteit, CAST(c_nationkey AS BIGINT) AS CustomerCode "
          "FROM customer WHERE c_mktsegment <> 'MACHINERY' OR c_acctbal < 0")


@query("upsert_preserving", f"""
SELECT COALESCE(t.Division, s.Division) AS Division,
       CASE WHEN s.Division IS NOT NULL THEN s.Entiteit ELSE t.Entiteit END AS Entiteit,
       CASE WHEN s.Division IS NOT NULL THEN s.CustomerCode ELSE t.CustomerCode END AS CustomerCode,
       CASE WHEN t.Division IS NOT NULL THEN t.Status ELSE 0 END AS Status,
       CASE WHEN t.Division IS NOT NULL THEN t.Volledige_sync ELSE 0 END AS Volledige_sync
FROM ({_DIV_T}) t FULL OUTER JOIN ({_DIV_S}) s ON t.Division = s.Division
""")
def upsert_preserving(spark, sf):
    c = load(spark, sf, "customer")
    t = c.filter(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").alias("Division"), F.col("c_name").alias("Entiteit"),
        F.col("c_nationkey").cast("long").alias("CustomerCode"),
        F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(2).alias("Status"),
        F.when(F.col("c_nationkey") < 5, 1).otherwise(0).alias("Volledige_sync"))
    s = c.filter((F.col("c_mktsegment") != "MACHINERY") | (F.col("c_acctbal") < 0)).select(
        F.col("c_custkey").alias("Division"), F.upper("c_name").alias("Entiteit"),
        F.col("c_nationkey").cast("long").alias("CustomerCode"))
    return write.upsert_preserving(t, s, ["Division"], {"Status": 0, "Volledige_sync": 0})


@query("new_keys", f"""
SELECT o_orderkey FROM orders WHERE {NEW} EXCEPT SELECT o_orderkey FROM orders WHERE {OLD}
""")
def new_keys(spark, sf):
    return write.new_keys(_old(spark, sf), _new(spark, sf), ["o_orderkey"])


@query("write_counts", f"""
WITH t AS (SELECT * FROM ({_TARGET_SQL}) WHERE {OLD}),
     s AS (SELECT * FROM ({_TARGET_SQL}) WHERE {NEW}),
     kept AS (SELECT * FROM t WHERE AdministratieCode IS DISTINCT FROM 3)
SELECT CAST((SELECT count(*) FROM t) - (SELECT count(*) FROM kept) AS BIGINT) AS deleted,
       CAST((SELECT count(*) FROM s WHERE o_orderkey IN (SELECT o_orderkey FROM kept)) AS BIGINT) AS updated,
       CAST((SELECT count(*) FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM kept)) AS BIGINT) AS inserted,
       CAST((SELECT count(*) FROM s) AS BIGINT) AS written,
       CAST((SELECT count(*) FROM kept WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s))
            + (SELECT count(*) FROM s) AS BIGINT) AS result_rows
""")
def write_counts(spark, sf):
    return write.write_counts(_old(spark, sf), _new(spark, sf), ["o_orderkey"],
                              write.tenant_predicate("AdministratieCode", 3))


# Per-tenant plan of one run (control data: one row per administration).  4: rule none, 6: planned but no source
# rows arrive, 7: arrives without a plan row.
_PLAN = [(1, "tenant", "append", None, None), (2, "year_window", "append", 1999, None),
         (3, "none", "upsert", None, None), (4, "none", "none", None, None),
         (5, "date_window", "append", None, "2000-01-01 00:00:00"), (6, "tenant", "append", None, None)]
# tenants 6 and 7: part of the orders of tenant 4; only the target holds 6, only the source adds to 7
_MORE_SQL = ("CASE WHEN {t} = 4 AND o_custkey % 3 = 0 THEN {a} WHEN {t} = 4 AND o_custkey % 3 = 1 THEN 7 ELSE {t} END")


def _tenants(df, moved: int):
    return df.withColumn("AdministratieCode", F.expr(_MORE_SQL.format(t="AdministratieCode", a=moved)).cast("int"))


_PLAN_SQL = f"""p AS (SELECT * FROM (VALUES {", ".join(
    f"({t}, '{d}', '{w}', {y if y is not None else 'NULL'}, "
    f"{repr(ws) if ws else 'NULL'})" for t, d, w, y, ws in _PLAN)}) AS p(tenant, dr, wr, yr, ws)),
t AS (SELECT * EXCLUDE (AdministratieCode), CAST({_MORE_SQL.format(t="AdministratieCode", a=6)} AS INTEGER) AS AdministratieCode
      FROM ({_TARGET_SQL}) WHERE {OLD}),
s0 AS (SELECT * EXCLUDE (AdministratieCode, o_totalprice), o_totalprice + 1.0 AS o_totalprice,
              CAST({_MORE_SQL.format(t="AdministratieCode", a=4)} AS INTEGER) AS AdministratieCode FROM ({_TARGET_SQL}) WHERE {NEW}),
s AS (SELECT s0.*, p.wr FROM s0 JOIN p ON p.tenant = s0.AdministratieCode),
kept AS (SELECT t.* FROM t LEFT JOIN p ON p.tenant = t.AdministratieCode AND p.tenant IN (SELECT AdministratieCode FROM s)
         WHERE NOT COALESCE(CASE WHEN p.dr IN ('tenant', 'all') THEN true
                                 WHEN p.dr = 'year_window' THEN t.ReportingYear >= p.yr
                                 WHEN p.dr = 'date_window' THEN t.o_orderdate >= CAST(p.ws AS TIMESTAMP)
                                 ELSE false END, false))"""
_SYNC_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, AdministratieCode, ReportingYear"


def _plan(spark, rows=None):
    return spark.createDataFrame(_PLAN if rows is None else rows, "tenant int, delete_rule string, write_rule string, year int, window_start string")


@query("tenant_batch_sync", f"""
WITH {_PLAN_SQL},
su AS (SELECT * FROM s WHERE wr IN ('upsert', 'upsert_tenant'))
SELECT {_SYNC_COLS} FROM kept WHERE NOT EXISTS (SELECT 1 FROM su WHERE su.o_orderkey = kept.o_orderkey
                                     AND su.AdministratieCode = kept.AdministratieCode)
UNION ALL SELECT {_SYNC_COLS} FROM s WHERE wr <> 'none'
""")
def tenant_batch_sync(spark, sf):
    from ..plans.table_sync import sync_tenants
    return sync_tenants(_tenants(_old(spark, sf), 6), _tenants(_new(spark, sf), 4), _plan(spark), ["o_orderkey"], "AdministratieCode",
                        year_col="ReportingYear", date_col="o_orderdate")


_KEYLESS = [(t, d, "append" if w.startswith("upsert") else w, y, ws) for t, d, w, y, ws in _PLAN]


@query("keyless_tenant_sync", f"""
WITH {_PLAN_SQL}
SELECT {_SYNC_COLS} FROM kept UNION ALL SELECT {_SYNC_COLS} FROM s WHERE wr <> 'none'
""")
def keyless_tenant_sync(spark, sf):
    """A table without keys: deletes by tenant and appends, no join of target and source rows."""
    from ..plans.table_sync import sync_tenants
    return sync_tenants(_tenants(_old(spark, sf), 6), _tenants(_new(spark, sf), 4), _plan(spark, _KEYLESS), [], "AdministratieCode",
                        year_col="ReportingYear", date_col="o_orderdate")


@query("upsert_partial", f"""
WITH t AS (SELECT * FROM ({_TARGET_SQL}) WHERE {OLD}),
     s AS (SELECT o_orderkey, o_totalprice + 1.0 AS o_totalprice, AdministratieCode FROM ({_TARGET_SQL}) WHERE {NEW})
SELECT COALESCE(s.o_orderkey, t.o_orderkey) AS o_orderkey, t.o_custkey, t.o_orderstatus,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice, t.o_orderdate,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.AdministratieCode ELSE t.AdministratieCode END AS AdministratieCode, t.ReportingYear
FROM t FULL OUTER JOIN s ON s.o_orderkey = t.o_orderkey
""")
def upsert_partial(spark, sf):
    """A source with some of the target's columns updates those only."""
    return write.upsert(_old(spark, sf), _new(spark, sf).select("o_orderkey", "o_totalprice", "AdministratieCode"), ["o_orderkey"])


@query("duplicate_key_report", """
SELECT l_orderkey, CAST(l_suppkey % 10 AS BIGINT) AS part, count(*) AS count FROM lineitem GROUP BY ALL HAVING count(*) > 1
""")
def duplicate_key_report(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", (F.col("l_suppkey") % 10).cast("long").alias("part"))
    return write.duplicate_keys(li, ["l_orderkey", "part"])
