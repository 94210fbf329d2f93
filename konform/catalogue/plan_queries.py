"""Sync planning, write-rule and run-log queries (A12, A13, B11, B15, E1-E9, W5,
W16, G1-G7).

Customers play the tenants (administrations), nations the customers of the
service, regions the databases; the catalogue and write configuration are
the fixed control data from ``schemas``.  Work items fan out per tenant by
``explode`` of a literal array (a bounded factor), never by a join.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import elapsed_hms, local_time, message_tail
from ..plans import rules, runs, sync
from ..schemas import WRITE_CONFIG
from ..sources.control import control_map
from ._base import AS_OF, LIST_ROWS, bounded_chunk, load, query

AS_OF_SQL = f"TIMESTAMP '{AS_OF}'"


def _as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def _watermark(spark, sf):
    """Customers with a derived watermark: (c_custkey * 13 % 1200) days and
    (c_custkey % 24) hours before ``AS_OF``; none for a negative balance."""
    c = load(spark, sf, "customer")
    hours = (F.col("c_custkey") * 13 % 1200) * 24 + F.col("c_custkey") % 24
    wm = F.date_format(F.timestamp_add("HOUR", -hours, _as_of()), "yyyy-MM-dd'T'HH:mm:ss")
    return c.withColumn("watermark", F.when(F.col("c_acctbal") >= 0, wm))


_WM_SQL = ("CASE WHEN c_acctbal >= 0 THEN strftime(" + AS_OF_SQL +
           " - to_hours(CAST((c_custkey * 13 % 1200) * 24 + c_custkey % 24 AS INTEGER)), '%Y-%m-%dT%H:%M:%S') END")
_AGE_SQL = ("(floor(date_diff('microsecond', CAST(wm AS TIMESTAMP), " + AS_OF_SQL + ") / 86400000000) / 365.0)")


# ---------------------------------------------------------------- E1-E3, E8
@query("sync_mode", f"""
WITH b AS (
  SELECT c_custkey, c_mktsegment,
         CASE WHEN c_mktsegment = 'BUILDING' THEN '2000-01-01T00:00:00' ELSE {_WM_SQL} END AS wm,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 2000 ELSE 2023 END AS reporting_year
  FROM customer)
SELECT c_custkey, wm AS watermark, reporting_year,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'full' WHEN wm IS NULL THEN 'reset'
            WHEN {_AGE_SQL} > 2.0 THEN 'reset' ELSE 'regular' END AS mode_accounting,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'full' WHEN wm IS NULL THEN 'reset'
            WHEN {_AGE_SQL} > 1.2 THEN 'reset' ELSE 'regular' END AS mode_older,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'full' ELSE 'regular' END AS mode_erp,
       COALESCE({_AGE_SQL} > 2.0, false) AS stale_erp
FROM b
""")
def sync_mode(spark, sf):
    c = (_watermark(spark, sf)
         .withColumn("reporting_year", runs.reporting_year(_as_of()))
         .withColumn("full_sync", F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(0))
         .withColumn("run_mode", F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Volledig").otherwise("Wijzigingen")))
    c = sync.full_resync_override(c, "full_sync", "watermark", "reporting_year")
    return c.select("c_custkey", "watermark", "reporting_year",
                    sync.sync_mode("watermark", _as_of(), "run_mode", 2.0).alias("mode_accounting"),
                    sync.sync_mode("watermark", _as_of(), "run_mode", 1.2).alias("mode_older"),
                    sync.erp_sync_mode("run_mode").alias("mode_erp"),
                    sync.is_stale("watermark", _as_of(), 2.0).alias("stale_erp"))


# ------------------------------------------------------------------ E4, G2
@query("full_window", """
SELECT o_orderkey, CAST(date_trunc('year', CAST(o_orderdate AS DATE) - 365) AS DATE) AS window_start,
       make_date(CAST(year(o_orderdate) - 1 AS INTEGER), 1, 1) AS window_start_erp_old,
       CAST(year(o_orderdate) - 1 AS INTEGER) AS reporting_year
FROM orders
""")
def full_window(spark, sf):
    o = load(spark, sf, "orders")
    return o.select("o_orderkey", sync.full_window_start(F.col("o_orderdate")).alias("window_start"),
                    sync.full_window_start(F.col("o_orderdate"), "erp_old").alias("window_start_erp_old"),
                    runs.reporting_year(F.col("o_orderdate")).alias("reporting_year"))


# ---------------------------------------------------- A12, A13, B11, B15, E5, E6
TABLE_STATUS_ROWS = (  # (table, status, seq): control rows, the last per table wins
    [(t, 1, 1) for _, _, t, *_ in sync.catalogue_rows("accounting", "regular")
     if t not in ("Artikelen",)]
    + [("Budget", 0, 2), ("Documenten", 0, 2), ("Relaties", 0, 0)])
_STATUS = {}
for _t, _s, _q in sorted(TABLE_STATUS_ROWS, key=lambda r: r[2]):
    _STATUS[_t] = _s
_ON_TABLES = [(t, k) for _, _, t, _, k, _ in sync.catalogue_rows("accounting", "regular") if _STATUS.get(t, 0) != 0]
_VALUES = ", ".join(f"('{t}', '{k}')" for t, k in _ON_TABLES)


@query("work_list", f"""
SELECT n.n_name AS klant, c.c_custkey AS tenant, w.table_name, w.filter_kind,
       '/api/accounting/' || lower(w.table_name) AS endpoint
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
CROSS JOIN (VALUES {_VALUES}) AS w(table_name, filter_kind)
WHERE n.n_regionkey <> 4 AND n.n_regionkey <> 3 AND c.c_acctbal >= 0
""")
def work_list(spark, sf):
    n = load(spark, sf, "nation")
    klanten = n.select(F.col("n_name").alias("klant"),
                       F.when(F.col("n_regionkey") == 4, 2).otherwise(1).alias("klant_type"),
                       F.when(F.col("n_regionkey") == 3, "erp").otherwise("accounting").alias("application"))
    c = load(spark, sf, "customer")
    tenants = (c.join(n.select("n_nationkey", "n_name"), c.c_nationkey == n.n_nationkey)
               .select(F.col("n_name").alias("klant"), F.col("c_custkey").alias("tenant"),
                       F.when(F.col("c_acctbal") < 0, 0).otherwise(1).alias("status")))
    status_rows = spark.createDataFrame(TABLE_STATUS_ROWS, "table_name string, status int, seq int")
    table_status = control_map(status_rows, ["table_name"], "seq")                    # A13 + E7
    endpoints = spark.createDataFrame(                                                  # B15
        [(t, f"/api/accounting/{t.lower()}") for _, _, t, *_ in sync.catalogue_rows("accounting", "regular")],
        "table_name string, endpoint string")
    items = sync.work_list(klanten, tenants, table_status, "accounting", "regular")    # B11, E5, E6
    return (items.join(F.broadcast(endpoints), "table_name")
            .select("klant", "tenant", "table_name", "filter_kind", "endpoint"))


# ------------------------------------------------------------------------ E7
@query("control_last_wins", """
SELECT user_id, event_id, ts, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
""")
def control_last_wins(spark, sf):
    e = load(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value", "props")
    return sync.last_wins(e, ["user_id"], "event_id")


# ------------------------------------------------------------------------ E9
@query("resolve_database", """
WITH m AS (
  SELECT c.c_name AS klant, n.n_regionkey AS pos FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
  UNION ALL
  SELECT c.c_name, (n.n_regionkey + 1) % 5 FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
  WHERE c.c_acctbal < 0),
f AS (SELECT klant, min(pos) AS pos FROM m GROUP BY klant),
names AS (SELECT c_name AS klant FROM customer UNION ALL SELECT n_name FROM nation)
SELECT names.klant, r.r_name AS database
FROM names LEFT JOIN f ON f.klant = names.klant LEFT JOIN region r ON r.r_regionkey = f.pos
""")
def resolve_database(spark, sf):
    c = load(spark, sf, "customer")
    n = load(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    r = load(spark, sf, "region")
    cn = c.join(n, c.c_nationkey == n.n_nationkey)
    # Each database lists the customers of its region; customers with a negative
    # balance are also listed (later) in the next region's database.
    listed = (cn.select("c_name", F.col("n_regionkey").alias("pos"))
              .unionByName(cn.filter(F.col("c_acctbal") < 0)
                           .select("c_name", ((F.col("n_regionkey") + 1) % 5).alias("pos"))))
    members = (listed.withColumn("_chunk", bounded_chunk(LIST_ROWS))
               .groupBy("pos", "_chunk").agg(F.collect_list("c_name").alias("customers"))
               .join(r, F.col("pos") == r.r_regionkey)
               .select(F.col("r_name").alias("database"), F.col("pos").alias("db_pos"), "customers"))
    names = c.select(F.col("c_name").alias("klant")).unionByName(
        load(spark, sf, "nation").select(F.col("n_name").alias("klant")))
    return sync.resolve_database(members, names).select("klant", "database")


# ----------------------------------------------------------------- W5, W16
def _tables(source: str) -> list[str]:
    if source == "accounting":
        return [t for _, _, t, *_ in sync.catalogue_rows("accounting", "regular")] + ["Divisions"]
    if source == "erp":
        return [t for _, _, t, *_ in sync.catalogue_rows("erp", "regular")]
    return ["Bedrijven", "Looncomponenten"]


_SOURCE_SQL = ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'erp' WHEN 'BUILDING' THEN 'payroll' "
               "ELSE 'accounting' END")
_CFG_VALUES = ", ".join(f"('{c.source}', '{c.table}', '{c.mode}', {str(bool(c.keys)).lower()})"
                        for c in WRITE_CONFIG.values())
_TBL_VALUES = ", ".join(f"('{s}', '{t}')" for s in ("accounting", "erp", "payroll") for t in _tables(s))


@query("write_rule", f"""
WITH items AS (
  SELECT c.c_custkey AS tenant, t.table_name, {_SOURCE_SQL} AS source,
         CASE WHEN c.c_acctbal > 8000 THEN 'full' ELSE 'other' END AS run_mode,
         {_WM_SQL} AS wm
  FROM customer c JOIN (VALUES {_TBL_VALUES}) AS t(source, table_name) ON t.source = {_SOURCE_SQL}),
j AS (
  SELECT i.*, w.table_mode, w.has_keys, {_AGE_SQL} AS age
  FROM items i JOIN (VALUES {_CFG_VALUES}) AS w(source, table_name, table_mode, has_keys)
    ON w.source = i.source AND w.table_name = i.table_name)
SELECT tenant, table_name,
  CASE WHEN source = 'accounting' AND table_name = 'Divisions' THEN 'none'
       WHEN source = 'accounting' AND run_mode = 'full' AND table_name IN ('Verkoopfacturen', 'VerkoopOrders') THEN 'date_window'
       WHEN source = 'accounting' AND run_mode = 'full' AND table_name = 'GrootboekMutaties' THEN 'year_window'
       WHEN source = 'accounting' AND run_mode = 'full' THEN 'none'
       WHEN source = 'accounting' AND COALESCE(age > 2.0, false) THEN 'tenant'
       WHEN source = 'accounting' AND table_mode = 'truncate' THEN 'tenant'
       WHEN source = 'accounting' AND table_mode = 'reporting_year' THEN 'year_window'
       WHEN source = 'accounting' THEN 'none'
       WHEN source = 'erp' AND (run_mode = 'full' OR COALESCE(age > 1.2, false) OR table_mode = 'truncate') THEN 'tenant'
       WHEN source = 'erp' THEN 'none'
       WHEN table_name = 'Bedrijven' THEN 'all'
       ELSE 'company_year' END AS delete_rule,
  CASE WHEN source = 'accounting' AND table_name = 'Divisions' THEN 'upsert_preserving'
       WHEN source = 'accounting' AND run_mode = 'full' AND table_name IN ('Verkoopfacturen', 'VerkoopOrders', 'GrootboekMutaties') THEN 'append'
       WHEN source = 'accounting' AND run_mode = 'full' THEN 'none'
       WHEN source = 'accounting' AND (COALESCE(age > 2.0, false) OR table_mode IN ('truncate', 'reporting_year')) THEN 'append'
       WHEN source = 'accounting' AND age IS NOT NULL AND has_keys THEN 'upsert'
       WHEN source = 'accounting' THEN 'append'
       WHEN source = 'erp' AND (run_mode = 'full' OR COALESCE(age > 1.2, false) OR table_mode = 'truncate') THEN 'append'
       WHEN source = 'erp' AND has_keys THEN 'upsert_tenant'
       WHEN source = 'erp' THEN 'append'
       ELSE 'append' END AS write_rule
FROM j
""")
def write_rule(spark, sf):
    c = _watermark(spark, sf)
    source = F.expr(_SOURCE_SQL)
    tables = (F.when(source == "erp", F.array(*[F.lit(t) for t in _tables("erp")]))
              .when(source == "payroll", F.array(*[F.lit(t) for t in _tables("payroll")]))
              .otherwise(F.array(*[F.lit(t) for t in _tables("accounting")])))
    items = c.select(F.col("c_custkey").alias("tenant"), source.alias("source"),
                     F.when(F.col("c_acctbal") > 8000, "full").otherwise("other").alias("run_mode"),
                     sync.age_years("watermark", _as_of()).alias("age_years"),
                     F.explode(tables).alias("table_name"))
    cfg = (rules.write_configs(spark)
           .select("source", "table_name", "table_mode", (F.size("keys") > 0).alias("has_keys")))
    # The write configuration is fixed (42 rows): a broadcast with a proven bound.
    j = items.join(F.broadcast(cfg), ["source", "table_name"])
    return rules.choose_rule(j).select("tenant", "table_name", "delete_rule", "write_rule")


# ------------------------------------------------------------------ G1, G2
@query("watermark_advance", f"""
SELECT user_id, bool_and(event_type <> 'error') AS all_ok,
       max(strftime(ts, '%Y-%m-%dT%H:%M:%S')) AS old_watermark,
       CASE WHEN bool_and(event_type <> 'error') THEN strftime({AS_OF_SQL}, '%Y-%m-%dT%H:%M:%S')
            ELSE max(strftime(ts, '%Y-%m-%dT%H:%M:%S')) END AS new_watermark,
       bool_and(event_type <> 'error') AS advanced,
       CAST(2023 AS INTEGER) AS reporting_year
FROM events GROUP BY user_id
""")
def watermark_advance(spark, sf):
    e = load(spark, sf, "events").select(
        "user_id", (F.col("event_type") != "error").alias("ok"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("wm"))
    adv = runs.advance_watermark(e, ["user_id"], "ok", AS_OF, "Wijzigingen", "wm")
    return adv.withColumn("reporting_year", runs.reporting_year(AS_OF))


# ---------------------------------------------------------------------- G3
@query("next_run_id", "SELECT COALESCE(max(event_id), 0) + 1 AS next_run_id FROM events")
def next_run_id(spark, sf):
    return runs.next_run_id(load(spark, sf, "events"), "event_id")


# -------------------------------------------------------------------- G4-G7
@query("run_log", f"""
SELECT user_id AS KlantID, event_id AS ScriptID,
       trim(string_split(msg, ' - ')[-1]) AS Actie,
       trim(string_split(msg, '-')[-1]) AS ActieKort,
       printf('%02d:%02d:%02d', s // 3600, (s % 3600) // 60, s % 60) AS Duur,
       (ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Amsterdam' AS DatumTijd
FROM (SELECT user_id, event_id, ts,
             'Sync ' || event_type || ' - table T' || CAST(user_id AS VARCHAR) || ' - ' || event_type || ' done-ok' AS msg,
             CAST(floor((epoch_us({AS_OF_SQL}) - epoch_us(ts)) / 1000000) AS BIGINT) AS s
      FROM events)
""")
def run_log(spark, sf):
    e = load(spark, sf, "events")
    msg = F.concat(F.lit("Sync "), F.col("event_type"), F.lit(" - table T"), F.col("user_id").cast("string"),
                   F.lit(" - "), F.col("event_type"), F.lit(" done-ok"))
    secs = F.floor(F.timestamp_diff("MICROSECOND", F.col("ts"), _as_of()) / F.lit(1_000_000)).cast("long")
    return e.select(F.col("user_id").alias("KlantID"), F.col("event_id").alias("ScriptID"),
                    message_tail(msg).alias("Actie"), message_tail(msg, "-").alias("ActieKort"),
                    elapsed_hms(secs).alias("Duur"), local_time(F.col("ts")).alias("DatumTijd"))


# --------------------------------------------------- W16 + G: a whole run's plan
_RUN_TABLES = ("VerkoopOrders", "GrootboekMutaties", "ReportingBalance", "ArtikelGroepen", "Divisions")
_RUN_CFG = ", ".join(f"('{t}', '{m}', {str(bool(k)).lower()})" for s, t, m, k, _ in rules.write_config_rows()
                     if s == "accounting" and t in _RUN_TABLES)


@query("run_plan", f"""
WITH items AS (SELECT c.c_custkey AS tenant, w.*, {_WM_SQL} AS wm FROM customer c
               JOIN (VALUES {_RUN_CFG}) AS w(table_name, table_mode, has_keys) ON true),
j AS (SELECT *, {_AGE_SQL} AS age FROM items)
SELECT tenant, table_name,
  CASE WHEN table_name = 'Divisions' THEN 'none' WHEN COALESCE(age > 2.0, false) THEN 'tenant'
       WHEN table_mode = 'truncate' THEN 'tenant' WHEN table_mode = 'reporting_year' THEN 'year_window' ELSE 'none' END AS delete_rule,
  CASE WHEN table_name = 'Divisions' THEN 'upsert_preserving'
       WHEN COALESCE(age > 2.0, false) OR table_mode IN ('truncate', 'reporting_year') THEN 'append'
       WHEN age IS NOT NULL AND has_keys THEN 'upsert' ELSE 'append' END AS write_rule,
  CAST(2023 AS INTEGER) AS year, CAST(make_date(CAST(year({AS_OF_SQL} - INTERVAL 365 DAY) AS BIGINT), 1, 1) AS TIMESTAMP) AS window_start
FROM j
""")
def run_plan(spark, sf):
    """What a run decides for every customer and table (the plan that ``run_source`` follows)."""
    from ..plans.run import plan_items

    work = _watermark(spark, sf).select(F.col("c_custkey").alias("tenant"), "watermark", F.lit(2023).alias("reporting_year"),
                                        F.explode(F.array(*[F.lit(t) for t in _RUN_TABLES])).alias("table_name"))
    return plan_items(work, "accounting", "Wijzigingen", AS_OF).select("tenant", "table_name", "delete_rule", "write_rule", "year", "window_start")


@query("run_log_rows", f"""
SELECT CAST(o_custkey AS INTEGER) AS KlantID, 'Customer ' || CAST(o_custkey AS VARCHAR) AS KlantNaam,
       CAST(o_orderkey % 97 AS INTEGER) AS AdministratieID, 'Adm ' || CAST(o_orderkey % 97 AS VARCHAR) AS AdministratieNaam,
       'accounting' AS ApplicatieNaam, o_orderpriority AS Tabel, {AS_OF_SQL} AS DatumTijd,
       o_orderpriority || CASE WHEN o_orderstatus = 'F' THEN ' - failed' ELSE ' - synchronised' END AS Actie,
       CASE WHEN o_orderstatus = 'F' THEN 'ERROR' ELSE 'INFO' END AS TypeActie, 'Wijzigingen' AS ScriptType, CAST(7 AS INTEGER) AS ScriptID
FROM orders
""")
def run_log_rows(spark, sf):
    """The 11 fields of the run log, one row per table outcome."""
    o = load(spark, sf, "orders")
    text = lambda c: c.cast("string")
    adm = F.col("o_orderkey") % 97
    outcomes = o.select(F.col("o_custkey").cast("int").alias("KlantID"), F.concat(F.lit("Customer "), text(F.col("o_custkey"))).alias("KlantNaam"),
                        adm.cast("int").alias("AdministratieID"), F.concat(F.lit("Adm "), text(adm)).alias("AdministratieNaam"),
                        F.col("o_orderpriority").alias("Tabel"), (F.col("o_orderstatus") != "F").alias("ok"), F.lit("failed").alias("error"))
    return runs.log_frame(outcomes, "accounting", 7, "Wijzigingen", _as_of())
