"""A whole sync run for one source: plan -> one job per table -> outcomes -> run log -> watermark.

The planner (E1-E6, W16) produces one row per (customer, tenant, table) work item; the
driver loops over the *tables* of the run (at most the catalogue's ~20, a
fixed bound) and each table is synchronised for all of its tenants in one
Spark job, with each tenant's rule, year and window as columns of the plan.  Only planned tenants
with usable pages and at least one record are changed, whatever the rule.  What was planned, landed and
written is joined to one outcome per item (``outcomes``); a customer's watermark moves to the run start only when
all of its items succeeded (G1, deviation V5).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import POLICIES, SPARK_TYPES, audit_values
from ..operators import write
from ..schemas import DIVISION_OPERATOR_COLUMNS, NESTED, column_mapping, target_types, write_config
from ..session import scratch_path
from ..sources.chains import landed_once
from ..sources.payloads import JSON_PAYLOADS, XML_RECORDS, observed_fields, page_quality, resource_of
from . import outcomes as oc
from . import publish, rules, runs, sync
from .table_sync import (TENANT_WRITE_RULES, Step, apply_step, delete_tenant_column, mapped_records, read_records,
                         sync_tenant_partitions, sync_tenants, typed_records)

# Year / date columns the delete windows of a table refer to.
WINDOW_COLUMNS = {
    ("accounting", "ReportingBalance"): ("ReportingYear", None),
    ("accounting", "GrootboekMutaties"): ("Boekjaar", "Datum"),
    ("accounting", "Verkoopfacturen"): (None, "F_Factuurdatum"),
    ("accounting", "VerkoopOrders"): (None, "O_Orderdatum"),
    ("payroll", "Looncomponenten"): ("Jaar", None),
}


def row_schema_for(source: str, table: str) -> T.StructType:
    """The declared record schema of a landed table: its mapping's source fields
    (target names for the ERP source) as text, plus the nested line list of the
    three sales documents."""
    doc = NESTED.get(table) if source == "accounting" else None
    if doc is not None:
        line = T.StructType([T.StructField("results", T.ArrayType(
            T.StructType([T.StructField(f, T.StringType()) for f in doc.line_fields])))])
        return T.StructType([T.StructField(f, T.StringType()) for f in doc.header_fields]
                            + [T.StructField(doc.line_column, line)])
    m = column_mapping(source, table)
    names = [s for s, _ in m] if m else [c for c, _ in target_types(source, table)]
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def target_schema(source: str, table: str) -> T.StructType:
    return T.StructType([T.StructField(c, SPARK_TYPES[t]) for c, t in target_types(source, table)])


def stored_schema(source: str, table: str) -> T.StructType:
    """The target schema plus the columns that operators of the target maintain."""
    extra = DIVISION_OPERATOR_COLUMNS if (source, table) == ("accounting", "Divisions") else ()
    return T.StructType([*target_schema(source, table).fields, *[T.StructField(c, T.IntegerType()) for c in extra]])


@dataclass
class RunResult:
    """``outcomes``: a dict per table; ``items``: the relation of ``outcomes.run_outcomes``; ``watermark``: the new one if every
    item of every customer succeeded; ``audit``: the values that did not fit their type (table_name, column, value, n ...), with how
    often they occurred, of all tables of the run."""

    outcomes: list[dict] = field(default_factory=list)
    watermark: str | None = None
    items: DataFrame | None = None
    audit: DataFrame | None = None

    @property
    def ok(self) -> bool:
        return all(o["ok"] for o in self.outcomes)


def plan_items(work: DataFrame, source: str, run_mode: str, as_of: str) -> DataFrame:
    """W16 for each work item ``(tenant, table_name, watermark, reporting_year)``: the delete and write rule plus the
    year / window start they use.  ``configured`` is false for a table without write configuration (it gets no rule);
    a work list without ``customer`` or ``endpoint`` has one customer and no endpoints."""
    cfg = (rules.write_configs(spark=work.sparkSession).filter(F.col("source") == source)
           .select("table_name", "table_mode", (F.size("keys") > 0).alias("has_keys"), F.lit(True).alias("configured")))
    as_of_c = F.lit(as_of).cast("timestamp_ntz")
    for name in ("customer", "endpoint"):
        if name not in work.columns:
            work = work.withColumn(name, F.lit("" if name == "customer" else None).cast("string"))
    items = (work.join(F.broadcast(cfg), "table_name", "left")       # 42 fixed rows at most
             .withColumn("source", F.lit(source))
             .withColumn("configured", F.coalesce("configured", F.lit(False)))
             .withColumn("run_mode", F.lit("full" if run_mode == "Volledig" else "other"))
             .withColumn("age_years", sync.age_years("watermark", as_of_c)))
    return (rules.choose_rule(items)
            .withColumn("year", F.col("reporting_year").cast("int"))
            .withColumn("window_start", sync.full_window_start(as_of_c).cast("timestamp_ntz")))


def _present_fields(pages: DataFrame, schema: T.StructType, payload: str, path: list[str] | None) -> T.StructType | None:
    """The declared fields that occur in the landed records, JSON or XML: a field the API dropped or renamed is
    absent (so the strict map fails and defaults fill), not silently null.  None: no record at all."""
    found = observed_fields(pages, payload, F.col("_resource"), path=path)
    names = {r["field"] for r in found.select("field").collect()}                     # one per API field
    return T.StructType([f for f in schema.fields if f.name in names]) if names else None


def run_source(spark: SparkSession, source: str, landed: DataFrame, work: DataFrame, target_root: str,
               run_start: str, run_mode: str = "Wijzigingen", payload: str = "odata",
               in_place: bool = True, resource: str | None = None, path: list[str] | None = None) -> RunResult:
    """Synchronise every table of ``work`` (one job per table) and report outcomes.

    ``landed`` holds the run's pages ``(source, tenant, table, page_no, body,
    next_token)``, optionally with the links ``own`` and ``nxt`` (``chains``); ``work`` the planned items ``(tenant,
    table_name, watermark, reporting_year)``, optionally with the ``customer`` and the ``endpoint`` of each (whose last
    segment is the key of a ``keyed`` payload; ``resource`` serves items without one); ``run_start`` is the new watermark.
    Tables with a tenant column are kept in tenant partitions, of which a run reads and
    rewrites only the touched ones; ``in_place=False`` publishes a new version of the
    whole table instead.

    A tenant whose pages cannot all be read, or whose page chain has a gap or stops short, or that landed nothing,
    is left as it is: nothing of it is deleted or written, its item is not ok and its customer's watermark stays.
    """
    base = scratch_path(spark, f"run-{uuid.uuid4().hex}")
    plan_items(work, source, run_mode, run_start).write.parquet(f"{base}/plan")
    plans = spark.read.parquet(f"{base}/plan")
    pages = landed.filter(F.col("source") == source)
    page_quality(pages, ["table", "tenant"], payload).withColumnRenamed("table", "table_name").write.parquet(f"{base}/quality")
    quality = spark.read.parquet(f"{base}/quality")
    # at most the catalogue's tables
    tables = {r["table_name"]: r["configured"] for r in plans.groupBy("table_name").agg(F.bool_and("configured").alias("configured")).collect()}
    result, written = RunResult(), []
    for table in sorted(tables):
        out = {"table": table, "ok": True, "rows": 0, "bad_values": 0}
        if tables[table]:
            try:
                out |= _run_table(spark, source, table, pages, plans, quality, target_root, payload, in_place, resource, path, f"{base}/audit")
            except Exception as e:  # noqa: BLE001 - a failed table is reported and blocks the watermark of its customers
                out |= {"ok": False, "error": str(e) or type(e).__name__}
        written.append((table, out.get("error")))
        result.outcomes.append(out)
    oc.run_outcomes(plans.select("customer", "tenant", "table_name", "configured"), quality,
                    spark.createDataFrame(written, "table_name string, error string")).write.parquet(f"{base}/outcomes")
    result.items = spark.read.parquet(f"{base}/outcomes")
    if publish._exists(spark, f"{base}/audit"):
        result.audit = spark.read.parquet(f"{base}/audit")
    bad = {r["table_name"]: r for r in result.items.filter("planned and not ok").groupBy("table_name")
           .agg(F.count(F.lit(1)).alias("n"), F.min("error").alias("error")).collect()}                       # at most the catalogue's tables
    for out in result.outcomes:
        if out["table"] in bad:
            r = bad[out["table"]]
            out |= {"ok": False, "error": out.get("error") or f"{r['n']} tenants not synchronised, such as: {r['error']}"}
    if not tables:
        result.outcomes.append({"table": "", "ok": False, "error": "nothing planned"})
    result.watermark = run_start.replace(" ", "T")[:19] if result.ok and run_mode != "Volledig" else None
    return result


#: stands for the tenant column of a table that has none; kept in the stored table so that a delete of all rows stays the tenant's
OWNER = "_tenant"


def _owner_column(source: str, table: str, plan_t: DataFrame) -> str | None:
    """The column that says whose a row is: the table's own, or ``OWNER`` where rows are replaced as a whole (rule ``all``)."""
    own = delete_tenant_column(source, table)
    if own is None and not plan_t.filter("delete_rule = 'all'").isEmpty():
        return OWNER
    return own


def _run_table(spark: SparkSession, source: str, table: str, landed: DataFrame, plans: DataFrame, quality: DataFrame, target_root: str,
               payload: str, in_place: bool, resource: str | None, path: list[str] | None, audit_path: str) -> dict:
    cfg = write_config(source, table)
    base = f"{target_root}/{source}/{table}"
    plan_t = (plans.filter(F.col("table_name") == table)
              .select(F.col("tenant").cast("long").alias("tenant"), "delete_rule", "write_rule", "year", "window_start", "endpoint").distinct())
    out = {"path": base, "rows": 0, "bad_values": 0}
    usable = quality.filter((F.col("table_name") == table) & F.col("usable")).select("tenant")
    pages = landed.filter(F.col("table") == table).join(usable, "tenant", "left_semi")
    pages = landed_once(pages, ["tenant"], ["own"] if "own" in pages.columns else ["page_no"])
    # each page with its tenant's year and, for keyed payloads, the resource its endpoint names; pages of unplanned tenants end here
    facts = plan_t.select(F.col("tenant").cast("string").alias("tenant"), F.col("year").alias("_year"),
                          F.coalesce(resource_of(F.col("endpoint")), F.lit(resource)).alias("_resource"))
    pages = pages.withColumn("tenant", F.col("tenant").cast("string")).join(facts, "tenant")
    schema = row_schema_for(source, table)
    if payload in JSON_PAYLOADS or XML_RECORDS.get(payload) or (payload == "elements" and path):
        schema = _present_fields(pages, schema, payload, path)
        if schema is None:
            return out                                       # nothing arrived: nothing changes
    rows = read_records(pages, schema, payload, keep=["tenant", "_year"], resource="_resource", path=path)
    owner = _owner_column(source, table, plan_t)
    mapped = mapped_records(rows, source, table, tenant=F.col("tenant").cast("long"), year=F.col("_year"), owner=OWNER if owner == OWNER else None)
    staged = publish.stage(spark, mapped, f"{base}/_staging")
    try:
        # one audit table per run; its total is observed while it is written
        seen = Observation("bad_values")
        found = audit_values(staged, target_types(source, table), POLICIES[source]).select(F.lit(table).alias("table_name"), "*")
        found.observe(seen, F.sum("n").alias("n")).write.mode("append").parquet(audit_path)
        out["bad_values"] = int(seen.get["n"] or 0)
        new_rows = typed_records(staged, source, table, extra=[OWNER] if owner == OWNER else [])
        out["rows"] = _apply(spark, source, table, cfg, base, new_rows, plan_t.drop("endpoint"), in_place, owner)
    finally:
        publish.unstage(spark, staged)
    return out


def _apply(spark: SparkSession, source: str, table: str, cfg, base: str, new_rows: DataFrame, plan_t: DataFrame, in_place: bool,
           tenant_col: str | None):
    if not write.validate_write(new_rows, table, list(cfg.keys)):
        return 0                                             # nothing arrived: nothing changes
    year_col, date_col = WINDOW_COLUMNS.get((source, table), (None, None))
    rules_used = {r["write_rule"] for r in plan_t.select("write_rule").distinct().collect()}   # a handful of names
    per_tenant = tenant_col and rules_used <= set(TENANT_WRITE_RULES)
    schema = stored_schema(source, table)
    if tenant_col == OWNER:
        schema = T.StructType([*schema.fields, T.StructField(OWNER, T.LongType())])
    if per_tenant and in_place and tenant_col != OWNER:
        return sync_tenant_partitions(spark, base, new_rows, plan_t, list(cfg.keys), tenant_col, target_schema(source, table),
                                      year_col=year_col, date_col=date_col, key_tenant_col=cfg.tenant_column).get("rows")
    current = publish.read_current(spark, base)
    if current is None:
        current = spark.createDataFrame([], schema)
    if tenant_col == OWNER and OWNER not in current.columns:
        current = current.withColumn(OWNER, F.lit(None).cast("long"))        # rows from before: nobody's, kept
    if per_tenant:
        new = sync_tenants(current, new_rows, plan_t, list(cfg.keys), tenant_col,
                           year_col=year_col, date_col=date_col, key_tenant_col=cfg.tenant_column)
    else:
        # a rule for the whole table: the plan rows must agree in what that rule uses (tenants may differ in the rest)
        used = F.struct("delete_rule", "write_rule", F.when(F.col("delete_rule").isin("year_window", "company_year"), F.col("year")).alias("year"),
                        F.when(F.col("delete_rule") == "date_window", F.col("window_start")).alias("window_start"))
        steps = plan_t.select(used.alias("s")).distinct().select("s.*").collect()
        if len(steps) != 1:
            raise ValueError(f"{table}: {len(steps)} different rules for one table")
        r = steps[0]
        new = apply_step(current, new_rows, Step(source, table, r["delete_rule"], r["write_rule"], year=r["year"],
                                                 window_start=r["window_start"], year_column=year_col, date_column=date_col))
    _, counts = publish.publish_with_counts(spark, new, base)
    return counts.get("rows")


def finish_run(spark: SparkSession, result: RunResult, entries: list[dict] | DataFrame, log_path: str, config: DataFrame, key: list[str],
               run_start: str, run_mode: str, config_path: str) -> None:
    """Append the run's log rows once (``entries``: dicts or the frame of ``item_log``), and write the next state of the
    control rows: a customer's watermark and reporting year move only when all of its items succeeded.

    ``key`` names the customer in ``config``; customers without a planned item keep theirs.  A result without an item
    relation counts as one outcome for all."""
    log = entries if isinstance(entries, DataFrame) else runs.log_rows(spark, entries)
    runs.append_log(log, log_path)
    if result.items is None or result.items.filter("planned and customer <> ''").isEmpty():
        marked = config.withColumn("_ok", F.lit(result.ok))
    else:
        own = oc.customer_outcomes(result.items).select(F.col("customer").alias("_customer"), F.col("ok").alias("_ok"))
        marked = config.join(own, F.col(key[0]).cast("string") == F.col("_customer"), "left").drop("_customer")
    moved = runs.advance_watermark(marked, key, "_ok", run_start, run_mode, "watermark")
    year = F.when(F.col("advanced"), runs.reporting_year(run_start)).otherwise(F.col("reporting_year"))
    (config.drop("watermark").join(moved.select(*key, F.col("new_watermark").alias("watermark"), "advanced"), key)
     .withColumn("reporting_year", year).drop("advanced").write.mode("overwrite").parquet(config_path))


def item_log(result: RunResult, administrations: DataFrame, application: str, run_id: int, script: str, at) -> DataFrame:
    """One log row per planned item, with its customer and administration.

    ``administrations(tenant, KlantID, KlantNaam, AdministratieID, AdministratieNaam)`` is control data; an item of an unknown
    tenant is logged without them."""
    items = result.items.filter("planned").withColumnRenamed("table_name", "Tabel")
    known = administrations.withColumn("tenant", F.col("tenant").cast("string"))
    return runs.log_frame(items.join(known, "tenant", "left"), application, run_id, script, at)


def log_entries(result: RunResult, klant: str, run_id: int, script: str, at, klant_id: int | None = None,
                administration: tuple[int, str] | None = None, application: str | None = None) -> list[dict]:
    """One run-log row per table outcome (written with one append per run), with the customer, the
    administration and the application the run was for."""
    adm_id, adm_name = administration or (None, None)
    return [{"KlantID": klant_id, "KlantNaam": klant, "AdministratieID": adm_id, "AdministratieNaam": adm_name,
             "ApplicatieNaam": application, "Tabel": o["table"], "DatumTijd": at, "ScriptID": run_id,
             "ScriptType": script, "TypeActie": "INFO" if o["ok"] else "ERROR",
             "Actie": f"{o['table']} - {'synchronised' if o['ok'] else o['error']}"}
            for o in result.outcomes]
