"""A run driven by mapping rows alone (A4, B15 -> B4 -> C14 -> W12 / W13).

Nothing about the tables is declared in code: which administrations have which tables, under which endpoint,
which source field becomes which target column of which type, all come from the control tables at run time.  The target's
schema is the mapping's: absent fields are left out of a write (a matched row keeps its value, a new one gets null),
and fields without a mapping are dropped.

Tables with keys are merged: a row is updated only where a value differs (W12).  Tables without keys are
replaced (W13), for each administration on its own: the stored table remembers whose a row is, so an
administration whose pages are missing or unreadable keeps its rows.  Tables are taken one after the other
(as many as the control tables name); each is one job for all of its administrations.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import metadata_cast, spark_type_name
from ..operators import mapping, write
from ..session import scratch_path
from ..sources.chains import landed_once
from ..sources.control import with_endpoints
from ..sources.payloads import keyed_rows, observed_fields, page_quality, resource_of
from . import outcomes as oc
from . import publish, rules
from .run import OWNER, RunResult
from .table_sync import sync_tenants


def metadata_work(administrations: DataFrame, links: DataFrame, tables: DataFrame, application: str) -> DataFrame:
    """The work list: active administrations x their active tables of the application, with customer, table id and endpoint."""
    of_app = tables.filter(F.col("ApplicatieNaam") == application)
    items = (administrations.filter("Actief").select(F.col("AdministratieID").alias("tenant"), F.col("KlantID").cast("string").alias("customer"))
             .join(links.filter("Actief").select(F.col("AdministratieID").alias("tenant"), "TabelID", F.col("TabelNaam").alias("table_name")), "tenant")
             .join(of_app.select("TabelID"), "TabelID", "left_semi"))
    return with_endpoints(items, of_app)


def table_schema(rows: list[tuple[str, str, str | None]]) -> T.StructType:
    """The target schema of mapping rows (source field, target column, type); a target named twice counts once, text without a type."""
    out: dict[str, str] = {}
    for _, target, kind in rows:
        out.setdefault(target, spark_type_name(kind) or "string")
    return T.StructType([T.StructField(c, T._parse_datatype_string(t)) for c, t in out.items()])


def run_metadata(spark: SparkSession, landed: DataFrame, work: DataFrame, mapping_table: DataFrame, keys: dict[str, list[str]], target_root: str,
                 run_start: str) -> RunResult:
    """Synchronise every table of ``work`` (from ``metadata_work``) from the landed pages ``(tenant, table, page_no, body,
    next_token)``; ``keys`` names the key columns of the tables that have some."""
    base = scratch_path(spark, f"metadata-run-{uuid.uuid4().hex}")
    work.write.parquet(f"{base}/work")
    work = spark.read.parquet(f"{base}/work")
    page_quality(landed, ["table", "tenant"], "keyed").withColumnRenamed("table", "table_name").write.parquet(f"{base}/quality")
    quality = spark.read.parquet(f"{base}/quality")
    result, written = RunResult(), []
    for r in work.select("table_name", "TabelID", "endpoint").distinct().orderBy("table_name").collect():       # rows of a control table
        table, out = r["table_name"], {"table": r["table_name"], "ok": True, "rows": 0}
        try:
            fields = mapping.mapping_rows(mapping_table, r["TabelID"])
            out["rows"] = _sync_table(spark, table, landed, work, quality, fields, r["endpoint"], keys.get(table, []), f"{target_root}/{table}")
        except Exception as e:  # noqa: BLE001 - a failed table is reported and blocks its customers
            out |= {"ok": False, "error": str(e) or type(e).__name__}
        written.append((table, out.get("error")))
        result.outcomes.append(out)
    configured = work.join(mapping_table.select("TabelID").distinct().withColumn("configured", F.lit(True)), "TabelID", "left")
    plan = configured.select("customer", "tenant", "table_name", F.coalesce("configured", F.lit(False)).alias("configured"))
    oc.run_outcomes(plan, quality, spark.createDataFrame(written, "table_name string, error string")).write.parquet(f"{base}/outcomes")
    result.items = spark.read.parquet(f"{base}/outcomes")
    bad = {r["table_name"] for r in result.items.filter("planned and not ok").select("table_name").distinct().collect()}
    for out in result.outcomes:
        out["ok"] = out["table"] not in bad
    result.watermark = run_start.replace(" ", "T")[:19] if result.ok and written else None
    return result


def _sync_table(spark: SparkSession, table: str, landed: DataFrame, work: DataFrame, quality: DataFrame, fields: list[tuple], endpoint: str | None,
                keys: list[str], base: str) -> int:
    if not fields:
        raise mapping.MappingError(f"no mapping rows for {table}")
    if not endpoint:
        raise ValueError(f"no endpoint for {table}")
    schema = table_schema(fields)
    missing = [k for k in keys if k not in schema.names]
    if missing:
        raise write.WriteError(f"key columns missing from the mapping of {table}: {missing}")
    planned = work.filter(F.col("table_name") == table).select(F.col("tenant").cast("string").alias("tenant")).distinct()
    usable = quality.filter((F.col("table_name") == table) & F.col("usable")).select(F.col("tenant").cast("string").alias("tenant"))
    pages = landed.filter(F.col("table") == table).withColumn("tenant", F.col("tenant").cast("string"))
    pages = landed_once(pages.join(planned, "tenant", "left_semi").join(usable, "tenant", "left_semi"), ["tenant"], ["page_no"])
    resource = resource_of(F.lit(endpoint))
    seen = {r["field"] for r in observed_fields(pages, "keyed", resource).select("field").collect()}                # one per field of the API
    present = [(s, t) for s, t, _ in fields if s in seen]
    if not present:
        return 0                                             # nothing arrived: nothing changes
    record = T.StructType([T.StructField(s, T.StringType()) for s in dict.fromkeys(s for s, _ in present)])
    rows = keyed_rows(pages, record, resource, keep=["tenant"]).withColumnRenamed("tenant", OWNER)
    rows = mapping.map_lenient(rows, [*present, (OWNER, OWNER)])                                                    # B4
    rows = metadata_cast(rows, {t: k for _, t, k in fields}).withColumn(OWNER, F.col(OWNER).cast("long"))             # C14
    staged = publish.stage(spark, rows, f"{base}/_staging")
    try:
        current = publish.read_current(spark, base)
        if current is None:
            current = spark.createDataFrame([], T.StructType([*schema.fields, *([] if keys else [T.StructField(OWNER, T.LongType())])]))
        delete, how = _rule(spark, bool(keys))
        if how == "upsert_changed":
            write.validate_write(staged, table, keys)
            new = write.upsert_changed(current, staged.drop(OWNER), keys, with_action=False)
        else:
            absent = [f for f in schema.fields if f.name not in staged.columns]
            whole = staged.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent])
            plan = planned.select(F.col("tenant").cast("long").alias("tenant"), F.lit(delete).alias("delete_rule"), F.lit("append").alias("write_rule"),
                                  F.lit(None).cast("int").alias("year"), F.lit(None).cast("timestamp_ntz").alias("window_start"))
            new = sync_tenants(current, whole, plan, [], OWNER)
        return publish.publish_with_counts(spark, new, base)[1].get("rows", 0)
    finally:
        publish.unstage(spark, staged)


def _rule(spark: SparkSession, has_keys: bool) -> tuple[str, str]:
    """W16 for the metadata-driven source."""
    item = spark.createDataFrame([("metadata", "other", "", "none", None, has_keys)],
                                 "source string, run_mode string, table_name string, table_mode string, age_years double, has_keys boolean")
    r = rules.choose_rule(item).first()
    return r["delete_rule"], r["write_rule"]
