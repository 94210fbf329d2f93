"""The sync pipeline driven by a file stream of landed pages.

Landed pages arrive as parquet files ``(source, tenant, table, page_no, body, next_token[, extraction])`` in a folder.
A Structured Streaming file source picks up new files; every micro-batch is conformed (unwrap -> flatten ->
map -> coerce) and merged into the target table's next version.  ``trigger(availableNow=True)`` processes
what is there and stops, which is how a scheduled sync run uses it.

Pages are put together in one of two ways:

* ``page``: every page stands alone and is applied with its batch (upsert on the table's keys, append when it has
  none, or a plan without deletes).  A page that cannot be read fails the batch; nothing of it is applied.
* ``chain``: an extraction - a tenant's page chain - is applied once, as a whole, in the batch that brings its last missing
  page, however its pages were split over batches.  Pages of open extractions are the stream's keyed state: a table of held
  pages per batch, written before the batch's version, so a replayed batch finds the state it started from.  An extraction with
  an unreadable page stays open until that page lands again; until then it changes nothing.  A plan that
  deletes needs this form, and takes it by itself.

Fault tolerance: the stream's checkpoint (in the shared checkpoint folder)
records which files each batch consumed; the version a batch writes is noted
beside the table before it is written, so a batch replayed after a failure finds
its version already committed and writes nothing twice.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.sql.streaming import StreamingQuery

from ..plans.table_sync import Step, apply_step, conform_records, read_records, sync_tenants
from ..plans.publish import _fs, _remove, publish, read_current, versions
from ..plans.run import target_schema
from ..schemas import write_config
from ..sources.chains import landed_once
from ..sources.payloads import LANDED_SCHEMA, page_quality, readable


def batch_version(spark: SparkSession, target_base: str, stream_id: str, batch_id: int) -> tuple[int, bool]:
    """The table version that this batch of this stream writes, and whether it is committed.

    The number is noted under ``_batches`` before the version is written, so a replay finds it: a committed
    version is not written again, an uncommitted one is written anew under the same number.  Another
    stream (another checkpoint) has notes of its own, so its batch 0 is never taken for a replay."""
    fs, note, jvm = _fs(spark, f"{target_base}/_batches/{stream_id}/{batch_id}")
    have = versions(spark, target_base)
    if fs.exists(note):
        version = int(fs.listStatus(note)[0].getPath().getName())
        return version, version in have
    version = (have[-1] + 1) if have else 1
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(note, str(version)))
    return version, False


CHAIN = ["tenant", "extraction"]


class UnreadablePage(ValueError):
    """A page of the batch cannot be parsed."""


def _held_path(target_base: str, stream_id: str, batch_id: int) -> str:
    return f"{target_base}/_held/{stream_id}/upto={batch_id:012d}"


def held_pages(spark: SparkSession, target_base: str, stream_id: str = "stream", before: int | None = None) -> DataFrame:
    """The pages of open extractions after the last batch (or the last one below ``before``)."""
    fs, p, jvm = _fs(spark, f"{target_base}/_held/{stream_id}")
    done = []
    for st in fs.listStatus(p) if fs.exists(p) else []:
        name = st.getPath().getName()
        if not name.startswith("upto=") or name.endswith(".ready"):
            continue
        n = int(name.split("=")[1])
        if (before is None or n < before) and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            done.append(n)
    if not done:
        return spark.createDataFrame([], LANDED_SCHEMA)
    return spark.read.schema(LANDED_SCHEMA).parquet(_held_path(target_base, stream_id, max(done)))


def _settled(pages: DataFrame, payload: str) -> DataFrame:
    """Without unreadable copies of pages that have landed readable too."""
    marked = pages.withColumn("_ok", readable(F.col("body"), payload))
    again = (marked.filter("not _ok").select(*CHAIN, "page_no").distinct()
             .join(marked.filter("_ok").select(*CHAIN, "page_no").distinct(), [*CHAIN, "page_no"]).withColumn("_again", F.lit(True)))
    return (marked.join(again, [*CHAIN, "page_no"], "left").filter(F.col("_ok") | F.col("_again").isNull())
            .select(*pages.columns))


def _whole_extractions(spark: SparkSession, pages: DataFrame, batch_id: int, target_base: str, stream_id: str, payload: str,
                       first_page: int) -> list[DataFrame]:
    """The pages of the extractions that are whole with this batch, as many frames as one tenant has of them, in their order;
    the others are held."""
    held = held_pages(spark, target_base, stream_id, before=batch_id)
    known = held.unionByName(pages.select(*LANDED_SCHEMA.names)).withColumn("extraction", F.coalesce("extraction", F.lit("")))
    known = _settled(known, payload)
    whole = page_quality(known, CHAIN, payload, first_page=first_page).filter("usable").select(*CHAIN)
    order = whole.withColumn("_k", F.dense_rank().over(Window.partitionBy("tenant").orderBy("extraction")))    # one row per extraction
    ready = f"{_held_path(target_base, stream_id, batch_id)}.ready"
    landed_once(known, CHAIN, ["page_no"]).join(order, CHAIN).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(ready)
    (known.join(whole, CHAIN, "left_anti").write.mode("overwrite").option("partitionOverwriteMode", "static")
     .parquet(_held_path(target_base, stream_id, batch_id)))
    out = spark.read.parquet(ready)
    most = out.agg(F.max("_k")).first()[0] or 0
    return [out.filter(F.col("_k") == k) for k in range(1, most + 1)]


def sync_batch(spark: SparkSession, pages: DataFrame, batch_id: int, target_base: str, source: str,
               table: str, row_schema, payload: str = "odata", resource: str | None = None,
               plan: DataFrame | None = None, stream_id: str = "stream", assemble: str | None = None,
               first_page: int = 0, path: list[str] | None = None) -> str | None:
    """Conform one batch of landed pages and publish the merged next version (None: a replay, or nothing to apply).

    The version is the next free one, whatever the batch number (``batch_version``).

    With a per-tenant ``plan`` (``tenant, delete_rule, write_rule, year,
    window_start``) every tenant gets its own delete and write rule
    (``sync_tenants``); without one the table's keys decide upsert or append.  ``assemble`` is ``page`` or ``chain`` (see
    above); by default a plan that deletes takes ``chain``, everything else ``page``."""
    if assemble is None:
        assemble = "chain" if plan is not None and not plan.filter("delete_rule <> 'none'").isEmpty() else "page"
    version, done = batch_version(spark, target_base, stream_id, batch_id)
    if done:
        return None                                    # replayed batch: already published
    pages = pages.filter((F.col("source") == source) & (F.col("table") == table))
    if "extraction" not in pages.columns:
        pages = pages.withColumn("extraction", F.lit(None).cast("string"))
    if assemble == "chain":
        parts = _whole_extractions(spark, pages, batch_id, target_base, stream_id, payload, first_page)
        if not parts:
            return None
    else:
        bad = pages.filter(~readable(F.col("body"), payload)).select("tenant", "page_no").head()
        if bad is not None:
            raise UnreadablePage(f"{table}: page {bad['page_no']} of tenant {bad['tenant']} cannot be read")
        parts = [pages]
    cfg = write_config(source, table)
    new = read_current(spark, target_base, target_schema(source, table))
    if new is None:
        new = spark.createDataFrame([], target_schema(source, table))
    for part in parts:
        rows = read_records(part, row_schema, payload, keep=["tenant"], resource=resource, path=path)
        tenant = F.col("tenant").cast("long") if source == "accounting" else F.col("tenant")
        conformed = conform_records(rows, source, table, tenant=tenant)
        if plan is not None and cfg and cfg.tenant_column:
            new = sync_tenants(new, conformed, plan, list(cfg.keys), cfg.tenant_column)
        else:
            rule = "upsert" if (cfg and cfg.keys) else "append"
            new = apply_step(new, conformed, Step(source, table, write_rule=rule))
    out = publish(spark, new, target_base, version=version)
    if assemble == "chain":
        _remove(spark, f"{_held_path(target_base, stream_id, batch_id)}.ready")
    return out


def start_landed_sync(spark: SparkSession, landed_dir: str, target_base: str, source: str, table: str,
                      row_schema, checkpoint: str, payload: str = "odata",
                      max_files_per_trigger: int | None = None, plan: DataFrame | None = None, assemble: str | None = None,
                      first_page: int = 0) -> StreamingQuery:
    """Start the stream; the caller waits with ``awaitTermination()``."""
    stream_id = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]      # a checkpoint is a stream's identity
    reader = spark.readStream.schema(LANDED_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(landed_dir)

    def _process(batch: DataFrame, batch_id: int) -> None:
        sync_batch(spark, batch, batch_id, target_base, source, table, row_schema, payload, plan=plan, stream_id=stream_id, assemble=assemble,
                   first_page=first_page)

    return (stream.writeStream.foreachBatch(_process)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
