"""The file-stream sync (availableNow + foreachBatch) and the oracle gate."""

import os
import sys

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from konform.plans import publish
from konform.streaming.landed_stream import start_landed_sync

from conftest import SF_SMALL

ROW = T.StructType([T.StructField(n, T.StringType()) for n in ("ID", "Code", "Description")])


def _landed(spark, parts, label):
    rec = F.to_json(F.struct(
        F.concat_ws("-", *[F.substring(F.md5(F.col("p_partkey").cast("string")), a, b)
                           for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]).alias("ID"),
        F.col("p_brand").alias("Code"),
        F.concat(F.col("p_name"), F.lit(label)).alias("Description")))
    return (parts.select(F.floor(F.col("p_partkey") / 20).alias("page_no"), rec.alias("rec"))
            .groupBy("page_no").agg(F.concat(F.lit('{"d":{"results":['), F.concat_ws(",", F.collect_list("rec")),
                                             F.lit("]}}")).alias("body"))
            .select(F.lit("accounting").alias("source"), F.lit("1").alias("tenant"),
                    F.lit("ArtikelGroepen").alias("table"), F.col("page_no").cast("long"), "body",
                    F.lit(None).cast("string").alias("next_token")))


def test_stream_sync_upserts_each_batch(spark, tmpdir_path):
    parts = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    n = parts.count()
    landed = os.path.join(tmpdir_path, "landed")
    _landed(spark, parts.filter(F.col("p_partkey") < 100), " v1").coalesce(1).write.parquet(landed + "/b1")
    target = os.path.join(tmpdir_path, "target")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    q = start_landed_sync(spark, landed + "/*", target, "accounting", "ArtikelGroepen", ROW, ckpt)
    q.awaitTermination()
    first = publish.read_current(spark, target)
    assert first.count() == min(n, 100)
    _landed(spark, parts.filter(F.col("p_partkey") >= 50), " v2").coalesce(1).write.parquet(landed + "/b2")
    q = start_landed_sync(spark, landed + "/*", target, "accounting", "ArtikelGroepen", ROW, ckpt)
    q.awaitTermination()
    final = publish.read_current(spark, target)
    assert final.count() == n
    v2 = final.filter(F.col("Omschrijving").endswith(" v2")).count()
    assert v2 == n - 50
    assert final.columns == ["ID", "Code", "Omschrijving", "AdministratieCode"]
    assert dict(final.dtypes)["AdministratieCode"] == "bigint"
    assert publish.versions(spark, target) == [1, 2]


def test_oracle_gate_small(spark):
    """Every registered query equals its DuckDB oracle at sf0.001."""
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
    import oracle_check as oc

    import __spark_entry__ as entry

    con = oc.duck_con(SF_SMALL)
    failures = []
    for name, fn in entry.queries().items():
        sql = entry.oracle_sql().get(name)
        df = fn(spark, SF_SMALL)
        s_rows = [tuple(r) for r in df.collect()]
        if sql is None:
            continue
        cur = con.execute(sql)
        d_names = [d[0] for d in cur.description]
        d_rows = cur.fetchall()
        if sorted(df.columns) != sorted(d_names) or oc.rows_of(df.columns, s_rows) != oc.rows_of(d_names, d_rows):
            failures.append(name)
    assert failures == []


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert "OR_OrderRegelID" in df.columns


def test_stream_with_tenant_plan(spark, tmpdir_path):
    parts = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    landed = os.path.join(tmpdir_path, "landed")
    _landed(spark, parts, " v1").coalesce(1).write.parquet(landed + "/b1")
    target = os.path.join(tmpdir_path, "target")
    plan = spark.createDataFrame([(1, "none", "upsert", None, None)],
                                 "tenant long, delete_rule string, write_rule string, year int, window_start string")
    for batch in ("b1", "b2"):
        if batch == "b2":
            _landed(spark, parts, " v2").coalesce(1).write.parquet(landed + "/b2")
        q = start_landed_sync(spark, landed + "/*", target, "accounting", "ArtikelGroepen", ROW,
                              os.path.join(tmpdir_path, "ckpt"), plan=plan)
        q.awaitTermination()
    final = publish.read_current(spark, target)
    assert final.count() == parts.count()
    assert final.filter(F.col("Omschrijving").endswith(" v2")).count() == parts.count()


def test_replayed_batch_is_not_applied_twice(spark, tmpdir_path):
    from konform.streaming.landed_stream import sync_batch
    parts = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    pages = _landed(spark, parts, " v1")
    target = os.path.join(tmpdir_path, "replay")
    first = sync_batch(spark, pages, 0, target, "accounting", "ArtikelGroepen", ROW)
    again = sync_batch(spark, pages, 0, target, "accounting", "ArtikelGroepen", ROW)   # replay of batch 0
    assert first.endswith("v=00000001") and again is None
    assert publish.versions(spark, target) == [1]
    assert publish.read_current(spark, target).count() == parts.count()


def test_a_new_stream_on_an_existing_table_loses_no_batch(spark, tmpdir_path):
    from konform.streaming.landed_stream import batch_version, sync_batch
    parts = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    target = os.path.join(tmpdir_path, "second")
    go = lambda label, batch, stream: sync_batch(spark, _landed(spark, parts, label), batch, target, "accounting", "ArtikelGroepen", ROW,
                                                 stream_id=stream)
    assert go(" v1", 0, "one").endswith("v=00000001") and go(" v2", 1, "one").endswith("v=00000002")
    assert go(" v3", 0, "two").endswith("v=00000003") and go(" v3", 0, "two") is None       # another checkpoint starts at 0
    assert publish.read_current(spark, target).filter(F.col("Omschrijving").endswith(" v3")).count() == parts.count()
    # noted but not committed: the replay writes the same version
    assert batch_version(spark, target, "two", 1) == (4, False) and batch_version(spark, target, "two", 1) == (4, False)
    assert go(" v4", 1, "two").endswith("v=00000004")
