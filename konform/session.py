"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

#: Bytes of a batch of rows sent to a Python worker: texts are handled a megabyte at a time at most, so more only takes memory.
BATCH_BYTES = 4 * 1024 * 1024
DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what Catalyst measured as small; everything else shuffles.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "konform",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def bound_batches(spark: SparkSession) -> None:
    """Batches for Python workers of about ``BATCH_BYTES``, unless the session sets their size itself.

    Spark's own bound (64 MB) is held by the executor and by its worker, for every task that runs.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session (one JVM, as in tests) without any configured folder
    gets a private one, registered with ``setCheckpointDir`` (the config itself
    cannot be changed on a running session).  On a cluster without a shared
    folder this is an error: each executor would write to its own disk.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
        return d
    current = sc.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    d = tempfile.mkdtemp(prefix="konform-ckpt-")
    sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder below the shared checkpoint folder for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)
