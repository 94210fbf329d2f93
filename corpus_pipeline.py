"""The corpus pipeline: documents through the operators of ``konform.llm``, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet
into the shared folder and read again as the next stage's documents.  All stages but the last
return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from konform.llm import decontaminate, mixing, near_dup, quality, sharding
from konform.llm.ship import ship
from konform.session import scratch_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that the weakly trained classifier rejects go."""
    ship(spark)
    return quality.keep_good(docs)


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of each near-duplicate group the smallest id stays."""
    ship(spark)
    return near_dup.keep_first(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that hold a benchmark item, copied or edited, go."""
    ship(spark)
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def draw(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents are drawn with their calibrated probabilities."""
    return mixing.draw(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: every document gets its shard and slot on the ring."""
    return sharding.shard_rows(docs, shards=40, vnodes=32)


STAGES = [("quality", keep_good), ("near_dup", keep_first), ("decontaminate", keep_clean), ("mixing", draw), ("sharding", shard)]
#: Trained models and near-duplicate groups have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each on what its predecessor kept."""
    base = scratch_path(spark, f"corpus-pipeline-{uuid.uuid4().hex}")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
