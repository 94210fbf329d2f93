"""Connected components of a link table, by repeated hooking and shortcutting."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def thinned(edges: DataFrame, base: str) -> DataFrame:
    """Few edges with the components of ``edges`` (u, v; u > v, without repeats).

    Every node hands its smaller neighbours to the smallest of them and keeps that one, so members that hang on the same
    hubs leave one edge each and one between the hubs: the rounds that follow grow with the nodes and not with the
    links among them.  A pass never adds edges; passes end when one saves less than a tenth.
    """
    n, k = edges.count(), 0
    while True:
        low = edges.groupBy("u").agg(F.min("v").alias("_m"))
        (edges.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("_m").alias("v")), F.struct(F.col("v").alias("u"), F.col("_m").alias("v")))).alias("_e"))
         .select("_e.*").filter("u <> v").distinct().write.parquet(f"{base}/thin-{k}"))
        edges = edges.sparkSession.read.parquet(f"{base}/thin-{k}")
        before, n, k = n, edges.count(), k + 1
        if 10 * n >= 9 * before:
            return edges


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its smallest node) of every node that has a link.

    Every round lowers each node's label to the smallest among its neighbours and
    then to its label's label; rounds are logarithmic in the longest path.  Labels are
    written to the shared folder each round, so lineage stays short and a lost executor
    costs one round.
    """
    spark = links.sparkSession
    base = scratch_path(spark, f"components-{uuid.uuid4().hex}")
    links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct().write.parquet(f"{base}/links")
    (thinned(spark.read.parquet(f"{base}/links"), base)
     .select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("_e"))
     .select("_e.*").write.parquet(f"{base}/edges"))
    edges = spark.read.parquet(f"{base}/edges")
    # the first labels need no join: each node's smallest neighbour
    edges.groupBy("u").agg(F.min("v").alias("_m")).select(F.col("u").alias("node"), F.least("u", "_m").alias("label")).write.parquet(f"{base}/0")
    labels, k = spark.read.parquet(f"{base}/0"), 0
    while True:
        near = (edges.join(labels.select(F.col("node").alias("v"), F.col("label").alias("_l")), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("_l").alias("_near")))
        hooked = labels.join(near, "node").select("node", "label", F.least("label", "_near").alias("_new"))
        # shortcut: the label's own label
        up = labels.select(F.col("node").alias("_new"), F.col("label").alias("_up"))
        step = hooked.join(up, "_new", "left").select("node", F.least("_new", F.coalesce("_up", "_new")).alias("label"),
                                                      (F.least("_new", F.coalesce("_up", "_new")) < F.col("label")).alias("changed"))
        k += 1
        step.write.parquet(f"{base}/{k}")
        done = spark.read.parquet(f"{base}/{k}")
        labels = done.select("node", "label")
        if done.filter("changed").isEmpty():
            return labels.select("node", F.col("label").alias("component"))
