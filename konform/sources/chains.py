"""Page chains assembled by their links (A2).

A page knows the link it was asked under (``own``; null on the first page of a chain) and the link
of the page that follows (``nxt``; null on the last): OData ``__next`` and Atom ``rel=next`` URLs, the
``offset_rowid`` header sent and received, or plain page numbers (``numbered``).  Pages land in any
order, some twice, some not at all.

A chain counts only if every distinct page is reached exactly once on the way from the first page to
the one without a link.  The way is found by list ranking: in each round every page replaces
the page it points to by the one that points to, so a chain of n pages takes log2(n) joins, whatever
its shape; nothing is walked page by page and no chain sits in one task.  Bodies do not move:
only links and a digest of the body take part.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

FIRST = ""                      # the key of a chain's first page, which no link names


def numbered(pages: DataFrame, page_no: str = "page_no", next_token: str = "next_token") -> DataFrame:
    """``own`` and ``nxt`` for pages that are numbered one after the other from 0."""
    n = F.col(page_no).cast("long")
    return pages.withColumns({"own": F.when(n != 0, n.cast("string")), "nxt": F.when(F.col(next_token).isNotNull(), (n + 1).cast("string"))})


def distinct_pages(pages: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """One row per chain and ``own`` link: ``copies`` landed, and ``same`` - whether all of them are equal."""
    digest = F.xxhash64(F.col(body), F.col("nxt"))
    return (pages.groupBy(*keys, F.coalesce("own", F.lit(FIRST)).alias("own"))
            .agg(F.count(F.lit(1)).alias("copies"), (F.min(digest) == F.max(digest)).alias("same"), F.max("nxt").alias("nxt")))


def ranked_pages(pages: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """Every distinct page with ``last`` (the page its links lead to) and ``left`` (how many pages follow until there).

    ``last`` is null where the links lead nowhere: to a page that has not landed, or round in a circle.
    """
    spark = pages.sparkSession
    base = scratch_path(spark, f"chains-{uuid.uuid4().hex}")
    distinct_pages(pages, keys, body).write.parquet(f"{base}/pages")
    nodes = spark.read.parquet(f"{base}/pages")
    longest = nodes.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    # to: the page pointed at so far; left: steps to it; state: open, ended (to has no link), lost (to has not landed)
    state = nodes.select(*keys, "own", F.coalesce("nxt", F.col("own")).alias("to"), F.when(F.col("nxt").isNull(), 0).otherwise(1).cast("long").alias("left"),
                         F.col("nxt").isNull().alias("ended"), F.lit(False).alias("lost"))
    rounds = max(longest - 1, 0).bit_length() + 1
    for r in range(rounds):
        there = state.select(*keys, F.col("own").alias("to"), F.col("to").alias("_to"), F.col("left").alias("_left"), F.col("ended").alias("_ended"),
                             F.col("lost").alias("_lost"))
        done = F.col("ended") | F.col("lost")
        gone = F.col("_ended").isNull()
        # Pages that are done stay where they are: only open ones move, whose targets differ.  The sides grow with the
        # pages, so they are merged, never collected for a broadcast.
        step = state.filter(~done).join(there.hint("merge"), [*keys, "to"], "left").select(
            *keys, "own", F.when(gone, F.col("to")).otherwise(F.col("_to")).alias("to"),
            F.when(gone, F.col("left")).otherwise(F.col("left") + F.col("_left")).alias("left"),
            F.coalesce("_ended", F.lit(False)).alias("ended"), (gone | F.coalesce("_lost", F.lit(False))).alias("lost"))
        step.unionByName(state.filter(done)).write.parquet(f"{base}/{r}")
        state = spark.read.parquet(f"{base}/{r}")
    ranks = state.select(*keys, "own", F.when(F.col("ended"), F.col("to")).alias("last"), F.when(F.col("ended"), F.col("left")).alias("left"))
    return nodes.join(ranks.hint("merge"), [*keys, "own"])


def report_of(ranks: DataFrame, keys: list[str]) -> DataFrame:
    first = F.col("own") == FIRST
    return (ranks.groupBy(*keys)
            .agg(F.sum("copies").alias("n_pages"), F.count(F.lit(1)).alias("n_distinct"), F.count_if(~F.col("same")).alias("n_conflicts"),
                 F.coalesce(F.max(F.when(first & F.col("last").isNotNull(), F.col("left") + 1)), F.lit(0)).alias("n_reached"))
            .withColumn("complete", (F.col("n_conflicts") == 0) & (F.col("n_reached") == F.col("n_distinct"))))


def chain_report(pages: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """Per chain: ``n_pages`` landed, ``n_distinct``, ``n_conflicts`` (a page landed again with another body or link), ``n_reached``
    (pages on the way from the first page, 0 if that way does not end) and ``complete``.

    Rows with a null in a key belong to no chain and are not reported.
    """
    return report_of(ranked_pages(pages.dropna(subset=keys), keys, body), keys)


def chain_order(pages: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """``place`` (from 0) of every distinct page of the complete chains: keys, own, place."""
    ranks = ranked_pages(pages.dropna(subset=keys), keys, body)
    whole = report_of(ranks, keys).filter("complete").select(*keys, "n_distinct")
    return ranks.join(whole, keys).select(*keys, "own", (F.col("n_distinct") - 1 - F.col("left")).alias("place"))


def landed_once(pages: DataFrame, keys: list[str], page: list[str]) -> DataFrame:
    """Every page of a chain once.  Only pages that landed more than once are shuffled; the others stay where they are."""
    again = pages.groupBy(*keys, *page).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    marks = [*keys, *page]
    same = _same([F.col(f"p.{c}") for c in marks], [F.col(f"a.{c}") for c in marks])
    single = pages.alias("p").join(again.alias("a"), same, "left_anti")
    rest = [c for c in pages.columns if c not in marks]
    double = (pages.alias("p").join(again.alias("a"), same, "left_semi").groupBy(*marks)
              .agg(F.any_value(F.struct(*rest)).alias("_r")).select(*marks, "_r.*").select(*pages.columns))
    return single.unionByName(double)


def _same(left: list[Column], right: list[Column]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right):
        out = out & a.eqNullSafe(b)
    return out
