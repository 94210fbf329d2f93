"""Prefix trie of conversations, its subtree totals by parallel tree contraction.

Conversations are rebuilt (the first turns of their block's base conversation, then their own), and
every distinct sequence of first turns is a node.  A turn travels as two 64-bit hashes of (role, text) and the
length of its text, never as text.  A node is named by the sums, over its turns, of the hashes mixed with
the turn's place, so the names of all prefixes are running sums: rows are dealt by *range* of
(conversation, place), summed in their tasks, and only what a conversation that crosses a border of ranges brings
along goes through the driver (at most one entry per range).  A conversation with a third of all turns is
spread like any other rows.

Subtree totals come from contraction in rounds of joins, on any shape of tree:

* rake: every childless node hands its total to its parent (a partial aggregate per parent) and leaves the tree;
* compress: of the nodes with one child, those whose hash is smaller than their parent's and their child's - no two
  neighbours - are spliced out; the child takes over the parent and keeps what it owes for the node.

A round rakes all leaves and removes about a third of every unary chain, so a chain of length n takes some ``log n`` rounds
and all rounds together touch a number of rows in proportion to the tree.  Then the rounds are run backwards: a
spliced node's total is its child's total and what was noted, so every node gets its own.  Each round's tree is a written
table; a lost executor costs part of one round.

What one task must do alone: the digest of the conversations that end at one node reads their (sorted, joined) ids as
one stream, in constant memory.

Defined results: turns are ordered by turn (null first), then role, then the hash of the text; null role or text is
empty; rows without a conversation id belong to none and are left out; the base of a negative id is found as SQL
divides (towards zero); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from . import textvec as tv

SHARE = 6                    # h = crc32(id) % SHARE turns come from the base
BLOCK = 100                  # conversations per base
STRETCH = 1 << 16            # turns of one conversation that meet its facts in one join key
BLOB_BYTES = 1 << 14
ROOT = (0, 0)


def _runs(conv: np.ndarray, last) -> tuple[np.ndarray, bool]:
    """(first row of each run of equal ids, whether the first run goes on from ``last``)."""
    return np.concatenate(([0], np.flatnonzero(conv[1:] != conv[:-1]) + 1)), bool(len(conv)) and conv[0] == last


def _ranked(rows: DataFrame) -> DataFrame:
    """part, conv, local (place within the conversation and range, from 1) and the turn's hashes and length."""

    def scan(batches):
        part, last, held = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(0).to_numpy()
            starts, goes_on = _runs(conv, last)
            base = np.repeat(starts, np.diff([*starts, len(conv)]))
            local = np.arange(1, len(conv) + 1) - base
            if goes_on:
                local[: starts[1] if len(starts) > 1 else len(conv)] += held
            last, held = conv[-1], int(local[-1])
            yield pa.record_batch([pa.array(np.full(len(conv), part, np.int32)), batch.column(0), pa.array(local), *batch.columns[1:]],
                                  names=["part", "conv", "local", "x", "y", "size"])

    order = ["conv", "turn", "role", "x", "salt"]
    return (rows.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
            .select("conv", "x", "y", "size").mapInArrow(scan, "part int, conv long, local long, x long, y long, size long"))


def _summed(rows: DataFrame) -> DataFrame:
    """part, conv, depth, end, size and the running sums before (px, py) and with (sx, sy) each turn, within the range."""

    def scan(batches):
        part, last, held = TaskContext.get().partitionId(), None, (np.uint64(0), np.uint64(0))
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, depth = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.uint64)
            starts, goes_on = _runs(conv, last)
            runs = np.diff([*starts, len(conv)])
            out = []
            for k, name in enumerate(("x", "y")):
                with np.errstate(over="ignore"):
                    v = tv.mix(batch.column(name).to_numpy().view(np.uint64) ^ tv.mix(depth + np.uint64(1000 * k + 7)))
                    total = np.cumsum(v)
                    before = total - v
                    carry = np.repeat(before[starts], runs)
                    if goes_on:
                        carry[:runs[0]] -= held[k]
                    out += [before - carry, total - carry]
            last, held = conv[-1], (out[1][-1], out[3][-1])
            yield pa.record_batch([pa.array(np.full(len(conv), part, np.int32)), batch.column(0), batch.column(1), batch.column("end"), batch.column("size"),
                                   *(pa.array(o.view(np.int64)) for o in out)], names=["part", "conv", "depth", "end", "size", "px", "sx", "py", "sy"])

    return (rows.repartitionByRange("conv", "depth").sortWithinPartitions("conv", "depth").select("conv", "depth", "end", "size", "x", "y")
            .mapInArrow(scan, "part int, conv long, depth long, end boolean, size long, px long, sx long, py long, sy long"))


def _carried(rows: DataFrame, values: dict[str, Column]) -> dict[tuple[int, int], tuple[int, ...]]:
    """What each conversation that crosses range borders brings into each range: the wrapped sum of its values in the
    ranges before.  A range is entered by at most one conversation, so this holds no more entries than there are ranges."""
    per = rows.groupBy("conv", "part").agg(*[c.alias(n) for n, c in values.items()])
    crossing = rows.groupBy("conv").agg(F.min("part").alias("_lo"), F.max("part").alias("_hi")).filter("_lo < _hi").select("conv")
    out, before = {}, {}
    for r in sorted(per.join(crossing, "conv").collect(), key=lambda r: (r["conv"], r["part"])):
        now = before.get(r["conv"], (0,) * len(values))
        out[r["conv"], r["part"]] = now
        before[r["conv"]] = tuple((a + r[n]) & ((1 << 64) - 1) for a, n in zip(now, values))
    return out


def _with_carry(rows: DataFrame, carried: dict, columns: list[list[str]]) -> DataFrame:
    """Add to each group of columns what the conversation brought into the range."""

    def scan(batches):
        for batch in batches:
            conv, part = batch.column("conv").to_numpy(), batch.column("part").to_numpy()
            new = {name: batch.column(name).to_numpy().view(np.uint64).copy() for group in columns for name in group}
            for p in np.unique(part).tolist():
                for c in entering.get(p, ()):
                    here = (part == p) & (conv == c)
                    for group, add in zip(columns, carried[c, p]):
                        for name in group:
                            with np.errstate(over="ignore"):
                                new[name][here] += np.uint64(add)
            yield pa.record_batch([pa.array(new[n].view(np.int64)) if n in new else batch.column(n) for n in batch.schema.names], names=batch.schema.names)

    entering: dict[int, list[int]] = {}
    for (c, p), add in carried.items():
        if any(add):
            entering.setdefault(p, []).append(c)
    return rows.mapInArrow(scan, rows.schema) if entering else rows


def rebuilt(turns: DataFrame, base: str, conv_col: str, turn_col: str, role_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(facts: conv, total, of every conversation; rows: conv, depth, x, y, size, end, of every rebuilt turn)."""
    spark = turns.sparkSession
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = turns.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), F.xxhash64(role, text).alias("x"),
                        F.xxhash64(F.lit("second"), text, role).alias("y"), F.char_length(text).cast("long").alias("size")).filter("conv is not null")
    _ranked(rows).write.parquet(f"{base}/ranked")
    ranked = spark.read.parquet(f"{base}/ranked")
    carried = _carried(ranked, {"n": F.count(F.lit(1))})
    placed = _with_carry(ranked, carried, [["local"]]).withColumnRenamed("local", "pos")
    size = ranked.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    size = size.withColumn("block", F.col("conv") - F.col("conv") % BLOCK).withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % SHARE)
    bases = size.filter("conv = block").select(F.col("conv").alias("block"), F.col("n").alias("_nb"))
    size.join(bases, "block", "left").select("conv", "block", "n", "h", F.least("h", F.coalesce("_nb", F.lit(0))).alias("k")) \
        .withColumn("total", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).write.parquet(f"{base}/facts")
    facts = spark.read.parquet(f"{base}/facts")
    stretch = lambda c: F.floor(F.col(c) / STRETCH).cast("long")
    copies = facts.withColumn("_s", F.explode(F.sequence(F.lit(0).cast("long"), stretch("n"))))
    own = (placed.withColumn("_s", stretch("pos")).join(copies, ["conv", "_s"]).filter("pos > h")
           .select("conv", (F.col("pos") - F.col("h") + F.col("k")).alias("depth"), "x", "y", "size", "total"))
    # at most SHARE - 1 turns of a base, for at most 2 * BLOCK conversations
    first = placed.filter((F.col("pos") < SHARE) & (F.col("conv") % BLOCK == 0)).select(F.col("conv").alias("block"), F.col("pos").alias("depth"), "x", "y", "size")
    shared = first.join(facts, "block").filter("depth <= k").select("conv", "depth", "x", "y", "size", "total")
    return facts.select("conv", "total"), own.unionByName(shared).withColumn("end", F.col("depth") == F.col("total")).drop("total")


def paths(facts: DataFrame, rows: DataFrame, base: str) -> DataFrame:
    """node, up (the parent), conv, depth, size, end: one row per conversation and depth; the root's rows too."""
    spark = rows.sparkSession
    _summed(rows).write.parquet(f"{base}/sums")
    sums = spark.read.parquet(f"{base}/sums")
    carried = _carried(sums, {"x": F.max_by("sx", "depth"), "y": F.max_by("sy", "depth")})
    deep = _with_carry(sums, carried, [["px", "sx"], ["py", "sy"]])
    node = lambda a, b: F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    deep = deep.select(node(F.col("sx"), F.col("sy")).alias("node"), node(F.col("px"), F.col("py")).alias("up"), "conv", "depth", "size", "end")
    top = facts.select(node(F.lit(ROOT[0]), F.lit(ROOT[1])).alias("node"), F.lit(None).cast("struct<a:long,b:long>").alias("up"), "conv",
                       F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("size"), (F.col("total") == 0).alias("end"))
    return deep.unionByName(top)


def digests(ends: DataFrame) -> DataFrame:
    """node, sha: SHA-256 of the ids (conv) of each node, ascending, comma-joined."""

    def join(batches):
        part, k, node, ids, held = TaskContext.get().partitionId(), 0, None, [], 0

        def blob():
            return pa.record_batch([pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()), pa.array([part], pa.int32()), pa.array([k], pa.int64()),
                                    pa.array([",".join(ids)])], names=["a", "b", "part", "k", "ids"])

        for batch in batches:
            for a, b, c in zip(*(x.to_pylist() for x in batch.columns)):
                if node != (a, b) or held > BLOB_BYTES:
                    if ids:
                        yield blob()
                    node, ids, held, k = (a, b), [], 0, k + 1
                ids.append(str(c))
                held += len(ids[-1]) + 1
        if ids:
            yield blob()

    def digest(batches):
        node, sha = None, None
        for batch in batches:
            done = []
            for a, b, text in zip(*(x.to_pylist() for x in batch.columns)):
                if node == (a, b):
                    sha.update(b",")
                else:
                    if node:
                        done.append((*node, sha.hexdigest()))
                    node, sha = (a, b), hashlib.sha256()
                sha.update(text.encode())
            yield rows_of(done)
        if node:
            yield rows_of([(*node, sha.hexdigest())])

    def rows_of(done):
        return pa.record_batch([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))], names=["a", "b", "sha"])

    blobs = (ends.select(F.col("node.a").alias("a"), F.col("node.b").alias("b"), "conv").repartitionByRange("a", "b", "conv")
             .sortWithinPartitions("a", "b", "conv").mapInArrow(join, "a long, b long, part int, k long, ids string"))
    return (blobs.repartition("a", "b").sortWithinPartitions("a", "b", "part", "k").select("a", "b", "ids").mapInArrow(digest, "a long, b long, sha string")
            .select(F.struct("a", "b").alias("node"), "sha"))


def subtree_totals(tree: DataFrame, values: list[str], base: str) -> DataFrame:
    """node and, for every value column, its sum over the node's subtree, by rake and compress.

    ``tree`` holds node, up (null at the root) and the values (long).
    """
    spark = tree.sparkSession
    owed = [f"_o_{v}" for v in values]
    kids = tree.filter("up is not null").groupBy("up").agg(F.count(F.lit(1)).alias("_n"))
    (tree.join(kids.withColumnRenamed("up", "_u"), F.col("node") == F.col("_u"), "left")
     .select("node", "up", F.coalesce("_n", F.lit(0)).alias("kids"), *values, *[F.lit(0).cast("long").alias(o) for o in owed],
             F.lit(None).cast(tree.schema["node"].dataType).alias("out"), *[F.lit(None).cast("long").alias(f"_a_{v}") for v in values])
     .write.parquet(f"{base}/0"))
    state, r = spark.read.parquet(f"{base}/0"), 0
    while not state.filter("up is not null").isEmpty():
        # rake
        leaves = state.filter("kids = 0 and up is not null")
        gain = leaves.groupBy(F.col("up").alias("_u")).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(F.col(v) + F.col(o)).alias(f"_g_{v}") for v, o in zip(values, owed)])
        (state.filter("kids > 0 or up is null").join(gain, F.col("node") == F.col("_u"), "left")
         .select("node", "up", (F.col("kids") - F.coalesce("_n", F.lit(0))).alias("kids"), *[(F.col(v) + F.coalesce(f"_g_{v}", F.lit(0))).alias(v) for v in values], *owed)
         .write.parquet(f"{base}/raked-{r}"))
        raked = spark.read.parquet(f"{base}/raked-{r}")
        # compress: local minima among nodes with one child
        prio = lambda c: F.xxhash64(f"{c}.a", f"{c}.b", F.lit(r))
        only = raked.filter("up is not null").groupBy(F.col("up").alias("_u")).agg(F.max(F.struct("node", *owed)).alias("_c"))
        chain = raked.filter("kids = 1 and up is not null").filter(prio("node") < prio("up"))
        cut = (chain.join(only, F.col("node") == F.col("_u")).withColumn("_child", F.col("_c.node")).filter(prio("node") < prio("_child"))
               .select(F.col("node").alias("_out"), F.col("up").alias("_up"), "_child", *[(F.col(v) + F.col(f"_c.{o}")).alias(f"_a_{v}") for v, o in zip(values, owed)],
                       *[(F.col(v) + F.col(o) + F.col(f"_c.{o}")).alias(f"_new_{v}") for v, o in zip(values, owed)]))
        change = cut.select(F.explode(F.array(F.struct(F.col("_out").alias("_key"), F.lit(True).alias("_gone"), *[c for c in cut.columns if c != "_child"]),
                                              F.struct(F.col("_child").alias("_key"), F.lit(False).alias("_gone"), *[c for c in cut.columns if c != "_child"]))).alias("_x")).select("_x.*")
        r += 1
        (raked.join(change, F.col("node") == F.col("_key"), "left").filter("not coalesce(_gone, false)")
         .select("node", F.when(F.col("_key").isNotNull(), F.col("_up")).otherwise(F.col("up")).alias("up"), "kids", *values,
                 *[F.coalesce(f"_new_{v}", o).alias(o) for v, o in zip(values, owed)], F.col("_out").alias("out"), *[f"_a_{v}" for v in values])
         .write.parquet(f"{base}/{r}"))
        state = spark.read.parquet(f"{base}/{r}")
    # re-expand
    totals = state.select("node", *values)
    for k in range(r - 1, -1, -1):
        after = spark.read.parquet(f"{base}/{k + 1}").filter("out is not null").select("node", "out", *[f"_a_{v}" for v in values])
        (after.join(totals, "node").select(F.col("out").alias("node"), *[(F.col(v) + F.col(f"_a_{v}")).alias(v) for v in values])
         .write.parquet(f"{base}/spliced-{k}"))
        raked_off = spark.read.parquet(f"{base}/{k}").filter("kids = 0 and up is not null").select("node", *values)
        totals = totals.unionByName(raked_off).unionByName(spark.read.parquet(f"{base}/spliced-{k}"))
    return totals


def trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = turns.sparkSession
    base = scratch_path(spark, f"prefix-trie-{uuid.uuid4().hex}")
    facts, rows = rebuilt(turns, base, conv_col, turn_col, role_col, text_col)
    paths(facts, rows, base).write.parquet(f"{base}/paths")
    steps = spark.read.parquet(f"{base}/paths")
    nodes = steps.groupBy("node").agg(F.min("conv").alias("conv_id"), F.max("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"),
                                      F.max("size").alias("size"), F.max("up").alias("up"))
    kids = nodes.filter("up is not null").groupBy(F.col("up").alias("_u")).agg(F.count(F.lit(1)).alias("n_children"))
    (nodes.join(kids, F.col("node") == F.col("_u"), "left").drop("_u").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
     .write.parquet(f"{base}/nodes"))
    nodes = spark.read.parquet(f"{base}/nodes")
    tree = nodes.select("node", "up", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"))
    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"], f"{base}/rounds")
    parents = nodes.select(F.col("node").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    ends = digests(steps.filter("end"))
    return (nodes.join(parents, "up", "left").join(totals, "node").join(ends, "node", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))
