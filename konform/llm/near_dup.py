"""MinHash near-duplicates with tensored banding.

A document's set holds its distinct five-word shingles.  From few minhashes - ``COLLECTIONS``
collections of ``ROWS`` values each - many table keys are formed by combining every *pair* of
collections: 12 collections of 2 values (24 minhashes) give 66 tables of 4 values.  Two
documents meet in a table as soon as any two of their collections agree; a pair with
similarity 0.75 is missed with probability 8e-4, one with 0.8 with 1e-4, before
links through third documents are counted.

Equal sets are one class from the start, known by the row (id and text) that stands for it.  The members of a
bucket are compared with the bucket's centre on their full sets, and with each
other: all members with one centre form a group, which is dealt out in chunks of
``CHUNK`` members.  In a chunk, members that match the centre are attached to it; each
other is compared with every member, and is attached if it reaches the centre through them.  Pairs of
attached members are linked already.  Members that are still open in a group of several chunks
are regrouped under a centre of their own (the smallest of them) as long as that halves
them, which gives most a common label; then they meet the other chunks block by block, where pairs with
one label need no comparison.  So every candidate pair is either compared or already linked, and no task
holds more than two blocks.  Links are confirmed on full sets and leave a task as a spanning forest: fewer
links than members (or labels), however many pairs are similar.  Components follow from the links.

Defined results: A-Z are lower-cased, other letters stay; a text with fewer than
five words is one shingle; texts without words (or null) have an empty set, are
linked with nothing and kept; rows that share an id are judged by their own texts (equal
rows stay or go together); rows without an id are linked with nothing and kept; an empty
table gives no rows; other columns are ignored (``keep_first`` passes them on).
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bound_batches, scratch_path
from . import textvec as tv
from .components import components

SHINGLE = 5
COLLECTIONS, ROWS = 12, 2
CHUNK = 128
SIMILAR = (75, 100)             # links: 100 * intersection >= 75 * union
_RNG = np.random.default_rng(77)
_A = _RNG.integers(1, 1 << 63, COLLECTIONS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(1, 1 << 63, COLLECTIONS * ROWS, dtype=np.uint64)


def shingle_sets(data: np.ndarray, off: np.ndarray):
    """(hashes sorted within each row and without repeats, row bounds)."""
    s, e, row = tv.word_spans(data, off)
    h, r = tv.shingles(tv.span_hash(tv.prefix_hash(tv.LOWER[data]), s, e), row, len(off) - 1, SHINGLE)
    bounds = np.searchsorted(r, np.arange(len(off)))
    h = h.copy()
    for a, b in zip(bounds[:-1], bounds[1:]):
        h[a:b].sort()
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    kept = np.concatenate(([0], np.cumsum(keep)))
    return h[keep], kept[bounds]


def row_key(id_col: str, text_col: str):
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col))


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, k (row key), n (set size), d1 and d2 (digest of the set), c (one value per collection)."""

    def scan(batches):
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            for lo, hi, data, off in tv.chunks(batch.column(2), tv.SCAN_BYTES):
                h, b = shingle_sets(data, off)
                n = np.diff(b)
                some = np.flatnonzero(n)
                at = b[:-1][some]
                c = np.zeros((len(n), COLLECTIONS), np.uint64)
                d1, d2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
                if len(some):
                    with np.errstate(over="ignore"):
                        d1[some] = np.add.reduceat(tv.mix(h + np.uint64(11)), at)
                        d2[some] = np.add.reduceat(tv.mix(h ^ np.uint64(0x5851F42D4C957F2D)), at)
                        for k in range(COLLECTIONS * ROWS):
                            low = np.minimum.reduceat(h * _A[k] + _B[k], at)
                            c[some, k // ROWS] = tv.mix(c[some, k // ROWS] * np.uint64(31) + low)
                flat = pa.array(c.reshape(-1).view(np.int64))
                yield pa.record_batch([ids.slice(lo, hi - lo), keys.slice(lo, hi - lo), pa.array(n.astype(np.int64)), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                                       pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * COLLECTIONS), flat)],
                                      names=["id", "k", "n", "d1", "d2", "c"])

    return (docs.select(F.col(id_col).cast("long"), row_key(id_col, text_col), F.col(text_col))
            .mapInArrow(scan, "id long, k long, n long, d1 long, d2 long, c array<long>"))


def similar(inter, n_a, n_b):
    return SIMILAR[1] * inter >= SIMILAR[0] * (n_a + n_b - inter)


class _Sets:
    """The shingle sets of some documents, ready for counting intersections with one of them."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        self.sets = sets
        values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.size)
        o = np.argsort(values, kind="stable")
        self.values, self.owner = values[o], owner[o]

    def shared(self, s: np.ndarray) -> np.ndarray:
        """Size of the intersection of s with every set."""
        lo, hi = np.searchsorted(self.values, s, "left"), np.searchsorted(self.values, s, "right")
        n = hi - lo
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.bincount(self.owner[at], minlength=len(self.size))

    def partners(self, s: np.ndarray) -> np.ndarray:
        return np.flatnonzero(similar(self.shared(s), self.size, len(s)))


class _Forest:
    """Union-find over some labels; ``join`` says whether two were apart."""

    def __init__(self, labels):
        self.up = {x: x for x in labels}

    def root(self, x):
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _links_of_chunk(ids: list[int], sets: list[np.ndarray]):
    """Links among documents, ``ids[0]`` being the centre: a spanning forest of the similar pairs.  Returns (links, positions
    of the members that do not reach the centre)."""
    group, forest, links = _Sets(sets), _Forest(range(len(ids))), []
    for k in range(len(ids)):
        if k and forest.root(k) == 0:
            continue
        for j in group.partners(sets[k]).tolist():
            if forest.join(k, j):
                links.append((ids[k], ids[j]))
    return links, [k for k in range(len(ids)) if forest.root(k)]


def _links_of_blocks(ids, labels, sets, others, other_labels, other_sets):
    """Links between two blocks: a spanning forest of their labels."""
    group, forest, links, distinct = _Sets(sets), _Forest([*labels, *other_labels]), [], list(dict.fromkeys(labels))
    for x, label, s in zip(others, other_labels, other_sets):
        if all(forest.root(label) == forest.root(y) for y in distinct):
            continue
        for j in group.partners(s).tolist():
            if forest.join(label, labels[j]):
                links.append((x, ids[j]))
    return links


def _grouped(batches, keys: int):
    """(key values, rows as (role, id, text) columns) of consecutive rows with equal leading columns; input
    is sorted by them.  A group may run on into the next batch."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        cols = [table.column(k).to_numpy() for k in range(keys)]
        change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1
        cuts = [0, *change.tolist()]
        held = table.slice(cuts[-1])
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield table.slice(a, b - a)
    if held is not None and held.num_rows:
        yield held


def _sets_of(col) -> list[np.ndarray]:
    out = []
    for _, _, data, off in tv.chunks(col, tv.SCAN_BYTES):
        h, b = shingle_sets(data, off)
        out += [h[x:y] for x, y in zip(b[:-1], b[1:])]
    return out


def _compare(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Links within each group of ``keys``; rows are sorted by key, then role (0 centre, 1 member, 2 open member of
    another chunk).  Members of groups with more than one chunk that stay open come back as rows with kind 1."""
    n = len(keys)

    def run(batches):
        out = []
        for t in _grouped(batches, n):
            role, ids = t["role"].to_numpy(), t["id"].to_pylist()
            if len(ids) < 2:
                continue
            sets = _sets_of(t["text"])
            if role[0] == 0:
                links, open_ = _links_of_chunk(ids, sets)
                if t["chunks"][0].as_py() > 1:
                    out += [(ids[k], 0, 1, t[keys[0]][0].as_py(), t[keys[1]][0].as_py()) for k in open_]
            else:
                here, labels = int((role == 1).sum()), t["label"].to_pylist()
                links = _links_of_blocks(ids[:here], labels[:here], sets[:here], ids[here:], labels[here:], sets[here:]) if here else []
            out += [(x, y, 0, 0, 0) for x, y in links]
            if len(out) > 5000:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    def batch_of(rows):
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["a", "b", "kind", "g", "s"])

    return (parts.repartition(*keys).sortWithinPartitions(*keys, "role", "id").select(*keys, "role", "chunks", "label", "id", "text")
            .mapInArrow(run, "a long, b long, kind int, g long, s long"))


def groups_of(classes: DataFrame, base: str) -> DataFrame:
    """member, centre: every class with the centres of its buckets."""
    spark = classes.sparkSession
    tables = [(i, j) for i in range(COLLECTIONS) for j in range(i + 1, COLLECTIONS)]
    key = F.explode(F.array(*[F.xxhash64(F.lit(k), F.col("c")[i], F.col("c")[j]) for k, (i, j) in enumerate(tables)]))
    keyed = classes.select("rep", key.alias("key"))
    shared = keyed.groupBy("key").agg(F.min("rep").alias("centre"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    # none of these tables has a size bound, so none is broadcast, at any size
    keyed.join(shared.hint("merge"), "key").write.parquet(f"{base}/buckets")
    buckets = spark.read.parquet(f"{base}/buckets")
    # a bucket whose members all have the same first centre joins that centre's group: fewer, larger groups
    first = buckets.groupBy("rep").agg(F.min("centre").alias("_first"))
    merged = (buckets.join(first.hint("merge"), "rep").groupBy("key").agg(F.min("_first").alias("_lo"), F.max("_first").alias("_hi"), F.min("centre").alias("_c"))
              .select("key", F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(F.col("_c")).alias("g")))
    return buckets.join(merged.hint("merge"), "key").select("rep", "g").distinct().filter("rep <> g")


def _dealt(member: DataFrame) -> DataFrame:
    """id, g, s, chunks, role of every member (rep, g) and of the centres, one for each chunk of their group."""
    size = member.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("rep", "g"), F.col("chunks").cast("long"))
    return (member.join(size, "g").select(F.col("rep").alias("id"), "g", chunk.alias("s"), "chunks", F.lit(1).alias("role"))
            .unionByName(size.select(F.col("g").alias("id"), "g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks").cast("long") - 1)).alias("s"),
                                     "chunks", F.lit(0).alias("role"))).withColumn("label", F.lit(0).cast("long")))


def links_of(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, base: str) -> DataFrame:
    """Confirmed links (a, b) between class representatives: forests whose components are those of all similar pairs."""
    spark = docs.sparkSession
    groups_of(classes, base).write.parquet(f"{base}/groups")
    roles = _dealt(spark.read.parquet(f"{base}/groups"))
    # one text of each row key, so that equal rows come once
    texts = (docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(row_key(id_col, text_col).alias("id"), F.col(text_col).alias("text"))
             .groupBy("id").agg(F.any_value("text").alias("text")))
    texts.join(roles.hint("merge"), "id").write.parquet(f"{base}/texts")
    placed = spark.read.parquet(f"{base}/texts")
    _compare(placed, ["g", "s"]).write.parquet(f"{base}/links")
    found = spark.read.parquet(f"{base}/links")
    links = found.filter("kind = 0").select("a", "b")
    open_ = found.filter("kind = 1").select(F.col("a").alias("id"), "g", "s")
    if open_.isEmpty():
        return links
    labels, more = _regrouped(placed, open_, base)
    return links.unionByName(more).unionByName(_across(placed, labels))


def _regrouped(placed: DataFrame, open_: DataFrame, base: str) -> tuple[DataFrame, DataFrame]:
    """(g, s, id, label of every open member; the links found): open members of a group compared under centres of their own,
    the smallest first, as long as half of them are attached to it."""
    spark = placed.sparkSession
    texts = placed.filter("role = 1 and chunks > 1").select("g", "id", "text").join(open_.select("g", "id"), ["g", "id"], "left_semi")
    texts.write.parquet(f"{base}/open-texts")
    texts = spark.read.parquet(f"{base}/open-texts")
    left, before, named, links, r = open_.select("g", "id"), None, [], [], 0
    while True:
        n = left.count()
        if not n or (before is not None and 2 * n > before):
            break
        centre = left.groupBy("g").agg(F.min("id").alias("c"))
        member = left.join(centre, "g")
        # a group's open members under their new centre; the old group stays as ``_g``
        size = member.groupBy("g", "c").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("_n"))
        dealt = (member.filter("id <> c").join(size.drop("c"), "g").select("g", "id", F.pmod(F.xxhash64("id", "c"), F.col("_n").cast("long")).alias("s"), F.lit(1).alias("role"))
                 .unionByName(size.select("g", F.col("c").alias("id"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n").cast("long") - 1)).alias("s"), F.lit(0).alias("role"))))
        (_compare(texts.join(dealt, ["g", "id"]).withColumns({"chunks": F.lit(2), "label": F.lit(0).cast("long")}), ["g", "s"]).write.parquet(f"{base}/regroup-{r}"))
        found = spark.read.parquet(f"{base}/regroup-{r}")
        links.append(found.filter("kind = 0").select("a", "b"))
        rest = found.filter("kind = 1").select("g", F.col("a").alias("id"))
        named.append(member.join(rest, ["g", "id"], "left_anti").select("g", "id", F.col("c").alias("label")))
        left, before, r = rest, n, r + 1
    named.append(left.select("g", "id", F.col("id").alias("label")))
    label, link = named[0], links[0]
    for x in named[1:]:
        label = label.unionByName(x)
    for x in links[1:]:
        link = link.unionByName(x)
    open_.join(label, ["g", "id"]).write.parquet(f"{base}/labels")
    return spark.read.parquet(f"{base}/labels"), link


def _across(placed: DataFrame, labels: DataFrame) -> DataFrame:
    """Open members against the other chunks of their group: a block of open members and a chunk at a time.  The others of a
    group are attached to its centre, which is their label."""
    blocks = labels.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("blocks"))
    members = placed.filter("role = 1 and chunks > 1").drop("label").join(labels.select("g", "s", "id", F.col("label").alias("_l")), ["g", "s", "id"], "left")
    members = members.withColumn("label", F.coalesce("_l", "g"))
    here = (members.join(blocks, "g").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))
            .select("g", "s", F.col("k").cast("long").alias("k"), F.lit(1).alias("role"), "chunks", "label", "id", "text"))
    there = (members.filter("_l is not null").join(blocks, "g")
             .withColumn("k", F.pmod(F.xxhash64("label", "id"), F.col("blocks").cast("long")))
             .withColumn("_to", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks").cast("long") - 1))).filter("_to <> s")
             .select("g", F.col("_to").cast("long").alias("s"), "k", F.lit(2).alias("role"), "chunks", "label", "id", "text"))
    return _compare(here.unionByName(there), ["g", "s", "k"]).select("a", "b")


def decided(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, k, n, component_id, kept of every row."""
    spark = docs.sparkSession
    bound_batches(spark)
    base = scratch_path(spark, f"near-dup-{uuid.uuid4().hex}")
    signatures(docs, id_col, text_col).write.parquet(f"{base}/sets")
    sets = spark.read.parquet(f"{base}/sets")
    # a class is known by the key of its first row, not by an id that other texts may share
    (sets.filter("n > 0 and id is not null").groupBy("n", "d1", "d2").agg(F.min(F.struct("id", "k")).alias("m"), F.any_value("c").alias("c"))
     .select("n", "d1", "d2", F.col("m.k").alias("rep"), F.col("m.id").alias("first"), "c").write.parquet(f"{base}/classes"))
    classes = spark.read.parquet(f"{base}/classes")
    label = components(links_of(docs, classes, id_col, text_col, base))
    (classes.join(label, classes["rep"] == label["node"], "left").select("n", "d1", "d2", "first", F.coalesce("component", "rep").alias("_c"))
     .write.parquet(f"{base}/named"))
    named = spark.read.parquet(f"{base}/named")
    smallest = named.groupBy("_c").agg(F.min("first").alias("_id"))
    named = named.join(smallest.hint("merge"), "_c").select("n", "d1", "d2", "_id")
    out = sets.drop("c").join(named.hint("merge"), ["n", "d1", "d2"], "left").withColumn("component_id", F.when(F.col("id").isNotNull(), F.coalesce("_id", "id")))
    return out.select("id", "k", "n", "component_id", F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id, kept of every row."""
    return decided(docs, id_col, text_col).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "kept")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group (its smallest id), with the columns they came with."""
    gone = decided(docs, id_col, text_col).filter("not kept").select(F.col("k").alias("_k")).distinct()
    key = row_key(id_col, text_col)
    return docs.join(gone, key == gone["_k"], "left_anti").select(*[docs[f"`{c}`"] for c in docs.columns])
