"""Repeated passages by bucketed suffix arrays and longest-previous-factor (LPF) arrays.

A byte string of ``LENGTH`` bytes that occurs twice has the same *anchor* in both places: the
smallest hash among its ``SEED``-byte substrings (leftmost of equals).  So all string
starts that share an anchor form a run, and runs bucketed by their anchor's hash
hold every pair of equal strings in one bucket.

1. One scan gives the runs; anchors that occur once cannot repeat and leave at once.
2. Runs whose whole block of bytes occurs again repeat as a whole.  One
   representative (the first in order) of every different block goes on.
3. The blocks of a bucket are put in suffix order (prefix doubling up to ``LENGTH``).  For
   every string start, the previous and the next *smaller position* in suffix order
   give the longest earlier match: LPF = the larger of the two common prefixes.  The
   mirrored arrays (greater positions) give later matches.
4. Buckets beyond ``BUCKET_BYTES`` (a very common line in different surroundings) are
   not sorted in one task: their strings are grouped by hash over the cluster,
   and the group's first position takes the place of the smaller position.

Positions are ordered by id, then by place in the text.  ``earlier`` spans cover the bytes of strings
that occur before, so cutting them keeps the first copy; ``repeated`` spans cover the
bytes of strings that occur anywhere else.

Defined results: a null text is an empty one; texts shorter than ``LENGTH`` bytes have
no spans; spans never cross documents; equal rows (same id and text) are copies of
each other for ``repeated``, and share one place in the order; an empty table gives no rows;
other columns are ignored (``cut_repeats`` passes them on).
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from . import textvec as tv

LENGTH = 200
SEED = 32
SLICE = 2 << 20                 # a longer text is scanned in slices that overlap by LENGTH - 1
BUCKET_BYTES = 4 << 20          # blocks of one anchor that one task may put in suffix order
SORT_BYTES = 1 << 19            # bytes sorted at once where buckets are small
POS_BITS = 23
KEY = ("_id", "_k")


def _anchors(data: np.ndarray, prefix: np.ndarray, off: np.ndarray, length: int):
    """(first start, number of starts, anchor) of every run; starts whose string crosses a row do not count."""
    n, w = len(data), length - SEED + 1
    z = np.zeros(0, np.int64)
    if n < length:
        return z, z, z
    at = np.arange(n - SEED + 1)
    h = tv.span_hash(prefix, at, at + SEED)
    low = (h >> np.uint64(POS_BITS) << np.uint64(POS_BITS)) | at.astype(np.uint64)      # hash first, then position
    size = 1
    while size * 2 <= w:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < w:
        low = np.minimum(low[:len(low) - (w - size)], low[w - size:])
    anchor = (low & np.uint64((1 << POS_BITS) - 1)).astype(np.int64)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    s = np.flatnonzero(row[:n - length + 1] == row[length - 1:])
    if not len(s):
        return z, z, z
    a = anchor[s]
    new = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (s[1:] != s[:-1] + 1))))
    return s[new], np.diff(np.append(new, len(s))), a[new]


def _slices(data: np.ndarray, off: np.ndarray, length: int):
    """(bytes, offsets, row, start within the row) of pieces that hold every string once."""
    if len(data) <= 2 * SLICE:
        yield data, off, np.arange(len(off) - 1), np.zeros(len(off) - 1, np.int64)
        return
    for r in range(len(off) - 1):                           # only a single long text gets here
        for a in range(int(off[r]), int(off[r + 1]), SLICE):
            part = data[a:min(int(off[r + 1]), a + SLICE + length - 1)]
            yield part, np.array([0, len(part)]), np.array([r]), np.array([a - off[r]])


def runs(rows: DataFrame, length: int) -> DataFrame:
    """a (anchor hash), b (block hash), _id, _k, s (first start), n (starts) of every run."""

    def scan(batches):
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            for lo, hi, data, off in tv.chunks(batch.column(2)):
                for part, po, row, base in _slices(data, off, length):
                    p = tv.prefix_hash(part)
                    s, n, anchor = _anchors(part, p, po, length)
                    if not len(s):
                        continue
                    r = tv.rows_of(po, s)
                    block = tv.span_hash(p, s, s + n - 1 + length)
                    with np.errstate(over="ignore"):
                        block = tv.mix(block + (anchor - s).astype(np.uint64))
                    take = pa.array(row[r])
                    yield pa.record_batch([pa.array(tv.span_hash(p, anchor, anchor + SEED).view(np.int64)), pa.array(block.view(np.int64)),
                                           ids.slice(lo, hi - lo).take(take), keys.slice(lo, hi - lo).take(take),
                                           pa.array(s - po[r] + base[r]), pa.array(n.astype(np.int32))], names=["a", "b", "_id", "_k", "s", "n"])

    return rows.mapInArrow(scan, "a long, b long, _id long, _k long, s long, n int")


# ----------------------------------------------------------------- suffix order
class SuffixOrder:
    """Suffix order, up to ``length`` bytes, of the string starts of some blocks."""

    def __init__(self, blocks: list[bytes], starts: np.ndarray, length: int):
        sizes = np.array([len(b) for b in blocks], np.int64)
        base = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        self.data = np.frombuffer(b"".join(blocks) + bytes(8), np.uint8)
        self.length = length
        n = len(self.data) - 8
        v = np.zeros(n, np.uint64)
        for j in range(8):
            v = v << np.uint64(8) | self.data[j:n + j].astype(np.uint64)
        self.rank = {8: self._rank(v)}
        size = 8
        while size * 2 <= length:
            r = self.rank[size]
            key = r[:-size].astype(np.uint64) << np.uint64(32) | r[size:].astype(np.uint64)
            full = np.full(n, 0, np.uint32)
            full[:len(key)] = self._rank(key)
            size *= 2
            self.rank[size] = full
        # every start of every block, in text order
        self.block = np.repeat(np.arange(len(blocks)), starts)
        self.inner = np.arange(len(self.block)) - np.repeat(np.cumsum(starts) - starts, starts)
        self.at = base[self.block] + self.inner
        r = self.rank[size]
        self.full = r[self.at].astype(np.uint64) << np.uint64(32) | r[self.at + length - size].astype(np.uint64)

    @staticmethod
    def _rank(key: np.ndarray) -> np.ndarray:
        return np.unique(key, return_inverse=True)[1].astype(np.uint32)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the strings at starts i and j (at most ``length``)."""
        a, b = self.at[i], self.at[j]
        got = np.zeros(len(i), np.int64)
        for size in sorted(self.rank, reverse=True):
            for _ in range(self.length // size if size == max(self.rank) else 1):
                fits = got + size <= self.length
                same = fits & (self.rank[size][np.where(fits, a + got, a)] == self.rank[size][np.where(fits, b + got, b)])
                got += size * same
        for _ in range(7):
            more = got < self.length
            got += more & (self.data[np.where(more, a + got, a)] == self.data[np.where(more, b + got, b)])
        return got


def nearest_smaller(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the previous and of the next smaller value of every element (-1, len(x): none).

    All elements follow their neighbours' pointers at once; the distance at least doubles where values rise
    towards the left, so few rounds are needed.
    """
    def previous(v):
        p = np.arange(len(v)) - 1
        todo = np.flatnonzero((p >= 0) & (v[p] >= v))
        while len(todo):
            p[todo] = p[p[todo]]
            q = p[todo]
            todo = todo[(q >= 0) & (v[np.maximum(q, 0)] >= v[todo])]
        return p

    back = previous(x[::-1])
    return previous(x), len(x) - 1 - back[::-1]


def longest_factors(order: SuffixOrder, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(longest earlier factor, longest later factor) of every start, at most ``length`` bytes.

    ``position`` numbers the starts in text order.
    """
    sa = np.lexsort((position, order.full))
    pos = position[sa]

    def factor(value):
        before, after = nearest_smaller(value)
        out = np.zeros(len(sa), np.int64)
        for near in (before, after):
            ok = np.flatnonzero((near >= 0) & (near < len(sa)))
            out[ok] = np.maximum(out[ok], order.common(sa[ok], sa[near[ok]]))
        return out

    lpf, lnf = np.empty(len(sa), np.int64), np.empty(len(sa), np.int64)
    lpf[sa], lnf[sa] = factor(pos), factor(-pos)
    return lpf, lnf


def _flag_runs(block: np.ndarray, inner: np.ndarray, flag: np.ndarray):
    """(block, first start, number) of the maximal runs of flagged starts."""
    k = np.flatnonzero(flag)
    if not len(k):
        return [], [], []
    new = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1] + 1) | (block[k[1:]] != block[k[:-1]]))))
    return block[k[new]].tolist(), inner[k[new]].tolist(), np.diff(np.append(new, len(k))).tolist()


def _sorted_buckets(blocks: DataFrame, length: int) -> DataFrame:
    """_k, s, n, earlier: runs of starts that repeat within their bucket."""

    def sort_some(t: pa.Table):
        n = t["n"].to_numpy().astype(np.int64)
        order = SuffixOrder(t["bytes"].to_pylist(), n, length)
        ids, keys, s = t["_id"].to_numpy(), t["_k"].to_numpy(), t["s"].to_numpy()
        place = np.lexsort((order.inner + s[order.block], keys[order.block], ids[order.block]))
        position = np.empty(len(place), np.int64)
        position[place] = np.arange(len(place))
        lpf, lnf = longest_factors(order, position)
        out = []
        for earlier, flag in ((True, lpf >= length), (False, (lpf >= length) | (lnf >= length))):
            b, i, c = _flag_runs(order.block, order.inner, flag)
            out += [(int(keys[x]), int(s[x]) + y, z, earlier) for x, y, z in zip(b, i, c)]
        return out

    def run(batches):
        for t in _whole_buckets(batches):
            got = sort_some(t)
            if got:
                k, s, n, e = zip(*got)
                yield pa.record_batch([pa.array(k, pa.int64()), pa.array(s, pa.int64()), pa.array(n, pa.int32()), pa.array(e, pa.bool_())],
                                      names=["_k", "s", "n", "earlier"])

    return (blocks.repartition("a").sortWithinPartitions("a").select("a", "_id", "_k", "s", "n", "bytes")
            .mapInArrow(run, "_k long, s long, n int, earlier boolean"))


def _whole_buckets(batches):
    """Tables of whole buckets, together about SORT_BYTES."""
    held, size = [], 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            part = pa.Table.from_batches([batch.slice(lo, 1024)])
            held.append(part)
            size += part["bytes"].nbytes
            if size >= SORT_BYTES:
                t = pa.concat_tables(held).combine_chunks()
                a = t["a"].to_numpy()
                end = int(np.searchsorted(a, a[-1], "left"))            # the last bucket may go on
                if end:
                    yield t.slice(0, end)
                held = [t.slice(end)]
                size = held[0]["bytes"].nbytes
    if held:
        t = pa.concat_tables(held).combine_chunks()
        if t.num_rows:
            yield t


def _grouped_buckets(blocks: DataFrame, length: int) -> DataFrame:
    """The same for buckets with many blocks: their strings are grouped by hash over the cluster."""

    def strings(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                t = batch.slice(i, 256)
                raw, off = tv.buffers(t.column("bytes"))
                data, off = raw[off[0]:off[-1]], off - off[0]
                n = t.column("n").to_numpy().astype(np.int64)
                block = np.repeat(np.arange(len(n)), n)
                inner = np.arange(len(block)) - np.repeat(np.cumsum(n) - n, n)
                at = off[block] + inner
                w = tv.span_hash(tv.prefix_hash(data), at, at + length)
                pick = pa.array(block)
                yield pa.record_batch([pa.array(w.view(np.int64)), t.column("_id").take(pick), t.column("_k").take(pick),
                                       pa.array(t.column("s").to_numpy()[block] + inner), t.column("many").take(pick)],
                                      names=["w", "_id", "_k", "s", "many"])

    each = (blocks.select("_id", "_k", "s", "n", "bytes", "many").mapInArrow(strings, "w long, _id long, _k long, s long, many boolean"))
    groups = (each.groupBy("w").agg(F.count(F.lit(1)).alias("c"), F.max("many").alias("m"), F.min(F.struct("_id", "_k", "s")).alias("first"))
              .filter("c > 1").select("w", "first"))
    hit = each.join(groups, "w")
    return hit.select("_k", "s", F.lit(1).cast("int").alias("n"),
                      F.explode(F.when(F.struct("_id", "_k", "s") == F.col("first"), F.array(F.lit(False)))
                                .otherwise(F.array(F.lit(False), F.lit(True)))).alias("earlier"))


# --------------------------------------------------------------------- operator
def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    t = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    return t.select("_id", F.xxhash64("_id", "_t").alias("_k"), "_t")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """_k (document key), s, n, earlier: runs of starts whose strings occur elsewhere (earlier false) or before
    (earlier true).  Written to the shared folder."""
    spark = docs.sparkSession
    base = scratch_path(spark, f"suffix-{uuid.uuid4().hex}")
    rows = _keyed(docs, id_col, text_col)
    # kept, so that the texts are scanned once
    runs(rows.filter(F.octet_length("_t") >= length), length).write.parquet(f"{base}/all-runs")
    all_runs = spark.read.parquet(f"{base}/all-runs")
    # anchors that occur once leave here
    all_runs.select("a").groupBy("a").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select("a").write.parquet(f"{base}/anchors")
    # read back, so that both sides of the join are plain exchanges and a very frequent anchor is split over tasks
    shared = spark.read.parquet(f"{base}/anchors")
    all_runs.join(shared.hint("merge"), "a").write.parquet(f"{base}/runs")
    left = spark.read.parquet(f"{base}/runs")
    blocks = left.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("_id", "_k", "s", "n")).alias("first"))
    blocks.write.parquet(f"{base}/blocks")
    blocks = spark.read.parquet(f"{base}/blocks")
    # whole blocks that occur again
    twice = left.join(blocks.filter("c > 1").select("a", "b", "first"), ["a", "b"])
    whole = twice.select("_k", "s", "n", F.explode(F.when(F.struct("_id", "_k", "s", "n") == F.col("first"), F.array(F.lit(False)))
                                                  .otherwise(F.array(F.lit(False), F.lit(True)))).alias("earlier"))
    # buckets with different blocks: their representatives' bytes
    sizes = (blocks.groupBy("a").agg(F.count(F.lit(1)).alias("_m"), F.sum(F.col("first.n") + (length - 1)).alias("m"))
             .filter("_m > 1").drop("_m"))                              # m: bytes of the bucket
    reps = (blocks.join(sizes, "a").select(F.col("first._k").alias("_k"), F.struct("a", F.col("first._id").alias("_id"), F.col("first.s").alias("s"),
                                                                                F.col("first.n").alias("n"), (F.col("c") > 1).alias("many"), "m").alias("r"))
            .groupBy("_k").agg(F.collect_list("r").alias("r")))         # at most one entry per run of the document

    def cut(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py().encode()
                r = batch.column(2).slice(i, 1).flatten()
                s, n = r.field("s").to_numpy(), r.field("n").to_numpy()
                out = [text[x:x + y - 1 + length] for x, y in zip(s.tolist(), n.tolist())]
                yield pa.record_batch([r.field("a"), r.field("_id"), pa.array(np.full(len(s), keys[i])), r.field("s"), r.field("n"), r.field("many"),
                                       r.field("m"), pa.array(out, pa.binary())], names=["a", "_id", "_k", "s", "n", "many", "m", "bytes"])

    texts = rows.select("_k", "_t").filter(F.octet_length("_t") >= length)
    found = texts.join(reps, "_k").select("_k", "_t", "r").mapInArrow(
        cut, "a long, _id long, _k long, s long, n int, many boolean, m long, bytes binary").dropDuplicates(["a", "_k", "s"])
    found.write.parquet(f"{base}/bytes")
    found = spark.read.parquet(f"{base}/bytes")
    parts = whole.unionByName(_sorted_buckets(found.filter(F.col("m") <= BUCKET_BYTES), length)) \
        .unionByName(_grouped_buckets(found.filter(F.col("m") > BUCKET_BYTES), length))
    parts.write.parquet(f"{base}/repeated")
    return spark.read.parquet(f"{base}/repeated")


def _merge(s: np.ndarray, n: np.ndarray, length: int):
    """Byte spans (starts, ends) that runs of starts cover; touching spans become one."""
    if not len(s):
        return s, s
    o = np.argsort(s, kind="stable")
    a, b = s[o], np.maximum.accumulate((s + n - 1 + length)[o])
    new = np.concatenate(([True], a[1:] > b[:-1]))
    return a[new], b[np.append(np.flatnonzero(new)[1:] - 1, len(a) - 1)]


def _with_runs(docs: DataFrame, id_col: str, text_col: str, length: int, earlier: bool) -> DataFrame:
    """_doc (the row as it came), _t, _k and _runs (null where nothing repeats)."""
    found = (repeated_runs(docs, id_col, text_col, length).filter(F.col("earlier") == earlier)
             .groupBy("_k").agg(F.collect_list(F.struct("s", "n")).alias("_runs")))       # at most one entry per start of the document
    key = F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")))
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    return docs.select(F.struct(*others).alias("_doc"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"), key.alias("_k")).join(found, "_k", "left")


def _cut_rows(batch, length: int):
    """(kept bytes, span starts, span ends, size) of every row of (_t, _runs)."""
    texts, all_runs = batch
    for i in range(len(texts)):
        text = texts[i].as_py().encode()
        r = all_runs.slice(i, 1).flatten()
        a, b = _merge(r.field("s").to_numpy().astype(np.int64), r.field("n").to_numpy().astype(np.int64), length)
        at, kept = 0, []
        for x, y in zip(a.tolist(), b.tolist()):
            kept.append(text[at:x])
            at = y
        kept.append(text[at:])
        yield b"".join(kept), a, b, len(text)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, earlier: bool = False) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""

    def digest(texts: pa.Array, runs_: pa.Array) -> pa.Array:
        removed, spans, sha = [], [], []
        for kept, a, b, size in _cut_rows((texts, runs_), length):
            removed.append(int((b - a).sum())); spans.append(len(a)); sha.append(hashlib.sha256(kept).hexdigest())
        return pa.StructArray.from_arrays([pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string())], ["n_removed", "n_spans", "kept_sha256"])

    f = F.arrow_udf(digest, "n_removed long, n_spans long, kept_sha256 string")
    cut = F.when(F.col("_runs").isNotNull(), f("_t", "_runs"))
    return (_with_runs(docs.select(id_col, text_col), id_col, text_col, length, earlier).withColumn("_d", cut)
            .select(F.col(f"_doc.{id_col}").alias(id_col), F.octet_length("_t").cast("long").alias("n_bytes"), F.coalesce("_d.n_removed", F.lit(0).cast("long")).alias("n_removed"),
                    F.coalesce("_d.n_spans", F.lit(0).cast("long")).alias("n_spans"),
                    F.coalesce("_d.kept_sha256", F.sha2(F.col("_t").cast("binary"), 256)).alias("kept_sha256")))


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep_first: bool = True) -> DataFrame:
    """``docs`` with later copies (or all copies) cut out of the text, and the cut spans.

    Spans are bytes; half characters that a cut leaves behind are dropped from the text.
    """
    def cut(texts: pa.Array, runs_: pa.Array) -> pa.Array:
        out, spans = [], []
        for kept, a, b, _ in _cut_rows((texts, runs_), length):
            out.append(kept.decode("utf-8", "ignore")); spans.append([{"start": int(x), "end": int(y)} for x, y in zip(a, b)])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.StructArray.from_arrays([pa.array(out, pa.string()), pa.array(spans, kind)], ["text", "spans"])

    f = F.arrow_udf(cut, "text string, spans array<struct<start:long,end:long>>")
    d = _with_runs(docs, id_col, text_col, length, keep_first).withColumn("_d", F.when(F.col("_runs").isNotNull(), f("_t", "_runs")))
    columns = [F.coalesce("_d.text", "_t").alias(c) if c == text_col else F.col(f"_doc.`{c}`").alias(c) for c in docs.columns]
    return d.select(*columns, F.coalesce("_d.spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("cut_spans"))
