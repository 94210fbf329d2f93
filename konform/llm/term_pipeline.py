"""Ranked lexical search by pipelined term partitioning.

Every document is ranked for every item of a query table.  The terms of the items are dealt to
``STAGES`` owners, the weightiest terms first, each owner with about the same number of
postings.  Bundles of items then travel from owner to owner: a bundle carries one sparse
accumulator - (item, document, score so far) - per segment of documents; at each owner it is
cogrouped with that owner's postings of the segment, adds their integer contributions and
goes on.  What is left after the last owner is ranked.

Accumulators that cannot reach an item's final list are put down on the way, by a bound that
loses nothing: a document stays while its score plus the most that later owners can add reaches
the ``k``-th best score so far, in its segment or (between stages) overall.  Ties stay.

The work grows with documents x items that share a term.  A task holds one segment (``SEGMENT_BYTES`` of
text or one longer text) for one bundle.  Items are read in blocks of ``BLOCK_ITEMS`` and
``BLOCK_BYTES`` of text (one longer text is a block), so what is sent to the tasks - a block's terms, owners and
weights - is bounded; each block scans the documents once.

Scores: with N documents that hold a term, L terms in all, n in the document, df documents holding the term and tf
occurrences, a term adds ``w * ((10**9 * tf) div (1000 * tf + 20 * m))`` where ``w = floor(1000 ln((2N+2)/(2df+1)))``
and ``m = 50 + (50 * n * N) div L``.

Defined results: terms are the maximal runs of letters and digits, every character above 127 included, only A-Z
lower-cased; null or empty texts hold none; an item counts each of its terms once; rows that share an id (items or
documents) are ranked separately, equal documents with consecutive ranks; documents without an id come last among
equal scores; items without a match, empty items and empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import scratch_path
from . import textvec as tv

STAGES = 4
SEGMENT_BYTES, SEGMENT_DOCS = 2 << 20, 4096
BUNDLE_ITEMS = 256
BLOCK_ITEMS, BLOCK_BYTES = 4096, 4 << 20
_GAPS = ~tv.byte_table(bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]))
SEGMENTS = "seg long, n_docs long, n_terms long, ids binary, has binary, n binary, terms binary, counts binary, docs binary, tf binary"
CARRIED = "bundle int, seg long, items binary, docs binary, scores binary"


def words_of(data: np.ndarray, off: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(terms in order, row of each) of a chunk of texts."""
    low = tv.LOWER[data]
    s, e, row = tv.word_spans(low, off, _GAPS)
    bounds = np.concatenate(([0], np.cumsum(e - s))).astype(np.int64)
    kept = np.ascontiguousarray(low[~_GAPS[low]])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(s), [None, pa.py_buffer(bounds), pa.py_buffer(kept)]), row


def contribution(tf, m):
    """What a term adds per unit of weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def length_factor(n, docs: int, terms: int):
    return 100 - 50 + (50 * n * docs) // max(terms, 1)


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


class Block:
    """A bounded run of items: their terms, and which items of which bundle hold each."""

    def __init__(self, texts: list[str | None]):
        col = pa.array([t or "" for t in texts], pa.large_string())
        found, rows = [pa.array([], pa.large_binary())], [np.zeros(0, np.int64)]
        for lo, _, data, off in tv.chunks(col):
            w, r = words_of(data, off)
            found.append(w)
            rows.append(r + lo)
        coded = pc.dictionary_encode(pa.concat_arrays(found))
        self.vocabulary, self.size = coded.dictionary, len(texts)
        pairs = np.unique(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * max(self.size, 1) + np.concatenate(rows))
        self.term, self.item = pairs // max(self.size, 1), pairs % max(self.size, 1)
        self.bundles = -(-self.size // BUNDLE_ITEMS)

    def by_bundle(self, owner: np.ndarray, stage: int) -> list[dict[int, np.ndarray]]:
        """For each bundle, the items (within it) of every term of one owner."""
        out: list[dict[int, np.ndarray]] = [{} for _ in range(self.bundles)]
        mine = owner[self.term] == stage
        term, item = self.term[mine], self.item[mine]
        key = term * self.bundles + item // BUNDLE_ITEMS
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.diff(key[order], prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(order)]):
            t, k = divmod(int(key[order[a]]), self.bundles)
            out[k][t] = item[order[a:b]] % BUNDLE_ITEMS
        return out


def segments_of(docs: DataFrame, vocabulary: pa.Array, id_col: str, text_col: str) -> DataFrame:
    """The postings of the given terms, one row per segment of documents."""

    def scan(batches):
        place, size = TaskContext.get().partitionId() << 32, len(vocabulary)
        for batch in batches:
            for first in range(0, batch.num_rows, SEGMENT_DOCS):
                part = batch.slice(first, SEGMENT_DOCS)
                for lo, hi, data, off in tv.chunks(part.column(1), SEGMENT_BYTES):
                    words, row = words_of(data, off)
                    n = np.bincount(row, minlength=hi - lo)
                    term = pc.index_in(words, value_set=vocabulary)
                    here = pc.is_valid(term).to_numpy(zero_copy_only=False)
                    key, tf = np.unique(term.drop_null().to_numpy().astype(np.int64) * SEGMENT_DOCS + row[here], return_counts=True)
                    terms, counts = np.unique(key // SEGMENT_DOCS, return_counts=True)
                    ids = part.column(0).slice(lo, hi - lo)
                    yield pa.record_batch(
                        [pa.array([place], pa.int64()), pa.array([int((n > 0).sum())], pa.int64()), pa.array([int(n.sum())], pa.int64()),
                         *(pa.array([x.tobytes()], pa.binary()) for x in (
                             ids.fill_null(0).to_numpy().astype("<i8"), ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8), n.astype("<u4"),
                             terms.astype("<u4"), counts.astype("<u4"), (key % SEGMENT_DOCS).astype("<u2"), tf.astype("<u4")))],
                        names=["seg", "n_docs", "n_terms", "ids", "has", "n", "terms", "counts", "docs", "tf"])
                    place += 1
        assert size < 1 << 32

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(scan, SEGMENTS)


def _array(value, dtype: str) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), dtype)


def _term_totals(segments: DataFrame, size: int, n_docs: int, n_terms: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents holding each term, the most it adds anywhere per unit of weight)."""

    def scan(batches):
        df, most = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            for n, terms, counts, docs, tf in zip(*batch.columns):
                m = length_factor(_array(n, "<u4").astype(np.int64), n_docs, n_terms)
                t, c = _array(terms, "<u4"), _array(counts, "<u4").astype(np.int64)
                if len(t):
                    df[t] += c
                    unit = contribution(_array(tf, "<u4").astype(np.int64), m[_array(docs, "<u2")])
                    most[t] = np.maximum(most[t], np.maximum.reduceat(unit, np.cumsum(c) - c))
        some = np.flatnonzero(df)
        yield pa.record_batch([pa.array(some), pa.array(df[some]), pa.array(most[some])], names=["term", "df", "most"])

    rows = (segments.select("n", "terms", "counts", "docs", "tf").mapInArrow(scan, "term long, df long, most long")
            .groupBy("term").agg(F.sum("df").alias("df"), F.max("most").alias("most")).toPandas())      # at most a block's terms
    df, most = np.zeros(size, np.int64), np.zeros(size, np.int64)
    df[rows["term"]], most[rows["term"]] = rows["df"], rows["most"]
    return df, most


def _deal(segments: DataFrame, items_of: list[dict[int, np.ndarray]], last: bool) -> DataFrame:
    """One owner's postings: a row per segment and bundle, with the document ids at the last owner."""
    held = [np.array(sorted(b), np.int64) for b in items_of]

    def scan(batches):
        for batch in batches:
            for seg, ids, has, n, terms, counts, docs, tf in zip(*batch.columns):
                t, c = _array(terms, "<u4"), _array(counts, "<u4").astype(np.int64)
                d, f = _array(docs, "<u2"), _array(tf, "<u4")
                for k, own in enumerate(held):
                    mine = np.isin(t, own)
                    if not mine.any() and not last:
                        continue
                    at = np.repeat(mine, c)
                    yield pa.record_batch(
                        [pa.array([k], pa.int32()), pa.array([seg.as_py()], pa.int64()), pa.array([ids.as_py() if last else None], pa.binary()),
                         pa.array([has.as_py() if last else None], pa.binary()), pa.array([n.as_py()], pa.binary()),
                         *(pa.array([x.tobytes()], pa.binary()) for x in (t[mine], c[mine].astype("<u4"), d[at], f[at]))],
                        names=["bundle", "seg", "ids", "has", "n", "terms", "counts", "docs", "tf"])

    return (segments.select("seg", "ids", "has", "n", "terms", "counts", "docs", "tf")
            .mapInArrow(scan, "bundle int, seg long, ids binary, has binary, n binary, terms binary, counts binary, docs binary, tf binary"))


def _visit(carried: DataFrame, postings: DataFrame, items_of, weights, later, least, n_docs: int, n_terms: int, k: int, last: bool) -> DataFrame:
    """Bundles at one owner: add its contributions, put down what cannot reach the list any more."""

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        bundle = (left if left.num_rows else right)["bundle"][0].as_py()
        seg = (left if left.num_rows else right)["seg"][0].as_py()
        docs = np.zeros(0, np.int64)
        if right.num_rows:
            n = _array(right["n"][0], "<u4").astype(np.int64)
        sums = np.zeros((BUNDLE_ITEMS, len(n) if right.num_rows else SEGMENT_DOCS), np.int64)
        if left.num_rows:
            sums[_array(left["items"][0], "<u2"), _array(left["docs"][0], "<u2")] = _array(left["scores"][0], "<i8")
        if right.num_rows:
            m = length_factor(n, n_docs, n_terms)
            docs, tf = _array(right["docs"][0], "<u2").astype(np.int64), _array(right["tf"][0], "<u4").astype(np.int64)
            unit = contribution(tf, m[docs])
            at = 0
            for t, c in zip(_array(right["terms"][0], "<u4").tolist(), _array(right["counts"][0], "<u4").tolist()):
                gain, where = weights[t] * unit[at:at + c], docs[at:at + c]
                at += c
                for i in items_of[bundle][t].tolist():
                    sums[i, where] += gain
        lo = bundle * BUNDLE_ITEMS
        more, need = later[lo:lo + BUNDLE_ITEMS], least[lo:lo + BUNDLE_ITEMS].copy()
        if sums.shape[1] >= k:
            need = np.maximum(need, np.partition(sums, sums.shape[1] - k, axis=1)[:len(need), sums.shape[1] - k])
        rest = sums[:len(need)]
        items, at = np.nonzero((rest > 0) & (rest + more[:, None] >= need[:, None]))
        scores = rest[items, at]
        if last:
            ids = pa.array(_array(right["ids"][0], "<i8")[at], mask=_array(right["has"][0], np.uint8)[at] == 0)
            return pa.table([pa.array(items + lo, pa.int32()), ids, pa.array(scores)], names=["item", "doc", "score"])
        some = len(items) > 0
        return pa.table([pa.array([bundle][:some], pa.int32()), pa.array([seg][:some], pa.int64()),
                         *(pa.array([x.tobytes()][:some], pa.binary()) for x in (items.astype("<u2"), at.astype("<u2"), scores.astype("<i8")))],
                        names=["bundle", "seg", "items", "docs", "scores"])

    return (carried.groupBy("bundle", "seg").cogroup(postings.groupBy("bundle", "seg"))
            .applyInArrow(add, "item int, doc long, score long" if last else CARRIED))


def _kth(carried: DataFrame, least: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score so far of each item (what it was, where fewer are carried)."""

    def scan(batches):
        for batch in batches:
            for bundle, items, scores in zip(*batch.columns):
                i, s = _array(items, "<u2").astype(np.int64) + bundle.as_py() * BUNDLE_ITEMS, _array(scores, "<i8")
                order = np.lexsort((-s, i))
                i, s = i[order], s[order]
                first = np.searchsorted(i, i, "left")
                keep = (np.arange(len(i)) - first < k) & (s >= least[i])
                yield pa.record_batch([pa.array(i[keep], pa.int32()), pa.array(s[keep])], names=["item", "score"])

    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
    rows = (carried.select("bundle", "items", "scores").mapInArrow(scan, "item int, score long")
            .withColumn("_r", rank).filter(F.col("_r") <= k).filter(F.col("_r") == k).select("item", "score").collect())   # a row per item of the block
    out = least.copy()
    for r in rows:
        out[r["item"]] = max(out[r["item"]], r["score"])
    return out


def _blocks(items: DataFrame, id_col: str, text_col: str):
    ids, texts, size = [], [], 0
    for r in items.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        more = len((r["t"] or "").encode())
        if ids and (len(ids) == BLOCK_ITEMS or size + more > BLOCK_BYTES):
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(r["i"])
        texts.append(r["t"])
        size += more
    if ids:
        yield ids, texts


def _search_block(docs: DataFrame, ids: list, texts: list, id_type: T.DataType, base: str, k: int, doc_id: str, doc_text: str) -> None:
    """Ranks of one block of items, written below ``base``."""
    spark, block = docs.sparkSession, Block(texts)
    segments_of(docs, block.vocabulary, doc_id, doc_text).write.parquet(f"{base}/segments")
    segments = spark.read.parquet(f"{base}/segments")
    n_docs, n_terms = (int(x or 0) for x in segments.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    df, most = _term_totals(segments, len(block.vocabulary), n_docs, n_terms)
    weights = np.array([weight(n_docs, int(x)) if x else 0 for x in df], np.int64)
    # the weightiest terms first, about as many postings for each owner
    order = np.lexsort((df, -weights))
    owner = np.zeros(len(df), np.int64)
    owner[order] = np.minimum((np.cumsum(df[order]) - df[order]) * STAGES // max(int(df.sum()), 1), STAGES - 1)
    least = np.zeros(block.size, np.int64)
    carried = spark.createDataFrame([], CARRIED)
    for stage in range(STAGES):
        last = stage == STAGES - 1
        after = owner[block.term] > stage
        later = np.zeros(block.size, np.int64)
        np.add.at(later, block.item[after], (weights * most)[block.term[after]])
        items_of = block.by_bundle(owner, stage)
        now = _visit(carried, _deal(segments, items_of, last), items_of, weights, later, least, n_docs, n_terms, k, last)
        if not last:
            now.write.parquet(f"{base}/{stage}")
            carried = spark.read.schema(CARRIED).parquet(f"{base}/{stage}")
            least = _kth(carried, least, k)
    names = spark.createDataFrame(list(enumerate(ids)), T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", id_type)]))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc")))
    (now.withColumn("rank", rank).filter(F.col("rank") <= k).join(F.broadcast(names), "item")       # names: at most BLOCK_ITEMS rows
     .select("item_id", F.col("rank").cast("int").alias("rank"), F.col("doc").alias("doc_id"), "score").write.parquet(f"{base}/ranked"))


def search(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", doc_text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``k`` best documents with a score above 0."""
    spark = docs.sparkSession
    base = scratch_path(spark, f"term-pipeline-{uuid.uuid4().hex}")
    id_type = items.select(item_id).schema[0].dataType
    schema = T.StructType([T.StructField("item_id", id_type), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()),
                           T.StructField("score", T.LongType())])
    paths = []
    for b, (ids, texts) in enumerate(_blocks(items, item_id, item_text)):
        _search_block(docs, ids, texts, id_type, f"{base}/{b}", k, doc_id, doc_text)
        paths.append(f"{base}/{b}/ranked")
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
