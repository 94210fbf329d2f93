"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Test items are cut into passages of at most ``PASSAGE`` words (overlapping by
half), and the runs of ``SEED`` words of a passage are its seeds.  An alignment counts if enough of its
columns are equal words (``identity``) and enough of the passage takes part (``coverage``); with so many equal
words and so few others, some number of runs is *certain* to be intact in every alignment that counts
(at least one).  A first scan counts the documents that hold each seed; all but one of that number may be left
out, and the most frequent ones are: the rare seeds that stay lose no alignment that counts.  A second scan joins every run
of words of a document to them, and wherever one meets, the passage is aligned with its surroundings word by word
(Smith-Waterman), which finds edited and paraphrased copies.

Items are joined in blocks of at most ``BLOCK_WORDS`` words: one block is what a task
holds in memory, whatever the size of the benchmark; each further block is a further
scan, for the filter too.  Documents are never shuffled by ``find``; the filter takes out the flagged texts by their hashes.  Long texts are
read in slices of ``SLICE_WORDS`` words that overlap by more than an alignment can span, and a seed that a passage repeats
is met once with the range of its places, so the meetings held at once stay below ``PAIRS`` or those of one passage with one slice.

Defined results: words are lower-case runs of letters and digits; null or empty
texts and items match nothing; an item of fewer than ``SEED`` words matches only as a
whole sequence; of several alignments of one item in a document the best is
reported, ties to the earlier place; repeated rows are reported each; other
columns are ignored (``keep_clean`` passes them on).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bound_batches, scratch_path
from . import textvec as tv

SEED = 3
PASSAGE = 200
BLOCK_WORDS = 1_000_000
IDENTITY = 0.75
COVERAGE = 0.5
LEAST_WORDS = 8
PAIRS = 4_000_000               # meetings of a word run and a seed held at once
SLICE_WORDS = 20_000            # words of one text handled at once
MATCH, MISMATCH, GAP = 2, -1, -1
SEPARATORS = ~tv.byte_table(bytes([*range(48, 58), *range(97, 123), *range(128, 256)]))


def _run_hashes(wh: np.ndarray, row: np.ndarray, n: int):
    """(hash, index of first word) of every run of n words within a row."""
    m = len(wh) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        acc = np.zeros(m, np.uint64)
        for j in range(n):
            acc += wh[j:j + m] * tv._C[j]
        at = np.flatnonzero(row[:m] == row[n - 1:])
        return tv.mix(acc[at] + np.uint64(n)), at


def words_of(data: np.ndarray, off: np.ndarray):
    """(hash, start, end, row) of the words of every row."""
    s, e, row = tv.word_spans(data, off, SEPARATORS)
    return tv.span_hash(tv.prefix_hash(data), s, e), s, e, row


@dataclass
class Index:
    """Passages of one block of items and where their seeds stand."""

    item: np.ndarray                # passage -> item
    words: list[np.ndarray]         # passage -> word hashes
    hashes: np.ndarray              # seed hashes, sorted (one row per passage and hash)
    passage: np.ndarray             # seed -> passage
    first: np.ndarray               # seed -> its first place within the passage
    last: np.ndarray                # seed -> its last place
    times: np.ndarray               # seed -> number of places
    lengths: tuple[int, ...]        # run lengths in use
    certain: np.ndarray             # passage -> seeds that every alignment that counts holds
    least: np.ndarray               # passage -> equal words of an alignment that counts
    bits: np.ndarray | None = None

    def __post_init__(self):
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def candidates(self, h: np.ndarray) -> np.ndarray:
        return np.flatnonzero(self.bits[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])

    def lookup(self, h: np.ndarray):
        """(positions in h that meet, first seed row and number of seed rows of each)."""
        c = self.candidates(h)
        lo = np.searchsorted(self.hashes, h[c], "left")
        n = np.searchsorted(self.hashes, h[c], "right") - lo
        return c[n > 0], lo[n > 0], n[n > 0]

    def only(self, seeds: np.ndarray) -> "Index":
        return replace(self, hashes=self.hashes[seeds], passage=self.passage[seeds], first=self.first[seeds], last=self.last[seeds],
                       times=self.times[seeds], bits=None)

    def rare(self, df: tuple[np.ndarray, np.ndarray]) -> "Index":
        """Without the most frequent seeds that no alignment that counts can depend on: of a passage, fewer places
        than every such alignment is certain to hold."""
        keys, n = df
        count = np.zeros(len(self.hashes), np.int64)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, self.hashes), len(keys) - 1)
            count = np.where(keys[at] == self.hashes, n[at], 0)
        order = np.lexsort((self.hashes, -count, self.passage))
        places = np.cumsum(self.times[order])
        starts = np.flatnonzero(np.diff(self.passage[order], prepend=-1))
        before = np.repeat(places[starts] - self.times[order][starts], np.diff([*starts, len(order)]))
        drop = places - before < self.certain[self.passage[order]]
        return self.only(np.sort(order[~drop]))


def index_items(ids: np.ndarray, texts: pa.Array) -> Index:
    item, words, hs, ps, first, last, times, certain, least, lengths = [], [], [], [], [], [], [], [], [], set()
    for lo, hi, data, off in tv.chunks(texts):
        wh, _, _, row = words_of(data, off)
        bound = np.searchsorted(row, np.arange(hi - lo + 1))
        for r in range(hi - lo):
            w = wh[bound[r]:bound[r + 1]]
            step = PASSAGE // 2
            for a in range(0, max(1, len(w) - step), step) if len(w) else ():
                part = w[a:a + PASSAGE]
                n = min(SEED, len(part))
                h, at = _run_hashes(part, np.zeros(len(part), np.int64), n)
                keys, of = np.unique(h, return_inverse=True)
                lengths.add(n)
                hs.append(keys); ps.append(np.full(len(keys), len(item)))
                lows, highs = np.full(len(keys), len(part)), np.zeros(len(keys), np.int64)
                np.minimum.at(lows, of, at)
                np.maximum.at(highs, of, at)
                first.append(lows); last.append(highs); times.append(np.bincount(of, minlength=len(keys)))
                item.append(ids[lo + r]); words.append(part)
                least.append(max(int(np.ceil(len(part) * COVERAGE)), min(len(part), LEAST_WORDS)))
                certain.append(_certain(least[-1], len(part)) if n == SEED else 1)
    cat = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
    h = cat(hs, np.uint64)
    o = np.argsort(h, kind="stable")
    return Index(np.array(item, np.int64), words, h[o], cat(ps, np.int64)[o], cat(first, np.int64)[o], cat(last, np.int64)[o], cat(times, np.int64)[o],
                 tuple(sorted(lengths)), np.array(certain, np.int64), np.array(least, np.int64))


def _certain(least: int, size: int) -> int:
    """Runs of SEED words that every alignment with at least so many equal words holds whole.

    Its other columns - few, by the identity - cut the equal words into one more run of equal columns than there are; each run is SEED - 1
    short of as many seeds."""
    return max(1, min(e - (SEED - 1) * (int(e * (1 / IDENTITY - 1) + 1e-9) + 1) for e in range(least, size + 1)))


def align(a: np.ndarray, b: np.ndarray):
    """Smith-Waterman of two word sequences: (score, equal words, columns, first and last word of b)."""
    n, m = len(a), len(b)
    h = np.zeros((n + 1, m + 1), np.int32)
    ramp = np.arange(m + 1, dtype=np.int32) * -GAP
    for i in range(1, n + 1):
        d = h[i - 1, :-1] + np.where(b == a[i - 1], MATCH, MISMATCH)
        row = np.maximum(np.maximum(d, h[i - 1, 1:] + GAP), 0)
        # a gap along the row: the best earlier cell less its distance
        best = np.maximum.accumulate(np.concatenate(([0], row)) + ramp) - ramp
        h[i, 1:] = np.maximum(row, best[1:])
    i, j = np.unravel_index(int(h.argmax()), h.shape)
    score, equal, columns, last = int(h[i, j]), 0, 0, int(j)
    while i and j and h[i, j]:
        same = a[i - 1] == b[j - 1]
        if h[i, j] == h[i - 1, j - 1] + (MATCH if same else MISMATCH):
            equal += bool(same)
            i, j = i - 1, j - 1
        elif h[i, j] == h[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
        columns += 1
    return score, equal, columns, int(j), last


def matches(ix: Index, data: np.ndarray, off: np.ndarray, one: bool = False):
    """(row, item, identity, coverage, score, first byte, last byte) of every item found in a chunk of texts
    (of one item a row, if one is enough)."""
    wh, ws, we, row = words_of(data, off)
    if not len(wh) or not len(ix.hashes):
        return []
    bounds = np.searchsorted(row, np.arange(len(off)))
    step = SLICE_WORDS - 3 * PASSAGE                       # an alignment spans less than two passages
    slices = [(r, a, min(int(bounds[r + 1]), a + SLICE_WORDS)) for r in range(len(off) - 1)
              for a in range(int(bounds[r]), max(int(bounds[r]) + 1, int(bounds[r + 1]) - 3 * PASSAGE), step)]
    best: dict[tuple[int, int], tuple] = {}
    _match_slices(ix, wh, slices, best, one)
    return [(k[0], k[1], v[3], v[4], v[1], int(ws[v[5]] - off[k[0]]), int(we[v[6]] - off[k[0]])) for k, v in sorted(best.items())]


def _match_slices(ix: Index, wh: np.ndarray, slices: list[tuple[int, int, int]], best: dict, one: bool) -> None:
    """Add the best alignment of each (row, item) to ``best``; splits the slices, then the passages, where too many meet at once."""
    if not len(ix.hashes):
        return
    place = np.concatenate([np.arange(a, b) for _, a, b in slices])
    part = np.repeat(np.arange(len(slices)), [b - a for _, a, b in slices])
    found = []
    for n in ix.lengths:
        h, at = _run_hashes(wh[place], part, n)
        c, lo, k = ix.lookup(h)
        found.append((at[c], lo, k))
    at, lo, k = (np.concatenate(x) for x in zip(*found))
    if k.sum() > PAIRS:
        passages = np.unique(ix.passage)
        if len(slices) > 1:
            mid = len(slices) // 2
            _match_slices(ix, wh, slices[:mid], best, one)
            return _match_slices(ix, wh, slices[mid:], best, one)
        if len(passages) > 1:
            low = ix.passage < passages[len(passages) // 2]
            _match_slices(ix.only(np.flatnonzero(low)), wh, slices, best, one)
            return _match_slices(ix.only(np.flatnonzero(~low)), wh, slices, best, one)
    if not len(at):
        return
    seed = np.repeat(lo, k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
    at = np.repeat(at, k)
    ps = ix.passage[seed]
    # the diagonals (document word less passage word) that the meeting may lie on
    low, high = place[at] - ix.last[seed], place[at] - ix.first[seed]
    o = np.lexsort((low, ps, part[at]))
    pt, ps, low, high = part[at][o], ps[o], low[o], high[o]
    size = np.array([len(w) for w in ix.words])[ps]
    # a new window where the slice or passage changes, or the diagonals are too far apart for one alignment
    change = np.concatenate(([True], (pt[1:] != pt[:-1]) | (ps[1:] != ps[:-1])))
    group = np.cumsum(change) - 1
    reach = np.maximum.accumulate(high + group * (1 << 40)) - group * (1 << 40)
    new = change.copy()
    new[1:] |= low[1:] - reach[:-1] > size[1:] // 2 + 2
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(ps)) - 1
    for a, b in zip(starts.tolist(), ends.tolist()):
        r, start, end = slices[int(pt[a])]
        p = int(ps[a])
        if one and (r, -1) in best:
            continue
        w = ix.words[p]
        slack = len(w) // 3 + 2
        lo_, hi_ = max(start, int(low[a]) - slack), min(end, int(reach[b]) + len(w) + slack)
        # no alignment has more equal words than the passage has in common with the window
        if np.isin(w, wh[lo_:hi_]).sum() < ix.least[p]:
            continue
        score, equal, columns, j0, j1 = align(w, wh[lo_:hi_])
        identity, coverage = equal / max(1, columns), equal / len(w)
        if identity >= IDENTITY and equal >= ix.least[p]:
            key = (r, -1 if one else int(ix.item[p]))
            got = (identity * coverage, score, -(lo_ + j0), identity, coverage, lo_ + j0, lo_ + j1 - 1)
            if key not in best or got[:3] > best[key][:3]:
                best[key] = got


def document_frequency(texts: DataFrame, ix: Index) -> tuple[np.ndarray, np.ndarray]:
    """Sorted seeds and the number of documents that hold each; at most one row per seed and task is shuffled."""
    shared = texts.sparkSession.sparkContext.broadcast(ix)

    def count(batches):
        ix = shared.value
        keys = np.unique(ix.hashes)
        total = np.zeros(len(keys), np.int64)
        for batch in batches:
            for _, _, data, off in tv.chunks(batch.column(0)):
                wh, _, _, row = words_of(data, off)
                for n in ix.lengths:
                    h, at = _run_hashes(wh, row, n)
                    c = ix.candidates(h)
                    k = np.searchsorted(keys, h[c])
                    k = np.minimum(k, len(keys) - 1)
                    hit = keys[k] == h[c]
                    pair = np.unique(row[at[c[hit]]] * len(keys) + k[hit])
                    total += np.bincount(pair % len(keys), minlength=len(keys))
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(keys[some].astype(np.int64)), pa.array(total[some])], names=["h", "n"])

    if not len(ix.hashes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rows = texts.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).toArrow()   # bounded by BLOCK_WORDS
    keys, n = rows["h"].to_numpy().astype(np.int64).view(np.uint64), rows["n"].to_numpy()
    o = np.argsort(keys)
    return keys[o], n[o]


def blocks(items: DataFrame, id_col: str, text_col: str):
    """The items, in blocks of at most BLOCK_WORDS words (a longer item is its own block)."""
    rows = items.select(F.col(id_col).cast("long").alias("i"), F.lower(F.col(text_col)).alias("t")).filter("t is not null and i is not null")
    bytes_ = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-bytes_ // (BLOCK_WORDS * 4)) or 1
    for k in range(n):
        part = rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).orderBy("i", "t").toArrow()
        yield index_items(part["i"].to_numpy(), part["t"].combine_chunks())


def rare_indexes(docs: DataFrame, items: DataFrame, text_col: str, item_id: str, item_text: str):
    bound_batches(docs.sparkSession)
    texts = docs.select(F.lower(F.col(text_col)).alias("t")).filter("t is not null")
    for ix in blocks(items, item_id, item_text):
        yield ix.rare(document_frequency(texts, ix))


def find(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
         item_text: str = "text") -> DataFrame:
    """id, item, identity, coverage, score, start_byte, end_byte (in the lower-case text) of every item found."""
    schema = f"{id_col} long, item_id long, identity double, coverage double, score int, start_byte long, end_byte long"
    out = None
    rows = docs.select(F.col(id_col).cast("long"), F.lower(F.col(text_col)).alias("_t"))
    for ix in rare_indexes(docs, items, text_col, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(ix)

        def scan(batches, shared=shared):
            for batch in batches:
                ids = batch.column(0)
                for lo, hi, data, off in tv.chunks(batch.column(1)):
                    got = matches(shared.value, data, off)
                    if got:
                        cols = list(zip(*got))
                        yield pa.record_batch([ids.slice(lo, hi - lo).take(pa.array(cols[0])), pa.array(cols[1], pa.int64()),
                                               pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.float64()), pa.array(cols[4], pa.int32()),
                                               pa.array(cols[5], pa.int64()), pa.array(cols[6], pa.int64())],
                                              names=[id_col, "item_id", "identity", "coverage", "score", "start_byte", "end_byte"])

        part = rows.mapInArrow(scan, schema)
        out = part if out is None else out.unionByName(part)
    return out


def _text_key(text_col: str):
    text = F.col(text_col)
    return [F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit("second"), text).alias("_h2")]


def leaked_texts(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The hashes (_h1, _h2) of the texts that hold any of the items; one scan a block of items, each written when done."""
    spark = docs.sparkSession
    base = scratch_path(spark, f"leaked-{uuid.uuid4().hex}")
    rows = docs.select(*_text_key(text_col), F.lower(F.col(text_col)).alias("_t"))
    paths = []
    for k, ix in enumerate(rare_indexes(docs, items, text_col, item_id, item_text)):
        shared = spark.sparkContext.broadcast(ix)

        def scan(batches, shared=shared):
            for batch in batches:
                for lo, hi, data, off in tv.chunks(batch.column(2)):
                    hit = pa.array([lo + m[0] for m in matches(shared.value, data, off, one=True)], pa.int64())
                    yield pa.record_batch([batch.column(0).take(hit), batch.column(1).take(hit)], names=["_h1", "_h2"])

        rows.mapInArrow(scan, "_h1 long, _h2 long").distinct().write.parquet(f"{base}/{k}")
        shared.unpersist()
        paths.append(f"{base}/{k}")
    out = spark.createDataFrame([], "_h1 long, _h2 long")
    return spark.read.parquet(*paths).distinct() if paths else out


def keep_clean(docs: DataFrame, items: DataFrame, text_col: str = "text", **kw) -> DataFrame:
    """The documents without any item, with the columns they came with."""
    gone = leaked_texts(docs, items, text_col, **kw)
    key = _text_key(text_col)
    return docs.join(gone, (key[0] == gone["_h1"]) & (key[1] == gone["_h2"]), "left_anti").select(*[docs[f"`{c}`"] for c in docs.columns])
