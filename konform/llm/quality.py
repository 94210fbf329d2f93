"""Quality classifier trained without labels.

1. Overlapping *heuristic labellers* vote good / bad or abstain on every
   document, from byte, word and line statistics.
2. *Expectation-maximisation* estimates how accurate each labeller is and how
   common good documents are.  It needs only the number of documents per vote
   pattern, so Spark counts the patterns of the whole corpus (at most
   ``3 ** labellers`` rows) and the model is fitted on those counts.
3. The *posterior* of each pattern labels a bounded sample, on which a linear
   scorer over hashed features (byte-class trigrams and binned statistics) is
   trained with soft labels; its score decides for every document.

Defined results: a null or empty text, or one of white space only, is rejected
(score 0); with fewer than two vote patterns, or where all sampled posteriors
lie on one side, the posterior itself is the score; other columns are kept as
they are; rows that repeat are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import bound_batches
from . import textvec as tv

TRAIN_DOCS = 6000               # bound of the sample that the linear scorer is fitted on
CLASS_BITS = 3
BUCKETS = 1 << 10               # hashed features: 8**3 byte-class trigrams, then binned statistics
LEAST_WORDS = 4                 # below that the scorer has no say: the share of good documents is the score
SHORT = 256                     # texts of fewer bytes say less: their trigram shares are held back
TRIGRAMS = 1 << (3 * CLASS_BITS)
STATS = ("words", "upper", "shout", "bars", "stutter", "variety", "top_word", "lines", "stops", "symbols")
# byte classes: lower, upper, digit, white space, line end and stop, other punctuation, bar and exclamation, rest
CLASS = np.full(256, 5, np.uint8)
CLASS[97:123] = 0
CLASS[65:91] = 1
CLASS[48:58] = 2
CLASS[list(b" \t\r\x0b\x0c")] = 3
CLASS[list(b".\n,")] = 4
CLASS[list(b"|!")] = 6
CLASS[128:] = 7
LETTER = tv.byte_table(bytes([*range(65, 91), *range(97, 123)]))


@dataclass(frozen=True)
class Labeller:
    """Votes on documents with at least ``least`` words: good where every statistic of ``good`` lies in its range,
    bad where one of ``bad`` lies in its range, else it abstains."""

    good: tuple[tuple[str, float, float], ...] = ()
    bad: tuple[tuple[str, float, float], ...] = ()
    least: int = 1


INF = float("inf")
LABELLERS = (
    Labeller(bad=(("upper", 0.50, INF),)),                                              # shouted text
    Labeller(bad=(("shout", 0.30, INF), ("bars", 0.20, INF))),                          # tables, exclamations
    Labeller(bad=(("symbols", 0.60, INF),)),                                            # symbol noise
    Labeller(bad=(("stutter", 0.25, INF),), least=4),                                   # a word again and again
    Labeller(bad=(("variety", 0.0, 0.42),), least=8),                                   # few different words
    Labeller(bad=(("lines", 0.0, 0.40), ("top_word", 0.25, INF)), least=12),            # lines or a word repeated
    Labeller(good=(("stops", 0.02, 0.60), ("symbols", 0.0, 0.15), ("shout", 0.0, 0.10)),
             bad=(("stops", 0.0, 0.005),), least=12),                                   # sentences
    Labeller(good=(("variety", 0.48, 1.0), ("stutter", 0.0, 0.10), ("symbols", 0.0, 0.30), ("bars", 0.0, 0.05), ("upper", 0.0, 0.3)), least=4),
)


def _per_row(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return (total[off[1:]] - total[off[:-1]]).astype(np.float64)


def _repeats(h: np.ndarray, row: np.ndarray, n: int):
    """(distinct, most frequent) number of hashes per row."""
    with np.errstate(over="ignore"):
        key = np.sort(tv.mix(h + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64((1 << 40) - 1)
                      | row.astype(np.uint64) << np.uint64(40))
    if not len(key):
        return np.zeros(n), np.zeros(n)
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(first, len(key)))
    at = (key[first] >> np.uint64(40)).astype(np.int64)
    top = np.zeros(n)
    np.maximum.at(top, at, size)
    return np.bincount(at, minlength=n).astype(np.float64), top


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of STATS per document."""
    n = len(off) - 1
    ws, we, row = tv.word_spans(data, off)
    p = tv.prefix_hash(data)
    wh = tv.span_hash(p, ws, we)
    words = np.bincount(row, minlength=n).astype(np.float64)
    w1 = np.maximum(words, 1)
    w8 = np.maximum(words, 8)               # shares in short texts are held back
    same = (wh[1:] == wh[:-1]) & (row[1:] == row[:-1]) if len(wh) else np.zeros(0, bool)
    distinct, top = _repeats(wh, row, n)
    ls, le, lrow = tv.word_spans(data, off, tv.byte_table(b"\n"))
    lines = np.maximum(np.bincount(lrow, minlength=n), 1)
    ldistinct, _ = _repeats(tv.span_hash(p, ls, le), lrow, n)
    letters = _per_row(LETTER[data], off)
    upper = _per_row(CLASS[data] == 1, off)
    count = lambda c: _per_row(data == c, off)
    symbols = _per_row(CLASS[data] == 5, off)
    return np.stack([words, upper / np.maximum(letters, 40), count(33) / w8, count(124) / w8,
                     np.bincount(row[1:][same], minlength=n) / w8, distinct / w1, top / w8, ldistinct / lines,
                     count(46) / w8, symbols / w8], 1)


def votes(stats: np.ndarray) -> np.ndarray:
    """1 good, -1 bad, 0 abstains; documents x labellers."""
    out = np.zeros((len(stats), len(LABELLERS)), np.int64)
    inside = lambda r: (stats[:, STATS.index(r[0])] >= r[1]) & (stats[:, STATS.index(r[0])] <= r[2])
    for k, f in enumerate(LABELLERS):
        good = np.logical_and.reduce([inside(r) for r in f.good]) if f.good else np.zeros(len(stats), bool)
        bad = np.logical_or.reduce([inside(r) for r in f.bad]) if f.bad else np.zeros(len(stats), bool)
        out[:, k] = np.where(bad, -1, np.where(good, 1, 0)) * (stats[:, 0] >= f.least)
    return out


def pattern_of(v: np.ndarray) -> np.ndarray:
    return ((v + 1) * 3 ** np.arange(v.shape[1])).sum(1)


def fit_labellers(patterns: np.ndarray, count: np.ndarray, steps: int = 200):
    """EM over vote patterns: (posterior of good per pattern, accuracies [labeller, class, vote], share of good)."""
    n = len(LABELLERS)
    v = patterns[:, None] // 3 ** np.arange(n) % 3                  # 0 bad, 1 abstains, 2 good
    good = np.where((v == 0).any(1), 0.02, 0.98)                    # start: one bad vote tells
    for _ in range(steps):
        w = np.stack([(1 - good) * count, good * count])            # class x pattern
        share = (w[1].sum() + 1) / (count.sum() + 2)
        table = np.stack([[[(w[c] * (v[:, k] == x)).sum() + 0.5 for x in range(3)] for c in range(2)] for k in range(n)])
        table /= table.sum(2, keepdims=True)
        ll = np.stack([np.log(table[np.arange(n), c, v]).sum(1) + np.log((1 - share, share)[c]) for c in range(2)])
        new = 1 / (1 + np.exp(np.clip(ll[0] - ll[1], -700, 700)))
        done = np.abs(new - good).max() < 1e-9
        good = new
        if done:
            break
    # where every labeller abstains there is no evidence: the share of good documents is all that is known
    return np.where((v == 1).all(1), share, good), table, share


def _features(data: np.ndarray, off: np.ndarray, stats: np.ndarray):
    """Hashed features: (trigram index of every byte position, its row, bin index of every statistic)."""
    c = CLASS[data].astype(np.int64)
    n = len(c)
    tri = np.zeros(0, np.int64)
    row = np.zeros(0, np.int64)
    if n > 2:
        tri = c[:-2] << (2 * CLASS_BITS) | c[1:-1] << CLASS_BITS | c[2:]
        row = np.repeat(np.arange(len(off) - 1), np.diff(off))
        inside = row[:-2] == row[2:]
        tri, row = tri[inside], row[:-2][inside]
    level = np.minimum((np.log2(1 + 1000 * np.maximum(stats, 0)) * 2).astype(np.uint64), np.uint64(63))
    key = tv.mix(level + (np.arange(stats.shape[1], dtype=np.uint64) << np.uint64(8)))
    return tri, row, TRIGRAMS + (key % np.uint64(BUCKETS - TRIGRAMS)).astype(np.int64)


def feature_matrix(data: np.ndarray, off: np.ndarray, stats: np.ndarray) -> np.ndarray:
    tri, row, bins = _features(data, off, stats)
    n = len(stats)
    x = np.bincount(row * BUCKETS + tri, minlength=n * BUCKETS).reshape(n, BUCKETS).astype(np.float64)
    x /= np.maximum(x.sum(1, keepdims=True), SHORT)
    for k in range(bins.shape[1]):
        np.add.at(x, (np.arange(n), bins[:, k]), 1.0 / bins.shape[1])
    return x


@dataclass
class QualityModel:
    patterns: dict[int, float]      # vote pattern -> posterior of good
    accuracy: np.ndarray            # labeller x class x vote
    share: float                    # of good documents
    weights: np.ndarray | None      # linear scorer; None: the posterior decides
    bias: float = 0.0

    def score(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        s = statistics(data, off)
        if self.weights is None:
            p = np.array([self.patterns.get(int(k), self.share) for k in pattern_of(votes(s))])
        else:
            tri, row, bins = _features(data, off, s)
            n = np.maximum(np.bincount(row, minlength=len(s)), SHORT)
            z = np.bincount(row, weights=self.weights[tri], minlength=len(s)) / n + self.weights[bins].mean(1) + self.bias
            p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            p = np.where(s[:, 0] < LEAST_WORDS, self.share, p)
        return np.where(s[:, 0] > 0, p, 0.0)


def patterns(col: pa.Array) -> pa.Array:
    out = np.zeros(len(col), np.int64)
    for lo, hi, data, off in tv.chunks(col, tv.SCAN_BYTES):
        out[lo:hi] = pattern_of(votes(statistics(data, off)))
    return pa.array(out)


def _patterns(text: Column) -> Column:
    def f(col: pa.Array) -> pa.Array:
        return patterns(col)

    return F.arrow_udf(f, "long")(text)


def fit(docs: DataFrame, text_col: str = "text", train_docs: int = TRAIN_DOCS) -> QualityModel:
    """Vote patterns of all documents, EM on their counts, and a scorer on at most about ``train_docs`` documents."""
    bound_batches(docs.sparkSession)
    text = docs.select(F.col(text_col).alias("_t")).filter(F.col("_t").rlike(r"\S"))
    rows = text.select(_patterns(F.col("_t")).alias("pattern")).groupBy("pattern").count().collect()   # at most 3**9 rows
    if not rows:
        return QualityModel({}, np.zeros((len(LABELLERS), 2, 3)), 0.0, None)
    pattern = np.array([r["pattern"] for r in rows], np.int64)
    count = np.array([r["count"] for r in rows], np.float64)
    good, accuracy, share = fit_labellers(pattern, count)
    model = QualityModel(dict(zip(pattern.tolist(), good.tolist())), accuracy, float(share), None)
    keep = min(1.0, train_docs / count.sum())
    sample = text.filter(F.pmod(F.xxhash64("_t"), F.lit(1 << 30)) < int(keep * (1 << 30)))

    def examples(batches):
        for batch in batches:
            for lo, hi, data, off in tv.chunks(batch.column(0), tv.SCAN_BYTES):
                s = statistics(data, off)
                v = votes(s)
                p = np.array([model.patterns.get(int(k), model.share) for k in pattern_of(v)])
                told = (v != 0).any(1)                      # without a vote there is nothing to learn
                p, x = p[told], feature_matrix(data, off, s)[told]
                yield pa.record_batch([pa.array(list(x), pa.list_(pa.float64())), pa.array(p)], names=["x", "p"])

    soft = sample.mapInArrow(examples, "x array<double>, p double")
    # each document counts for both classes, by its posterior
    both = soft.select(array_to_vector("x").alias("features"), F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), F.col("p").alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("weight")))).alias("_e")).select("features", "_e.*").filter("weight > 1e-6")
    both = both.persist()
    classes = {r["label"]: r["w"] for r in both.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    if len(classes) == 2 and min(classes.values()) >= 1:
        lr = LogisticRegression(weightCol="weight", maxIter=60, regParam=1e-5, standardization=True).fit(both)
        model.weights, model.bias = lr.coefficients.toArray(), float(lr.intercept)
    both.unpersist()
    return model


def score(model: QualityModel, text: Column) -> Column:
    """Probability that a document is good (0 for a text without words)."""
    def f(col: pa.Array) -> pa.Array:
        out = np.zeros(len(col))
        for lo, hi, data, off in tv.chunks(col, tv.SCAN_BYTES):
            out[lo:hi] = model.score(data, off)
        return pa.array(out)

    return F.arrow_udf(f, "double")(text)


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """id, score, kept of every document."""
    model = fit(docs, text_col)
    d = docs.select(F.col(id_col), score(model, F.col(text_col)).alias("score"))
    return d.select(id_col, "score", (F.col("score") >= threshold).alias("kept"))


def keep_good(docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents that pass, with the columns they came with; one more scan, no shuffle of texts."""
    model = fit(docs, text_col)
    return docs.filter(score(model, F.col(text_col)) >= threshold)
