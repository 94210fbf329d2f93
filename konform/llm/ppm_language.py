"""Language identification by prediction by partial matching.

For each language a tree of byte contexts (up to ``ORDER`` bytes) holds the
counts of the byte that follows.  A byte seen in a context costs
``-log2(count / (n + u))`` bits (``n`` occurrences, ``u`` different bytes); any
other byte costs the escape ``-log2(u / (n + u))`` plus its code length in the
next shorter context, renormalised over the bytes not yet excluded.  The
statistics are frozen after training, so every (context, byte) pair has one exact
code length per language: that of each seen pair and the escape of each context
are tabulated once, and a text's code length is a sum of look-ups.  The language
with the shortest code wins; the score is its posterior probability.

Counts are taken over every training text in Spark (partial counts per task,
then a sum per gram); only the model leaves the cluster, bounded by
``max_grams`` leaves of the tree of each language, its own most frequent first -
rarer leaves back off to shorter contexts.  No language takes room from another,
and every language that is learned from stays.

Defined results: a null text or a text without a letter is ``und`` with score 0,
as is everything when there is no training text; equal code lengths go to the
first language in alphabetical order; rows without an id are never learned from;
other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textvec as tv

ORDER = 3
PAD = 10                        # byte that stands before the first byte of a text
MAX_GRAMS = 150_000             # leaves of each language's tree that the model may keep
MAX_LANGS = 64


def _windows(data: np.ndarray, off: np.ndarray):
    """Every byte with its three predecessors as one 32-bit number (contexts stop at the text's start)."""
    b = data.astype(np.uint32)
    gram = b.copy()
    for back in range(1, ORDER + 1):
        prev = np.full(len(b), PAD, np.uint32)
        prev[back:] = b[:-back] if len(b) > back else b[:0]
        for k in range(back):                       # positions closer than `back` to their text's start
            at = off[:-1] + k
            at = at[(at < off[1:])]
            prev[at] = PAD
        gram |= prev << np.uint32(8 * back)
    return gram


def gram_counts(train: DataFrame, lang: str, text: str) -> DataFrame:
    """lang, gram, n over all rows: counts per task first, then one small shuffle."""

    def count(batches):
        acc: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def add(key, g, n):
            if key in acc:
                g = np.concatenate((acc[key][0], g))
                n = np.concatenate((acc[key][1], n))
                g, inv = np.unique(g, return_inverse=True)
                n = np.bincount(inv, weights=n).astype(np.int64)
            acc[key] = g, n

        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lo, hi, data, off in tv.chunks(batch.column(1)):
                gram = _windows(data, off)
                here = langs[lo:hi]
                for key in dict.fromkeys(here.tolist()):
                    pick = np.repeat(here == key, np.diff(off))
                    add(key, *np.unique(gram[pick], return_counts=True))
        for key, (g, n) in acc.items():
            for s in range(0, len(g), 50_000):
                part = g[s:s + 50_000]
                yield pa.record_batch([pa.array([key] * len(part), pa.string()), pa.array(part.astype(np.int64)),
                                       pa.array(n[s:s + 50_000].astype(np.int64))], names=["lang", "gram", "n"])

    parts = train.select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInArrow(count, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Tree:
    """One language: per order, the seen (context, byte) keys with their bits and the contexts with their escape's bits."""

    keys: list[np.ndarray]      # order -> packed context and byte, sorted
    bits: list[np.ndarray]
    contexts: list[np.ndarray]  # order -> packed context, sorted
    escape: list[np.ndarray]

    def code_lengths(self, gram: np.ndarray) -> np.ndarray:
        """Bits of the last byte of every gram."""
        out = np.zeros(len(gram))
        rest = np.arange(len(gram))
        for order in range(ORDER, -1, -1):
            key = _suffix(gram[rest], order)
            at = _find(self.keys[order], key)
            hit = at >= 0
            out[rest[hit]] += self.bits[order][at[hit]]
            rest, key = rest[~hit], key[~hit]
            at = _find(self.contexts[order], key >> np.uint32(8))
            out[rest[at >= 0]] += self.escape[order][at[at >= 0]]
        out[rest] += 8                                  # no context knows the byte: one of 256
        return out


def _suffix(gram: np.ndarray, order: int) -> np.ndarray:
    """The last byte with ``order`` bytes of context."""
    return gram & np.uint32((1 << 8 * (order + 1)) - 1)


def _find(table: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Place of every key in a sorted table, -1 if it is not there."""
    at = np.minimum(np.searchsorted(table, key), len(table) - 1)
    return np.where(table[at] == key, at, -1)


@dataclass
class PPM:
    """The trees of all languages; they hold only what was seen."""

    langs: list[str]
    trees: list[Tree]

    def code_lengths(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Bits of every text under every language (rows x languages)."""
        out = np.zeros((len(off) - 1, len(self.langs)))
        if not len(data):
            return out
        gram, at = np.unique(_windows(data, off), return_inverse=True)
        for k, tree in enumerate(self.trees):
            total = np.concatenate(([0.0], np.cumsum(tree.code_lengths(gram)[at])))
            out[:, k] = total[off[1:]] - total[off[:-1]]
        return out


def build_tree(gram: np.ndarray, count: np.ndarray) -> Tree:
    """Code lengths of one language from its 4-byte grams and their counts."""
    tree = Tree([], [], [], [])
    shorter_keys, shorter_p = np.zeros(0, np.uint32), np.zeros(0)
    for order in range(ORDER + 1):
        keys, at = np.unique(_suffix(gram, order), return_inverse=True)
        c = np.bincount(at, weights=count)
        contexts, ctx = np.unique(keys >> np.uint32(8), return_inverse=True)
        n, u = np.bincount(ctx, weights=c), np.bincount(ctx)
        # every seen pair is also seen in the next shorter context
        below = shorter_p[np.searchsorted(shorter_keys, _suffix(keys, order - 1))] if order else np.full(len(keys), 1 / 256)
        mass = np.maximum(1 - np.bincount(ctx, weights=below), 1e-12)       # of the bytes that the context has not seen
        p = c / (n + np.where(u < 256, u, 0))[ctx]
        tree.keys.append(keys)
        tree.bits.append(-np.log2(p).astype(np.float32))
        tree.contexts.append(contexts)
        tree.escape.append(-np.log2(u / (n + u) / mass).astype(np.float32))
        shorter_keys, shorter_p = keys, p
    return tree


def build(langs: list[str], lang_id: np.ndarray, gram: np.ndarray, count: np.ndarray) -> PPM:
    """Trees from (language, 4-byte gram, count) rows."""
    gram = gram.astype(np.uint32)
    return PPM(langs, [build_tree(gram[lang_id == k], count[lang_id == k]) for k in range(len(langs))])


def train(docs: DataFrame, learn: Column, lang_col: str = "lang", text_col: str = "text", max_grams: int = MAX_GRAMS) -> PPM | None:
    """The frozen model of all rows that satisfy ``learn``."""
    t = docs.filter(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("_l"), F.lower(F.col(text_col)).alias("_t"))
    counts = gram_counts(t, "_l", "_t").persist()
    langs = [r["lang"] for r in counts.select("lang").distinct().orderBy("lang").limit(MAX_LANGS + 1).collect()]
    if len(langs) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    trees = []
    for name in langs:                                                    # the model itself, bounded per language
        top = counts.filter(F.col("lang") == name).select("gram", "n").orderBy(F.desc("n"), "gram").limit(max_grams).toArrow()
        trees.append(build_tree(top["gram"].to_numpy().astype(np.uint32), top["n"].to_numpy().astype(np.float64)))
    counts.unpersist()
    return PPM(langs, trees) if trees else None


def predict(docs: DataFrame, model: PPM | None, text_col: str = "text") -> Column:
    """struct(lang_pred, score) of a text column."""
    out = "lang_pred string, score double"
    if model is None:
        return F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)              # bounded by MAX_GRAMS x MAX_LANGS, whatever the corpus

    def score(col: pa.Array) -> pa.Array:
        m = shared.value
        best, conf = np.zeros(len(col), np.int64), np.zeros(len(col))
        for lo, hi, data, off in tv.chunks(col):
            bits = m.code_lengths(data, off)
            k = bits.argmin(1)
            p = np.exp2(-(bits - bits.min(1, keepdims=True)))
            best[lo:hi], conf[lo:hi] = k, 1.0 / p.sum(1)
        return pa.StructArray.from_arrays([pa.array([m.langs[i] for i in best], pa.string()), pa.array(conf)], ["lang_pred", "score"])

    f = F.arrow_udf(score, out)
    text = F.col(text_col)
    return (F.when(text.rlike(r"\p{L}"), f(F.lower(text)))
            .otherwise(F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))))


def held_out(id_col: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == 0, F.lit(True))


def identify(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """id, held_out, lang_pred, score of every row; learned from the rows that are not held out."""
    model = train(docs, ~held_out(F.col(id_col)), lang_col, text_col)
    d = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
    d = d.select("_id", held_out(F.col("_id")).alias("held_out"), predict(d, model, "_t").alias("_p"))
    return d.select(F.col("_id").alias(id_col), "held_out", "_p.lang_pred", "_p.score")
