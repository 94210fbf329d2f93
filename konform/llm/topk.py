"""Exact top-k inner-product search with multi-resolution segment statistics.

Each vector is cut into segments; a segment is summarised by its mean and its
deviation.  For two vectors the Cauchy-Schwarz inequality on every segment,
    <q, x> <= sum_seg len * (mean_q * mean_x + dev_q * dev_x),
bounds the score from above (the distance from below).  Bounds are computed
coarse to fine; what the current k-th best score beats is dropped, and exact
integer scores are computed for the survivors only.

The stated queries meet all rows in blocks: a block of queries and a slice of
candidates at a time, both of bounded size, each pair of blocks one Spark group.
Every group returns its best k per query; a window over those few rows gives
the final ranks.

Defined results: vectors that are null, or hold null or non-finite components,
take no part; a vector only meets vectors of its own length; empty vectors
score 0 with each other; rows that repeat an id are candidates each, but one
query (the first by vector); an id is never its own candidate; ties go to the
smaller id; an empty table gives no rows.  Scores are exact for components of any size: where a block's
largest possible score passes 2**52, survivors are scored in integers instead of doubles (and the bounds
get a margin for their rounding); a score among the k best that does not fit a long fails the job.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LEVELS = (2, 8, 32)             # segments per vector, coarse to fine
QUERY_BLOCK = 2048              # queries of one block
SLICE_ROWS = 16_384             # candidates of one slice
STEP = 128                      # queries compared at once inside a task
SEEDS = 64                      # candidates scored first to get a threshold


def segment_features(v: np.ndarray, parts: int) -> np.ndarray:
    """Rows whose inner products are the upper bounds at this resolution."""
    out = []
    for seg in np.array_split(np.arange(v.shape[1]), min(parts, v.shape[1])):
        x = v[:, seg]
        w = np.sqrt(len(seg))
        out += [w * x.mean(1), w * x.std(1)]
    return np.stack(out, 1) if out else np.zeros((len(v), 1))


def exact_scores(q: np.ndarray, x: np.ndarray, a: np.ndarray, b: np.ndarray, largest: float) -> np.ndarray:
    """Integer inner products of the pairs (a, b) of rows that hold integers: in doubles, longs or Python's integers, by
    the largest score there can be."""
    if largest < 2.0 ** 62:
        kind = np.float64 if largest < 2.0 ** 52 else np.int64
        q, x = q.astype(kind), x.astype(kind)
        parts = [np.einsum("ij,ij->i", q[a[s:s + (1 << 18)]], x[b[s:s + (1 << 18)]]) for s in range(0, len(a), 1 << 18)]
        return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
    rows = {}
    whole = lambda m, i, side: rows.setdefault((side, i), [int(v) for v in m[i]])
    return np.array([sum(u * v for u, v in zip(whole(q, i, 0), whole(x, j, 1))) for i, j in zip(a.tolist(), b.tolist())], object)


def best_in_block(q: np.ndarray, q_id: np.ndarray, x: np.ndarray, x_id: np.ndarray, k: int):
    """(query row, candidate row, score) of the k best candidates of every query."""
    top_q, top_x = (float(np.abs(m).max(initial=0.0)) for m in (q, x))
    largest = top_q * top_x * max(q.shape[1], 1)
    large = not largest < 2.0 ** 52
    # large components are brought to 1 for the bounds, so that nothing overflows
    fq_, fx_ = (q / max(top_q, 1.0), x / max(top_x, 1.0)) if large else (q, x)
    norm_q, norm_x = (np.sqrt((m * m).sum(1)) for m in (fq_, fx_))
    feats = [(segment_features(fq_, m), segment_features(fx_, m)) for m in LEVELS if m < max(2, q.shape[1])]
    got = []
    for lo in range(0, len(q), STEP):
        hi = min(len(q), lo + STEP)
        other = q_id[lo:hi, None] != x_id[None, :]
        alive = other
        floor = np.full(hi - lo, -np.inf)
        # small scores are integers: half a point covers all rounding of the bounds
        margin = 1e-9 * norm_q[lo:hi, None] * norm_x[None, :] if large else 0.5
        for level, (fq, fx) in enumerate(feats):
            dense = alive.mean() > 0.1
            if dense:
                bound = fq[lo:hi] @ fx.T
                bound[~alive] = -np.inf
            else:
                a, b = np.nonzero(alive)
                bound = np.full(alive.shape, -np.inf)
                for s in range(0, len(a), 1 << 18):
                    i, j = a[s:s + (1 << 18)], b[s:s + (1 << 18)]
                    bound[i, j] = np.einsum("ij,ij->i", fq[lo + i], fx[j])
            if level == 0:
                # scores of the most promising candidates give the first threshold
                n = min(SEEDS, len(x))
                top = np.argpartition(-bound, n - 1, axis=1)[:, :n]
                seen = np.einsum("ij,ikj->ik", fq_[lo:hi], fx_[top])
                if large:
                    seen -= np.take_along_axis(margin, top, 1)
                seen[~np.take_along_axis(other, top, 1)] = -np.inf
                if n >= k:
                    floor = np.partition(seen, n - k, axis=1)[:, n - k]
            alive = alive & (bound >= floor[:, None] - margin - 1e-9 * np.abs(bound))
        a, b = np.nonzero(alive)
        score = exact_scores(q, x, lo + a, b, largest)
        if not large:
            keep = score >= floor[a]
            a, b, score = a[keep], b[keep], score[keep]
        # descending by score, ties to the smaller id; Python's integers are ranked first
        rank = np.unique(score, return_inverse=True)[1] if score.dtype == object else score
        order = np.lexsort((x_id[b], -rank, a))
        a, b, score = a[order], b[order], score[order]
        place = np.arange(len(a)) - np.searchsorted(a, a)
        keep = place < k
        if score.dtype == object and any(not -(1 << 63) <= s < 1 << 63 for s in score[keep]):
            raise OverflowError("an inner product among the best does not fit a long")
        got.append((lo + a[keep], b[keep], score[keep].astype(np.int64)))
    cat = lambda i: np.concatenate([g[i] for g in got]) if got else np.zeros(0, np.int64)
    return cat(0), cat(1), cat(2)


def _floor(x: Column) -> Column:
    """The largest whole number up to x, as a double (every double from 2**53 on is one)."""
    return F.when(F.abs(x) < 2.0 ** 53, F.floor(x).cast("double")).otherwise(x)


def _matrix(col, dim: int) -> np.ndarray:
    flat = col.combine_chunks().flatten().to_numpy(zero_copy_only=False) if isinstance(col, pa.ChunkedArray) else col.flatten().to_numpy()
    return flat.astype(np.float64).reshape(-1, dim)


def search(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of every query row."""
    rows = vectors.select(F.col(id_col).cast("long").alias("_id"), is_query.alias("_q"),
                          F.col(vector_col).cast("array<double>").alias("_v"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = (rows.filter(F.col("_v").isNotNull() & F.col("_id").isNotNull() & F.forall("_v", finite))
            .withColumn("_v", F.transform("_v", lambda x: _floor(x * scale)))
            .withColumn("_d", F.size("_v")))
    queries = rows.filter("_q").groupBy("_id", "_d").agg(F.min("_v").alias("_v"))
    n_rows, n_queries = rows.agg(F.count(F.lit(1)), F.count_if("_q")).first()
    blocks, slices = -(-max(1, n_queries) // QUERY_BLOCK), -(-max(1, n_rows) // SLICE_ROWS)
    left = (queries.withColumn("_b", F.pmod(F.xxhash64("_id"), F.lit(blocks)).cast("int"))
            .withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))))
    # slices are dealt by row number, so repeated rows spread as well
    right = (rows.select("_id", "_d", "_v", F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(slices)).cast("int").alias("_s"))
             .withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))

    def block(lt: pa.Table, rt: pa.Table) -> pa.Table:
        names = ("query_id", "vec_id", "score")
        if not lt.num_rows or not rt.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3, names=names)
        dim = lt["_d"][0].as_py()
        qi, xi = lt["_id"].to_numpy(), rt["_id"].to_numpy()
        a, b, score = best_in_block(_matrix(lt["_v"], dim), qi, _matrix(rt["_v"], dim), xi, k)
        return pa.table([pa.array(qi[a]), pa.array(xi[b]), pa.array(score.astype(np.int64))], names=names)

    found = (left.groupBy("_b", "_s", "_d").cogroup(right.groupBy("_b", "_s", "_d"))
             .applyInArrow(block, "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
