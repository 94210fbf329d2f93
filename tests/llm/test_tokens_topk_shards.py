"""Token counts, exact top-k search and sharding against brute force."""

import os
import random
import sys

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from helpers import by_id, docs_of, table, with_clashes  # noqa: E402

from konform.llm import sharding, token_prefix, topk  # noqa: E402
from konform.llm.queries import QUERIES  # noqa: E402
from konform.llm.ship import ship  # noqa: E402

VOCAB = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, " ", "a", "it's  x\n\n y's ''s 'sx don't 'll 're'd", "<|endoftext|>a<|endoftext|> b", "a  <|endoftext|>  b\n",
       "日本語テキスト 한국어 　x  y\x1c z", "a" * 3000, " \n\t " * 400, "é" * 50 + "́ ²³ ½", "same", "same", "x" * 10 + " 123456789 " * 50]


@pytest.fixture(scope="module")
def lib():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCAB)


def test_counts_equal_the_library(spark, lib):
    ship(spark)
    rnd = random.Random(3)
    fuzz = ["".join(rnd.choice("ab' sstre\n\tdéü1 2.!? 日<|endoftext|>’'llvm") for _ in range(rnd.randrange(60))) for _ in range(1500)]
    texts = ODD + fuzz
    got = by_id(token_prefix.count_tokens(with_clashes(docs_of(spark, texts)), VOCAB, limit=20))
    for i, t in enumerate(texts):
        want = len(lib.encode(t or "", add_special_tokens=False).ids)
        assert got[i]["n_tokens"] == want and got[i]["n_bytes"] == len((t or "").encode()) and got[i]["over_limit"] == (want > 20), t


def test_registered_query_covers_the_whole_table(spark, lib):
    got = by_id(QUERIES["op7_token_counts"](spark, "/root/testdata/sf0.001"))
    rows = table(spark, "documents").collect()
    assert len(got) == len(rows)
    want = lib.encode_batch([r["text"] or "" for r in rows], add_special_tokens=False)
    assert [got[r["doc_id"]]["n_tokens"] for r in rows] == [len(e.ids) for e in want]


def test_every_prefix_of_a_piece(lib):
    bpe = token_prefix.vocabulary(VOCAB)
    for piece in (b" unbelievable", b"antidisestablishment", b"aaaaaaaaaaaaaaaa", b" 1234567890", b"=" * 90):
        want = [len(lib.encode(piece[:i].decode(), add_special_tokens=False).ids) for i in range(len(piece) + 1)]
        assert bpe.prefix_counts(piece) == want


def test_cut_and_stored_prefixes(spark, lib):
    ship(spark)
    text = "The quick brown fox, it's jumping over 12345 lazy dogs. " * 30
    d = docs_of(spark, [text, "", None, "é" * 5000])
    cut = by_id(token_prefix.count_tokens(d, VOCAB, limit=50))[0]["cut_bytes"]
    assert len(lib.encode(text[:cut], add_special_tokens=False).ids) <= 50
    stored = token_prefix.prefix_table(d, VOCAB)
    r = stored.filter("doc_id = 0").select("piece_end", "tokens", token_prefix.tokens_within(F.col("piece_end"), F.col("tokens"), F.lit(cut)).alias("t")).first()
    assert r["t"] == 50 and r["tokens"][-1] == len(lib.encode(text, add_special_tokens=False).ids) and r["piece_end"][-1] == len(text)
    assert stored.filter("doc_id in (1, 2)").select(F.size("tokens")).collect() == [(0,), (0,)]
    assert token_prefix.count_tokens(d.limit(0), VOCAB).count() == 0


# ------------------------------------------------------------------------ top-k
def _brute(rows, k=5):
    ok = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    ints = [(i, np.floor(256 * np.array(v, np.float64)).astype(np.int64)) for i, v in ok]
    out = []
    for q, qv in {i: v for i, v in ints}.items():
        if q % 50 == 0:
            s = sorted(((-int(qv @ v), i) for i, v in ints if i != q and len(v) == len(qv)))[:k]
            out += [(q, r + 1, i, -m) for r, (m, i) in enumerate(s)]
    return sorted(out)


def _search(df):
    return sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 50 == 0).collect())


def test_large_components_are_scored_exactly(spark):
    rnd = random.Random(9)
    for size in (2.0 ** 17, 2.0 ** 20, 2.0 ** 21):                       # largest scores of 2**55, 2**61 and close to 2**63
        rows = [(i, [rnd.choice((-1, 1)) * size * rnd.random() for _ in range(24)]) for i in range(120)] + [(500, [size] * 24), (501, [size] * 24)]
        v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        whole = {i: [int(np.floor(256 * x)) for x in e] for i, e in rows}
        got = {}
        for r in topk.search(v, F.col("vec_id") % 10 == 0, k=5, scale=256).collect():
            got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
        for q in [i for i in whole if i % 10 == 0]:
            want = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q)[:5]
            assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(want)]


def test_a_score_beyond_a_long_fails(spark):
    v = spark.createDataFrame([(0, [1e19, 1.0]), (1, [1e19, 2.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit a long"):
        topk.search(v, F.col("vec_id") == 0, k=2).collect()


def test_topk_odd_rows(spark):
    ship(spark)
    rnd = np.random.default_rng(1)
    rows = [(i, rnd.normal(size=8).tolist()) for i in range(120)]
    rows += [(i, rows[3][1]) for i in range(120, 400)]                    # one vector again and again: ties
    rows += [(400, None), (401, [1.0] * 7 + [float("nan")]), (402, [1.0] * 7 + [None]), (403, [float("inf")] + [0.0] * 7), (None, [1.0] * 8),
             (450, [1.0, 2.0, 3.0]), (451, [1.0, 2.0, 4.0]), (7, rows[9][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert _search(with_clashes(df)) == _brute(rows)
    assert _search(df.filter("vec_id = 50")) == [] and _search(df.limit(0)) == []


def test_topk_blocks_and_slices(spark, monkeypatch):
    ship(spark)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "SLICE_ROWS", 100)
    df = table(spark, "embeddings")
    assert _search(df) == _brute([(r["vec_id"], r["embedding"]) for r in df.collect()])


def test_bounds_are_upper_bounds():
    rnd = np.random.default_rng(2)
    a, b = np.floor(rnd.normal(size=(40, 64)) * 40), np.floor(rnd.normal(size=(60, 64)) * 40)
    exact, last = a @ b.T, None
    for m in topk.LEVELS:
        bound = topk.segment_features(a, m) @ topk.segment_features(b, m).T
        assert (bound >= exact - 1e-6).all() and (last is None or (bound <= last + 1e-6).all())     # finer is tighter
        last = bound


# --------------------------------------------------------------------- sharding
def _check_law(rows, shards):
    per = {s: [] for s in range(shards)}
    for r in rows:
        per[r["shard"]].append(r["slot"])
    sizes = [len(v) for v in per.values()]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in per.values())


def test_shards_are_level_and_slots_gapless(spark):
    import zlib

    rows = QUERIES["op3_shard_ring"](spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    _check_law(rows, 40)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 16 and r["text_crc32"] == zlib.crc32(raw) and r["law"] == "rows" and r["grown_shard"] is None


def test_odd_rows_are_sharded_too(spark):
    d = docs_of(spark, ["a", None, "", "b" * 100_000, "a"])
    d = d.unionByName(d).unionByName(spark.createDataFrame([(None, "x", None, None, None)], d.schema))
    rows = sharding.shard_rows(with_clashes(d), shards=4, vnodes=3).collect()
    assert len(rows) == 11
    _check_law(rows, 4)
    assert sharding.shard_rows(d.limit(0), shards=4).count() == 0


def test_the_plan_of_the_ring_starts_no_python_worker(spark, monkeypatch):
    made, create = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **kw: made.append(create(*a, **kw)) or made[-1])
    d = spark.range(300).selectExpr("id AS doc_id", "concat('t', id) AS text")
    out = sharding.shard_rows(d, 4)
    assert made and not any("PythonRDD" in x._jdf.queryExecution().toRdd().toDebugString() for x in made)
    assert sorted(r["count"] for r in out.groupBy("shard").count().collect()) == [75] * 4


def test_ring_moves_few_keys_and_respects_bounds():
    def place(shards):
        points = sharding.ring_points(shards, 64)
        rnd = random.Random(5)
        counts = {a: rnd.randrange(20, 60) for a in range(len(points))}
        return points, counts, sharding.plan_stretches(counts, points, shards)

    points, counts, plan = place(10)
    total = sum(counts.values())
    got = [0] * 10
    covered = {a: 0 for a in counts}
    for s in plan:
        got[s.shard] += s.end - s.start
        covered[s.arc] += s.end - s.start
    assert covered == counts and max(got) - min(got) <= 1
    own = sum(s.end - s.start for s in plan if points[s.arc][1] == s.shard)
    assert own > 0.8 * total                                               # overflow is the exception


def _ring_brute(rows, shards, vnodes):
    """arc -> rows per shard, by walking the ring with bounds of the floor or ceiling of the mean."""
    points = sharding.ring_points(shards, vnodes)
    n = len(rows)
    room = [n // shards + (s < n % shards) for s in range(shards)]
    arcs = {}
    for pos in rows:
        a = next((k for k, (p, _) in enumerate(points) if p >= pos), 0)
        arcs[a] = arcs.get(a, 0) + 1
    placed = {a: {} for a in arcs}
    for first in (True, False):                                   # own shards fill up first, then overflow goes on clockwise
        for a in sorted(arcs):
            k = a
            while sum(placed[a].values()) < arcs[a] and (first or True):
                s = points[k][1]
                if room[s]:
                    room[s] -= 1
                    placed[a][s] = placed[a].get(s, 0) + 1
                elif first:
                    break
                else:
                    k = (k + 1) % len(points)
    return placed


def test_placement_equals_a_walk_around_the_ring(spark):
    d = table(spark, "documents")
    got = {}
    for r in sharding.assign(d, shards=7, vnodes=5).collect():
        got.setdefault(r["arc"], {}).setdefault(r["shard"], []).append(r["slot"])
    pos = [r["p"] for r in d.select(sharding.key_hash(F.col("doc_id")).alias("p")).collect()]
    assert {a: {s: len(x) for s, x in v.items()} for a, v in got.items()} == _ring_brute(pos, 7, 5)


def test_a_hot_id_is_dealt_like_any_rows(spark):
    d = docs_of(spark, ["x"] * 300, 0).withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, 7).when(F.col("doc_id") % 3 == 1, None).otherwise(F.col("doc_id")))
    rows = sharding.shard_rows(d, shards=6, vnodes=4).collect()
    _check_law(rows, 6)
    assert len(rows) == 300


def test_movement_to_one_more_shard_is_limited(spark):
    """With some slack only what the new shard takes and what overflows differently moves."""
    d = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    at = [{r["doc_id"]: r["shard"] for r in sharding.assign(d, shards=n, vnodes=64, slack=0.25).collect()} for n in (40, 41)]
    moved = [i for i in at[0] if at[0][i] != at[1][i]]
    assert 0 < len(moved) / 4000 < 3 / 41
