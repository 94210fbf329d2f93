"""Registered queries of the corpus operators: thin, whole tables, production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import decontaminate, mixing, near_dup, pii, ppm_language, prefix_trie, quality, sharding, suffix_dedup, term_pipeline, token_prefix, topk, wavelet
from .ship import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql.strip()
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op3_shard_ring")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), shards=40, vnodes=32)


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_prefix.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


@query("op1_pii_boosted")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.contract(pii.find(table(spark, sf_dir, "documents")))


@query("op2_topk_segments", """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e
  FROM embeddings WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


@query("op4_mixing_raked", mixing.oracle())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.probabilities(table(spark, sf_dir, "documents"))


@query("op8_decontaminate_align")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_quality_weak")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"))


@query("op5_suffix_lpf")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.measure(table(spark, sf_dir, "documents"), length=200)


@query("op6_language_ppm")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_language.identify(table(spark, sf_dir, "documents"))


@query("op10_near_dup_tensored")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op11_token_wavelet")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, f"token-files-{uuid.uuid4().hex}")
    wavelet.write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path, end_id=1)
    return wavelet.documents(spark, path).withColumnRenamed("id", "doc_id")


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""


@query("op12_term_pipeline", f"""
WITH t AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
p AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM p GROUP BY doc_id),
g AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
d AS (SELECT term, count(*) AS df FROM p GROUP BY term),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)),
s AS (
  SELECT q.item_id, p.doc_id,
         CAST(sum(CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT)
                  * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
  FROM q JOIN p ON p.term = q.term JOIN d ON d.term = q.term JOIN n ON n.doc_id = p.doc_id CROSS JOIN g
  GROUP BY q.item_id, p.doc_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_pipeline.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


_CRC = """xor(list_reduce([4294967295::BIGINT] || flatten([[ascii(x)::BIGINT] || list_value(-1, -1, -1, -1, -1, -1, -1, -1)
                                                          FOR x IN string_split(c::VARCHAR, '')]),
              lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"""


@query("op13_trie_contraction", f"""
WITH own AS (
  SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (SELECT c, turns, c - c % 100 AS b, {_CRC} % 6 AS h FROM own),
built AS (
  SELECT h.c, list_concat(list_slice(coalesce(o.turns, h.turns[:0]), 1, h), list_slice(h.turns, h + 1, len(h.turns))) AS s
  FROM h LEFT JOIN own o ON o.c = h.b
), steps AS (SELECT c, list_slice(s, 1, d) AS p, d, d = len(s) AS ends FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM built)),
node AS (
  SELECT p, d, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM steps GROUP BY p, d
), kids AS (SELECT list_slice(p, 1, d - 1) AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
own_values AS (
  SELECT node.*, coalesce(kids.n, 0) AS n_children, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * length(node.p[d].t) END AS saved
  FROM node LEFT JOIN kids ON kids.p = node.p
), totals AS (
  SELECT list_slice(p, 1, k) AS p, CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM own_values) GROUP BY 1
)
SELECT v.conv_id, v.d AS depth, up.conv_id AS parent_conv_id, v.n_convs, v.n_children, t.n_leaves, t.saved_tokens, v.ends_sha256
FROM own_values v JOIN totals t ON t.p = v.p LEFT JOIN node up ON v.d > 0 AND up.p = list_slice(v.p, 1, v.d - 1)
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))
