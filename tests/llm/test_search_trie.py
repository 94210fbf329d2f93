"""Ranked search and the conversation trie against brute force on small fixtures and the whole small tables."""

import hashlib
import math
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from helpers import SF, docs_of, with_clashes  # noqa: E402

from konform.llm import prefix_trie, term_pipeline  # noqa: E402
from konform.llm.queries import ORACLES, QUERIES  # noqa: E402
from konform.llm.ship import ship  # noqa: E402

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, k):
    """item index -> [(score, doc)] by the definition."""
    tf = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, total = sum(1 for _, c in tf if c), sum(sum(c.values()) for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    out = []
    for _, text in items:
        rows = []
        for d, c in tf:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if s > 0:
                rows.append((-s, d is None, d or 0))
        out.append([(-s, None if none else d) for s, none, d in sorted(rows)[:k]])
    return out


def oracle(name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(ORACLES[name])
    names = [c[0] for c in cur.description]
    return [dict(zip(names, r)) for r in cur.fetchall()]


def same_rows(df, want):
    names = sorted(want[0])
    assert sorted(df.columns) == names
    key = lambda rows: sorted((tuple(r[n] for n in names) for r in rows), key=repr)
    assert key(r.asDict() for r in df.collect()) == key(want)


@pytest.mark.parametrize("name", ["op12_term_pipeline", "op13_trie_contraction"])
def test_registered_queries_equal_their_sql(spark, name):
    same_rows(QUERIES[name](spark, SF), oracle(name))


def test_search_equals_brute_force(spark, monkeypatch):
    ship(spark)
    rnd = random.Random(11)
    vocab = [f"{w}{i}" for i in range(120) for w in ("Ab", "é", "z")]
    texts = [" ".join(rnd.choice(vocab[: rnd.choice((5, 40, 360))]) for _ in range(rnd.randrange(1, 60))) for _ in range(300)]
    texts += [None, "", " .,! ", "AB0-ab0_Ab0 É0 é0", "common " * 5000, *["same words here Ab1 z3"] * 40]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, "Ab1 z1 no id"), (3, "Ab1 z1 repeated id")]
    items = [(i, " ".join(rnd.sample(vocab, rnd.randrange(1, 30)))) for i in range(20)]
    items += [(50, None), (51, ""), (52, "unseen"), (53, "Ab1 z3"), (53, "common same"), (None, "Ab2"), (54, "Ab2 ab2 AB2")]
    monkeypatch.setattr(term_pipeline, "BUNDLE_ITEMS", 8)
    monkeypatch.setattr(term_pipeline, "BLOCK_ITEMS", 15)
    monkeypatch.setattr(term_pipeline, "SEGMENT_DOCS", 64)
    d = with_clashes(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], docs_of(spark, []).schema))
    q = spark.createDataFrame(items, "item_id long, text string")
    got = defaultdict(list)
    for r in term_pipeline.search(d, q, k=7).orderBy("rank").collect():
        got[r["item_id"]].append((r["rank"], r["score"], r["doc_id"]))
    want = defaultdict(list)
    for (i, _), rows in zip(items, ranked(docs, items, 7)):
        if rows:
            want[i] += [(n + 1, s, x) for n, (s, x) in enumerate(rows)]
    assert {i: sorted(v, key=repr) for i, v in got.items()} == {i: sorted(v, key=repr) for i, v in want.items()}


def test_search_of_nothing(spark):
    ship(spark)
    d, q = docs_of(spark, ["a b", None]), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert term_pipeline.search(d.limit(0), q).collect() == []
    assert term_pipeline.search(d, q.limit(0)).collect() == []
    assert term_pipeline.search(docs_of(spark, [None, "", "!!"]), q).collect() == []


def brute_trie(rows):
    """The trie by its definition, from (conv, turn, role, text) rows."""
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append(((t is not None, t or 0), r or "", x or ""))
    own = {c: [(r, x) for _, r, x in sorted(v, key=lambda z: z[0])] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, c - int(math.fmod(c, 100))
        built[c] = tuple(own.get(base, [])[:h] + v[h:])
    members = defaultdict(list)
    for c, s in built.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return [{"conv_id": min(m), "depth": len(p), "parent_conv_id": min(members[p[:-1]]) if p else None, "n_convs": len(m), "n_children": kids[p],
             "n_leaves": leaves[p], "saved_tokens": saved[p],
             "ends_sha256": hashlib.sha256(",".join(str(c) for c in sorted(m) if built[c] == p).encode()).hexdigest()} for p, m in members.items()]


TURNS = "conv_id long, turn long, role string, text string"


def test_trie_equals_brute_force(spark):
    ship(spark)
    rnd = random.Random(4)
    rows = []
    for c in [*range(0, 260), *range(-130, -90), 0x7FFFFFFF00, *range(5000, 5040)]:
        rows += [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["", None, "hi", "é日", "longer text"])) for t in range(rnd.randrange(1, 9))]
    rows += [(900, t, "user", f"chain {t % 50}") for t in range(260)] + [(901, t, "user", f"chain {t % 50}") for t in range(250)]       # long unary chains
    rows += [(c, t, "user", "the same") for c in range(1000, 1100) for t in range(3)]                                               # equal conversations
    rows += [(2000, None, "user", "null turn first"), (2000, 0, "user", "x"), (None, 0, "user", "no conversation"), (2001, 7, "a", "tie"), (2001, 7, "a", "tie")]
    rnd.shuffle(rows)
    got = prefix_trie.trie(with_clashes(spark.createDataFrame(rows, TURNS).repartition(7)))
    same_rows(got, brute_trie(rows))


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    ship(spark)
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).collect() == []
    c = next(i for i in range(1, 100) if zlib.crc32(str(i).encode()) % 6 >= 2)
    rows = [(c, 0, "user", "gone: within the first turns, and there is no base")]
    same_rows(prefix_trie.trie(spark.createDataFrame(rows, TURNS)), brute_trie(rows))
