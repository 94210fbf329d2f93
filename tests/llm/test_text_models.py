"""Personal data, language identification, quality and mixing."""

import hashlib
import os
import re
import sys
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from helpers import SF, by_id, docs_of, table, with_clashes, words  # noqa: E402

from konform.llm import mixing, pii, ppm_language, quality  # noqa: E402
from konform.llm.queries import ORACLES, QUERIES  # noqa: E402
from konform.llm.ship import ship  # noqa: E402

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(t):
    """The base formats, straight from their patterns."""
    out = []
    for kind, p in BASE.items():
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else True,
                  "card": 16 <= len(d) <= 19 and pii.luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def check_pii(rows, texts):
    for i, t in texts.items():
        want, r = base_spans(t), rows[i]
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest(), (t, want, r["spans"])
        assert [r[f"n_{k}"] for k in BASE] == [sum(x[0] == k for x in want) for k in BASE]
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= set(r["spans"].split(","))


def test_base_spans_of_the_whole_table(spark):
    rows = by_id(QUERIES["op1_pii_boosted"](spark, SF))
    check_pii(rows, {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()})


def test_base_spans_of_odd_texts(spark):
    ship(spark)
    texts = ["", None, "a@b", "é a.b@c.d.e, x@@y.z x@y.z@w.v a@b.c@d.e.f", "@a.b ..@..@a.b", "1.2.3.4.5.6.7.8 999.1.1.1 0001.02.3.255 1.2.3",
             "4111 1111 1111 1111", "4111111111111111 4111111111111111", "4111-1111-1111-1112 41111111-11111111", "+1 (988) 555-2485. +12 +1234567 +1 2 3 4 5 6 7 8",
             "9" * 5000, "a" * 5000 + "@b.c", "日本 +49 30 1234567 日", "mail a＠b.de or foo [at] bar dot com", "x" * 100_000 + " a@b.co " + "y" * 100_000, "a@b.co", "a@b.co"]
    d = docs_of(spark, texts)
    check_pii(by_id(pii.contract(pii.find(with_clashes(d)))), dict(enumerate(texts)))
    assert pii.contract(pii.find(d.limit(0))).count() == 0
    twice = pii.contract(pii.find(d.unionByName(d)))
    assert twice.count() == 2 * len(texts)


def test_added_spans_rescue_joined_cards(spark):
    ship(spark)
    good = "4111111111111111"
    # true and false numbers in the same surroundings
    train = [f"card {n}, {i:05d}{i:05d} x" for i in range(500) for n in (good, 1000000000000000 + 7 * i)]
    got = by_id(pii.contract(pii.find(docs_of(spark, train + [f"card {good} {good} now"]))))[1000]
    assert got["n_card"] == 0 and "card:5:21" in got["spans"] and "card:22:38" in got["spans"]


def test_prose_is_no_email_and_spelled_out_ones_are(spark):
    ship(spark)
    train = [f"Please write to {a}{i}@{b}{i % 7}.com today about {c}." for i in range(100)
             for a, b, c in (("anna", "mill", "rent"), ("bo.li", "north-sea", "trams"), ("office", "shop", "it"))]
    prose = ["He was from at and. Of course inged at rewhre. In time", "We met at noon.\nRe the rest, look at that. It is", "the cat at home. No one"] * 10
    asked = ["Please write to jane [at] harbour [dot] com today.", "Please write to max at garden.com today about it.", "mail kim(at)lake.org now"]
    rows = by_id(pii.contract(pii.find(docs_of(spark, train + prose + asked))))
    n = len(train)
    assert all(rows[n + i]["spans"] == "" for i in range(len(prose)))
    want = ("jane [at] harbour [dot] com", "max at garden.com", "kim(at)lake.org")
    for i, (t, w) in enumerate(zip(asked, want)):
        assert rows[n + len(prose) + i]["spans"] == f"email:{t.index(w)}:{t.index(w) + len(w)}"
    assert all(rows[i]["n_email"] == 1 and rows[i]["n_added"] == 0 for i in range(n))


def test_a_kind_without_both_outcomes_is_not_calibrated(spark):
    held = spark.range(1, 400).selectExpr("'ip' AS kind", "0.9D AS _p", "1 AS label", "id * 4 AS _h").unionByName(
        spark.range(1, 400).selectExpr("'card' AS kind", "IF(id % 2 = 0, 0.9D, 0.1D) AS _p", "IF(id % 2 = 0, 1, 0) AS label", "id * 4 AS _h"))
    cut = pii.thresholds(held, 0.98)
    assert cut["ip"] == 2.0 and 0.1 < cut["card"] <= 0.9


# --------------------------------------------------------------------- language
def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = by_id(QUERIES["op6_language_ppm"](spark, sf))
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(rows) == len(docs)
    import zlib

    held = [r for r in docs if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(rows[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in docs)
    assert np.mean([rows[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_language_odd_rows(spark):
    ship(spark)
    d = docs_of(spark, ["the cat sat on the mat"] * 20).unionByName(docs_of(spark, ["der hund und die katze"] * 20, 20, "de"))
    odd = docs_of(spark, [None, "", "123 !!", "ß", "the " * 30_000], 40, None)
    rows = by_id(ppm_language.identify(with_clashes(d.unionByName(odd))))
    assert [rows[40 + i]["lang_pred"] for i in range(3)] == ["und"] * 3 and rows[40]["score"] == 0
    assert rows[44]["lang_pred"] == "en" and rows[43]["lang_pred"] in ("en", "de") and rows[0]["lang_pred"] == "en" and rows[25]["lang_pred"] == "de"
    assert {r["lang_pred"] for r in by_id(ppm_language.identify(odd)).values()} == {"und"}
    assert ppm_language.identify(d.limit(0)).count() == 0


def test_a_rare_language_keeps_its_own_tree(spark):
    ship(spark)
    hot = docs_of(spark, [" ".join(words(200, i)) for i in range(60)])
    rare = docs_of(spark, ["žluťoučký kůň úpěl ďábelské ódy"] * 2, 60, "cs")
    d = hot.unionByName(rare)
    model = ppm_language.train(d, F.lit(True), max_grams=1500)
    assert model.langs == ["cs", "en"] and all(len(t.keys[-1]) <= 1500 for t in model.trees)
    got = by_id(d.select("doc_id", ppm_language.predict(d, model)["lang_pred"].alias("lang_pred")))
    assert {got[60 + i]["lang_pred"] for i in range(2)} == {"cs"} and got[0]["lang_pred"] == "en"


def test_code_lengths_are_a_probability():
    texts = [b"abracadabra alakazam", b"lorem ipsum dolor"]
    gram = np.concatenate([ppm_language._windows(np.frombuffer(t, np.uint8), np.array([0, len(t)])) for t in texts]).astype(np.int64)
    lang = np.repeat([0, 1], [len(t) for t in texts])
    m = ppm_language.build(["a", "b"], lang, gram, np.ones(len(gram)))
    for context in (b"abr", b"zzz", b"lor", b"q\xffx"):
        cost = np.array([m.code_lengths(np.frombuffer(context + bytes([s]), np.uint8), np.array([0, 4]))
                         - m.code_lengths(np.frombuffer(context, np.uint8), np.array([0, 3])) for s in range(256)])
        assert np.allclose(np.exp2(-cost).sum(0), 1, atol=1e-4)            # over all next bytes


# ---------------------------------------------------------------------- quality
def test_quality_agrees_with_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    rows = by_id(QUERIES["op9_quality_weak"](spark, sf))
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    good = [rows[r["doc_id"]]["kept"] for r in labels if r["quality"] == 1]
    bad = [rows[r["doc_id"]]["kept"] for r in labels if r["quality"] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_quality_odd_rows(spark):
    ship(spark)
    clean = [" ".join(words(60, i)).capitalize() + ". And so on." for i in range(60)]
    junk = ["BUY NOW!! " * 40] * 15 + ["word " * 200] * 5
    odd = [None, "", "  \n ", "x", "a " * 60_000]
    d = docs_of(spark, clean + junk + odd)
    rows = by_id(quality.classify(with_clashes(d)))
    assert all(rows[i]["kept"] for i in range(60)) and not any(rows[i]["kept"] for i in range(60, 80))
    assert not any(rows[80 + i]["kept"] for i in range(3)) and not rows[84]["kept"]
    kept = quality.keep_good(with_clashes(d))
    assert kept.columns == with_clashes(d).columns and kept.count() == sum(r["kept"] for r in rows.values())
    assert quality.classify(d.limit(0)).count() == 0
    assert quality.classify(docs_of(spark, ["one text only. It is short."])).count() == 1


def test_scans_hold_little_of_a_batch_at_once(spark):
    ship(spark)
    texts = [" ".join(words(4000, i)) for i in range(500)]          # about 12 MB in one partition
    d = docs_of(spark, texts).coalesce(1)
    assert quality.keep_good(d).count() <= len(texts)

    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.nbytes])], names=["n"])

    got = [r["n"] for r in d.select("text").mapInArrow(sizes, "n long").collect()]
    assert sum(got) > 10_000_000 and max(got) < 6_000_000


def test_memory_of_a_quality_scan_is_bounded_by_its_chunk():
    col = pa.array([" ".join(words(500, i)) for i in range(1500)])   # about 4 MB
    quality.patterns(col.slice(0, 200))
    tracemalloc.start()
    got = quality.patterns(col)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32_000_000
    one = pa.concat_arrays([quality.patterns(col.slice(i, 1)) for i in range(0, 1500, 50)])
    assert got.take(pa.array(range(0, 1500, 50))).equals(one)


def test_em_finds_the_accurate_labellers():
    rnd = np.random.default_rng(4)
    n, k = 20_000, len(quality.LABELLERS)
    truth = rnd.random(n) < 0.8
    acc = np.linspace(0.95, 0.6, k)
    votes = np.where(rnd.random((n, k)) < 0.3, 0, np.where(rnd.random((n, k)) < acc, np.where(truth, 1, -1)[:, None], np.where(truth, -1, 1)[:, None]))
    p, c = np.unique(quality.pattern_of(votes), return_counts=True)
    _, table_, share = quality.fit_labellers(p, c.astype(float))
    told = table_[:, 1, 2] / (table_[:, 1, 2] + table_[:, 1, 0])            # P(good | voted, good)
    assert abs(share - 0.8) < 0.05 and np.abs(told - acc).max() < 0.06


def test_overlaps_by_binary_search():
    import random

    rnd = random.Random(2)
    at, spans = 0, []
    for _ in range(200):
        at += rnd.randrange(0, 5)
        spans.append((at, at := at + rnd.randrange(1, 6)))
    index = pii.Spans(spans)
    for _ in range(500):
        a = rnd.randrange(0, at)
        b = a + rnd.randrange(1, 30)
        assert index.overlapping(a, b) == sum(x < b and a < y for x, y in spans)


def test_thousands_of_candidates_in_one_text(spark):
    """One text with many candidates of every kind: base spans stay, what is added overlaps none of its kind, and all count."""
    ship(spark)
    lines = [f"mail u{i}@host{i}.example.com or u{i} at host{i}.example.org, call +31 (0)20 555-{i:04d}, from 10.{i % 256}.2.3, pay 4111 1111 1111 {i:04d}" for i in range(3000)]
    train = [f"user{i}@mail{i}.example.com and 4111111111111111 or 4111111111111112 at 1.2.3.{i} or 1.2.3.999" for i in range(60)]
    rows = by_id(pii.find(docs_of(spark, ["\n".join(lines)] + train)))
    spans = rows[0]["spans"]
    assert sum(s["base"] and s["kind"] == "email" for s in spans) == 3000 and sum(s["base"] and s["kind"] == "ip" for s in spans) == 3000
    for kind in pii.KINDS:
        own = [s for s in spans if s["kind"] == kind]
        assert all(x["end"] <= y["start"] for x, y in zip(own, own[1:]))
    got = by_id(pii.contract(pii.find(docs_of(spark, train))))
    assert all(r["n_spans"] == r["n_added"] + r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] for r in got.values())


# ----------------------------------------------------------------------- mixing
def test_mixing_equals_its_sql(spark):
    got = QUERIES["op4_mixing_raked"](spark, SF).toPandas()
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    want = con.sql(ORACLES["op4_mixing_raked"]).df()
    c = sorted(want.columns)
    assert got[c].sort_values(c).reset_index(drop=True).equals(want[c].sort_values(c).reset_index(drop=True))


def test_raked_marginals_meet_their_targets(spark):
    cells = spark.createDataFrame([(s, lg, t, 10 * (i + 1)) for i, (s, lg, t) in enumerate(
        (s, lg, t) for s in "abc" for lg in ("en", "de") for t in ("x", "y"))], "_source string, _lang string, _topic string, tokens long")
    targets = {"lang": {"en": 0.7, "de": 0.3, "xx": 9.0}, "topic": {"x": 1.0, "y": 3.0}}
    out = mixing.rake(cells, power={"source": 0.0}, targets=targets, rounds=30).toPandas()
    total = out.tokens.sum()
    assert np.allclose(out.groupby("_lang").weight.sum() / total, [0.3, 0.7]) and np.allclose(out.groupby("_topic").weight.sum() / total, [0.25, 0.75])
    assert np.allclose(out.groupby("_source").weight.sum() / total, 1 / 3)


def test_one_stray_cell_beside_a_large_corpus(spark):
    """A row of a new source and language changes its own cell, not what is drawn of the others."""
    d = docs_of(spark, ["a b c d e f g h"] * 300, 0, "en", "x").unionByName(docs_of(spark, ["a b c @ e f"] * 200, 1000, "de", "y")) \
        .unionByName(docs_of(spark, ["k l m n"] * 100, 2000, "de", "x"))
    shares = []
    for docs in (d, d.unionByName(docs_of(spark, ["ciao"], 9999, "it", "new"))):
        rows = [r for r in mixing.probabilities(docs).collect()]
        expected = sum(r["tokens"] * r["probability"] for r in rows) / sum(r["tokens"] for r in rows)
        assert expected == pytest.approx(mixing.KEEP, abs=1e-6)
        shares.append(np.mean([r["probability"] for r in rows if r["doc_id"] != 9999]))
    assert abs(shares[0] - shares[1]) < 0.01


def test_margins_report_what_was_reached(spark):
    cells = spark.createDataFrame([("a", "en", "x", 50), ("a", "de", "x", 30), ("b", "en", "x", 40), ("c", "it", "x", 1)],
                                  "_source string, _lang string, _topic string, tokens long")
    rows = {(r["margin"], r["value"]): (r["target"], r["reached"]) for r in mixing.margins(mixing.rake(cells)).collect()}
    assert rows["topic", "x"] == (1.0, pytest.approx(1.0))
    # source c and language it are one cell with two targets: one of them is not attainable
    assert min(abs(np.subtract(*rows["source", "c"])), abs(np.subtract(*rows["lang", "it"]))) < 1e-3
    assert abs(rows["source", "a"][0] - rows["source", "a"][1]) < 0.02


def test_mixing_odd_rows(spark):
    d = docs_of(spark, [None, "", "a b c", "a b c", "x@y " * 50_000], lang=None)
    d = d.unionByName(d).unionByName(docs_of(spark, ["one two"] * 50, 10, "de", None))
    rows = mixing.probabilities(with_clashes(d)).collect()
    assert len(rows) == 60 and all(0 <= r["probability"] <= 1 for r in rows)
    assert all(r["probability"] == 0 and not r["drawn"] and r["topic"] == "empty" for r in rows if r["doc_id"] in (0, 1))
    drawn = mixing.draw(with_clashes(d))
    assert drawn.columns == with_clashes(d).columns and drawn.count() == sum(r["drawn"] for r in rows)
    assert mixing.probabilities(d.limit(0)).count() == 0
    everything = mixing.mix(d, rate=1e9).filter("_tokens > 0")
    assert everything.filter("not _drawn").count() == 0
    share = np.mean([r["u"] < 0.3 for r in spark.range(4000).select(mixing.draw_number(F.col("id")).alias("u")).collect()])
    assert share == pytest.approx(0.3, abs=0.03)
