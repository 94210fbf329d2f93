"""Near-duplicates, repeated passages, decontamination and the pipeline against brute force."""

import hashlib
import os
import random
import re
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from helpers import SF, by_id, docs_of, table, with_clashes, words  # noqa: E402

import corpus_pipeline  # noqa: E402
from konform.llm import decontaminate, mixing, near_dup, quality, suffix_dedup  # noqa: E402
from konform.llm.components import components  # noqa: E402
from konform.llm.queries import QUERIES  # noqa: E402
from konform.llm.ship import ship  # noqa: E402

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_brute(rows):
    """id -> smallest id reachable, over all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    inv = {}
    for n, (i, s) in enumerate(sets):
        near = {}
        for x in s:
            for m in inv.setdefault(x, []):
                near[m] = near.get(m, 0) + 1
            inv[x].append(n)
        for m, both in near.items():
            if 100 * both >= 75 * (len(s) + len(sets[m][1]) - both):
                a, b = find(i), find(sets[m][0])
                up[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in rows}, {i: len(s) for i, s in sets}


def check_near(df, rows):
    got = by_id(df)
    want, sizes = near_brute(rows)
    assert {i: got[i]["component_id"] for i in want} == want
    assert all(got[i]["n_shingles"] == sizes[i] and got[i]["kept"] == (want[i] == i) for i in want)


def edited(base, share, seed):
    rnd = random.Random(seed)
    return " ".join(w if rnd.random() > share else f"e{rnd.randrange(10**6)}" for w in base)


def test_near_duplicates_of_the_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, "documents").collect()]
    check_near(QUERIES["op10_near_dup_tensored"](spark, SF), rows)


@pytest.mark.parametrize("chunk", [128, 6])
def test_groups_of_any_size(spark, monkeypatch, chunk):
    """Copies at mixed distances: some match the centre, some only each other; small chunks take every path."""
    ship(spark)
    monkeypatch.setattr(near_dup, "CHUNK", chunk)
    base, other = words(150, 1), words(90, 2)
    texts = [edited(base, s, i) for i, s in enumerate([0, .01, .02, .03, .04, .05, .06, .08] * 6)]
    texts += [edited(other, .01, 100 + i) for i in range(9)] + [" ".join(other)] * 5 + [" ".join(words(80, 300 + i)) for i in range(20)]
    check_near(near_dup.near_duplicates(docs_of(spark, texts)), list(enumerate(texts)))


def test_off_centre_group_and_number_of_links(spark, monkeypatch, tmpdir_path):
    """500 copies that mostly miss the centre, in many chunks: no pair is lost, and links stay below members."""
    ship(spark)
    monkeypatch.setattr(near_dup, "CHUNK", 16)
    base, centre = words(120, 5), words(120, 5)
    for i in range(0, 120, 9):
        centre[i] = f"c{i}"
    # the centre's own few copies, a large cluster around the base it is half similar to, and strays between the two
    texts = [" ".join(centre)] + [edited(centre, .01, i) for i in range(30)]
    texts += [edited(base, .015 if i % 5 else .05, 1000 + i) for i in range(470)]
    rows = list(enumerate(texts))
    check_near(near_dup.near_duplicates(docs_of(spark, texts)), rows)
    docs = docs_of(spark, texts)
    sets = near_dup.signatures(docs, "doc_id", "text")
    classes = sets.groupBy("n", "d1", "d2").agg(F.min("k").alias("rep"), F.any_value("c").alias("c"))
    groups = near_dup.groups_of(classes, f"{tmpdir_path}/a").count()
    assert near_dup.links_of(docs, classes, "doc_id", "text", f"{tmpdir_path}/b").count() <= 4 * groups


def test_forests_have_fewer_links_than_members():
    same = [np.arange(100, dtype=np.uint64) + np.uint64(k % 3) for k in range(64)]
    links, open_ = near_dup._links_of_chunk([999, *range(64)], [np.arange(5000, 5100, dtype=np.uint64), *same])
    assert len(links) == 63 and open_ == list(range(1, 65))
    links = near_dup._links_of_blocks(list(range(32)), [7] * 32, same[:32], list(range(32, 64)), [8] * 32, same[32:])
    assert len(links) == 1


def test_rows_that_share_an_id_are_judged_by_their_texts(spark):
    ship(spark)
    a, b, c = words(60, 1), words(60, 2), words(60, 3)
    near = lambda w: " ".join([*w[:-1], "other"])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a)), (3, near(b)), (3, " ".join(c)), (4, near(c)), (5, "alone in the world with five words")]
    rows += [(6, " ".join(a))] * 40
    d = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], docs_of(spark, []).schema)
    got = sorted((r["doc_id"], r["component_id"]) for r in near_dup.near_duplicates(d).collect())
    assert got == sorted([(1, 1), (1, 1), (2, 1), (3, 1), (3, 3), (4, 3), (5, 5)] + [(6, 1)] * 40)


def test_near_duplicate_odd_rows(spark):
    ship(spark)
    texts = [None, "", " \t\n", "one two", "ONE  two", "One three", "a b c d e", "A B\vC D E", "ÄB c d e f", "äB c d e f",
             "w " * 50_000, "w " * 40_000, "x" * 200_000]
    d = docs_of(spark, texts)
    check_near(near_dup.near_duplicates(with_clashes(d)), list(enumerate(texts)))
    kept = near_dup.keep_first(with_clashes(d))
    assert kept.columns == with_clashes(d).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, c in near_brute(list(enumerate(texts)))[0].items() if i == c]
    assert near_dup.near_duplicates(d.limit(0)).count() == 0
    twice = d.unionByName(d).unionByName(d.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    assert near_dup.near_duplicates(twice).count() == 27 and near_dup.keep_first(twice).filter("doc_id is null").count() == 1


def test_components_of_paths_and_stars(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_of_members_to_many_hubs_are_thinned_to_the_nodes(spark, tmpdir_path):
    from konform.llm.components import thinned

    pairs = [(hub, 1000 + k) for hub in range(40) for k in range(200)] + [(5000, 5001)]
    rng = random.Random(3)
    pairs += [(x, y) for x, y in ((rng.randrange(6000, 6300), rng.randrange(6000, 6300)) for _ in range(250)) if x != y]
    edges = spark.createDataFrame([(max(p), min(p)) for p in {tuple(sorted(p)) for p in pairs}], "u long, v long")
    few = [(r["u"], r["v"]) for r in thinned(edges, tmpdir_path).collect()]
    assert len(few) < 600                                      # of more than 8000 links
    up = {x: x for p in pairs for x in p}
    while any(up[x] != up[y] for x, y in pairs):
        for x, y in pairs:
            up[x] = up[y] = min(up[x], up[y])
    assert {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()} == up


# -------------------------------------------------------------- repeated passages
def cover(texts, length, earlier=False):
    """Bytes covered by strings that occur elsewhere (or: before), straight from the definition."""
    places = {}
    for d, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            places.setdefault(t[i:i + length], []).append((d, i))
    out = []
    for d, t in enumerate(texts):
        m = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            at = places[t[i:i + length]]
            if (at[0] != (d, i)) if earlier else len(at) > 1:
                m[i] += 1
                m[i + length] -= 1
        out.append(np.cumsum(m)[:-1] > 0)
    return out


def check_removed(df, texts, length, earlier=False):
    got = by_id(df)
    for i, c in enumerate(cover(texts, length, earlier)):
        kept = bytes(np.frombuffer(texts[i], np.uint8)[~c])
        edges = int((c[1:] & ~c[:-1]).sum() + c[:1].sum())
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"]) == \
            (len(texts[i]), int(c.sum()), edges, hashlib.sha256(kept).hexdigest()), i


def test_repeats_of_the_whole_table(spark):
    texts = [(r["text"] or "").encode() for r in table(spark, "documents").orderBy("doc_id").collect()]
    check_removed(QUERIES["op5_suffix_lpf"](spark, SF), texts, 200)


PASSAGE = " ".join(words(60, 9))


def odd_passages():
    line = " ".join(words(25, 11)) + " common line of every page "
    out = [None, "", "a" * 199, "a" * 200, "a" * 900, "ab" * 300, PASSAGE, "é" * 150, "xé" * 120]
    out += [" ".join(words(40, 20 + i)) + " " + PASSAGE + " " + " ".join(words(40, 50 + i)) for i in range(4)]
    out += [" ".join(words(30, 90 + i)) + " " + PASSAGE[:201 + i] + "|" + " ".join(words(20, 130 + i)) for i in range(-3, 4)]
    out += [f"{i} {line}" + " ".join(words(30, 400 + i % 7)) for i in range(30)]
    return out + [PASSAGE * 2, PASSAGE]


@pytest.mark.parametrize("bucket_bytes", [4 << 20, 0])
def test_repeats_by_sorting_and_by_grouping(spark, monkeypatch, bucket_bytes):
    ship(spark)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", bucket_bytes)
    texts = odd_passages()
    raw = [(t or "").encode() for t in texts]
    d = with_clashes(docs_of(spark, texts))
    check_removed(suffix_dedup.measure(d), raw, 200)
    check_removed(suffix_dedup.measure(d, earlier=True), raw, 200, earlier=True)


def test_cut_repeats_keeps_the_first(spark, monkeypatch):
    ship(spark)
    monkeypatch.setattr(suffix_dedup, "SLICE", 5000)                     # long texts are scanned in slices
    long = " ".join(words(9000, 5))
    d = docs_of(spark, [PASSAGE, "before " + PASSAGE + " after", long, "z " + long, "short"])
    got = by_id(suffix_dedup.cut_repeats(with_clashes(d)))
    assert got[0]["text"] == PASSAGE and got[2]["text"] == long and got[4]["text"] == "short"
    assert len(got[1]["text"]) < 16 and len(got[3]["text"]) < 4 and len(got[3]["cut_spans"]) == 1
    empty = suffix_dedup.measure(d.limit(0))
    assert empty.count() == 0
    twice = suffix_dedup.measure(docs_of(spark, [PASSAGE]).unionByName(docs_of(spark, [PASSAGE])))
    assert [r["n_removed"] for r in twice.collect()] == [len(PASSAGE)] * 2


def test_longest_previous_factors():
    rnd = random.Random(8)
    text = bytes(rnd.choice(b"ab") for _ in range(400))
    length = 32
    order = suffix_dedup.SuffixOrder([text[:250], text[150:]], np.array([250 - length + 1, 250 - length + 1]), length)
    lpf, lnf = suffix_dedup.longest_factors(order, np.arange(len(order.at)))
    strings = [bytes(order.data[a:a + length]) for a in order.at]
    common = lambda x, y: next((k for k in range(length) if x[k] != y[k]), length)
    for i in range(0, len(strings), 7):
        assert lpf[i] == max((common(strings[i], s) for s in strings[:i]), default=0)
        assert lnf[i] == max((common(strings[i], s) for s in strings[i + 1:]), default=0)


# --------------------------------------------------------------- decontamination
ITEMS = [" ".join(words(n, 700 + n)) for n in (60, 30, 12, 450)] + ["two words", None, "", "the cat, the cat, the cat. the cat"]


def items_of(spark, items=ITEMS):
    return spark.createDataFrame(list(enumerate(items)), "item_id long, text string")


def test_copies_and_edited_copies_are_found(spark):
    ship(spark)
    around = lambda i: " ".join(words(150, 800 + i))
    texts = [around(0), f"{around(1)} {ITEMS[0]} {around(2)}", f"{around(3)} {ITEMS[1].upper().replace(' ', ', ')}.",
             f"{around(4)} {edited(ITEMS[0].split(), .15, 3)} {around(5)}", ITEMS[2], f"{around(6)} " + " ".join(ITEMS[3].split()[100:330]),
             "two words", "other two words here", None, "", f"{around(8)} {ITEMS[0]} {ITEMS[0]} {ITEMS[1]}",
             f"{around(9)} " + " ".join(w for k, w in enumerate(ITEMS[0].split()) if k % 6), "the cat sat"] + [around(20 + i) for i in range(80)]
    d = docs_of(spark, texts)
    got = sorted({(r["doc_id"], r["item_id"]) for r in decontaminate.find(with_clashes(d), items_of(spark)).collect()})
    want = [(1, 0), (2, 1), (3, 0), (4, 2), (5, 3), (6, 4), (10, 0), (10, 1), (11, 0)]
    assert [g for g in got if g[1] != 4] == [w for w in want if w[1] != 4] and (6, 4) in got
    clean = decontaminate.keep_clean(with_clashes(d), items_of(spark))
    assert clean.columns == with_clashes(d).columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(set(range(len(texts))) - {g[0] for g in got})
    assert decontaminate.find(d.limit(0), items_of(spark)).count() == 0
    assert decontaminate.find(d, items_of(spark, [])).count() == 0
    assert decontaminate.find(d.unionByName(d), items_of(spark)).count() == 2 * len(got)


def test_edited_copies_in_a_third_of_the_documents(spark):
    """Frequent seeds are all that edited and partial copies hold."""
    ship(spark)
    item = words(60, 900)
    copies = [" ".join("x" if k % 8 == 3 else w for k, w in enumerate(item)), " ".join(item[:35])]
    texts = [" ".join(words(80, 1000 + i)) + (f" {copies[i % 2]}" if i % 3 == 0 else "") for i in range(120)]
    d, b = docs_of(spark, texts), items_of(spark, [" ".join(item)])
    want = list(range(0, 120, 3))
    assert sorted(r["doc_id"] for r in decontaminate.find(d, b).collect()) == want
    assert sorted(r["doc_id"] for r in decontaminate.keep_clean(d, b).collect()) == [i for i in range(120) if i not in want]


def test_few_meetings_at_once_give_the_same(monkeypatch):
    import pyarrow as pa

    item = words(60, 900)
    texts = pa.array([" ".join(words(20, i) + item[i:] + words(20, 50 + i)) for i in range(9)])
    ix = decontaminate.index_items(np.array([7]), pa.array([" ".join(item)]))
    (_, _, data, off), = decontaminate.tv.chunks(texts)
    whole = decontaminate.matches(ix, data, off)
    monkeypatch.setattr(decontaminate, "PAIRS", 1)
    assert decontaminate.matches(ix, data, off) == whole and [m[0] for m in whole] == list(range(9))


def test_threshold_edits_equal_the_alignment_of_everything(spark):
    """Whatever a full alignment of item and text counts is found, with as few intact seeds as the identity allows."""
    ship(spark)
    rnd = random.Random(6)
    items = [words(n, 500 + n) for n in (8, 9, 10, 12, 13, 16, 21, 40, 90)]
    texts = [" ".join("x" if k % 3 == 2 and k < 9 else w for k, w in enumerate(items[3]))]              # 9 of 12 words, one seed whole
    for w in items:
        for every in (3, 4, 5, 9):
            for cut in (0, len(w) // 3):
                copy = [f"e{rnd.randrange(99)}" if k % every == every - 1 else x for k, x in enumerate(w[cut:])]
                texts.append(" ".join(words(rnd.randrange(20), rnd.randrange(10**6)) + copy + words(rnd.randrange(20), rnd.randrange(10**6))))
        texts.append(" ".join(x for k, x in enumerate(w) if k % 5))                                      # words left out
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find(docs_of(spark, texts), items_of(spark, [" ".join(w) for w in items])).collect()}
    assert (0, 3) in got
    for i, text in enumerate(texts):
        t = np.array([hash(x) for x in text.split()])
        for j, item in enumerate(items):
            w = np.array([hash(x) for x in item])
            _, equal, columns, _, _ = decontaminate.align(w, t)
            least = max(-(-len(w) // 2), min(len(w), decontaminate.LEAST_WORDS))
            assert ((i, j) in got) == (equal >= least and equal >= decontaminate.IDENTITY * columns), (i, j)


def test_one_word_over_and_over(spark, monkeypatch):
    """Items and a long text of one repeated word: meetings are split, alignments stay the same."""
    ship(spark)
    monkeypatch.setattr(decontaminate, "PAIRS", 50_000)
    items = ["same " * n for n in (10, 50, 199, 450)] + ["other words altogether here"]
    texts = ["same " * 60_000, "same " * 30, " ".join(words(300, 1)) + " same" * 260]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find(docs_of(spark, texts), items_of(spark, items)).collect()}
    assert got == {(0, 0), (0, 1), (0, 2), (0, 3), (1, 0), (1, 1), (2, 0), (2, 1), (2, 2), (2, 3)}


def test_a_copy_across_slices_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SLICE_WORDS", 700)
    item = words(150, 3)
    import pyarrow as pa
    ix = decontaminate.index_items(np.array([7]), pa.array([" ".join(item)]))
    for at in (0, 80, 90, 100, 555, 699, 700, 2000):
        text = " ".join(words(at, 8) + item + words(900, 9))
        (_, _, data, off), = decontaminate.tv.chunks(pa.array([text]))
        (found,) = decontaminate.matches(ix, data, off)
        assert found[:4] == (0, 7, 1.0, 1.0) and text[found[5]:found[6]] == " ".join(item)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    ship(spark)
    d, b = table(spark, "documents"), table(spark, "benchmark")
    key = lambda df: sorted(tuple(r) for r in df.collect())
    whole = key(decontaminate.find(d, b))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 100)
    assert key(decontaminate.find(d, b)) == whole
    norm = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    texts = {r["doc_id"]: norm(r["text"] or "") for r in d.collect()}
    exact = {(i, r["item_id"]) for r in b.collect() for i, t in texts.items() if norm(r["text"]) in t}
    assert exact and exact == {(r[0], r[1]) for r in whole}


def test_alignment_against_the_full_recurrence():
    rnd = random.Random(3)
    for _ in range(30):
        a = np.array([rnd.randrange(4) for _ in range(rnd.randrange(1, 14))], np.uint64)
        b = np.array([rnd.randrange(4) for _ in range(rnd.randrange(1, 18))], np.uint64)
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        score, equal, columns, lo, hi = decontaminate.align(a, b)
        assert score == h.max() and equal <= columns and 0 <= lo <= hi <= len(b)


# ----------------------------------------------------------------------- pipeline
def test_pipeline_equals_its_parts(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dup", "decontaminate", "mixing", "sharding"]
    docs = table(spark, "documents")
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    step = {}
    for k, (name, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        step[name] = (docs, spark.read.parquet(f"{tmp_path}/{k}"))
        docs = step[name][1]
        if name != "sharding":
            assert docs.columns == step[name][0].columns
    before, after = step["quality"]
    assert ids(after) == sorted(i for i, r in by_id(quality.classify(before)).items() if r["kept"])
    before, after = step["near_dup"]
    want, _ = near_brute([(r["doc_id"], r["text"]) for r in before.collect()])
    assert ids(after) == sorted(i for i, c in want.items() if i == c)
    before, after = step["decontaminate"]
    norm = lambda t: " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "
    items = [norm(r["text"]) for r in table(spark, "benchmark").collect()]
    assert ids(after) == sorted(r["doc_id"] for r in before.collect() if not any(i in norm(r["text"]) for i in items))
    before, after = step["mixing"]
    assert ids(after) == sorted(r["doc_id"] for r in mixing.probabilities(before).collect() if r["drawn"])
    before, after = step["sharding"]
    assert ids(after) == ids(before)
    final = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, final.collect())) == sorted(map(tuple, after.collect())) and stages["sharding"]


def test_texts_are_scanned_once_for_runs(spark, monkeypatch):
    ship(spark)
    seen, plain = spark.sparkContext.accumulator(0), suffix_dedup.runs

    def counted(rows, length):
        def tick(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b

        return plain(rows.mapInArrow(tick, rows.schema), length)

    monkeypatch.setattr(suffix_dedup, "runs", counted)
    shared = " ".join(words(80, 5))
    texts = [" ".join(words(60, 10 + k)) + (f" {shared} " if k % 2 else " ") + " ".join(words(60, 50 + k)) for k in range(12)]
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.measure(docs_of(spark, texts)).collect()}
    assert [i for i, n in got.items() if n] == [i for i in got if i % 2] and seen.value == len(texts)
