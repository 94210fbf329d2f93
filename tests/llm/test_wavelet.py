"""Token files: ids against the library, rank / select against numpy, files read back."""

import os
import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from helpers import SF, docs_of, table, with_clashes  # noqa: E402

from konform.llm import textvec as tv  # noqa: E402
from konform.llm import wavelet  # noqa: E402
from konform.llm.queries import QUERIES  # noqa: E402
from konform.llm.ship import ship  # noqa: E402

VOCAB = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def lib():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCAB)


def expected(lib, rows):
    """doc_id -> (start, n, crc) from the library, in ascending id order."""
    at, out = 0, {}
    for d, t in sorted(rows):
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        out[d] = (at, len(ids), zlib.crc32(ids))
        at += len(ids)
    return out


def test_matrix_against_numpy():
    rng = np.random.default_rng(1)
    for n in (0, 1, 63, 64, 511, 512, 513, 5000):
        x = rng.integers(0, 300, n)
        matrix, ids, lengths = wavelet.unpack(wavelet.pack(wavelet.WaveletMatrix.build(x, 9), [None, 3], np.array([0, n])))
        assert ids == [None, 3] and lengths.tolist() == [0, n]
        assert (matrix.decode() == x).all() and (matrix.access(np.arange(n)) == x).all()
        for t in (0, 1, 5, 299, 511, 512, -1):
            assert matrix.count(t) == (x == t).sum() and (matrix.occurrences(t) == np.flatnonzero(x == t)).all()
            assert matrix.count(t, n // 3, n - n // 4) == (x[n // 3:n - n // 4] == t).sum()


def test_words_encode_like_whole_texts(lib):
    rnd = random.Random(5)
    alphabet = ["a", "B", "'", "s", "S", "ll", "'re", ".", ",", "!", "?", ";", " ", "\n", "\t", " ", "́", "̌", "J", "H̱", "é", "É",
                "ß", "İ", "Σ", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<", "|", "…", "1", "23", "²", "日本", "　", "\x1c", "\x85", "\x0b",
                "😀", "-", "_", "’", "ǆ", "K", "ﬁ", "‍", "\0"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(25))) for _ in range(4000)]
    coder = wavelet.WordEncoder(VOCAB)
    got = []
    for _, _, data, off in tv.chunks(pa.array(texts), 4096):
        ids, b = coder.encode(data, off)
        got += [ids[x:y].tolist() for x, y in zip(b[:-1], b[1:])]
    assert got == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_registered_query_covers_the_whole_table(spark, lib):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, "documents").collect()]
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in QUERIES["op11_token_wavelet"](spark, SF).collect()}
    assert got == expected(lib, rows)


def test_small_shards_search_and_odd_rows(spark, lib, tmpdir_path):
    ship(spark)
    texts = ["the cat, the dog", None, "", "The END <|endoftext|> the", "x " * 700, *["same words the"] * 30, "日本 the é"]
    d = with_clashes(docs_of(spark, texts))
    path = f"{tmpdir_path}/files"
    wavelet.write(d, VOCAB, path, shard_tokens=50)
    got = {r["id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in wavelet.documents(spark, path).collect()}
    want = expected(lib, list(enumerate(texts)))
    assert got == want
    assert wavelet.read_files(spark, path)[0].count() > 4
    flat = np.concatenate([[*lib.encode(t or "", add_special_tokens=False).ids, 1] for t in texts])
    the = lib.encode("the").ids[0]
    counts = {r["token"]: r["n"] for r in wavelet.token_counts(spark, path, [the, 1, 49000]).collect()}
    assert counts == {t: int((flat == t).sum()) for t in (the, 1, 49000)}
    found = sorted(want[r["id"]][0] + r["place"] for r in wavelet.occurrences(spark, path, the).collect())
    assert found == np.flatnonzero(flat == the).tolist()
    places = spark.range(-2, len(flat) + 3).withColumnRenamed("id", "place")
    at = {r["place"]: r["token"] for r in wavelet.tokens_at(places, path).collect()}
    assert [at[i] for i in range(len(flat))] == flat.tolist() and len(at) == len(flat)


def test_repeated_and_missing_ids_and_an_empty_table(spark, lib, tmpdir_path):
    ship(spark)
    rows = [(None, "no id", "en", "s", 5), (7, "a b c", "en", "s", 5), (7, "a b c", "en", "s", 5), (7, "other", "en", "s", 5), (3, "first", "en", "s", 5)]
    d = spark.createDataFrame(rows, docs_of(spark, []).schema)
    wavelet.write(d, VOCAB, f"{tmpdir_path}/a", shard_tokens=2)
    got = sorted(((r["start"], r["id"], r["n_tokens"]) for r in wavelet.documents(spark, f"{tmpdir_path}/a").collect()))
    assert [g[1] for g in got] == [None, 3, 7, 7, 7]
    assert [g[0] for g in got] == [0, *np.cumsum([g[2] for g in got])[:-1].tolist()]
    wavelet.write(d.limit(0), VOCAB, f"{tmpdir_path}/b")
    assert wavelet.documents(spark, f"{tmpdir_path}/b").collect() == []


def test_words_are_looked_up_once():
    coder, asked = wavelet.WordEncoder(VOCAB), []

    class Counted(dict):
        def get(self, *k):
            asked.append(k)
            return super().get(*k)

        def __contains__(self, k):
            asked.append(k)
            return super().__contains__(k)

        def __getitem__(self, k):
            asked.append(k)
            return super().__getitem__(k)

    coder.known = Counted()
    first, again = ["one", "two", "three"], ["two", "four", "one", "five"]
    a, b = coder._lookup(first).tolist(), coder._lookup(again).tolist()
    assert len(asked) == len(first) + len(again)
    assert (a, b) == ([0, 1, 2], [1, 3, 0, 4])
    ids = [coder.flat[coder.at[k]:coder.at[k + 1]].tolist() for k in b]
    assert ids == [coder.lib.encode(w, add_special_tokens=False).ids for w in again]
