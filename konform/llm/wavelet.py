"""Token ids in wavelet-matrix files: one compressed, searchable file per shard.

A shard holds the ids of consecutive documents (ascending id) as a wavelet matrix: one bit
plane per bit of an id, the highest first; each plane is the shard's tokens in the order
that stable partitions by the earlier planes gave them.  With the number of ones before
every 512 bits (the rank directory) the token at a place, the occurrences of an id before a
place and the place of its k-th occurrence each take one step per plane, without
decoding the rest.  A shard is one row ``(part, shard, ..., payload)`` of a Parquet file of its own
(zstd), so any store that Spark reads will do; ``payload`` is, little-endian:

    magic "WVM1" | u32 planes | u64 tokens | u32 documents | u64 zeros of each plane
    | i64 id, u8 has id, u32 tokens of each document | per plane: u64 words, u32 rank directory

Steps: one scan turns texts into ids (white space never reaches the vocabulary's pieces, so the
library encodes each different word of a chunk once), the id rows - not the texts - are dealt by
range of the document id, and every task closes a shard when it has ``SHARD_TOKENS``.
Rows that share an id spread over tasks like any others; a task holds one shard.

Defined results: a null or empty text is the end id alone; special strings inside texts are special
tokens (the library's default); rows without an id come first, rows that share one follow each other by
number and checksum of their ids (equal rows are interchangeable); an empty table gives no files
with rows and an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import textvec as tv

MAGIC = b"WVM1"
END_ID = 1
SHARD_TOKENS = 1 << 22
ENCODE_BYTES = 4 << 20          # text whose different words are encoded together
WORD_CACHE = 700_000            # words a Python worker remembers (memory only; others are encoded again)
WORDS_AT_ONCE = 512
_MARKS = tv.byte_table(b".,;:!?")
_LETTERS = tv.byte_table(bytes([*range(65, 91), *range(97, 123)]))
FILES = "part int, shard int, n_docs long, n_tokens long, payload binary"


class WaveletMatrix:
    """Bit planes with rank and select over an array of ids below ``2**planes``."""

    def __init__(self, n: int, zeros: np.ndarray, words: list[np.ndarray], ranks: list[np.ndarray]):
        self.n, self.zeros, self.words, self.ranks = n, zeros, words, ranks
        self.planes = len(words)

    @classmethod
    def build(cls, ids: np.ndarray, planes: int) -> WaveletMatrix:
        n, zeros, words, ranks = len(ids), np.zeros(planes, np.int64), [], []
        now = np.asarray(ids)
        for k in range(planes):
            ones = (now & now.dtype.type(1 << (planes - 1 - k))) != 0
            packed = np.zeros((n + 511) // 512 * 64, np.uint8)
            packed[:(n + 7) // 8] = np.packbits(ones, bitorder="little")
            w = packed.view(np.uint64)
            before = np.cumsum(np.bitwise_count(w).reshape(-1, 8).sum(1, dtype=np.int64))
            words.append(w)
            ranks.append(np.concatenate(([0], before)).astype(np.uint32))
            zeros[k] = n - int(before[-1]) if n else 0
            now = np.concatenate((now[~ones], now[ones]))
        return cls(n, zeros, words, ranks)

    def _ones(self, k: int, at: np.ndarray) -> np.ndarray:
        """Ones of plane k before each place."""
        block, inside = at >> 9, at & 511
        out = self.ranks[k][block].astype(np.int64)
        if not len(self.words[k]):
            return out
        last = len(self.words[k]) - 1
        for j in range(8):
            bits = np.clip(inside - 64 * j, 0, 64)
            mask = np.where(bits == 64, ~np.uint64(0), (np.uint64(1) << (bits & 63).astype(np.uint64)) - np.uint64(1))
            out += np.bitwise_count(self.words[k][np.minimum(block * 8 + j, last)] & mask)
        return out

    def _bits(self, k: int, at: np.ndarray) -> np.ndarray:
        return (self.words[k][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1

    def access(self, at) -> np.ndarray:
        """The id at each place."""
        at = np.array(at, np.int64)
        out = np.zeros(len(at), np.int64)
        for k in range(self.planes):
            bit, ones = self._bits(k, at), self._ones(k, at)
            out = out * 2 + bit
            at = np.where(bit, self.zeros[k] + ones, at - ones)
        return out

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` among places [lo, hi) stand below the last plane."""
        if token < 0 or token >> self.planes:
            return 0, 0
        for k in range(self.planes):
            a, b = (int(x) for x in self._ones(k, np.array([lo, hi], np.int64)))
            lo, hi = (int(self.zeros[k]) + a, int(self.zeros[k]) + b) if token >> (self.planes - 1 - k) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of ``token`` at places [lo, hi)."""
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def _select(self, k: int, which: np.ndarray, ones: bool) -> np.ndarray:
        """Place of the ``which``-th (from 0) one or zero of plane k."""
        ranks = self.ranks[k].astype(np.int64)
        if not ones:
            ranks = np.minimum(np.arange(len(ranks), dtype=np.int64) * 512, self.n) - ranks
        block = np.searchsorted(ranks, which, "right") - 1
        left = which - ranks[block]
        out = np.empty(len(which), np.int64)
        for lo in range(0, len(which), 4096):
            b = block[lo:lo + 4096]
            rows = self.words[k].reshape(-1, 8)[b]
            bits = np.unpackbits((rows if ones else ~rows).view(np.uint8), axis=1, bitorder="little")
            hit = (np.cumsum(bits, axis=1, dtype=np.int32) == left[lo:lo + 4096, None] + 1) & (bits == 1)
            out[lo:lo + 4096] = b * 512 + hit.argmax(1)
        return out

    def select(self, token: int, which) -> np.ndarray:
        """Places of the given occurrences (from 0) of ``token``."""
        at = self._range(token, 0, self.n)[0] + np.array(which, np.int64)
        for k in reversed(range(self.planes)):
            one = bool(token >> (self.planes - 1 - k) & 1)
            at = self._select(k, at - self.zeros[k] if one else at, one)
        return at

    def occurrences(self, token: int) -> np.ndarray:
        return self.select(token, np.arange(self.count(token)))

    def decode(self) -> np.ndarray:
        """All ids, by undoing the partitions from the last plane to the first."""
        kind = np.uint16 if self.planes <= 16 else np.uint32
        out = np.zeros(self.n, kind)
        for k in reversed(range(self.planes)):
            bits = np.unpackbits(self.words[k].view(np.uint8), count=self.n, bitorder="little").view(bool)
            z = int(self.zeros[k])
            before = np.empty(self.n, kind)
            before[~bits] = out[:z]
            before[bits] = out[z:] | kind(1 << (self.planes - 1 - k))
            out = before
        return out.astype(np.uint32)


def pack(matrix: WaveletMatrix, doc_ids: list, lengths: np.ndarray) -> bytes:
    """The file form of a shard."""
    parts = [MAGIC, struct.pack("<IQI", matrix.planes, matrix.n, len(doc_ids)), matrix.zeros.astype("<u8").tobytes(),
             np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([d is not None for d in doc_ids], np.uint8).tobytes(),
             np.asarray(lengths, "<u4").tobytes()]
    for w, r in zip(matrix.words, matrix.ranks):
        parts += [w.astype("<u8").tobytes(), r.astype("<u4").tobytes()]
    return b"".join(parts)


def unpack(payload: bytes) -> tuple[WaveletMatrix, list, np.ndarray]:
    """(matrix, document ids, tokens per document) of a shard's file form."""
    if payload[:4] != MAGIC:
        raise ValueError("not a wavelet-matrix shard")
    planes, n, docs = struct.unpack_from("<IQI", payload, 4)
    at = 20

    def take(dtype, k):
        nonlocal at
        out = np.frombuffer(payload, dtype, k, at)
        at += out.nbytes
        return out

    zeros = take("<u8", planes).astype(np.int64)
    ids, has, lengths = take("<i8", docs), take(np.uint8, docs), take("<u4", docs).astype(np.int64)
    blocks = (n + 511) // 512
    words, ranks = [], []
    for _ in range(planes):
        words.append(take("<u8", blocks * 8))
        ranks.append(take("<u4", blocks + 1))
    return WaveletMatrix(n, zeros, words, ranks), [i if h else None for i, h in zip(ids.tolist(), has.tolist())], lengths


class WordEncoder:
    """Ids of whole texts from ids of their words, for a vocabulary that drops white space.

    Pieces never cross white space, nor a border between an ASCII letter and one of ``.,;:!?``, and
    composition works inside them, so the ids of a text are those of such words in a row.  Only words of
    ASCII bytes without ``<`` (which begins the special strings) are put in lower case here; everything else, other
    white space included, is left to the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        size = self.lib.get_vocab_size()
        self.ends = np.array([(self.lib.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.clear()

    def clear(self):
        self.known: dict[str, int] = {}
        self.flat, self.at = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, ids per word).  A word of letters is one piece and so holds one id that ends a piece: many of
        them are encoded as one text and told apart by those ids.  (No word of letters is less than a piece, so equal
        numbers of words and ends leave no word with two.)"""
        plain = np.fromiter(map(str.isalpha, words), bool, len(words))
        counts, found = np.zeros(len(words), np.int64), []
        lots = [some for lo in range(0, len(words), WORDS_AT_ONCE) if len(some := np.flatnonzero(plain[lo:lo + WORDS_AT_ONCE]) + lo)]
        texts = self.lib.encode_batch_fast([" ".join([words[k] for k in some.tolist()]) for some in lots], add_special_tokens=False) if lots else []
        for some, text in zip(lots, texts):
            ids = np.array(text.ids, np.int64)
            last = np.flatnonzero(self.ends[ids])
            if len(last) != len(some) or last[-1] != len(ids) - 1:
                plain[some] = False                            # another kind of vocabulary: one by one
                continue
            counts[some] = np.diff(last, prepend=-1)
            found.append((some, ids))
        rest = np.flatnonzero(~plain)
        encoded = [e.ids for e in self.lib.encode_batch_fast([words[k] for k in rest.tolist()], add_special_tokens=False)] if len(rest) else []
        counts[rest] = [len(e) for e in encoded]
        at = np.cumsum(counts) - counts
        flat = np.zeros(int(counts.sum()), np.int64)
        found.append((rest, np.fromiter((i for e in encoded for i in e), np.int64)))
        for which, ids in found:
            n = counts[which]
            flat[np.repeat(at[which] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return flat, counts

    def _lookup(self, words: list[str]) -> np.ndarray:
        if len(self.known) + len(words) > WORD_CACHE:
            self.clear()
        known = self.known
        slot = np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(slot < 0)
        if len(new):
            fresh = [words[k] for k in new.tolist()]
            flat, n = self._encode(fresh)
            slot[new] = np.arange(len(known), len(known) + len(new))
            known.update(zip(fresh, range(len(known), len(known) + len(new))))
            self.flat, self.at = np.concatenate((self.flat, flat)), np.concatenate((self.at, self.at[-1] + np.cumsum(n)))
        return slot

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, their bounds by text)."""
        inside = ~tv.WHITE[data]
        starts = np.zeros(len(data) + 1, bool)
        starts[1:-1] = ~inside[:-1]
        starts[off] = True
        mark, letter = _MARKS[data], _LETTERS[data]
        starts[1:-1] |= (mark[:-1] & letter[1:]) | (letter[:-1] & mark[1:])
        s = np.flatnonzero(starts[:-1] & inside)
        if not len(s):
            return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
        place = np.cumsum(inside)                              # bytes that are kept, up to each one
        bounds = np.concatenate((place[s] - 1, place[-1:])).astype(np.int64)
        kept = data[inside]
        keep_case = np.maximum.reduceat((kept >= 128) | (kept == 60), bounds[:-1])
        lower = np.where(np.repeat(keep_case, np.diff(bounds)), kept, tv.LOWER[kept])
        words = pa.LargeStringArray.from_buffers(len(s), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(lower)))
        coded = pc.dictionary_encode(words)
        slot = self._lookup(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        lo, n = self.at[slot], self.at[slot + 1] - self.at[slot]
        ends = np.cumsum(n)
        ids = self.flat[np.repeat(lo - (ends - n), n) + np.arange(ends[-1])]
        per_row = np.bincount(tv.rows_of(off, s), weights=n, minlength=len(off) - 1).astype(np.int64)
        return ids, np.concatenate(([0], np.cumsum(per_row)))


_coders: dict[str, WordEncoder] = {}


def _coder(vocab: str) -> WordEncoder:
    """One per Python worker, so that words are remembered from task to task."""
    if vocab not in _coders:
        _coders[vocab] = WordEncoder(vocab)
    return _coders[vocab]


def encode(docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """id, n, crc, ids (little-endian, 2 bytes where the vocabulary allows, else 4) of every row; one scan."""

    def scan(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # Spark deals out the cores
        coder = _coder(vocab)
        kind = _width(coder.lib.get_vocab_size())
        for batch in batches:
            for lo, hi, data, off in tv.chunks(batch.column(1), ENCODE_BYTES):
                ids, b = coder.encode(data, off)
                rows = np.arange(hi - lo)
                bounds = b + np.arange(len(b))                  # every document has one id more
                out = np.full(bounds[-1], end_id, "<u4")
                out[np.arange(len(ids)) + np.repeat(rows, np.diff(b))] = ids
                crc = [zlib.crc32(out[x:y]) for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                short = out.astype(kind)
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(bounds)), pa.array(crc, pa.int64()),
                                       pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer((bounds * short.itemsize).astype(np.int32)), pa.py_buffer(short)])],
                                      names=["id", "n", "crc", "ids"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(scan, "id long, n long, crc long, ids binary")


def _width(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def build_files(spark: SparkSession, encoded: str, path: str, vocab_size: int, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the shards of the encoded rows stored at ``encoded`` to ``path``, one file each."""
    kind = _width(vocab_size)
    planes = max(1, (vocab_size - 1).bit_length())
    rows = spark.read.parquet(encoded).withColumn("salt", F.monotonically_increasing_id())

    def cut(batches):
        part, shard = TaskContext.get().partitionId(), 0
        ids, lengths, parts, held = [], [], [], 0

        def close():
            m = WaveletMatrix.build(np.concatenate(parts), planes)
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(ids)], pa.int64()),
                                    pa.array([held], pa.int64()), pa.array([pack(m, ids, np.array(lengths))], pa.binary())],
                                   names=["part", "shard", "n_docs", "n_tokens", "payload"])

        for batch in batches:
            for d, b in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens = np.frombuffer(b.as_buffer(), kind)
                if held and held + len(tokens) > shard_tokens:
                    yield close()
                    shard, ids, lengths, parts, held = shard + 1, [], [], [], 0
                ids.append(d)
                lengths.append(len(tokens))
                parts.append(tokens)
                held += len(tokens)
        if held:
            yield close()

    order = ["id", "n", "crc", "salt"]
    (rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "ids").mapInArrow(cut, FILES)
     .write.option("compression", "zstd").option("maxRecordsPerFile", 1).parquet(path))


def write(docs: DataFrame, vocab: str, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
          shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode the documents and store them at ``path`` as wavelet-matrix files."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    encoded = re.sub(r"/*$", "", path) + ".ids"
    encode(docs, vocab, id_col, text_col, end_id).write.parquet(encoded)
    build_files(spark, encoded, path, Tokenizer.from_file(vocab).get_vocab_size(), shard_tokens)


def read_files(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The shards, and the number of ids before each (part, shard, start)."""
    files = spark.read.schema(FILES).parquet(path)
    sizes = files.select("part", "shard", "n_tokens")
    # one row per range of ids, and within a range its few shards
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    parts = parts.select("part", (F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).alias("_before"))
    starts = (sizes.withColumn("_in", F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_tokens"))
              .join(parts, "part").select("part", "shard", (F.col("_before") + F.col("_in")).alias("start")))
    return files, starts


def documents(spark: SparkSession, path: str) -> DataFrame:
    """id, start, n_tokens, ids_crc32 of every document, decoded from the files."""
    files, starts = read_files(spark, path)

    def scan(batches):
        for batch in batches:
            for part, shard, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                matrix, ids, n = unpack(payload.as_buffer().to_pybytes())
                tokens = matrix.decode().astype("<u4")
                ends = np.cumsum(n)
                crc = [zlib.crc32(tokens[b - k:b]) for b, k in zip(ends.tolist(), n.tolist())]
                yield pa.record_batch([pa.array([part] * len(ids), pa.int32()), pa.array([shard] * len(ids), pa.int32()), pa.array(ids, pa.int64()),
                                       pa.array(ends - n, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                                      names=["part", "shard", "id", "at", "n_tokens", "ids_crc32"])

    rows = files.select("part", "shard", "payload").mapInArrow(scan, "part int, shard int, id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(starts, ["part", "shard"]).select("id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_counts(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """token, n: occurrences of the given ids in all documents, by rank, without decoding."""

    def scan(batches):
        for batch in batches:
            for payload in batch.column(0):
                matrix = unpack(payload.as_buffer().to_pybytes())[0]
                yield pa.record_batch([pa.array(tokens, pa.int64()), pa.array([matrix.count(t) for t in tokens], pa.int64())], names=["token", "n"])

    files, _ = read_files(spark, path)
    return files.select("payload").mapInArrow(scan, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """id, place (within the document, from 0) of every occurrence of one id, by select, without decoding."""

    def scan(batches):
        for batch in batches:
            for payload in batch.column(0):
                matrix, ids, n = unpack(payload.as_buffer().to_pybytes())
                ends = np.cumsum(n)
                total = matrix.count(token)
                for lo in range(0, total, 1 << 16):
                    at = matrix.select(token, np.arange(lo, min(total, lo + (1 << 16))))
                    doc = np.searchsorted(ends, at, "right")
                    yield pa.record_batch([pa.array([ids[d] for d in doc.tolist()], pa.int64()), pa.array(at - (ends - n)[doc], pa.int64())],
                                          names=["id", "place"])

    files, _ = read_files(spark, path)
    return files.select("payload").mapInArrow(scan, "id long, place long")


def tokens_at(places: DataFrame, path: str, place_col: str = "place") -> DataFrame:
    """The id at each place counted over all documents: place, token; places outside the files give no row."""
    spark = places.sparkSession
    files, starts = read_files(spark, path)
    sized = files.select("part", "shard", "n_tokens").join(starts, ["part", "shard"])
    # fixed blocks of places turn the range condition into an equality
    block = lambda c: F.floor(c / SHARD_TOKENS)
    spans = sized.withColumn("_b", F.explode(F.sequence(block(F.col("start")), block(F.col("start") + F.col("n_tokens") - 1))))
    asked = places.select(F.col(place_col).cast("long").alias("place")).withColumn("_b", block(F.col("place")))
    wanted = (asked.join(spans, "_b").filter("place >= start and place < start + n_tokens")
              .select(F.col("part").alias("_p"), F.col("shard").alias("_s"), "place", (F.col("place") - F.col("start")).alias("at")))

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("place", pa.int64()), ("token", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        matrix = unpack(right["payload"][0].as_buffer().to_pybytes())[0]
        return pa.table([left["place"].combine_chunks(), pa.array(matrix.access(left["at"].to_numpy()))], schema=schema)

    return (wanted.groupBy("_p", "_s").cogroup(files.select("part", "shard", "payload").groupBy("part", "shard"))
            .applyInArrow(look, "place long, token long"))
