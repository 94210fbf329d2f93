"""Token counts by prefix dynamic programming (byte-level BPE).

A text is cut into the pieces the pattern of the vocabulary prescribes; inside
a piece the encoding of *every* prefix follows from the encodings of shorter
prefixes: the last token of a prefix is the one token that ends there and may
follow the last token of what is left of it.  Whether token ``b`` may follow
token ``a`` is decided by undoing their merges from the latest to the earliest.
So one pass gives the exact count at every prefix, and truncation or budget
questions are look-ups.

Defined results: a null or empty text has 0 bytes and 0 tokens; a special
string inside a text is one token (the library's default); repeated rows give
repeated rows; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textvec as tv

CACHE_PIECES = 120_000      # piece -> count entries a Python worker keeps (memory only; misses are recomputed)
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: The suffixes that the pattern splits off after an apostrophe.
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")


def _byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {}, 256
    for b in range(256):
        if b in keep:
            out[chr(b)] = b
        else:
            out[chr(extra)] = b
            extra += 1
    return out


def _classes() -> np.ndarray:
    """Letter / number / white space / other for every code point."""
    t = np.zeros(0x110000, np.uint8)
    text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", SPACE)):
        for m in regex.finditer(pattern, text):
            a, b = m.span()
            t[[ord(c) for c in text[a:b]]] = kind
    return t


class PrefixBPE:
    """Vocabulary and merge order of one byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError("a byte-level BPE vocabulary is needed")
        if spec["pre_tokenizer"].get("add_prefix_space") or not spec["pre_tokenizer"].get("use_regex", True):
            raise ValueError("unsupported pre-tokenizer options")
        chars = _byte_chars()
        raw = lambda s: bytes(chars[c] for c in s)
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        self.rank: dict[bytes, int] = {bytes([b]): -1 for b in range(256)}
        self.split: dict[bytes, tuple[bytes, bytes]] = {}
        self.pair: dict[tuple[bytes, bytes], int] = {}
        for i, m in enumerate(spec["model"]["merges"]):
            a, b = map(raw, m.split(" ") if isinstance(m, str) else m)
            self.pair[a, b] = i
            if a + b not in self.rank:
                self.rank[a + b] = i
                self.split[a + b] = a, b
        self._whole: dict[bytes, bool] = {}
        self._fits: dict[int, bool] = {}
        self._new: dict[bytes, int] = {}
        self._old: dict[bytes, int] = {}
        self.bytes_of = [t for t in self.rank if self.is_token(t)]
        self.token = {t: i for i, t in enumerate(self.bytes_of)}
        self.reach: dict[bytes, int] = {}       # last three bytes -> longest token that ends in them
        for t in self.bytes_of:
            if len(t) > self.reach.get(t[-3:], 2):
                self.reach[t[-3:]] = len(t)
        self.kind = _classes()

    def follows(self, a: bytes, b: bytes) -> bool:
        """Does the boundary between adjacent tokens a and b survive all merges?"""
        before = len(self.pair)         # only merges earlier than this could still cross the boundary
        while True:
            if self.pair.get((a, b), before) < before:
                return False
            ra, rb = self.rank[a], self.rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:                 # the left token was formed last: undo it
                before, a = ra, self.split[a][1]
            else:                       # of equal merges the left one comes first
                before, b = rb + 1, self.split[b][0]

    def is_token(self, t: bytes) -> bool:
        """Is t one token when it stands alone?  (A vocabulary may hold unreachable entries.)"""
        known = self._whole.get(t)
        if known is None:
            if t not in self.rank:
                return False
            if self.rank[t] < 0:
                known = True
            else:
                a, b = self.split[t]
                known = self.is_token(a) and self.is_token(b) and self._joins(t, a, b)
            self._whole[t] = known
        return known

    def _joins(self, t: bytes, a: bytes, b: bytes) -> bool:
        before = self.rank[t] + 1
        ra, rb = self.rank[a], self.rank[b]
        # undo a and b: no merge across their boundary may come before both are formed
        while ra >= 0 or rb >= 0:
            if ra > rb:
                before, a = ra, self.split[a][1]
            else:
                before, b = rb + 1, self.split[b][0]
            if self.pair.get((a, b), before) < before:
                return False
            ra, rb = self.rank[a], self.rank[b]
        return True

    def prefix_counts(self, piece: bytes) -> list[int]:
        """Token count of piece[:i] for every i from 0 to its length."""
        last, count = [0], [0]
        self._extend(piece, last, count)
        return count

    def _extend(self, piece: bytes, last: list[int], count: list[int]) -> None:
        """Carry the table on from the prefix it already covers (its length is len(count) - 1)."""
        token, reach, fits = self.token, self.reach, self._fits
        for i in range(len(count), len(piece) + 1):
            # no token that ends in these bytes is longer than this
            long = reach.get(piece[i - 3:i], 2) if i >= 3 else i
            for lo in range(i - long if long < i else 0, i):
                t = token.get(piece[lo:i])
                if t is None:
                    continue
                if lo:
                    key = last[lo] << 32 | t
                    ok = fits.get(key)
                    if ok is None:
                        if len(fits) > 4 * CACHE_PIECES:
                            fits.clear()
                        ok = fits[key] = self.follows(self.bytes_of[last[lo]], self.bytes_of[t])
                    if not ok:
                        continue
                last.append(t)
                count.append(count[lo] + 1)
                break
            else:
                raise ValueError("no token ends here")

    def piece_counts(self, pieces: list[bytes]) -> list[int]:
        """Token count of every piece.  Pieces seen lately are looked up; the others are taken in sorted
        order, so that a piece starts from the table of the prefix it shares with its predecessor."""
        new, old = self._new, self._old
        out = [0] * len(pieces)
        missing = []
        for k, w in enumerate(pieces):
            n = new.get(w)
            if n is None:
                n = old.get(w)
                if n is None:
                    missing.append((w, k))
                    continue
                new[w] = n
            out[k] = n
        missing.sort()
        before, last, count = b"", [0], [0]
        for w, k in missing:
            if w in self.token:
                n = 1
            else:
                keep, top = 0, min(len(w), len(before))
                while keep < top and w[keep] == before[keep]:
                    keep += 1
                del last[keep + 1:], count[keep + 1:]
                self._extend(w, last, count)
                before, n = w, count[-1]
            new[w] = out[k] = n
        if len(new) > CACHE_PIECES:             # the older half goes; memory stays bounded
            self._old, self._new = new, {}
        return out

    # ------------------------------------------------------------------ pieces
    def pieces(self, data: np.ndarray, off: np.ndarray):
        """(starts, ends, row, special) of the pieces of every row; ``special`` marks special strings."""
        n = len(data)
        z = np.zeros(0, np.int64)
        if not n:
            return z, z, z, np.zeros(0, bool)
        sp_s, sp_e = self._specials(data, off)
        at = np.flatnonzero((data & 0xC0) != 0x80)
        cp = data[at].astype(np.int64)
        wide = np.flatnonzero(cp >= 0x80)
        if len(wide):
            p, b0 = at[wide], cp[wide]
            get = lambda k: data[np.minimum(p + k, n - 1)].astype(np.int64) & 0x3F
            cp[wide] = np.where(b0 < 0xE0, (b0 & 0x1F) << 6 | get(1),
                                np.where(b0 < 0xF0, (b0 & 0x0F) << 12 | get(1) << 6 | get(2),
                                         (b0 & 0x07) << 18 | get(1) << 12 | get(2) << 6 | get(3)))
        kind = self.kind[cp]
        m = len(at)
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        edge[sp_s] = True
        edge[sp_e] = True
        first = edge[at]                                   # first character of a row (or beside a special string)
        start = first.copy()
        start[1:] |= kind[1:] != kind[:-1]
        # the last white space before other text belongs to what follows if it is a blank, else stands alone
        i = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:])
        start[i] = True
        start[i[cp[i] == 0x20] + 1] = False
        q = np.flatnonzero((cp[:-1] == 0x27) & start[:-1] & (kind[1:] == LETTER) & ~first[1:])
        for j in q:                                        # apostrophes are rare
            tail = bytes(data[at[j] + 1:at[j] + 3])
            row_end = off[np.searchsorted(off, at[j], "right")]
            for s in SUFFIXES:
                k = len(s)
                if tail[:k] == s.encode() and at[j] + 1 + k <= row_end and not first[j + 1:j + 1 + k].any():
                    start[j + 1:j + 1 + k] = False
                    if j + 1 + k < m and kind[j + 1 + k] == LETTER:
                        start[j + 1 + k] = True
                    break
        starts = at[start]
        ends = np.append(starts[1:], n)
        special = np.zeros(len(starts), bool)
        if len(sp_s):
            k = np.searchsorted(sp_s, starts, "right") - 1
            inside = (k >= 0) & (starts < sp_e[np.maximum(k, 0)])
            head = inside & (starts == sp_s[np.maximum(k, 0)])
            ends[head] = sp_e[k[head]]
            keep = ~inside | head
            starts, ends, special = starts[keep], ends[keep], head[keep]
        return starts, ends, tv.rows_of(off, starts), special

    def _specials(self, data: np.ndarray, off: np.ndarray):
        found = []
        text = data.tobytes()
        for s in self.special:
            p = text.find(s)
            while p >= 0:
                if p + len(s) <= off[np.searchsorted(off, p, "right")]:
                    found.append((p, p + len(s)))
                    p = text.find(s, p + len(s))
                else:
                    p = text.find(s, p + 1)
        found.sort()
        return (np.array([f[k] for f in found], np.int64) for k in (0, 1))

    def counts(self, data: np.ndarray, off: np.ndarray):
        """Pieces with their token counts: (starts, ends, row, count)."""
        starts, ends, row, special = self.pieces(data, off)
        h = tv.span_hash(tv.prefix_hash(data), starts, ends)
        _, one, back = np.unique(h, return_index=True, return_inverse=True)
        text = data.tobytes()
        got = np.array(self.piece_counts([text[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist())]),
                       np.int64)
        n = got[back]
        n[special] = 1
        return starts, ends, row, n


_loaded: dict[str, PrefixBPE] = {}


def vocabulary(path: str) -> PrefixBPE:
    if path not in _loaded:
        _loaded[path] = PrefixBPE(path)
    return _loaded[path]


def _measure(col: pa.Array, path: str, limit: int) -> pa.Array:
    bpe = vocabulary(path)
    total = np.zeros(len(col), np.int64)
    cut = np.zeros(len(col), np.int64)
    for lo, hi, data, off in tv.chunks(col):
        starts, ends, row, n = bpe.counts(data, off)
        upto = np.concatenate(([0], np.cumsum(n)))
        first = np.searchsorted(row, np.arange(hi - lo + 1))
        tokens = upto[first[1:]] - upto[first[:-1]]
        total[lo:hi] = tokens
        cut[lo:hi] = off[1:] - off[:-1]
        for r in np.flatnonzero(tokens > limit):           # where does the budget end?
            k = int(np.searchsorted(upto, upto[first[r]] + limit, "right")) - 1
            have, a, b = upto[k] - upto[first[r]], int(starts[k]), int(ends[k])
            inner = bpe.prefix_counts(data[a:b].tobytes()) if n[k] > 1 else [0, limit + 1]
            fit = max((i for i, c in enumerate(inner) if have + c <= limit
                       and (a + i >= b or data[a + i] & 0xC0 != 0x80)), default=0)
            cut[lo + r] = a + fit - off[r]
    return pa.StructArray.from_arrays([pa.array(total), pa.array(cut)], ["n_tokens", "cut_bytes"])


def token_measure(text: Column, vocab_path: str, limit: int) -> Column:
    """struct(n_tokens, cut_bytes): the exact token count of the whole text, and the bytes of its longest
    beginning (whole characters) that stays within ``limit`` tokens."""
    f = F.arrow_udf(lambda col: _measure(col, vocab_path, limit), "n_tokens long, cut_bytes long")
    return f(text.cast("string"))


def count_tokens(docs: DataFrame, vocab_path: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit, cut_bytes.  One scan, no shuffle."""
    d = docs.select(F.col(id_col), F.col(text_col).alias("_t"))
    d = d.withColumn("_m", token_measure(F.col("_t"), vocab_path, limit))
    return d.select(id_col, F.coalesce(F.octet_length("_t"), F.lit(0)).cast("long").alias("n_bytes"),
                    F.col("_m.n_tokens").alias("n_tokens"), (F.col("_m.n_tokens") > limit).alias("over_limit"),
                    F.col("_m.cut_bytes").alias("cut_bytes"))


def prefix_table(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored form: per document the byte end of every piece and the token count up to there, so any
    later budget or truncation question is a search in two arrays (``tokens_within``)."""

    def index(col: pa.Array) -> pa.Array:
        bpe = vocabulary(vocab_path)
        e_all, c_all, sizes = [], [], []
        for lo, hi, data, off in tv.chunks(col):
            _, ends, row, n = bpe.counts(data, off)
            first = np.searchsorted(row, np.arange(hi - lo + 1))
            upto = np.concatenate(([0], np.cumsum(n)))
            e_all.append(ends - off[row])
            c_all.append(upto[1:] - upto[first[row]])
            sizes.append(np.diff(first))
        offs = np.concatenate(([0], np.cumsum(np.concatenate(sizes)))) if sizes else np.zeros(1, np.int64)
        cat = lambda x: pa.array(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64))
        o = pa.array(offs.astype(np.int32))
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(o, cat(e_all)),
                                           pa.ListArray.from_arrays(o, cat(c_all))], ["piece_end", "tokens"])

    f = F.arrow_udf(index, "piece_end array<long>, tokens array<long>")
    d = docs.select(F.col(id_col), f(F.col(text_col).cast("string")).alias("_x"))
    return d.select(id_col, "_x.piece_end", "_x.tokens")


def tokens_within(piece_end: Column, tokens: Column, n_bytes: Column) -> Column:
    """Tokens of the whole pieces that end within the first ``n_bytes`` bytes (no re-encoding)."""
    k = F.size(F.filter(piece_end, lambda e: e <= n_bytes))
    return F.when(k > 0, F.element_at(tokens, k)).otherwise(F.lit(0).cast("long"))
