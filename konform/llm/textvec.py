"""Vectorised helpers over Arrow string columns, used inside tasks.

A string column is seen as one byte array plus offsets; words, spans and
shingles are found and hashed with numpy over a bounded chunk of rows, so no
Python object is made per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20          # text handled at once inside a task (one longer text is its own chunk)
SCAN_BYTES = 1 << 18           # for statistics that hold tens of bytes for every byte of text
U64 = np.uint64
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)
_pow = {"n": 0}


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null row is an empty span."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64) \
        if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, off


def chunks(col: pa.Array, limit: int = CHUNK_BYTES):
    """Yield (first row, end row, bytes, offsets from 0) for runs of rows of about ``limit`` bytes."""
    raw, off = buffers(col)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _pow["n"] < n:
        n = -(-n // (SCAN_BYTES + 65536)) * (SCAN_BYTES + 65536)
        with np.errstate(over="ignore"):
            f = np.full(n, U64(_BASE)); f[0] = 1
            b = np.full(n, U64(pow(_BASE, -1, 1 << 64))); b[0] = 1
            _pow.update(n=n, f=np.cumprod(f, dtype=np.uint64), b=np.cumprod(b, dtype=np.uint64))
    return _pow["f"], _pow["b"]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash (mod 2**64); ``span_hash`` reads any span of it."""
    n = len(data)
    f, _ = _powers(n + 1)
    out = np.zeros(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_TABLE[data] * f[:n], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position-independent 64-bit hash of every span [start, end)."""
    _, b = _powers(len(prefix))
    with np.errstate(over="ignore"):
        return mix((prefix[ends] - prefix[starts]) * b[starts] + (ends - starts).astype(np.uint64) * U64(0xD6E8FEB86659FD93))


def byte_table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


WHITE = byte_table(b" \t\n\x0b\x0c\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, off: np.ndarray, sep: np.ndarray = WHITE):
    """(starts, ends, row) of the maximal runs of non-separator bytes; runs never cross rows."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    gap = sep[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    inside = ~gap
    starts = np.flatnonzero(inside & (edge[:n] | np.concatenate(([True], gap[:-1]))))
    ends = np.flatnonzero(inside & (edge[1:] | np.concatenate((gap[1:], [True])))) + 1
    return starts, ends, rows_of(off, starts)


def rows_of(off: np.ndarray, pos: np.ndarray) -> np.ndarray:
    return np.searchsorted(off, pos, "right") - 1


_C = mix(np.arange(1, 65, dtype=np.uint64)) | U64(1)


def shingles(word_hash: np.ndarray, row: np.ndarray, n_rows: int, k: int):
    """(hash, row) of every run of ``k`` words of a row; a row with fewer words gives its whole
    sequence as one shingle, a row without words none.  Repeats are kept."""
    counts = np.bincount(row, minlength=n_rows)
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    full = len(word_hash) - k + 1
    parts_h, parts_r = [], []
    with np.errstate(over="ignore"):
        if full > 0:
            acc = np.zeros(full, np.uint64)
            for j in range(k):
                acc += word_hash[j:j + full] * _C[j]
            same = row[:full] == row[k - 1:]
            parts_h.append(mix(acc[same] + U64(k))); parts_r.append(row[:full][same])
        short = np.flatnonzero((counts > 0) & (counts < k))
        if len(short):
            acc = np.zeros(len(short), np.uint64)
            for j in range(k - 1):
                has = counts[short] > j
                acc[has] += word_hash[first[short[has]] + j] * _C[j]
            parts_h.append(mix(acc + counts[short].astype(np.uint64))); parts_r.append(short)
    if not parts_h:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h, r = np.concatenate(parts_h), np.concatenate(parts_r)
    if len(short):
        o = np.argsort(r, kind="stable")
        h, r = h[o], r[o]
    return h, r
