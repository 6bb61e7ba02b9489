"""Vectorised word arithmetic over Arrow text columns, shared by the operators that run inside tasks.

A word is a maximal run of bytes outside space and 0x09-0x0D, on UTF-8 bytes (the bytes of multi-byte
characters are all above 0x20, so this equals the code point rule).  All work is done on slices of a
batch, so memory is a small multiple of ``SLICE_BYTES`` or of the longest single text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 2 << 20
_BLOCK = 1 << 18
_LONG_WORD = 4096

_R = np.uint64(0x9E3779B97F4A7C15)
_R_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_POW: list[np.ndarray] = []


def tidied(run: Callable) -> Callable:
    """A function for ``mapInArrow`` that gives the memory it used back to the system when its task ends: Spark
    keeps Python workers for later tasks, and what they hold counts against the executor."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return wrapped


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POW:
        for r in (_R, _R_INV):
            p = np.full(_BLOCK + _LONG_WORD + 1, r, np.uint64)
            p[0] = 1
            _POW.append(np.multiply.accumulate(p))
    return _POW[0], _POW[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, in a new array."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the rows' offsets into them; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    n = len(col)
    _, offs, data = col.buffers()
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[off[0] : off[-1]]
    return buf, off - off[0]


def one_array(col: pa.ChunkedArray) -> pa.Array:
    """A table's column as one array."""
    return pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)


def slices(off: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text is a range of its own."""
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j
        i = j


def text_slices(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for each slice of a string column."""
    buf, off = utf8(col)
    for i, j in slices(off):
        yield i, j, buf[off[i] : off[j]], off[i : j + 1] - off[i]


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the index of each row's first word (one more for the end)."""
    space = (buf == 32) | ((buf >= 9) & (buf <= 13))
    edge = np.ones(len(buf) + 1, bool)
    edge[1:-1] = space[1:] != space[:-1]
    edge[off] = True  # a word never runs on into the next text
    cut = np.flatnonzero(edge)
    inside = ~space[cut[:-1]] if len(cut) > 1 else np.zeros(0, bool)
    start, end = cut[:-1][inside], cut[1:][inside]
    return start, end, np.searchsorted(start, off)


def word_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: a polynomial in its bytes, mixed.  Words over 4096 bytes use XXH64."""
    pw, ip = _powers()
    out = np.empty(len(start), np.uint64)
    long = (end - start) > _LONG_WORD
    for w in np.flatnonzero(long):
        out[w] = xxhash.xxh64_intdigest(buf[start[w] : end[w]].tobytes(), 7)
    short = np.flatnonzero(~long)
    s0, e0 = start[short], end[short]
    i = 0
    with np.errstate(over="ignore"):
        while i < len(short):
            base = s0[i]
            j = int(np.searchsorted(s0, base + _BLOCK, "left"))
            s, e = s0[i:j] - base, e0[i:j] - base
            part = buf[base : base + e[-1]]
            acc = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * pw[: len(part)], out=acc[1:])
            out[short[i:j]] = mix((acc[e] - acc[s]) * ip[s])
            i = j
    return out


def gram_hash(wh: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on (positions near row ends run over; the caller masks them)."""
    n = max(0, len(wh) - k + 1)
    with np.errstate(over="ignore"):
        acc = wh[:n].copy()
        for t in range(1, k):
            acc *= _GRAM
            acc += wh[t : t + n]
        return mix(acc)


def joined(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words, each followed by one space, and the words' starts in that; word i ends at starts[i+1]-1."""
    size = end - start
    at = np.zeros(len(start) + 1, np.int64)
    np.cumsum(size + 1, out=at[1:])
    out = np.full(at[-1], 32, np.uint8)
    keep = np.ones(at[-1], bool)
    keep[at[1:] - 1] = False
    covered = np.zeros(len(buf) + 1, np.int8)
    covered[start] = 1
    covered[end] -= 1  # a word that starts where another text's word ends keeps its +1
    out[keep] = buf[np.cumsum(covered[:-1], dtype=np.int8).astype(bool)]
    return out, at


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbours, by doubling."""
    have = 1
    while have * 2 <= w:
        x = np.minimum(x[: len(x) - have], x[have:]) if len(x) > have else x[:0]
        have *= 2
    rest = w - have
    return (np.minimum(x[: len(x) - rest], x[rest:]) if len(x) > rest else x[:0]) if rest else x
