"""Vectorised text kernels shared by the Arrow-side operators.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``.  All functions work on the raw UTF-8
buffer of an Arrow string column, so a batch of texts is tokenised and hashed with a fixed number of
numpy passes and no Python object per word.  Hashes are 64 bit: a polynomial in an odd base over
random byte values, evaluated by prefix sums (odd numbers are invertible modulo 2**64) and finished
with a bit mixer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SLICE_BYTES = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(31))
    x = x * U(0x9E3779B97F4A7C15)
    x = x ^ (x >> U(29))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def _table() -> np.ndarray:
    t = mix(mix(np.arange(1, 257, dtype=U)) + U(0x5851F42D4C957F2D))
    return t


_BYTES = _table()
_LOWER = _BYTES.copy()
_LOWER[65:91] = _BYTES[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9FB21C651E98DF25  # odd
_STEP = 0xC2B2AE3D27D4EB4F  # odd


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = U(base), U(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, dtype=U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up = np.concatenate(([U(1)], np.cumprod(np.full(size - 1, self.base))))
            self.down = np.concatenate(([U(1)], np.cumprod(np.full(size - 1, self.inverse))))
        return self.up[:n], self.down[:n]


_byte_powers, _word_powers = _Powers(_BASE), _Powers(_STEP)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of a string column with about ``limit`` bytes each: (first, end, bytes, offsets).

    Nulls count as empty texts; one text longer than the limit forms a range of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def _pieces(buf: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``limit`` bytes that end after white space, so that no word is cut; a longer word is a range of its own."""
    lo, n = 0, len(buf)
    while lo < n:
        hi = min(lo + limit, n)
        if hi < n:
            gaps = np.flatnonzero(_SPACE[buf[lo:hi]])
            while not len(gaps) and hi < n:
                gaps = hi - lo + np.flatnonzero(_SPACE[buf[hi : hi + limit]])[:1]
                hi += limit
            hi = lo + int(gaps[-1]) + 1 if len(gaps) else n
        yield lo, hi
        lo = hi


def words(buf: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, words per text, first byte and end of each word.

    Long texts are worked off in pieces, so that beside the results memory does not grow with a text.
    """
    found = [(hashed, lo + first, lo + end) for lo, hi in _pieces(buf, 2 * SLICE_BYTES) for hashed, first, end in [_words(buf[lo:hi], offsets[(offsets >= lo) & (offsets <= hi)] - lo, lower)]]
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return np.zeros(0, dtype=U), np.zeros(len(offsets) - 1, dtype=np.int64), none, none
    hashed, first, end = (x[0] if len(x) == 1 else np.concatenate(x) for x in zip(*found, strict=True))
    return hashed, np.diff(np.searchsorted(first, offsets)), first, end


def _words(buf: np.ndarray, edges: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(buf)
    space = _SPACE[buf]
    edge = np.zeros(n + 1, dtype=bool)
    edge[edges] = True
    before = np.concatenate(([True], space[:-1])) | edge[:-1]
    after = np.concatenate((space[1:], [True])) | edge[1:]
    first, end = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    up, down = _byte_powers.get(n + 1)
    total = np.concatenate((np.zeros(1, U), np.cumsum((_LOWER if lower else _BYTES)[buf] * up[:n])))
    return mix((total[end] - total[first]) * down[first] + (end - first).astype(U)), first, end


def window_hashes(word: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words, whatever text they belong to."""
    n = len(word)
    if n < size:
        return np.zeros(0, dtype=U)
    up, down = _word_powers.get(n + 1)
    total = np.concatenate((np.zeros(1, U), np.cumsum(word * up[:n])))
    return mix((total[size:] - total[:-size]) * down[: n - size + 1] + U(size))


def windows(word: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start within the text, hash) of every window of ``size`` words inside one text."""
    owner = np.repeat(np.arange(len(counts)), counts)
    if len(word) < size:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(0, dtype=U)
    at = np.flatnonzero(owner[: len(owner) - size + 1] == owner[size - 1 :])
    begin = np.concatenate(([0], np.cumsum(counts)))[:-1]
    return owner[at], at - begin[owner[at]], window_hashes(word, size)[at]


def shingle_sets(word: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, shingle hash), sorted.  A text with 1 to size-1 words has one shingle: all of them."""
    owner, _, hashed = windows(word, counts, size)
    few = np.flatnonzero((counts > 0) & (counts < size))
    if len(few):
        begin = np.concatenate(([0], np.cumsum(counts)))
        extra = np.array([window_hashes(word[begin[t] : begin[t + 1]], int(counts[t]))[0] for t in few], dtype=U)
        owner, hashed = np.concatenate((owner, few)), np.concatenate((hashed, extra))
    order = np.lexsort((hashed, owner))
    owner, hashed = owner[order], hashed[order]
    if len(owner):
        new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (hashed[1:] != hashed[:-1])))
        owner, hashed = owner[new], hashed[new]
    return owner, hashed


# --- packed rows ---------------------------------------------------------------------------------


def pack(*columns: np.ndarray, delta: int = 0) -> bytes:
    """Columns of non-negative integers as byte planes; the first ``delta`` columns hold sorted values.

    Sorted columns are stored as differences and every column only as wide as its largest value, so the
    shuffle's own compression sees long runs of equal bytes.
    """
    out = [len(columns[0]).to_bytes(4, "little")]
    for k, column in enumerate(columns):
        column = np.ascontiguousarray(column, dtype=U)
        if k < delta and len(column):
            column = np.concatenate((column[:1], np.diff(column)))
        width = max(1, (int(column.max()).bit_length() + 7) // 8) if len(column) else 1
        out += [bytes([width]), np.ascontiguousarray(column.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()]
    return b"".join(out)


def unpack(blob: bytes, columns: int, delta: int = 0) -> list[np.ndarray]:
    """The inverse of :func:`pack`."""
    n, at, out = int.from_bytes(blob[:4], "little"), 4, []
    for k in range(columns):
        width = blob[at]
        planes = np.frombuffer(blob, dtype=np.uint8, count=width * n, offset=at + 1).reshape(width, n)
        column = np.zeros((n, 8), dtype=np.uint8)
        column[:, :width] = planes.T
        column = column.view(U).reshape(-1)
        out.append(np.cumsum(column, dtype=U) if k < delta else column)
        at += 1 + width * n
    return out


def partition_edges(sorted_hashes: np.ndarray, parts: int) -> np.ndarray:
    """Where each of ``parts`` equal ranges of the hash space begins in a sorted array, and its end."""
    bounds = np.array([(p << 64) // parts for p in range(1, parts)], dtype=U)
    return np.concatenate(([0], np.searchsorted(sorted_hashes, bounds), [len(sorted_hashes)]))


def runs(*columns: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows in sorted columns, with the total length at the end."""
    n = len(columns[0])
    if not n:
        return np.zeros(1, dtype=np.int64)
    new = np.zeros(n, dtype=bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.concatenate((np.flatnonzero(new), [n]))


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(U).view(np.int64)


def zigzag(ids: np.ndarray) -> np.ndarray:
    """Signed ids as small non-negative numbers, and back by :func:`unzigzag`; the order is not kept."""
    ids = np.asarray(ids, dtype=np.int64)
    return ((ids << 1) ^ (ids >> 63)).view(U)


def unzigzag(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, dtype=U)
    return (x >> U(1)).view(np.int64) ^ -((x & U(1)).view(np.int64))
