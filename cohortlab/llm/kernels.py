"""Vectorised text kernels for Arrow batches.

The operators of this subpackage read texts through ``mapInArrow``. The
helpers here turn a batch of texts into flat numpy arrays (bytes, words, word
hashes) without making a Python string per word. Work is cut into slices of
at most ``SLICE_BYTES`` bytes (a longer text is a slice of its own), so that
memory does not follow the size of an Arrow batch.

Hashes are 64-bit and depend on the content alone: no process seed, no
position in the batch, so every executor and every retry gives the same value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U = np.uint64
_P = U(0x9E3779B97F4A7C15)
_Q = U(0xD6E8FEB86659FD93)
_M1 = U(0xBF58476D1CE4E5B9)
_M2 = U(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection), so that any bits can be used."""
    h = (h ^ (h >> U(30))) * _M1
    h = (h ^ (h >> U(27))) * _M2
    return h ^ (h >> U(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(max(n, 1), base, dtype=np.uint64)
    p[0] = U(1)
    return np.cumprod(p)


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _Q) | U(1)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def unsigned(h) -> np.ndarray:
    return np.ascontiguousarray(h, dtype=np.int64).view(np.uint64)


def utf8_buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null has no bytes."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    big = pa.types.is_large_string(col.type)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=np.int64 if big else np.int32)[col.offset: col.offset + len(col) + 1] \
        if len(col) else np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw, offsets.astype(np.int64)


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1, a + 1)
        yield a, min(b, n)
        a = min(b, n)


class Words:
    """The words of a slice of rows, as flat arrays.

    ``start``/``end``: byte positions in ``raw``; ``row``: row of the word in
    the slice; ``first``: index of each row's first word (one entry more than
    rows); ``hash``: 64-bit content hash of the word's bytes.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        """``table``: 256 entries; the byte a word holds in place of each
        byte, 0 for bytes that separate words."""
        base = int(offsets[0])
        self.base, self.offsets = base, offsets - base
        data = table[raw[base: int(offsets[-1])]]
        rows = len(offsets) - 1
        mask = data != 0
        if len(data):
            edge = np.zeros(len(data) + 1, dtype=bool)
            edge[self.offsets] = True
            before = np.empty_like(mask)
            before[0] = False
            before[1:] = mask[:-1]
            after = np.empty_like(mask)
            after[-1] = False
            after[:-1] = mask[1:]
            self.start = np.flatnonzero(mask & (~before | edge[:-1]))
            self.end = np.flatnonzero(mask & (~after | edge[1:])) + 1
        else:
            self.start = self.end = np.zeros(0, dtype=np.int64)
        n = len(self.start)
        self.first = np.searchsorted(self.start, self.offsets)
        self.first[-1] = n
        self.row = np.repeat(np.arange(rows), np.diff(self.first))
        if n:
            lens = self.end - self.start
            at = np.zeros(n, dtype=np.int64)
            np.cumsum(lens[:-1], out=at[1:])
            v = _BYTE[data[mask]]
            pos = np.arange(len(v), dtype=np.int64) - np.repeat(at, lens)
            v *= powers(_P, int(lens.max()))[pos]
            self.hash = mix(np.add.reduceat(v, at) + lens.astype(np.uint64))
        else:
            self.hash = np.zeros(0, dtype=np.uint64)
        self.data = data

    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]: self.end[i]].tobytes()


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive word hashes (shorter than ``h`` by k - 1)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    acc = np.zeros(n, dtype=np.uint64)
    for p, j in zip(powers(_Q, k), range(k), strict=True):
        acc += h[j: j + n] * p
    return mix(acc + U(k))


def sequence_hash(h: np.ndarray) -> np.uint64:
    """The same value as ``windows`` gives for the whole sequence."""
    return windows(h, len(h))[0]


def ascii_table(keep: str, lower: bool) -> np.ndarray:
    """Byte table for Words: bytes from 0x80 stay; ASCII by ``keep``:
    "alnum" (letters and digits) or "nonspace" (all but space and 0x09-0x0D)."""
    t = np.arange(256, dtype=np.uint8)
    if lower:
        t[65:91] += 32
    if keep == "alnum":
        for b in range(128):
            if not chr(b).isalnum():
                t[b] = 0
    else:
        # a zero byte is a word byte here, but 0 means "separator" in the
        # table: give it 0xFF, which no UTF-8 text holds
        t[0] = 255
        for b in (0x20, *range(0x09, 0x0E)):
            t[b] = 0
    return t


def char_positions(raw: np.ndarray) -> np.ndarray:
    """Code points before each byte position (one entry more than bytes)."""
    out = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=out[1:])
    return out
