"""Vectorised words of Arrow text columns.

A word is a maximal run of bytes other than space and ``\\x09-\\x0d``; as
those are ASCII, a word of bytes is the UTF-8 of a word of code points.
Everything below works on whole batches with numpy; texts are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
_P = 0x9E3779B97F4A7C15 | 1          # odd: has an inverse modulo 2**64
_P_INV = pow(_P, -1, 1 << 64)
SLICE_BYTES = 1 << 20                # text handled at once (a longer row goes alone)
_BLOCK_BYTES = 1 << 17               # bytes hashed at once

_WORD_BYTE = np.ones(256, dtype=bool)
_WORD_BYTE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    def table(size):
        p = np.full(size, U(_P)); p[0] = 1
        q = np.full(size, U(_P_INV)); q[0] = 1
        return np.cumprod(p), np.cumprod(q)
    if n > _BLOCK_BYTES + 4096:         # a huge word: for this once
        return table(n)
    if "p" not in _powers:
        _powers["p"], _powers["q"] = table(_BLOCK_BYTES + 4096)
    return _powers["p"], _powers["q"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash (a bijection with good avalanche)."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U(27))
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


@dataclass
class Slice:
    """Some rows of a batch: text bytes and where each row lies in them."""
    lo: int                 # first row in the batch
    hi: int
    buf: np.ndarray         # uint8, all rows of the slice
    offs: np.ndarray        # int64, hi - lo + 1 offsets into buf

    @property
    def rows(self) -> int:
        return self.hi - self.lo


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Rows of a text column in slices of about ``limit`` bytes; a null text
    is an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    _, ob, db = column.buffers()
    offs = np.frombuffer(ob, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(db, dtype=np.uint8) if db is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield Slice(lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
        lo = hi


@dataclass
class Words:
    starts: np.ndarray      # byte offsets in the slice
    ends: np.ndarray
    row: np.ndarray         # int64 row (within the slice) of each word
    first: np.ndarray       # index of each row's first word, rows + 1 entries


def find_words(s: Slice) -> Words:
    inside = _WORD_BYTE[s.buf]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    cut = s.offs[1:-1]
    if len(inside):
        at = cut[cut < len(inside)]
        begin[at] = inside[at]
        at = cut[cut > 0] - 1
        end[at] = inside[at]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    first = np.searchsorted(starts, s.offs)
    return Words(starts, ends, np.repeat(np.arange(s.rows), np.diff(first)), first)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each (ascending, disjoint) byte span, block by block."""
    out = np.empty(len(starts), dtype=np.uint64)
    i, n = 0, len(starts)
    while i < n:
        lo = int(starts[i])
        j = int(np.searchsorted(ends, lo + _BLOCK_BYTES, side="right"))
        j = max(j, i + 1)
        hi = int(ends[j - 1])
        p, q = _power_tables(hi - lo + 1)
        acc = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum((buf[lo:hi].astype(np.uint64) + U(1)) * p[:hi - lo], out=acc[1:])
        a, b = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (acc[b] - acc[a]) * q[a] + (b - a).astype(np.uint64) * U(0xD6E8FEB86659FD93)
        i = j
    return mix(out)


def grams(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``k`` consecutive words, and whether they are of one row.
    Both are as long as ``h``; the tail is not valid."""
    n = len(h)
    out, ok = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=bool)
    m = n - k + 1
    if m > 0:
        g = np.zeros(m, dtype=np.uint64)
        for j in range(k):
            g *= U(0x2545F4914F6CDD1D)
            g += h[j:j + m]
        out[:m] = mix(g)
        ok[:m] = row[:m] == row[k - 1:]
    return out, ok


def signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))
