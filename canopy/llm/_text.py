"""Words and their hashes for whole Arrow columns, with numpy passes over the bytes.

A word is a longest run of ASCII letters, ASCII digits and characters beyond ASCII, in lower case.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The same words in SQL: regexp_extract_all(lower(text), WORD).
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CHUNK = 2 << 20

_U = np.uint64
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_LUT = np.zeros(256, dtype=bool)
_LUT[128:] = True
for _c in "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _LUT[ord(_c)] = True
_pows: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _pows or len(_pows[base]) < n:
        x = np.full(max(n, CHUNK) + 1, base, dtype=_U)
        x[0] = 1
        _pows[base] = np.cumprod(x, dtype=_U)
    return _pows[base][:n]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x + _U((salt * 0xD1342543DE82EF95 + 0x9E3779B97F4A7C15) % (1 << 64))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def pieces(batch: pa.RecordBatch, column: int, most: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about most bytes of text; a longer text comes alone and whole."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    group = np.cumsum(size) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    texts = texts.fill_null("") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offs = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    bytes_ = np.frombuffer(data, dtype=np.uint8)[offs[0] : offs[-1]] if data is not None and len(data) else np.zeros(0, np.uint8)
    return bytes_, offs - offs[0]


def give_back() -> None:
    """Returns what is freed to the system: Arrow and the C library keep it otherwise, in each worker of an executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """run, but its worker, which waits for other tasks or goes on with them, gives back what is freed at the end."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


@dataclass
class Words:
    data: np.ndarray  # lower-case bytes of the whole column
    offsets: np.ndarray  # of the rows in data
    start: np.ndarray  # of the words in data
    end: np.ndarray
    doc: np.ndarray  # row of each word
    hash: np.ndarray

    def bounds(self, rows: int) -> np.ndarray:
        """Index of the first word of each row, and the number of words at the end."""
        return np.searchsorted(self.doc, np.arange(rows + 1))

    def chars(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each word within its row, in characters."""
        cum = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        base = cum[self.offsets[self.doc]]
        return cum[self.start] - base, cum[self.end] - base


def words(texts: pa.Array) -> Words:
    data, offs = raw(pc.utf8_lower(texts))
    n = len(data)
    if not n:
        e = np.zeros(0, np.int64)
        return Words(data, offs, e, e, e, e.astype(_U))
    w = _LUT[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = False, w[:-1]
    after[-1], after[:-1] = False, w[1:]
    before[offs[:-1][offs[:-1] < n]] = False
    after[offs[1:][offs[1:] > 0] - 1] = False
    start, end = np.flatnonzero(w & ~before), np.flatnonzero(w & ~after) + 1
    doc = np.searchsorted(offs, start, side="right") - 1
    return Words(data, offs, start, end, doc, hash_ranges(data, start, end))


def hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each range, none of them empty."""
    n = len(data)
    cum = np.cumsum((data.astype(_U) + _U(1)) * _powers(_P, n), dtype=_U)
    low = np.where(start > 0, cum[np.maximum(start, 1) - 1], _U(0))
    h = (cum[end - 1] - low) * _powers(_P_INV, n)[start]
    return mix(h, 1) ^ (end - start).astype(_U)


_MULT = [mix(np.array([i], dtype=_U), 77)[0] | _U(1) for i in range(64)]


def runs(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n successive hashes; len(h) - n + 1 of them."""
    out = np.zeros(max(0, len(h) - n + 1), dtype=_U)
    for j in range(n):
        out += mix(h[j : len(h) - n + 1 + j], 5) * _MULT[j]
    return mix(out, n)


def long_runs(h: np.ndarray, n: int) -> np.ndarray:
    """As runs, in time that doesn't depend on n: a polynomial hash from running sums."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=_U)
    cum = np.concatenate([np.zeros(1, _U), np.cumsum(mix(h, 9) * _powers(_P, len(h)), dtype=_U)])
    return mix((cum[n:] - cum[:-n]) * _powers(_P_INV, len(h))[:m], n)


def grams(w: Words, rows: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct runs of n words of each row, in order of row and hash.

    A row of fewer words, but at least one, has the run of all its words as its only one.
    """
    b = w.bounds(rows)
    all_ = runs(w.hash, n)
    docs, hashes = [], []
    for i in np.flatnonzero(np.diff(b)):
        a, z = int(b[i]), int(b[i + 1])
        if z - a >= n:
            s = np.sort(all_[a : z - n + 1])
            s = s[np.concatenate([[True], s[1:] != s[:-1]])]
        else:
            s = runs(w.hash[a:z], z - a)
        docs.append(np.full(len(s), i))
        hashes.append(s)
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    return np.concatenate(docs), np.concatenate(hashes)
