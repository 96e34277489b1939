"""Vectorised byte, word and hash kernels over Arrow string columns.

Everything here works inside one task on one Arrow batch, in blocks of about half
a megabyte, so that memory stays bounded whatever the batch holds.  A text is
always processed whole: a block ends at a document's edge.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_MASK = (1 << 64) - 1
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_GOLD = U64(0x9E3779B97F4A7C15)

#: word bytes: everything but space and \x09-\x0D
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: word bytes: digits, a-z and every byte of a non-ASCII character (after lower-casing)
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True
#: A-Z to a-z, all other bytes as they are
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise on uint64."""
    h = h ^ (h >> U64(30))
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * _GOLD)

_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        for i, base in enumerate((_P, _P_INV)):
            table = np.full(size, base, dtype=U64)
            table[0] = 1
            _powers[i] = np.cumprod(table, dtype=U64)
    return _powers[0][:n], _powers[1]


class RangeHasher:
    """64-bit hashes of any ranges of one sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        powers, self._inverse = _power_tables(n + 1)
        self._sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(values * powers[:n], out=self._sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self._sums[ends] - self._sums[starts]) * self._inverse[starts]
        return mix(h + (ends - starts + 1).astype(U64) * _GOLD)  # an empty range has no hash of 0


def text_blocks(column: pa.Array, max_bytes: int = 1 << 19):
    """Yield (first row, end row, bytes, document offsets) for runs of whole documents.

    A null counts as an empty text.
    """
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    buffers = column.buffers()
    offs = np.frombuffer(buffers[1], dtype=kind, count=n + 1, offset=column.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + max_bytes, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


class Words:
    """The words of a block: byte ranges, hashes, and each document's first word."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, table: np.ndarray = NOT_SPACE, lower: bool = False):
        self.buf = buf = LOWER[buf] if lower else buf
        n = len(buf)
        inside = table[buf]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        end = inside.copy()
        end[:-1] &= ~inside[1:]
        at = offs[:-1][offs[:-1] < n]
        begin[at] = inside[at]
        at = offs[1:][offs[1:] > 0] - 1
        end[at] = inside[at]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.starts, offs)
        self._hash: np.ndarray | None = None

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = RangeHasher(BYTE_VALUES[self.buf])(self.starts, self.ends)
        return self._hash

    def last(self) -> np.ndarray:
        """For each word, the end of its document in words."""
        return np.repeat(self.first[1:], self.counts)

    def text(self, a: int, b: int) -> bytes:
        """Words a to b, joined by one space."""
        return b" ".join(self.buf[s:e].tobytes() for s, e in zip(self.starts[a:b], self.ends[a:b], strict=True))


class Lookup:
    """Finds 64-bit keys: a bit filter first, then a binary search for the few left."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(np.asarray(keys, dtype=U64))
        bits = min(26, max(12, int(len(self.keys) * 16).bit_length()))
        self._shift = U64(64 - bits)
        self._filter = np.zeros(1 << bits, dtype=bool)
        self._filter[self.keys >> self._shift] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in h of known keys, and each one's index among the sorted keys."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self._filter[h >> self._shift])
        i = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        ok = self.keys[i] == h[at]
        return at[ok], i[ok]


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """min(h[j:j+w]) for every j that has w values."""
    n = len(h) - w + 1
    if n <= 0:
        return h[:0]
    a, k = h, 1
    while 2 * k <= w:
        a = np.minimum(a[:-k], a[k:])
        k *= 2
    return a[:n] if k == w else np.minimum(a[:n], a[w - k : w - k + n])


def window_minima(h: np.ndarray, w: int, valid: np.ndarray) -> np.ndarray:
    """Positions that are the minimum of some valid window of w values (all ties).

    valid: for each window start j, whether the window counts.  Whether a
    position is chosen depends on the values of a window alone, so equal windows
    have equal chosen positions wherever they stand.
    """
    m = sliding_min(h, w)
    if not len(m):
        return np.zeros(0, np.int64)
    m = np.where(valid[: len(m)], m, U64(0))
    padded = np.concatenate([np.zeros(w - 1, U64), m, np.zeros(w - 1, U64)])
    most = ~sliding_min(~padded, w)  # a sliding maximum
    return np.flatnonzero((most == h) & (most > 0))


def signed(h: np.ndarray) -> np.ndarray:
    """uint64 as Spark's long."""
    return h.view(np.int64)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges [start, start + length)."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)
