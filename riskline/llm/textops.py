"""Vectorised word hashing over the buffers of an Arrow string column.

A batch of texts is walked in runs of documents of about a megabyte, so the arrays stay a
few dozen times the size of such a run, or of the longest single text.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 20
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: every ASCII byte but letters separates words
NOT_LETTERS = np.arange(256) < 128
NOT_LETTERS[65:91] = NOT_LETTERS[97:123] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: neighbouring inputs give unrelated outputs."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as many as were needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, _U)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, RUN_BYTES + 1024)
            self.up, self.down = (np.cumprod(np.concatenate(
                [np.ones(1, _U), np.full(size - 1, b, _U)])) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


_BYTES = _Powers(0x5851F42D4C957F2D)
_SEQUENCE = (_Powers(0xD1342543DE82EF95), _Powers(0xAF251AF3B0F025B5))


class Words:
    """Words of the rows ``row0 ..`` of a column: 64-bit hashes and byte places."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, row0: int, lower: bool,
                 separators: np.ndarray = _SPACE):
        self.row0, self.rows = row0, len(offsets) - 1
        a = data[offsets[0]:offsets[-1]]
        at = offsets - offsets[0]
        if lower:
            a = _LOWER[a]
        self.data = a
        inside = ~separators[a]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cut = at[(at > 0) & (at < len(a))]
        first[cut] = inside[cut]
        last[cut - 1] = inside[cut - 1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        #: words of row r: first[r] up to first[r + 1]
        self.first = np.searchsorted(self.starts, at)
        up, down = _BYTES(len(a) + 1)
        total = np.concatenate([np.zeros(1, _U), np.cumsum(_BYTE[a] * up[:-1])])
        self._total, self._down = total, down
        self.hashes = mix((total[self.ends] - total[self.starts]) * down[self.starts])

    def prefixes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Which words are longer than ``n`` bytes, and hashes of their first ``n``."""
        longer = np.flatnonzero(self.ends - self.starts > n)
        at = self.starts[longer]
        return longer, mix((self._total[at + n] - self._total[at]) * self._down[at] + _U(n))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``k`` words, and which of them lie within one row."""
        h = self.hashes
        n = len(h) - k + 1
        if n <= 0:
            return np.zeros(0, _U), np.zeros(0, bool)
        w = h[:n].copy()
        for j in range(1, k):
            w *= _U(0x9FB21C651E98DF25)
            w += h[j:n + j]
        end = np.repeat(self.first[1:], self.counts())[:n]
        return mix(w), np.arange(n) + k <= end

    def sequence_keys(self) -> np.ndarray:
        """Two 64-bit keys of each row's whole word sequence, shape (rows, 2)."""
        out = np.empty((self.rows, 2), _U)
        n = self.counts().astype(_U)
        for c, powers in enumerate(_SEQUENCE):
            up, down = powers(len(self.hashes) + 1)
            total = np.concatenate([np.zeros(1, _U), np.cumsum(self.hashes * up[:-1])])
            out[:, c] = mix((total[self.first[1:]] - total[self.first[:-1]])
                            * down[self.first[:-1]] + n * _U(0x9E3779B97F4A7C15))
        return out


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n, start = len(column), column.offset
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, n + 1 + start)[start:] if n else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def word_runs(column: pa.Array, lower: bool = False,
              separators: np.ndarray = _SPACE) -> Iterator[Words]:
    """The column's rows in order, in runs of at most RUN_BYTES or of one longer text."""
    data, at = text_buffers(column)
    row, n = 0, len(at) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + RUN_BYTES, "right")) - 1)
        yield Words(data, at[row:end + 1], row, lower, separators)
        row = end


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
