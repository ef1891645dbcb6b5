"""Counting quotient filters over integer keys of two limbs, as byte strings.

A key of ``high_bits + low_bits`` bits is permuted invertibly (a Feistel network over its two
limbs) and cut into a quotient, its highest bits, and the whole rest, the remainder, so nothing
is lost: the filter counts exactly and gives its keys back. Elements are kept in the order of
(quotient, remainder), which is the order of the permuted key whatever the quotient's width, so
filters of any two widths are merged in one pass over both.

Layout of a filter: header; ``occupied``, one bit per quotient, says which quotients have a run;
``ends``, one bit per slot, marks the last slot of a run; the remainders in slots of whole bytes;
a counter byte per slot, and eight bytes for each counter of ESCAPE or more.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_HEADER = np.dtype([("prefix", "<u8"), ("slots", "<u4"), ("large", "<u4"), ("quotient_bits", "u1")])
ESCAPE = 255
_ROUND_KEYS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def _scramble(x: np.ndarray, key: int, bits: int) -> np.ndarray:
    x = (x + _U(key)) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(29))) * _U(0x94D049BB133111EB)
    return (x ^ (x >> _U(32))) >> _U(64 - bits)


class Layout:
    """Bits of the two limbs of a key: ``high_bits`` 1..31, ``low_bits`` 1..62."""

    def __init__(self, high_bits: int, low_bits: int):
        if not (0 < high_bits <= 31 and 0 < low_bits <= 62):
            raise ValueError(f"limbs of {high_bits} and {low_bits} bits are not supported")
        self.high_bits, self.low_bits = high_bits, low_bits

    def permute(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for i, key in enumerate(_ROUND_KEYS):
            if i % 2:
                low = low ^ _scramble(high, key, self.low_bits)
            else:
                high = high ^ _scramble(low, key, self.high_bits)
        return high, low

    def invert(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for i, key in reversed(list(enumerate(_ROUND_KEYS))):
            if i % 2:
                low = low ^ _scramble(high, key, self.low_bits)
            else:
                high = high ^ _scramble(low, key, self.high_bits)
        return high, low


def counted(high: np.ndarray, low: np.ndarray, count: np.ndarray | None = None, low_bits: int = 64
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their counts (one each by default). Keys that fit 64
    bits are sorted as one number; sorted runs that were put together are merged by the sort."""
    wide = low_bits < 64 and len(high) > 0 and int(high.max()).bit_length() + low_bits <= 64
    if wide:
        key = (high << _U(low_bits)) | low
        if count is None:
            key.sort()
        else:
            order = np.argsort(key, kind="stable")
            key, count = key[order], count[order]
        new = np.ones(len(key), bool)
        np.not_equal(key[1:], key[:-1], out=new[1:])
    else:
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        count = None if count is None else count[order]
        new = np.ones(len(high), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    first = np.flatnonzero(new)
    if count is None:
        total = np.diff(np.append(first, len(new)))
    else:
        total = np.add.reduceat(count, first) if len(first) else count[:0]
    if wide:
        key = key[first]
        return key >> _U(low_bits), key & _U((1 << low_bits) - 1), total.astype(np.int64)
    return high[first], low[first], total.astype(np.int64)


def pack(layout: Layout, prefix: int, prefix_bits: int, high: np.ndarray, low: np.ndarray,
         count: np.ndarray) -> bytes:
    """A filter of sorted permuted keys whose top ``prefix_bits`` bits are ``prefix``."""
    n = len(high)
    inner = layout.high_bits - prefix_bits           # bits of the high limb below the prefix
    q_bits = min(inner, max(int(n).bit_length(), 1))
    rest = inner - q_bits                            # bits of the high limb in the remainder
    within = high & _U((1 << inner) - 1)
    quotient = (within >> _U(rest)).astype(np.int64)
    occupied = np.zeros(1 << q_bits, bool)
    occupied[quotient] = True
    ends = np.ones(n, bool)
    ends[:-1] = quotient[1:] != quotient[:-1]
    high_bytes, low_bytes = -(-rest // 8), -(-layout.low_bits // 8)
    tail = (within & _U((1 << rest) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)[:, :high_bytes]
    body = low.astype("<u8").view(np.uint8).reshape(n, 8)[:, :low_bytes]
    large = count >= ESCAPE
    head = np.array([(prefix, n, large.sum(), q_bits)], _HEADER)
    return b"".join([head.tobytes(), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(),
                     np.concatenate([tail, body], axis=1).tobytes(),
                     np.minimum(count, ESCAPE).astype(np.uint8).tobytes(),
                     count[large].astype("<i8").tobytes()])


def unpack(layout: Layout, prefix_bits: int, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted permuted keys of a filter and their counts."""
    head = np.frombuffer(data, _HEADER, 1)[0]
    n, q_bits = int(head["slots"]), int(head["quotient_bits"])
    at = _HEADER.itemsize

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return np.frombuffer(data, np.uint8, size, at - size)

    occupied = np.flatnonzero(np.unpackbits(take(-(-(1 << q_bits) // 8)), count=1 << q_bits))
    ends = np.unpackbits(take(-(-n // 8)), count=n)
    inner = layout.high_bits - prefix_bits
    rest = inner - q_bits
    high_bytes, low_bytes = -(-rest // 8), -(-layout.low_bits // 8)
    slots = take(n * (high_bytes + low_bytes)).reshape(n, -1)
    wide = np.zeros((n, 16), np.uint8)
    wide[:, :high_bytes], wide[:, 8:8 + low_bytes] = slots[:, :high_bytes], slots[:, high_bytes:]
    limbs = wide.view("<u8")
    run = np.cumsum(ends) - ends                     # the run each slot is in
    quotient = occupied[run].astype(_U)
    high = (_U(int(head["prefix"])) << _U(inner)) | (quotient << _U(rest)) | limbs[:, 0]
    count = take(n).astype(np.int64)
    count[count == ESCAPE] = np.frombuffer(data, "<i8", int(head["large"]), at)
    return high, limbs[:, 1].copy(), count


def segments(layout: Layout, prefix_bits: int, high: np.ndarray, low: np.ndarray, count: np.ndarray
             ) -> list[tuple[int, bytes]]:
    """(prefix, filter) of sorted permuted keys, one for every prefix that occurs."""
    prefix = (high >> _U(layout.high_bits - prefix_bits)).astype(np.int64)
    cut = np.flatnonzero(np.diff(prefix)) + 1
    return [(int(prefix[lo]), pack(layout, int(prefix[lo]), prefix_bits, high[lo:hi], low[lo:hi], count[lo:hi]))
            for lo, hi in zip([0, *cut], [*cut, len(high)]) if hi > lo]


class Merger:
    """Adds filters of one prefix. Elements wait until there are as many as distinct keys were
    found so far (PENDING at least), then all are merged: each is moved few times, and no more
    than twice the distinct keys and PENDING are held."""

    PENDING = 1 << 20

    def __init__(self, layout: Layout, prefix_bits: int):
        self.layout, self.prefix_bits = layout, prefix_bits
        self.runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.known = self.waiting = 0

    def _join(self) -> None:
        self.runs = [counted(*(np.concatenate(x) for x in zip(*self.runs)), low_bits=self.layout.low_bits)]
        self.known, self.waiting = len(self.runs[0][0]), 0

    def add(self, data: bytes) -> None:
        self.runs.append(unpack(self.layout, self.prefix_bits, data))
        self.waiting += len(self.runs[-1][0])
        if self.waiting > max(self.known, self.PENDING):
            self._join()

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The original keys (not sorted) and their counts."""
        self._join()
        high, low, count = self.runs[0]
        return *self.layout.invert(high, low), count
