"""T4, low-latency form: online features from keyed state instead of stored history.

A state call of a Python operator is a round trip to the JVM, so users share a page (key = hash of
the user) and a page's events lie in blocks of six hours, one Arrow batch each, on RocksDB: a
micro-batch reads the blocks its windows reach and writes those it adds to, however many users and
events it has. Beside them lies a row per user (newest time, newest time that was pruned).

Events are answered in the order of arrival, those of one arrival time together, as in
:func:`riskline.operators.features.arrival_features`. A user's hours are kept for the widest window
plus ``lateness_us`` behind the user's newest event. An event later than that is stored and emitted
with ``exact = false``: its window may reach into pruned hours, and the batch form answers it.

The answers of a page are found in numpy (:class:`_Arrived`): slices of the micro-batch in the order
of arrival see what came before them as running sums in the order (user, time), and each other
through a merge-sort tree of the slice's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskline.config import FeatureConfig
from riskline.functions.exprs import MICROS
from riskline.operators.dominance import NONE, _Leaf

HOUR_US = 3600 * MICROS
LATENESS_US = 4 * 24 * HOUR_US
BLOCK_US = 6 * HOUR_US
PAGES = 64
PAGE_EVENTS = 1 << 14       # events of a page in a whole input, for callers that choose ``pages``
SLICE_ROWS = 1 << 15
QUIET = NONE                # number of the block of users' kept rows older than the page keeps

_ROWS = pa.schema([("user", pa.int32()), ("us", pa.int64()), ("cents", pa.int64())])
_USERS = pa.schema([("user", pa.string()), ("newest", pa.int64()), ("pruned", pa.int64())])
_BITS = 6                   # of a block of the range maxima


def _pack(schema: pa.Schema, columns) -> bytes:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)],
                                      schema=schema).serialize().to_pybytes()


def _unpack(schema: pa.Schema, data: bytes | None) -> list[np.ndarray]:
    if data is None:
        return [np.zeros(0, f.type.to_pandas_dtype()) for f in schema]
    return [c.to_numpy(zero_copy_only=False) for c in pa.ipc.read_record_batch(pa.py_buffer(data), schema).columns]


class _Arrived:
    """Rows in the order of ``place`` (user and time as one number): sums, counts and maxima of
    ranges of places. All of the rows have arrived."""

    def __init__(self, place: np.ndarray, cents: np.ndarray, us: np.ndarray):
        order = np.argsort(place, kind="stable")
        self.place, self.cents, self.us = place[order], cents[order], us[order]
        self._index()

    def add(self, place: np.ndarray, cents: np.ndarray, us: np.ndarray) -> None:
        """Further rows, sorted by place: two sorted runs are merged."""
        both = np.concatenate([self.place, place])
        order = np.argsort(both, kind="stable")
        self.place = both[order]
        self.cents = np.concatenate([self.cents, cents])[order]
        self.us = np.concatenate([self.us, us])[order]
        self._index()

    def _index(self) -> None:
        self.sums = np.concatenate([[0], np.cumsum(self.cents)])
        n = len(self.cents)
        width = 1 << _BITS
        grid = np.full(-(-max(n, 1) // width) * width, NONE)
        grid[:n] = self.cents
        grid = grid.reshape(-1, width)
        self.up = np.maximum.accumulate(grid, axis=1).ravel()                       # from a block's start
        self.down = np.maximum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()   # to its end
        self.tables = [grid.max(axis=1)]
        while len(self.tables[-1]) > 1 << len(self.tables) - 1:
            t, step = self.tables[-1], 1 << len(self.tables) - 1
            self.tables.append(np.maximum(t[:-step], t[step:]))

    def largest(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Largest cents of places lo <= i < hi, ``NONE`` of no place."""
        out = np.full(len(lo), NONE)
        first, last = lo >> _BITS, (hi - 1) >> _BITS
        far = np.flatnonzero((lo < hi) & (first < last))
        out[far] = np.maximum(self.down[lo[far]], self.up[hi[far] - 1])
        mid = far[last[far] - first[far] > 1]
        if len(mid):
            a, n = first[mid] + 1, last[mid] - first[mid] - 1
            level = np.frexp(n.astype(float))[1] - 1                                # largest power of two within n
            for k in np.unique(level):
                q = level == k
                t = self.tables[k]
                out[mid[q]] = np.maximum(out[mid[q]], np.maximum(t[a[q]], t[a[q] + n[q] - (1 << int(k))]))
        near = np.flatnonzero((lo < hi) & (first == last))
        for i in range(1 << _BITS):
            near = near[lo[near] + i < hi[near]]
            if not len(near):
                break
            out[near] = np.maximum(out[near], self.cents[lo[near] + i])
        return out

    def before(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Latest time of the rows from place ``start`` on and below ``end``, ``NONE`` without one."""
        at = np.searchsorted(self.place, end, "left") - 1
        some = at >= 0
        some[some] = self.place[at[some]] >= start[some]
        out = np.full(len(at), NONE)
        out[some] = self.us[at[some]]
        return out


class OnlineFeatures(StatefulProcessor):
    """transformWithStateInPandas over pages of users: a row per input row with its features."""

    def __init__(self, cfg: FeatureConfig, lateness_us: int, user: str, slice_rows: int):
        self.counts = [w * MICROS for w in cfg.count_windows_s]
        self.stats = cfg.stats_window_s * MICROS
        self.names = [f"velocity_{w}s" for w in cfg.count_windows_s] + ["_sum", "_max", "prev_us", "exact"]
        self.lateness = lateness_us
        self.reach = max(*self.counts, self.stats)
        self.kept = lateness_us + self.reach
        self.user, self.slice_rows = user, slice_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.blocks = handle.getMapState("blocks", "block long", "rows binary")
        self.edge = handle.getValueState("edge", "users binary, blocks binary, closed long")

    # --- state ----------------------------------------------------------------------------
    def _rows(self, ids: list[int]) -> list[np.ndarray]:
        """The rows of blocks: user, us, cents."""
        got = [_unpack(_ROWS, self.blocks.getValue((b,))[0]) for b in ids] or [_unpack(_ROWS, None)]
        return [np.concatenate(c) for c in zip(*got)]

    def _dead(self, rows: list[np.ndarray], newest: np.ndarray) -> np.ndarray:
        """Rows in hours that a user with that newest time keeps no longer."""
        last = newest[rows[0]]
        return (last != NONE) & ((rows[1] // HOUR_US + 1) * HOUR_US <= last - self.kept)

    @staticmethod
    def _pruned(pruned: np.ndarray, rows: list[np.ndarray], dead: np.ndarray) -> np.ndarray:
        out = pruned.copy()
        np.maximum.at(out, rows[0][dead], rows[1][dead])
        return out

    def _store(self, users: list[str], newest: np.ndarray, pruned: np.ndarray, ids: set[int], closed: int,
               new: list[np.ndarray]) -> None:
        """Add rows to their blocks; blocks behind what the page keeps are closed: rows that their
        users still keep (a user without newer events) go to the quiet block, the rest is pruned."""
        block = new[1] // BLOCK_US
        edge = (int(newest.max()) - self.kept) // BLOCK_US
        close = sorted(b for b in ids if b != QUIET and b < edge)
        old = block < max(closed, edge)
        for b in np.unique(block[~old]).tolist():
            own = block == b
            rows = [np.concatenate([x, y[own]]) for x, y in zip(self._rows([b] if b in ids else []), new)]
            self.blocks.updateValue((b,), (_pack(_ROWS, rows),))
            ids.add(b)
        if close or old.any():
            rows = [np.concatenate([x, y[old]]) for x, y in zip(self._rows(close + [QUIET] * (QUIET in ids)), new)]
            dead = self._dead(rows, newest)
            pruned = self._pruned(pruned, rows, dead)
            for b in close:
                self.blocks.removeKey((b,))
            ids = ids - set(close)
            if dead.all():
                if QUIET in ids:
                    self.blocks.removeKey((QUIET,))
                ids.discard(QUIET)
            else:
                self.blocks.updateValue((QUIET,), (_pack(_ROWS, [c[~dead] for c in rows]),))
                ids.add(QUIET)
        self.edge.update((_pack(_USERS, [users, newest, pruned]), np.array(sorted(ids), np.int64).tobytes(),
                          max(closed, edge)))

    # --- answers --------------------------------------------------------------------------
    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts, numbers, names = [], [], []
        for pdf in rows:                        # kept as columns of bytes until they leave
            if len(pdf):
                numbers.append([pdf[c].to_numpy(np.int64) for c in ("us", "created_us", "cents_")])
                names.append(pa.array(pdf[self.user], pa.string()))
                parts.append(pa.RecordBatch.from_pandas(pdf.drop(columns=["page_", "cents_"]), preserve_index=False))
        if not parts:
            return
        us, arrival, cents = (np.concatenate(c) for c in zip(*numbers))
        got = self._answers(pa.chunked_array(names), us, arrival, cents)
        lo = 0
        for part in parts:
            hi = lo + part.num_rows
            own = pd.DataFrame(dict(zip(self.names, (c[lo:hi] for c in got))))
            own["prev_us"] = own["prev_us"].astype("Int64").mask(own["prev_us"] == NONE)
            yield pd.concat([part.to_pandas(), own], axis=1)
            lo = hi

    def _answers(self, names: pa.ChunkedArray, us: np.ndarray, arrival: np.ndarray, cents: np.ndarray) -> list[np.ndarray]:
        packed, held, closed = self.edge.get() if self.edge.exists() else (None, b"", NONE)
        known = [] if packed is None else pa.ipc.read_record_batch(pa.py_buffer(packed), _USERS)["user"].to_pylist()
        _, newest, pruned = _unpack(_USERS, packed)
        code = {u: i for i, u in enumerate(known)}
        coded = names.combine_chunks().dictionary_encode()
        user = np.array([code.setdefault(u, len(code)) for u in coded.dictionary.to_pylist()])[coded.indices.to_numpy()]
        fresh = np.full(len(code) - len(known), NONE)
        newest, pruned = np.concatenate([newest, fresh]), np.concatenate([pruned, fresh])
        ids = set(np.frombuffer(held, np.int64).tolist())

        # state within reach of a window
        lo, hi = (int(us.min()) - self.reach) // BLOCK_US, int(us.max()) // BLOCK_US
        near = sorted(b for b in ids if lo <= b <= hi or b == QUIET and lo < closed)
        state = self._rows(near)
        dead = self._dead(state, newest)
        lost = self._pruned(pruned, state, dead)
        state = [c[~dead] for c in state]

        times = np.unique(np.concatenate([state[1], us, newest]))
        wide = len(times) + 1

        def place(who: np.ndarray, t: np.ndarray, side: str = "left") -> np.ndarray:
            return who.astype(np.int64) * wide + np.searchsorted(times, t, side)

        own = place(user, us)                   # rows of the same user and time share a place
        start = user.astype(np.int64) * wide
        begins = [place(user, us - w, "right") for w in (*self.counts, self.stats)]
        got = [np.zeros(len(us), np.int64) for _ in self.counts] + [
            np.zeros(len(us), np.int64), np.zeros(len(us), np.int64), np.full(len(us), NONE)]     # sum, largest, latest

        def ranges(places: np.ndarray, q: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
            return [np.searchsorted(places, b[q], "left") for b in begins], np.searchsorted(places, own[q], "right")

        arrived = _Arrived(place(state[0], state[1]), state[2], state[1])
        order = np.argsort(arrival, kind="stable")
        ends = np.flatnonzero(np.append(np.diff(arrival[order]) != 0, True)) + 1    # of the arrival times
        a = 0
        while a < len(order):
            # up to ``slice_rows`` rows, or one arrival time of more
            within = np.searchsorted(ends, a + self.slice_rows, "right") - 1
            b = int(ends[within]) if within >= 0 and ends[within] > a else int(ends[np.searchsorted(ends, a, "right")])
            q = order[a:b]
            q = q[np.argsort(own[q], kind="stable")]
            alone = arrival[q].min() == arrival[q].max()
            if alone:                           # they see each other
                arrived.add(own[q], cents[q], us[q])
            los, end = ranges(arrived.place, q)
            for i in range(len(self.counts)):
                got[i][q] += end - los[i]
            got[-3][q] += arrived.sums[end] - arrived.sums[los[-1]]
            got[-2][q] = np.maximum(got[-2][q], arrived.largest(los[-1], end))
            got[-1][q] = np.maximum(got[-1][q], arrived.before(start[q], own[q]))
            if not alone:
                tree = _Leaf(np.arange(len(q)), arrival[q], cents[q], us[q])
                los, end = ranges(own[q], q)
                for i in range(len(self.counts)):
                    got[i][q] += tree.ask(los[i], end, arrival[q])[0]
                _, total, largest, _ = tree.ask(los[-1], end, arrival[q])
                got[-3][q] += total
                got[-2][q] = np.maximum(got[-2][q], largest)
                first, until = (np.searchsorted(own[q], x[q], "left") for x in (start, own))
                got[-1][q] = np.maximum(got[-1][q], tree.ask(first, until, arrival[q])[3])
                arrived.add(own[q], cents[q], us[q])
            a = b

        # none within reach: the user's older events, then the newest that was pruned
        none = np.flatnonzero((got[-1] == NONE) & (user < len(known)))
        far = sorted(ids - set(near))
        if len(none) and far:
            older = self._rows(far)
            dead = self._dead(older, newest)
            lost = self._pruned(lost, older, dead)
            older = [c[~dead] for c in older]
            times = np.unique(np.concatenate([older[1], us[none]]))
            wide = len(times) + 1
            got[-1][none] = _Arrived(place(older[0], older[1]), older[2], older[1]).before(
                user[none].astype(np.int64) * wide, place(user[none], us[none]))
        last = lost[user]
        got[-1] = np.where((got[-1] == NONE) & (last < us), last, got[-1])

        seen = self._newest(user, us, arrival, newest)
        exact = us > seen - self.lateness
        np.maximum.at(newest, user, us)
        self._store(list(code), newest, pruned, ids, closed, [user, us, cents])
        return [*got, exact]

    @staticmethod
    def _newest(user: np.ndarray, us: np.ndarray, arrival: np.ndarray, newest: np.ndarray) -> np.ndarray:
        """The newest time of a row's user, of all that had arrived with the row or before it."""
        order = np.lexsort((arrival, user))
        u, t = user[order], us[order]
        new = np.append(True, u[1:] != u[:-1])
        t = np.where(new, np.maximum(t, newest[u]), t)
        times = np.unique(t)
        run = np.maximum.accumulate(u.astype(np.int64) * len(times) + np.searchsorted(times, t)) - u.astype(np.int64) * len(times)
        same = np.append((u[1:] == u[:-1]) & (arrival[order][1:] == arrival[order][:-1]), False)
        stop = np.flatnonzero(~same)            # last row of a user's arrival time
        out = np.empty(len(us), np.int64)
        out[order] = times[run[stop[np.searchsorted(stop, np.arange(len(u)))]]]
        return out

    def close(self) -> None:
        pass


def online_features(events: DataFrame, cfg: FeatureConfig = FeatureConfig(), *, user: str = "user_id",
                    lateness_us: int = LATENESS_US, pages: int = PAGES, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Streaming ``events`` (us, created_us, amount, ``user``, ...) with the as-of aggregates of
    ``arrival_features`` and ``exact``. Rows without a user, a time or an arrival time carry no
    state and are left out; the batch form reports them. Users share ``pages`` keys, a number that is
    fixed when the stream first starts."""
    # names that begin with an underscore do not reach the processor
    rows = events.filter(f"{user} IS NOT NULL AND us IS NOT NULL AND created_us IS NOT NULL").withColumn(
        "cents_", F.coalesce(F.col("amount") * 100, F.lit(0)).cast("bigint")).withColumn(
        "page_", F.pmod(F.xxhash64(user), F.lit(pages)))
    added = ", ".join(f"velocity_{w}s long" for w in cfg.count_windows_s)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in events.schema.fields)
    got = rows.groupBy("page_").transformWithStateInPandas(
        OnlineFeatures(cfg, lateness_us, user, slice_rows), f"{schema}, {added}, _sum long, _max long, prev_us long, exact boolean",
        "Append", "None")
    s = cfg.stats_window_s
    money = lambda c, t: (F.col(c).cast("decimal(28,0)") / 100).cast(t)
    return got.withColumn(f"user_amt_sum_{s}s", money("_sum", "decimal(28,2)")) \
        .withColumn(f"user_amt_max_{s}s", money("_max", "decimal(18,2)")).drop("_sum", "_max") \
        .withColumn("secs_since_prev", F.when(F.col("prev_us").isNull(), F.lit(-1.0)).otherwise(
            (F.col("us") - F.col("prev_us")).cast("double") / MICROS))
