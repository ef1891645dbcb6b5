"""T2 / T3 streaming form: the claim ledger as a keyed stateful operator with lease timers.

Key = event id, state (RocksDB) = (status, first_seen_us, last_seen_us, attempts, error_reason).
One task owns a key, so concurrent claims of the same event have exactly one winner (the
reference needs a row lock for this). Deliveries of a key inside one micro-batch are applied one
by one in arrival order, each giving an update.

A claim that is left ``processing`` sets an event-time timer for the end of its lease. When the
watermark passes it without a further claim, the operator emits the expired lease by itself: no
new delivery is needed to learn that an event is stuck.

A state call of a Python operator is a round trip to the JVM, about four of them per key and
micro-batch. Many events therefore share a page (``pages``: key = hash of the event id): its claims
are one Arrow batch, read and written once per micro-batch, and it has one timer, for the lease that
ends first. Both forms give the same updates.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskline.config import ERROR_REASON_MAX, LEASE_S, UNKNOWN_OUTCOME
from riskline.functions.exprs import from_micros

_FIELDS = ("event_id", "status", "first_seen_us", "last_seen_us", "attempts", "error_reason", "claimed",
           "received_us", "expired")
_UPDATE = Row(*_FIELDS)
OUT_SCHEMA = ("event_id string, status string, first_seen_us long, last_seen_us long, "
              "attempts int, error_reason string, claimed boolean, received_us long, expired boolean")
STATE_SCHEMA = ("status string, first_seen_us long, last_seen_us long, attempts int, "
                "error_reason string")


PAGE_EVENTS = 1024          # events of a page, about 60 bytes each


def _step(state: tuple | None, received: int, outcome: str | None, lease_us: int):
    """One delivery: returns (new_state, claimed)."""
    outcome = UNKNOWN_OUTCOME if outcome is None else outcome
    if state is None:
        claim, first, attempts, reason = True, received, 1, None
    else:
        status, first, last, attempts, reason = state
        if status == "success":
            return state, False
        if status == "processing" and received - last < lease_us:
            return state, False
        claim, attempts = True, attempts + 1
    if outcome == "ok":
        status = "success"
    elif outcome == "retryable":
        status = "processing"
    else:
        status = "failed"
        reason = f"non-retryable: {outcome}".encode()[:ERROR_REASON_MAX].decode("utf-8", "ignore")
    return (status, first, received, attempts, reason), claim


def _fold(cur: tuple | None, deliveries: list[tuple], lease_us: int) -> tuple[tuple | None, list[tuple]]:
    """Deliveries (received, no number, number, outcome) of one event in one micro-batch, in order
    of arrival: the state after them, and the fields of an update after the event id for each."""
    out = []
    for rec, _, _, outcome in sorted(deliveries, key=lambda b: b[:3]):
        cur, claimed = _step(cur, rec, outcome, lease_us)
        out.append((*cur, claimed, rec, False))
    return cur, out


def _expiry_ms(last_seen_us: int, lease_us: int) -> int:
    return -(-(last_seen_us + lease_us) // 1000)


class ClaimLedger(StatefulProcessor):
    """transformWithState over (event_id). Most events have one delivery per micro-batch, so rows
    are taken as they come: a data frame per event costs more than the fold."""

    def __init__(self, lease_s: int):
        self.lease_us = lease_s * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("claim", STATE_SCHEMA)

    def _expiry_ms(self, last_seen_us: int) -> int:
        return _expiry_ms(last_seen_us, self.lease_us)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        was_state = cur = self.state.get()              # None: a new event
        was = self._expiry_ms(cur[2]) if cur is not None and cur[0] == "processing" else None
        # the rows of one key in one micro-batch, three narrow columns
        batch = [(r.received_us, r.delivery_no is None, r.delivery_no or 0, r.outcome) for r in rows]
        cur, out = _fold(cur, batch, self.lease_us)
        if cur != was_state:
            self.state.update(cur)
        now = self._expiry_ms(cur[2]) if cur[0] == "processing" else None
        if was != now:
            if was is not None:
                self.handle.deleteTimer(was)
            if now is not None:
                self.handle.registerTimer(now)
        yield from (_UPDATE(key[0], *u) for u in out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        cur = self.state.get()
        if cur[0] == "processing" and self._expiry_ms(cur[2]) == expiredTimerInfo.getExpiryTimeInMs():
            yield _UPDATE(key[0], *cur, False, cur[2] + self.lease_us, True)

    def close(self) -> None:
        pass


_PAGE = pa.schema([("event_id", pa.string()), ("status", pa.string()), ("first_seen_us", pa.int64()),
                   ("last_seen_us", pa.int64()), ("attempts", pa.int32()), ("error_reason", pa.string()),
                   ("told", pa.bool_())])       # told: the end of this lease was emitted
_CLAIM = _PAGE.names[1:-1]


def _given(v):
    """A value of a pandas column, None for a missing one."""
    return None if v is None or v is pd.NA or v != v else v


class ClaimPages(StatefulProcessor):
    """transformWithStateInPandas over pages of events: the fold of :class:`ClaimLedger`."""

    def __init__(self, lease_s: int):
        self.lease_us = lease_s * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("page", "claims binary, timer_ms long")

    def _load(self) -> tuple[pa.RecordBatch, int | None]:
        claims, timer = self.state.get() or (None, None)
        if claims is None:
            return pa.RecordBatch.from_pylist([], schema=_PAGE), None
        return pa.ipc.read_record_batch(pa.py_buffer(claims), _PAGE), timer

    def _open(self, page: pa.RecordBatch) -> pa.RecordBatch:
        """Leases whose end was not emitted yet."""
        return page.filter(pc.and_(pc.and_(pc.equal(page["status"], "processing"), pc.invert(page["told"])),
                                   pc.is_valid(page["last_seen_us"])))

    def _store(self, page: pa.RecordBatch, timer: int | None, fired: bool = False) -> None:
        """The page with a timer for the lease that ends first; a fired timer is gone already."""
        first = pc.min(self._open(page)["last_seen_us"]).as_py()
        want = None if first is None else _expiry_ms(first, self.lease_us)
        if timer is not None and timer != want and not fired:
            self.handle.deleteTimer(timer)
        if want is not None and (want != timer or fired):
            self.handle.registerTimer(want)
        self.state.update((page.serialize().to_pybytes(), want))

    def _replaced(self, page: pa.RecordBatch, ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        """``page`` with the claims ``rows`` in place of those of ``ids``."""
        kept = page.filter(pc.invert(pc.is_in(page["event_id"], value_set=ids)))
        new = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PAGE)], schema=_PAGE)
        return pa.concat_batches([kept, new])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        got: dict[str | None, list[tuple]] = {}
        for pdf in rows:
            for e, rec, no, outcome in zip(*(pdf[c].tolist() for c in ("event_id", "received_us", "delivery_no", "outcome"))):
                rec, no = _given(rec), _given(no)
                got.setdefault(_given(e), []).append(
                    (None if rec is None else int(rec), no is None, int(no or 0), _given(outcome)))
        page, timer = self._load()
        ids = pa.array(list(got), pa.string())
        place = pc.index_in(ids, value_set=page["event_id"])
        known = page.take(place.drop_null()).to_pydict()
        before = {e: (claim, told) for e, *claim, told in zip(*(known[c] for c in _PAGE.names))}
        out, now = [], []
        for e, deliveries in got.items():
            was, told = before.get(e, (None, False))
            was = None if was is None else tuple(was)
            cur, updates = _fold(was, deliveries, self.lease_us)
            now.append((e, *cur, told and cur == was))
            out += [(e, *u) for u in updates]
        self._store(self._replaced(page, ids, now), timer)
        yield _updates(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        page, timer = self._load()
        end = timerValues.getCurrentWatermarkInMs()
        over = [c for c in self._open(page).to_pylist() if _expiry_ms(c["last_seen_us"], self.lease_us) <= end]
        if over:
            ids = pa.array([c["event_id"] for c in over], pa.string())
            page = self._replaced(page, ids, [(*list(c.values())[:-1], True) for c in over])
        self._store(page, timer, fired=True)
        if over:
            yield _updates([(c["event_id"], *[c[x] for x in _CLAIM], False, c["last_seen_us"] + self.lease_us, True)
                            for c in over])

    def close(self) -> None:
        pass


def _updates(rows: list[tuple]) -> pd.DataFrame:
    """Updates as columns; numbers that may be missing stay objects, none becomes a float."""
    columns = list(zip(*rows))
    return pd.DataFrame({c: pd.Series(v, dtype="bool" if c in ("claimed", "expired") else object)
                         for c, v in zip(_FIELDS, columns)})


def stream_claims(deliveries: DataFrame, lease_s: int = LEASE_S, disorder: str = "1 second",
                  pages: int | None = None) -> DataFrame:
    """Streaming ledger updates: one row per processed delivery, and one (``expired``) per lease
    that ran out. ``disorder`` is how far deliveries may come out of order (at least 1 ms: a
    delivery at the watermark itself is late); a lease is reported that much later, and
    deliveries later than it are dropped by the watermark. With ``pages`` the events share so many
    keys, fixed when the stream first starts; without, each has its own."""
    timed = deliveries.withColumn(
        "_ts", from_micros("received_us").cast("timestamp")).withWatermark("_ts", disorder)
    if pages is None:
        return timed.groupBy("event_id").transformWithState(
            ClaimLedger(lease_s), OUT_SCHEMA, "Append", "EventTime")
    paged = timed.select(F.pmod(F.xxhash64("event_id"), F.lit(pages)).alias("page"),
                         "event_id", "received_us", "delivery_no", "outcome", "_ts")
    return paged.groupBy("page").transformWithStateInPandas(
        ClaimPages(lease_s), OUT_SCHEMA, "Append", "EventTime")


def latest_claims(updates: DataFrame) -> DataFrame:
    """The last update of each event (a table of updates with their ``epoch``); an expired lease
    comes after the delivery that set it."""
    cols = ["status", "first_seen_us", "last_seen_us", "attempts", "error_reason", "expired"]
    last = updates.groupBy("event_id").agg(F.max_by(F.struct(*cols), F.struct(
        "epoch", "received_us", "expired")).alias("s"))
    return last.select("event_id", "s.*")
