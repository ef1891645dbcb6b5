"""Claim ledger and delivery handling: T1 duplicate suppression, T2 claim state machine,
T3 lease expiry, T6 retry / dead-letter routing, T7 safe redrive, A21 retry profile.

Batch form of the ledger: a map-side combined summary (first delivery, receive count)
settles every event whose first delivery succeeded -- success is final, so any number of
later copies is skipped without being moved. The deliveries of all other events are
hash-partitioned, sorted (external sort) and folded as a stream with constant state per
event, whatever their number: one path for every event. Streaming form, with the same
transition function: :mod:`riskline.streaming.ledger_state`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskline.config import LEASE_S, MAX_RECEIVES, UNKNOWN_OUTCOME
from riskline.functions.exprs import MICROS

LEDGER_COLS = ("event_id string, status string, first_seen_us long, last_seen_us long, "
               "attempts int, error_reason string, claims long, receives long")


def _fold_sorted(lease_s: int):
    """mapInPandas function: deliveries arrive sorted by (event_id, received, no) within
    the partition; fold each event with O(1) state, carried across Arrow batches."""
    from riskline.streaming.ledger_state import _step

    lease_us = lease_s * MICROS

    def run(batches):
        import pandas as pd

        cols = ["event_id", "status", "first_seen_us", "last_seen_us", "attempts",
                "error_reason", "claims", "receives"]
        key, state, claims, receives = None, None, 0, 0     # no state: no event yet
        for pdf in batches:
            out = []
            for eid, rec, outcome in zip(pdf["event_id"].tolist(),
                                         pdf["received_us"].tolist(),
                                         pdf["outcome"].tolist()):
                if state is None or eid != key:
                    if state is not None:
                        out.append((key, *state, claims, receives))
                    key, state, claims, receives = eid, None, 0, 0
                state, claimed = _step(state, int(rec), outcome, lease_us)
                claims += int(claimed)
                receives += 1
            if out:
                yield pd.DataFrame(out, columns=cols)
        if state is not None:
            yield pd.DataFrame([(key, *state, claims, receives)], columns=cols)

    return run


def claim_ledger(deliveries: DataFrame, lease_s: int = LEASE_S) -> DataFrame:
    """T2 (Q9): fold each event's deliveries (``received_us``, ``outcome``) in order.

    new -> claim; success -> skip; processing younger than the lease -> skip; stale
    processing or failed -> reclaim with attempts + 1. Processing of a claimed delivery
    is taken as instantaneous: its outcome is applied at ``received_us``. A null outcome is
    a non-retryable failure with the reason ``unknown``. Deliveries without an event id share
    one claim (the reference's empty id), with a null event_id.
    Output: event_id, status, first_seen_us, last_seen_us, attempts, error_reason,
    claims (deliveries that were claimed), receives (all deliveries).
    """
    d = deliveries.select("event_id", "received_us", "delivery_no",
                          F.coalesce("outcome", F.lit(UNKNOWN_OUTCOME)).alias("outcome"))
    summary = d.groupBy("event_id").agg(
        F.min_by(F.struct("received_us", "outcome"),
                 F.struct("received_us", "delivery_no")).alias("_first"),
        F.count(F.lit(1)).alias("receives"))
    first_ok = F.col("_first.outcome") == "ok"
    done = summary.filter(first_ok).select(
        "event_id", F.lit("success").alias("status"),
        F.col("_first.received_us").alias("first_seen_us"),
        F.col("_first.received_us").alias("last_seen_us"),
        F.lit(1).alias("attempts"), F.lit(None).cast("string").alias("error_reason"),
        F.lit(1).cast("bigint").alias("claims"), F.col("receives").cast("bigint"))
    again = summary.filter(~first_ok).select(F.col("event_id").alias("_again"))
    folded = (d.join(again, F.col("event_id").eqNullSafe(F.col("_again"))).drop("_again")
              .repartition("event_id")
              .sortWithinPartitions("event_id", "received_us", "delivery_no")
              .mapInPandas(_fold_sorted(lease_s), LEDGER_COLS))
    return done.unionByName(folded)


def stuck_events(ledger: DataFrame, now_us: Column, lease_s: int = LEASE_S) -> DataFrame:
    """Claims still ``processing`` whose lease has expired at ``now``: the reference
    ACKs the instant redelivery of a transiently failed event as "already processed",
    so these wait for a re-run (which reclaims them)."""
    age = now_us - F.col("last_seen_us")
    return ledger.filter((F.col("status") == "processing") & (age >= lease_s * MICROS)) \
        .select("event_id", "last_seen_us", "attempts",
                (age.cast("double") / MICROS).alias("age_s"))


def route_failures(ledger: DataFrame, max_receives: int = MAX_RECEIVES) -> DataFrame:
    """Per event: ``done`` (success), ``failed`` (non-retryable, ACKed), ``dlq``
    (still failing after ``max_receives`` receives) or ``retry`` (redeliver)."""
    route = (F.when(F.col("status") == "success", F.lit("done"))
              .when(F.col("status") == "failed", F.lit("failed"))
              .when(F.col("receives") >= max_receives, F.lit("dlq"))
              .otherwise(F.lit("retry")))
    return ledger.select("event_id", "status", "receives", route.alias("route"))


def with_redriven(deliveries: DataFrame, redriven: DataFrame, outcome: Column) -> DataFrame:
    """The delivery log with the redriven dead letters as further deliveries, whose
    processing ends with ``outcome``."""
    cols = ["event_id", "received_us", "delivery_no", "outcome"]
    return deliveries.select(*cols).unionByName(
        redriven.withColumn("outcome", outcome).select(*cols))


def redrive(routes: DataFrame, ledger: DataFrame, now_us: Column) -> DataFrame:
    """T7 + U2: dead letters whose failure is transient go back into the input as new
    deliveries; hash / schema failures never do; events already successful are skipped
    (anti join), so redriving twice adds nothing."""
    dead = routes.filter(F.col("route") == "dlq").select("event_id", "receives")
    done = ledger.filter(F.col("status") == "success").select("event_id")
    return dead.join(done, "event_id", "left_anti").select(
        "event_id", now_us.alias("received_us"),
        (F.col("receives") + 1).cast("int").alias("delivery_no"))


def suppress_duplicates(deliveries: DataFrame, order: list[str]) -> DataFrame:
    """T1 batch form: the first delivery per event id by ``order`` (a map-side combined
    ``min_by``, so a flood of copies of one id is reduced before the shuffle)."""
    from riskline.operators.sinks import first_writer

    return first_writer(deliveries, "event_id", order)


def retry_profile(ledger: DataFrame) -> DataFrame:
    """Events per (attempts, receives, status)."""
    return ledger.groupBy("attempts", "receives", "status").agg(
        F.count(F.lit(1)).alias("events"))
