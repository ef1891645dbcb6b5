"""Claim-ledger transitions (batch fold and streaming state agree)."""

from riskline.operators.ledger import claim_ledger
from riskline.streaming.ledger_state import _step

S = 1_000_000
SCHEMA = "event_id string, received_us long, delivery_no int, outcome string"


def _ledger(spark, rows):
    return {r["event_id"]: r for r in claim_ledger(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_transitions(spark):
    rows = [
        ("new", 0, 1, "ok"),
        ("dup_after_success", 0, 1, "ok"), ("dup_after_success", 30 * S, 2, "ok"),
        ("inside_lease", 0, 1, "retryable"), ("inside_lease", 5 * S, 2, "ok"),
        ("stale", 0, 1, "retryable"), ("stale", 90 * S, 2, "ok"),
        ("failed_retry", 0, 1, "hash_mismatch"), ("failed_retry", 1 * S, 2, "ok"),
    ]
    led = _ledger(spark, rows)
    assert (led["new"]["status"], led["new"]["attempts"]) == ("success", 1)
    assert (led["dup_after_success"]["attempts"], led["dup_after_success"]["last_seen_us"]) == (1, 0)
    assert (led["inside_lease"]["status"], led["inside_lease"]["attempts"]) == ("processing", 1)
    assert (led["stale"]["status"], led["stale"]["attempts"]) == ("success", 2)
    assert led["failed_retry"]["status"] == "success" and led["failed_retry"]["attempts"] == 2
    assert led["failed_retry"]["error_reason"] == "non-retryable: hash_mismatch"


def test_concurrent_claims_one_winner(spark):
    rows = [("e", 0, i, "ok") for i in range(50)]
    led = _ledger(spark, rows)
    assert led["e"]["claims"] == 1 and led["e"]["receives"] == 50


def test_stream_step_matches_fold():
    st, claimed = _step(None, 0, "retryable", 60 * S)
    assert claimed and st[0] == "processing"
    st2, claimed2 = _step(st, 5 * S, "ok", 60 * S)
    assert not claimed2 and st2 == st
    st3, claimed3 = _step(st, 61 * S, "ok", 60 * S)
    assert claimed3 and st3[0] == "success" and st3[3] == 2


def test_duplicate_flood_is_settled_without_folding(spark):
    from pyspark.sql import functions as F

    from riskline.operators.sinks import first_writer

    flood = spark.range(20000).select(
        F.lit("hot").alias("event_id"), (F.col("id") * 1000).alias("received_us"),
        F.col("id").cast("int").alias("delivery_no"), F.lit("ok").alias("outcome"))
    other = spark.createDataFrame([("cold", 0, 1, "retryable"), ("cold", 61 * S, 2, "ok")],
                                  SCHEMA)
    led = {r["event_id"]: r for r in claim_ledger(flood.unionByName(other)).collect()}
    assert (led["hot"]["status"], led["hot"]["claims"], led["hot"]["receives"]) == \
        ("success", 1, 20000)
    assert (led["cold"]["status"], led["cold"]["attempts"]) == ("success", 2)
    first = first_writer(flood, "event_id", ["received_us", "delivery_no"]).collect()
    assert len(first) == 1 and first[0]["delivery_no"] == 0


def test_hot_failing_event_like_any_other(spark):
    from pyspark.sql import functions as F

    # 500 deliveries of one event: first fails retryably, copies 1 s apart; the lease
    # makes every 60th copy a reclaim, and the first reclaim (ok) settles it.
    hot = spark.range(500).select(
        F.lit("hot").alias("event_id"), (F.col("id") * S).alias("received_us"),
        F.col("id").cast("int").alias("delivery_no"),
        F.when(F.col("id") < 60, F.lit("retryable")).otherwise(F.lit("ok")).alias("outcome"))
    small = spark.createDataFrame([("cold", 0, 1, "retryable"), ("cold", 61 * S, 2, "ok")],
                                  SCHEMA)
    led = {r["event_id"]: r for r in claim_ledger(hot.unionByName(small)).collect()}
    assert (led["hot"]["status"], led["hot"]["attempts"],
            led["hot"]["last_seen_us"], led["hot"]["receives"]) == \
        ("success", 2, 60 * S, 500)
    assert (led["cold"]["status"], led["cold"]["claims"]) == ("success", 2)


def test_null_outcome_is_a_failure_and_loses_no_event(spark):
    rows = [("only", 0, 1, None), ("then_ok", 0, 1, None), ("then_ok", S, 2, "ok"),
            ("late_null", 0, 1, "retryable"), ("late_null", 70 * S, 2, None)]
    led = _ledger(spark, rows)
    assert set(led) == {"only", "then_ok", "late_null"}
    assert (led["only"]["status"], led["only"]["error_reason"]) == ("failed", "non-retryable: unknown")
    assert (led["then_ok"]["status"], led["then_ok"]["attempts"]) == ("success", 2)
    assert (led["late_null"]["status"], led["late_null"]["attempts"]) == ("failed", 2)


def test_error_reason_is_cut_in_bytes(spark):
    led = _ledger(spark, [("e", 0, 1, "é" * 400)])
    assert len(led["e"]["error_reason"].encode()) <= 500
    assert led["e"]["error_reason"].startswith("non-retryable: é")
