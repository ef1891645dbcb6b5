"""Composed batch jobs: the processor's per-envelope stages (T9 batch twin) and the
synchronous evaluation as a micro-batch table function (P17)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskline.config import RETRYABLE_REASONS
from riskline.operators import ingest as I
from riskline.session import written


def process_envelopes(env: DataFrame, objects: DataFrame, now_us: Column) -> DataFrame:
    """Claim-check resolution -> hash check -> decode -> validate -> store constraints.

    Adds ``reason`` (first failing stage, null when the event is good), ``error_class``,
    ``cause`` and the decoded event fields ``p_*``. One pass: each stage is an
    expression over the previous stage's columns, no per-stage scan.
    """
    r = I.verify_hash(I.resolve_payloads(env, objects))
    p = I.parse_events(r.withColumn(
        "_body", F.when(F.col("fetch_error").isNull() & F.col("hash_ok"), F.col("payload"))),
        payload="_body").drop("_body")
    verr = I.validation_error(F.col("p_user_id"), F.col("p_amount"), F.col("p_currency"),
                              F.col("p_merchant"), F.col("p_us"), F.col("p_metadata_keys"),
                              now_us)
    p = p.withColumn("_verr", verr)
    store = {"event_id": F.col("event_id"), "user_id": F.col("p_user_id"),
             "currency": F.col("p_currency"), "merchant": F.col("p_merchant"),
             "amount": F.col("p_amount")}
    if "correlation_id" in env.columns:
        store["correlation_id"] = F.col("correlation_id")
    p = p.withColumn("_violated", I.constraint_violation(store))
    reason = (F.when(F.col("fetch_error").isNotNull(), F.col("fetch_error"))
               .when(~F.col("hash_ok"), F.lit("hash_mismatch"))
               .when(~F.col("parse_ok"), F.lit("unmarshal_error"))
               .when(F.col("_verr").isNotNull(), F.lit("validation_error"))
               .when(F.col("_violated").isNotNull(), F.lit("constraint_violation")))
    reason_c = F.col("_o.reason")
    cause = (F.when(reason_c == "unmarshal_error", F.lit("malformed JSON"))
              .when(reason_c == "validation_error", I.error_text(F.col("_verr")))
              .when(reason_c == "constraint_violation", F.col("_violated")))
    cls = F.when(reason_c.isin(list(RETRYABLE_REASONS)), F.lit("retryable")) \
        .when(reason_c.isNotNull(), F.lit("non-retryable"))
    # The outcome leaves through a generator: filters on it (quarantine = reason IS NOT
    # NULL) cannot be pushed below, so the stage chain is not re-expanded, and
    # duplicated, inside one huge filter condition.
    out = p.select("*", F.explode(F.array(F.struct(reason.alias("reason")))).alias("_o"))
    return out.select(*[c for c in p.columns if c not in ("_verr", "_violated")], reason_c.alias("reason"),
                      cls.alias("error_class"), cause.alias("cause"))


def evaluate_batch(new_events: DataFrame, history: DataFrame, scores: DataFrame | None,
                   cfg, now_us: Column) -> dict[str, DataFrame]:
    """P17 as a micro-batch table function: validate -> insert-if-absent -> evaluate
    (velocity over stored history plus the batch) -> flags -> decisions.

    Returns ``stored`` (events to append), ``flags`` and ``decisions``. The history is
    only read for its keys and the velocity window's columns (pruned scan).
    """
    from riskline.operators import rules as R
    from riskline.operators import sinks as S

    v = I.validate(new_events, now_us)
    valid = S.first_writer(v.filter(F.col("error").isNull()).drop("error"), "event_id", ["created_us"])
    stored = valid.join(history.select("event_id"), "event_id", "left_anti")
    # a request for an event that is stored already is evaluated all the same
    with_v = R.with_velocity(valid, cfg, history=history)
    scored = R.attach_scores(with_v, scores, cfg.model_version)
    flags = R.evaluate_rules(scored, cfg, with_score=scores is not None)
    decisions = R.evaluate_decisions(scored, cfg, with_score=scores is not None)
    return {"stored": stored, "flags": flags, "decisions": decisions,
            "rejected": v.filter(F.col("error").isNotNull())}


def process_batch(env: DataFrame, objects: DataFrame, scores: DataFrame | None, cfg,
                  now_us: Column) -> dict[str, DataFrame]:
    """T9 batch twin: delivered envelopes -> stages -> claim ledger -> one settled delivery
    per event -> rule evaluation over the stored events -> outcome per event.

    Deliveries of an event are claimed in arrival order (T2): a copy of a stored event, or
    one inside the lease of a running claim, changes nothing; a failed event is claimed
    again. The event that is stored is that of the claimed delivery that succeeded, once.
    Outcome status: ``success`` (stored and evaluated), ``failed`` (non-retryable, ACKed
    with its reason), ``processing`` (retryable: left for redelivery). Events are
    evaluated after they are stored (T10: a failing evaluation never loses the event).
    """
    from riskline.operators import rules as R
    from riskline.operators import sinks as S
    from riskline.operators.features import arrival_velocity
    from riskline.operators.ledger import claim_ledger

    if "delivery_no" not in env.columns:
        env = env.withColumn("delivery_no", F.lit(1))
    # the stages run once; their result (without payloads) is read by ledger and join
    p = written(process_envelopes(env, objects, now_us).select(
        "event_id", "received_us", "delivery_no", "p_user_id", "p_amount", "p_currency",
        "p_merchant", "p_us", "reason", "error_class"), "processed")
    outcome = F.when(F.col("reason").isNull(), F.lit("ok")) \
        .when(F.col("error_class") == "retryable", F.lit("retryable")).otherwise(F.col("reason"))
    ledger = claim_ledger(p.select("event_id", "received_us", "delivery_no", outcome.alias("outcome")))
    settled = p.join(ledger.select("event_id", "status", F.col("last_seen_us").alias("received_us")),
                     ["event_id", "received_us"])
    settled = S.first_writer(settled, "event_id", ["delivery_no"])
    ok = F.col("status") == "success"
    # One pass over the settled deliveries: the velocity window runs over every row but
    # counts only stored events; failed rows are keyed by their own id so they do not pile
    # up in one null-user partition. The outcome then needs no join back.
    rows = settled.select(
        "event_id", F.when(ok, F.col("p_user_id"))
        .otherwise(F.concat(F.lit("\u0000"), F.col("event_id"))).alias("user_id"),
        F.col("p_amount").try_cast("decimal(18,2)").alias("amount"),
        F.col("p_currency").alias("currency"), F.col("p_merchant").alias("merchant"),
        F.col("p_us").alias("us"), F.col("received_us").alias("created_us"),
        "reason", "status", ok.alias("_ok"))
    counted = arrival_velocity(rows, cfg.velocity_window_seconds, counted="_ok") \
        if cfg.velocity_window_seconds > 0 and cfg.velocity_max_count > 0 else rows
    scored = R.attach_scores(counted, scores, cfg.model_version)
    triples = R.rule_triples(cfg)
    if scores is not None and R.ml_triple(cfg) is not None:
        triples.append(R.ml_triple(cfg))
    result = scored.select(
        "event_id", "status", "reason",
        F.when(F.col("_ok"), F.size(R.flag_array(triples))).otherwise(F.lit(0))
         .cast("bigint").alias("n_flags"))
    good = scored.filter("_ok")
    flags = R.evaluate_rules(good, cfg, with_score=scores is not None)
    good = good.select("event_id", "user_id", "amount", "currency", "merchant", "us",
                       "created_us")
    return {"events": good, "flags": flags, "outcome": result}
