"""Registered queries: claim ledger, delivery routing, idempotent sinks and the ledger
reports (T1-T3, T6, T7, S8, S9, J2, J10, A1-A4, A21)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.operators import ledger as L
from riskline.operators import reports as RP
from riskline.operators import sinks as S
from riskline.operators.ordinal import exact_percentiles
from riskline.plans import views as V
from riskline.plans.oracle_views import claim_views, view, with_views
from riskline.plans.registry import register
from riskline.sources import fixtures as fx

DLQ_RECEIVES = 2          # the routing key runs with max receives = 2

view("delivery_steps", ("deliveries",), """
SELECT event_id, received_us, coalesce(outcome, 'unknown') AS outcome,
  row_number() OVER (PARTITION BY event_id ORDER BY received_us, delivery_no) AS k FROM deliveries""")
claim_views("delivery_steps", "")

_NOW_LEDGER = "(SELECT max(received_us) FROM deliveries)"


def ledger_df(spark, sf_dir) -> DataFrame:
    return L.claim_ledger(fx.deliveries(spark, sf_dir))


def _now(spark, sf_dir):
    return fx.now_us(fx.deliveries(spark, sf_dir), "received_us")


@register("claim_ledger", with_views("SELECT * EXCLUDE (last_k) FROM ledger", "ledger"))
def claim_ledger(spark, sf_dir):
    """T2 (Q9): claim / skip / reclaim fold over the at-least-once delivery log."""
    return ledger_df(spark, sf_dir)


@register("stuck_events", with_views(f"""
SELECT event_id, last_seen_us, attempts,
  CAST({_NOW_LEDGER} - last_seen_us AS DOUBLE) / 1000000 AS age_s
FROM ledger WHERE status = 'processing' AND {_NOW_LEDGER} - last_seen_us >= 60000000""",
                                     "ledger"))
def stuck_events(spark, sf_dir):
    """Processing claims past the 60 s lease (lost by the instant redelivery)."""
    return L.stuck_events(ledger_df(spark, sf_dir), _now(spark, sf_dir))


@register("stream_dedup", with_views("""
SELECT event_id, received_us, outcome FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY received_us, delivery_no) AS k
  FROM deliveries) WHERE k = 1""", "deliveries"))
def stream_dedup(spark, sf_dir):
    """T1 (batch twin): the first delivery of each event id."""
    return L.suppress_duplicates(fx.deliveries(spark, sf_dir),
                                 ["received_us", "delivery_no"]).select(
        "event_id", "received_us", "outcome")


view("routes", ("ledger",), f"""
SELECT event_id, status, receives, CASE WHEN status = 'success' THEN 'done'
  WHEN status = 'failed' THEN 'failed' WHEN receives >= {DLQ_RECEIVES} THEN 'dlq' ELSE 'retry' END AS route
FROM ledger""")


@register("route_failures", with_views("SELECT * FROM routes", "routes"))
def route_failures(spark, sf_dir):
    """Done / failed (non-retryable, ACKed) / retry / dead-letter after max receives."""
    return L.route_failures(ledger_df(spark, sf_dir), DLQ_RECEIVES)


@register("redrive", with_views(f"""
SELECT r.event_id, {_NOW_LEDGER} AS received_us, CAST(r.receives + 1 AS INTEGER) AS delivery_no
FROM routes r WHERE r.route = 'dlq'
  AND r.event_id NOT IN (SELECT event_id FROM ledger WHERE status = 'success')""",
                                "routes", "deliveries"))
def redrive(spark, sf_dir):
    """T7 + U2: transient dead letters re-enter the input; never hash / schema failures;
    already-successful events are skipped."""
    led = ledger_df(spark, sf_dir)
    return L.redrive(L.route_failures(led, DLQ_RECEIVES), led, _now(spark, sf_dir))


@register("retry_profile", with_views("""
SELECT attempts, receives, status, CAST(count(*) AS BIGINT) AS events
FROM ledger GROUP BY attempts, receives, status""", "ledger"))
def retry_profile(spark, sf_dir):
    """Events per attempts / receives / status."""
    return L.retry_profile(ledger_df(spark, sf_dir))


# --- reports over the ledger (A1-A4) ---------------------------------------------------------
@register("status_share", with_views("""
SELECT g.status, g.n_events, round(100.0 * g.n_events / t.n_all, 2) AS share_pct
FROM (SELECT status, CAST(count(*) AS BIGINT) AS n_events FROM ledger GROUP BY ALL) g
CROSS JOIN (SELECT count(*) AS n_all FROM ledger) t""", "ledger"))
def status_share(spark, sf_dir):
    """A1 + W6: events per status and share in percent (2 decimals)."""
    return RP.status_share(ledger_df(spark, sf_dir))


@register("failure_pareto", with_views("""
SELECT error_reason AS reason, CAST(sum(CASE WHEN status = 'failed' THEN 1 END) AS BIGINT) AS n_failed
FROM ledger GROUP BY ALL HAVING count(*) FILTER (status = 'failed') > 0""", "ledger"))
def failure_pareto(spark, sf_dir):
    """A2: failure reasons of failed events, most frequent first."""
    return RP.failure_pareto(ledger_df(spark, sf_dir))


@register("ingest_latency", with_views("""
SELECT q[1] AS latency_p50_s, q[2] AS latency_p95_s, q[3] AS latency_max_s FROM (
  SELECT quantile_cont((done.last_seen_us - arrived.created_us) / 1e6, [0.5, 0.95, 1.0]) AS q
  FROM txn arrived JOIN ledger done USING (event_id) WHERE done.status = 'success') x""", "ledger", "txn"))
def ingest_latency(spark, sf_dir):
    """A3 + J10: p50 / p95 (continuous, exact) and max of completion minus arrival for
    successful events, from counts per distinct latency."""
    led = ledger_df(spark, sf_dir).filter(F.col("status") == "success")
    j = led.select("event_id", "last_seen_us").join(
        fx.txn(spark, sf_dir).select("event_id", "created_us"), "event_id")
    lat = j.select(((F.col("last_seen_us") - F.col("created_us")).cast("double") / 1e6).alias("lat"))
    # max = percentile 1.0: one ranked pass yields all three numbers.
    return exact_percentiles(lat, "lat", {"latency_p50_s": 0.5, "latency_p95_s": 0.95,
                                          "latency_max_s": 1.0})


@register("activity_by_minute", with_views(f"""
SELECT (last_seen_us // 60000000) * 60000000 AS minute_us, status, CAST(count(*) AS BIGINT) AS n_events
FROM ledger WHERE {_NOW_LEDGER} - last_seen_us < 3600000000 GROUP BY ALL""", "ledger", "deliveries"))
def activity_by_minute(spark, sf_dir):
    """A4: processed events per minute and status over the last hour ("now" = the
    newest delivery)."""
    return RP.activity_by_minute(ledger_df(spark, sf_dir), _now(spark, sf_dir))


@register("redriven_ledger", with_views(f"""
SELECT status, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT CASE WHEN r.route = 'dlq' AND l.status = 'processing' AND {_NOW_LEDGER} - l.last_seen_us >= 60000000
              THEN 'success' ELSE l.status END AS status
  FROM ledger l JOIN routes r USING (event_id)) x GROUP BY ALL""", "ledger", "routes", "deliveries"))
def redriven_ledger(spark, sf_dir):
    """The ledger after the redriven dead letters went back into the delivery log and
    succeeded (claims still inside their lease skip them): events per status."""
    d = fx.deliveries(spark, sf_dir)
    led = ledger_df(spark, sf_dir)
    again = L.redrive(L.route_failures(led, DLQ_RECEIVES), led, _now(spark, sf_dir))
    return L.claim_ledger(L.with_redriven(d, again, F.lit("ok"))).groupBy("status").agg(
        F.count(F.lit(1)).alias("n"))


# --- idempotent sinks (S8, S9, J2) ------------------------------------------------------------
_CUT = "(SELECT max(created_us) - 86400000000 FROM txn)"


@register("persist_events", with_views(f"""
SELECT event_id, user_id, amount, currency, merchant, us, created_us FROM txn_m
WHERE created_us <= {_CUT}
UNION ALL
SELECT event_id, user_id, amount, currency, merchant, us, received_us FROM (
  SELECT t.event_id, t.user_id, t.amount, t.currency, t.merchant, t.us, d.received_us,
    row_number() OVER (PARTITION BY t.event_id ORDER BY d.received_us, d.delivery_no) AS k
  FROM deliveries d JOIN txn_m t ON d.event_id = t.event_id
  WHERE d.received_us > {_CUT}) b
WHERE k = 1 AND event_id NOT IN (SELECT event_id FROM txn_m WHERE created_us <= {_CUT})""",
                                      "txn_m", "deliveries"))
def persist_events(spark, sf_dir):
    """S8 + J2 + W9: the events table after appending a batch of deliveries (first
    writer per event id, anti join on stored ids); re-running the batch adds nothing."""
    t = fx.txn_m(spark, sf_dir)
    cut = fx.now_us(t) - F.lit(86_400_000_000)
    cols = ["event_id", "user_id", "amount", "currency", "merchant", "us", "created_us"]
    stored = t.filter(F.col("created_us") <= cut).select(*cols)
    batch = (fx.deliveries(spark, sf_dir).filter(F.col("received_us") > cut)
             .join(t.drop("created_us"), "event_id")
             .withColumn("created_us", F.col("received_us")))
    return S.insert_if_absent(stored, batch.select(*cols, "delivery_no"), "event_id",
                              ["created_us", "delivery_no"])


@register("persist_flags", with_views("SELECT flag_id, event_id, rule_name FROM flags",
                                      "flags"))
def persist_flags(spark, sf_dir):
    """Flags inserted twice (overlapping re-evaluation) stay unique by the
    deterministic flag id (Q11)."""
    f = V.flags(spark, sf_dir).select("flag_id", "event_id", "rule_name", "flagged_us")
    t = fx.txn(spark, sf_dir)
    cut = fx.now_us(t) - F.lit(86_400_000_000)
    stored = f.filter(F.col("flagged_us") <= cut + F.lit(3_600_000_000))  # overlaps 1 h
    second = f.filter(F.col("flagged_us") > cut)
    return S.insert_if_absent(stored, second, "flag_id", ["flagged_us"]).drop("flagged_us")


@register("event_lookup", with_views(f"""
SELECT t.event_id, s.user_id, s.amount, s.currency, s.merchant, s.us,
  s.event_id IS NOT NULL AS found
FROM txn t LEFT JOIN (SELECT event_id, user_id, amount, currency, merchant, us FROM txn_m
                      WHERE created_us <= {_CUT}) s ON t.event_id = s.event_id""",
                                    "txn", "txn_m"))
def event_lookup(spark, sf_dir):
    """S7 (batch form): every event id looked up in the store as it was one day before
    "now"; ids arriving later are NotFound (``found = false``)."""
    t = fx.txn_m(spark, sf_dir)
    cut = fx.now_us(t) - F.lit(86_400_000_000)
    stored = t.filter(F.col("created_us") <= cut).select(
        "event_id", "user_id", "amount", "currency", "merchant", "us")
    return RP.lookup_events(stored, fx.txn(spark, sf_dir).select("event_id"))
