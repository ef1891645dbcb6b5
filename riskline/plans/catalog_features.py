"""Registered queries: as-of features and training data (W2-W5, W7, J7-J9, P19, P20, S6,
S12, M1, M4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskline.operators import modeldata as MD
from riskline.operators.features import asof_probe as asof_probe_op
from riskline.operators.features import feature_vector
from riskline.plans import views as V
from riskline.plans.oracle_views import with_views
from riskline.plans.registry import register
from riskline.sources import fixtures as fx

_FEATURE_COLS = ("event_id, user_id, us, amount, velocity_60s, velocity_3600s, "
                 "velocity_86400s, secs_since_prev, user_amt_sum_3600s, user_amt_max_3600s, "
                 "currency, product_code, card_network, merchant, email_domain, label")


@register("features", with_views(f"SELECT {_FEATURE_COLS} FROM features", "features"))
def features(spark, sf_dir):
    """P19 + J7: the 12 raw model features per event (one exchange, one sort)."""
    return V.features(spark, sf_dir)


@register("arrival_features", with_views(f"SELECT {_FEATURE_COLS} FROM arrival_features", "arrival_features"))
def arrival_features(spark, sf_dir):
    """T4 (batch form): the features an online service sees, from events that had arrived;
    some arrive days late, and one user has a third of all events."""
    from riskline.operators.features import arrival_features as arrived

    return feature_vector(arrived(fx.late_txn(spark, sf_dir)), precomputed=True)


@register("velocity_asof", with_views(
    "SELECT event_id, user_id, us, velocity_60s, velocity_3600s, velocity_86400s "
    "FROM features", "features"))
def velocity_asof(spark, sf_dir):
    """As-of counts over (t - w, t] for w = 60 s, 1 h, 24 h (ties at t included)."""
    return V.features(spark, sf_dir).select(
        "event_id", "user_id", "us", "velocity_60s", "velocity_3600s", "velocity_86400s")


@register("amount_asof", with_views("""
SELECT event_id, coalesce(sum(amount) OVER w, 0) AS user_amt_sum_3600s,
  coalesce(max(amount) OVER w, 0) AS user_amt_max_3600s
FROM txn_m WINDOW w AS (PARTITION BY user_id ORDER BY us
  RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW)""", "txn_m"))
def amount_asof(spark, sf_dir):
    """W3 + W4: as-of sum and max of the stored DECIMAL amount over 1 h (0 if none)."""
    from riskline.operators.features import asof_features

    f = asof_features(fx.txn_m(spark, sf_dir))
    return f.select("event_id", "user_amt_sum_3600s", "user_amt_max_3600s")


@register("prev_event", with_views("""
SELECT event_id, max(us) OVER (PARTITION BY user_id ORDER BY us
    RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_us, secs_since_prev
FROM features""", "features"))
def prev_event(spark, sf_dir):
    """W5 + J9: strictly previous event (unlimited look-back, ties excluded), -1 if none."""
    from riskline.operators.features import asof_features

    return asof_features(fx.txn_m(spark, sf_dir)).select("event_id", "prev_us",
                                                         "secs_since_prev")


@register("asof_probe", with_views(f"""
SELECT {_FEATURE_COLS} FROM features WHERE event_id IN (
  SELECT event_id FROM txn WHERE created_us > (SELECT max(created_us) FROM txn) - 86400000000)""",
                                   "features"))
def asof_probe(spark, sf_dir):
    """The last day's arrivals scored against the stored history (probe set !=
    history); equals the complete features of those events."""
    t = fx.txn_m(spark, sf_dir)
    cut = fx.now_us(t) - F.lit(86_400_000_000)
    probes = t.filter(F.col("created_us") > cut)
    history = t.filter(F.col("created_us") <= cut)
    scored = asof_probe_op(probes, history)
    cats = probes.select("event_id", "currency", "product_code", "card_network", "merchant",
                         "email_domain", "label")
    return feature_vector(
        scored.join(cats, "event_id"), precomputed=True).select(
        *[c.strip() for c in _FEATURE_COLS.split(",")])


@register("labelled_events", with_views(
    "SELECT event_id, user_id, us, gt_label AS label FROM labelled", "labelled"))
def labelled_events(spark, sf_dir):
    """S6 + P20: events with a ground-truth label in metadata; JSON strings only (Q6)."""
    return MD.labelled_events(fx.txn_meta(spark, sf_dir)).select(
        "event_id", "user_id", "us", F.col("gt_label").alias("label"))


def _export(spark, sf_dir):
    return MD.feature_export(fx.txn_meta(spark, sf_dir), feature_vector)


@register("feature_export", with_views(f"SELECT {_FEATURE_COLS} FROM export_features",
                                       "export_features"))
def feature_export(spark, sf_dir):
    """M1 + S12: features of all labelled events, categoricals from metadata, label."""
    return _export(spark, sf_dir).select(*[c.strip() for c in _FEATURE_COLS.split(",")])


@register("temporal_split", with_views("SELECT event_id, us, label, split FROM split", "split"))
def temporal_split(spark, sf_dir):
    """M4 + W7: 70/15/15 split by global time ordinal (range-partitioned, no
    single-partition window)."""
    return MD.temporal_split(_export(spark, sf_dir)).select("event_id", "us", "label", "split")


@register("split_summary", with_views("""
SELECT split, CAST(count(*) AS BIGINT) AS rows,
  round(avg(CASE WHEN label = '1' THEN 1.0 ELSE 0.0 END), 6) AS pos_rate
FROM split GROUP BY split""", "split"))
def split_summary(spark, sf_dir):
    """M4 report: rows and positive rate per split."""
    return MD.split_summary(MD.temporal_split(_export(spark, sf_dir)))
