"""Registered queries: rule evaluation, blend, decisions and flag reports (P10-P16, J1, J3,
J11, A5, A7, A8, K1-K3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskline.config import TEST_RULES as C
from riskline.operators import rules as R
from riskline.plans import views as V
from riskline.plans.oracle_views import with_views
from riskline.plans.registry import register
from riskline.sources import fixtures as fx

_FLAG_COLS = "flag_id, event_id, user_id, rule_name, rule_value, flagged_us"


def _rule_only(spark, sf_dir, name):
    return V.flags(spark, sf_dir).filter(F.col("rule_name") == name).select(
        *[c.strip() for c in _FLAG_COLS.split(",")])


def _rule_sql(name: str) -> str:
    return with_views(f"SELECT {_FLAG_COLS} FROM flags WHERE rule_name = '{name}'", "flags")


@register("rule_amount", _rule_sql("amount_threshold"))
def rule_amount(spark, sf_dir):
    """P10: amount strictly above the threshold, text ``amount=X > threshold=Y``."""
    return _rule_only(spark, sf_dir, "amount_threshold")


@register("rule_velocity", _rule_sql("velocity"))
def rule_velocity(spark, sf_dir):
    """P11 + W1: arrival-time count in a closed window reaches the maximum."""
    return _rule_only(spark, sf_dir, "velocity")


@register("rule_blocked_merchant", _rule_sql("blocked_merchant"))
def rule_blocked_merchant(spark, sf_dir):
    """P12 + J3: exact, case-sensitive merchant membership, Go-quoted text."""
    return _rule_only(spark, sf_dir, "blocked_merchant")


@register("rule_currency", _rule_sql("high_risk_currency"))
def rule_currency(spark, sf_dir):
    """Exact currency membership."""
    return _rule_only(spark, sf_dir, "high_risk_currency")


@register("rule_flags", with_views(
    f"SELECT {_FLAG_COLS} FROM flags WHERE rule_name <> 'ml_risk'", "flags"))
def rule_flags(spark, sf_dir):
    """All-match evaluation, one row per fired rule (no model)."""
    t = R.with_velocity(fx.txn_m(spark, sf_dir), C)
    return R.evaluate_rules(t, C)


@register("blended_flags", with_views(f"SELECT {_FLAG_COLS}, ml_score FROM flags", "flags"))
def blended_flags(spark, sf_dir):
    """P15 + J11: rules plus ``ml_risk`` at score >= tau; every flag carries the score."""
    return V.flags(spark, sf_dir)


@register("decisions", with_views("""
SELECT t.event_id, t.user_id,
  CASE WHEN count(f.rule_name) = 0 THEN 'ALLOW' ELSE 'FLAG' END AS decision,
  CAST(count(f.rule_name) AS BIGINT) AS n_flags,
  coalesce(string_agg(f.rule_name, ',' ORDER BY CASE f.rule_name WHEN 'amount_threshold' THEN 1
    WHEN 'velocity' THEN 2 WHEN 'blocked_merchant' THEN 3 WHEN 'high_risk_currency' THEN 4
    ELSE 5 END), '') AS rules,
  CASE WHEN t.model_version = 'unavailable' THEN 'v1' ELSE 'v1+ml-' || t.model_version END
    AS evaluated_by,
  t.ml_score
FROM scored_txn t LEFT JOIN flags f ON t.event_id = f.event_id
GROUP BY t.event_id, t.user_id, t.model_version, t.ml_score""", "flags"))
def decisions_q(spark, sf_dir):
    """ALLOW / FLAG per event with the rule list in rule order and ``evaluated_by``."""
    d = R.evaluate_decisions(V.scored_txn(spark, sf_dir), C)
    return d.select("event_id", "user_id", "decision", "n_flags",
                    F.array_join(F.transform("flags", lambda x: x["rule_name"]), ",")
                     .alias("rules"), "evaluated_by", "ml_score")


@register("flag_feed", with_views("SELECT * FROM flag_events", "flag_events"))
def flag_feed(spark, sf_dir):
    """Flags joined with their events (FraudEvent shape)."""
    return V.flag_events(spark, sf_dir)


@register("orphan_flags", with_views("""
SELECT CAST(count(*) AS BIGINT) AS orphan_flags FROM flags f
WHERE NOT EXISTS (SELECT 1 FROM txn_m e WHERE e.event_id = f.event_id)""", "flags"))
def orphan_flags(spark, sf_dir):
    """Foreign-key audit flags -> events; zero on a consistent store."""
    ev = fx.txn_m(spark, sf_dir).select("event_id")
    return (V.flags(spark, sf_dir).join(ev, "event_id", "left_anti")
            .agg(F.count(F.lit(1)).alias("orphan_flags")))


@register("top_flagged_merchants", with_views("""
SELECT merchant, CAST(count(*) AS BIGINT) AS flag_count
FROM flag_events GROUP BY merchant ORDER BY flag_count DESC, merchant LIMIT 10""",
                                              "flag_events"))
def top_flagged_merchants(spark, sf_dir):
    """A5: J1 + count per merchant, top 10 (unique tie-breaker on merchant)."""
    return (V.flag_events(spark, sf_dir).groupBy("merchant")
            .agg(F.count(F.lit(1)).alias("flag_count"))
            .orderBy(F.desc("flag_count"), "merchant").limit(10))


@register("flags_by_rule", with_views("""
SELECT rule_name, CAST(count(*) AS BIGINT) AS flag_count FROM flags GROUP BY rule_name""",
                                      "flags"))
def flags_by_rule(spark, sf_dir):
    """Flags per rule."""
    return V.flags(spark, sf_dir).groupBy("rule_name").agg(
        F.count(F.lit(1)).alias("flag_count"))


@register("top_flagged_users", with_views("""
SELECT user_id, CAST(count(*) AS BIGINT) AS flag_count,
  CAST(count(DISTINCT event_id) AS BIGINT) AS flagged_events
FROM flags GROUP BY user_id ORDER BY flag_count DESC, user_id LIMIT 10""", "flags"))
def top_flagged_users(spark, sf_dir):
    """Top-k users by flag count."""
    return (V.flags(spark, sf_dir).groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("flag_count"),
                 F.count_distinct("event_id").alias("flagged_events"))
            .orderBy(F.desc("flag_count"), "user_id").limit(10))


FEED_N = 50


@register("recent_flags", with_views(f"""
SELECT * FROM flag_events ORDER BY flagged_us DESC, flag_id DESC LIMIT {FEED_N}""",
                                     "flag_events"))
def recent_flags(spark, sf_dir):
    """K1: latest N flags, newest first (cursor tie-breaker flag_id)."""
    from riskline.operators.reports import recent_flags as op

    return op(V.flag_events(spark, sf_dir), FEED_N)


@register("flags_since", with_views("""
SELECT * FROM flag_events
WHERE flagged_us > (SELECT max(created_us) - 86400000000 FROM txn)
   OR (flagged_us = (SELECT max(created_us) - 86400000000 FROM txn) AND flag_id > '')""",
                                    "flag_events"))
def flags_since(spark, sf_dir):
    """K2: flags strictly after a (flagged_us, flag_id) cursor, oldest first; the cursor
    here is one day before "now"."""
    from riskline.operators.reports import flags_since as op

    cursor = fx.now_us(fx.txn(spark, sf_dir)) - F.lit(86_400_000_000)
    return op(V.flag_events(spark, sf_dir), cursor, F.lit(""))


@register("feed_replay", with_views(f"""
SELECT * FROM (SELECT * FROM flag_events ORDER BY flagged_us DESC, flag_id DESC
  LIMIT {FEED_N}) r""", "flag_events"))
def feed_replay(spark, sf_dir):
    """K3: the latest N flags re-sorted oldest first for replay on connect."""
    from riskline.operators.reports import feed_replay as op

    return op(V.flag_events(spark, sf_dir), FEED_N)
