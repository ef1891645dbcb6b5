"""Derived tables shared by many registered queries (Spark side).

The DuckDB twins are registered in :mod:`riskline.plans.oracle_views` under the same names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskline.config import TEST_RULES, RulesConfig
from riskline.operators import rules as R
from riskline.sources import fixtures as fx


def scored_txn(spark: SparkSession, sf_dir: str, cfg: RulesConfig = TEST_RULES) -> DataFrame:
    """txn_m with the arrival-time velocity count and the (fail-open) proxy score."""
    t = R.with_velocity(fx.txn_m(spark, sf_dir), cfg)
    return R.attach_scores(t, fx.scores(spark, sf_dir).select("event_id", "ml_score"),
                           cfg.model_version)


def flags(spark: SparkSession, sf_dir: str, cfg: RulesConfig = TEST_RULES) -> DataFrame:
    """Blended flags (rules + ml_risk), ``flagged_us = created_us``."""
    return R.evaluate_rules(scored_txn(spark, sf_dir, cfg), cfg, with_score=True)


def flag_events(spark: SparkSession, sf_dir: str, cfg: RulesConfig = TEST_RULES) -> DataFrame:
    """Flags joined with their events (the feed's FraudEvent shape)."""
    ev = fx.txn_m(spark, sf_dir).select("event_id", "correlation_id", "amount", "currency",
                                         "merchant")
    return flags(spark, sf_dir, cfg).join(ev, "event_id").select(
        "flag_id", "event_id", "correlation_id", "user_id", "amount", "currency", "merchant",
        "rule_name", "rule_value", "flagged_us", "ml_score")


def features(spark: SparkSession, sf_dir: str, skew_safe: bool = True) -> DataFrame:
    from riskline.operators.features import feature_vector

    return feature_vector(fx.txn_m(spark, sf_dir), skew_safe=skew_safe)


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every envelope through the processor stages (reason null = good event)."""
    from riskline.plans.pipeline import process_envelopes
    from riskline.sources import wire

    now = fx.now_us(fx.txn(spark, sf_dir))
    return process_envelopes(wire.envelopes(spark, sf_dir), wire.objects(spark, sf_dir), now)
