"""Rule boundaries and the all-match evaluation (mirrors the reference's table tests)."""

from pyspark.sql import functions as F

from riskline.config import RulesConfig
from riskline.operators import rules as R

SCHEMA = ("event_id string, user_id string, amount double, currency string, "
          "merchant string, velocity_count long, created_us long")


def _mk(spark, rows):
    rows = [(r[0], r[1], float(r[2]), *r[3:]) for r in rows]
    return spark.createDataFrame(rows, SCHEMA).withColumn(
        "amount", F.col("amount").cast("decimal(18,2)"))


def _flags(spark, rows, cfg):
    df = _mk(spark, rows)
    return {(r["event_id"], r["rule_name"]): r["rule_value"]
            for r in R.evaluate_rules(df, cfg).collect()}


OFF = dict(amount_threshold=0, velocity_window_seconds=0, velocity_max_count=0,
           blocked_merchants=(), high_risk_currencies=())


def test_amount_threshold_is_strict(spark):
    cfg = RulesConfig(**{**OFF, "amount_threshold": 10000.0})
    rows = [("a", "u", 15000, "USD", "m", 0, 0), ("b", "u", 10000, "USD", "m", 0, 0),
            ("c", "u", 5000, "USD", "m", 0, 0)]
    f = _flags(spark, rows, cfg)
    assert list(f) == [("a", "amount_threshold")]
    assert f[("a", "amount_threshold")] == "amount=15000.00 > threshold=10000.00"


def test_velocity_reaches_max(spark):
    cfg = RulesConfig(**{**OFF, "velocity_window_seconds": 60, "velocity_max_count": 5})
    rows = [(e, "u", 1, "USD", "m", n, 0) for e, n in (("a", 5), ("b", 10), ("c", 4), ("d", 0))]
    f = _flags(spark, rows, cfg)
    assert set(f) == {("a", "velocity"), ("b", "velocity")}
    assert f[("b", "velocity")] == "count=10 in 60s >= max=5"


def test_merchant_and_currency_exact_case_sensitive(spark):
    cfg = RulesConfig(**{**OFF, "blocked_merchants": ("bad-corp",),
                         "high_risk_currencies": ("XMR",)})
    rows = [("a", "u", 1, "XMR", "bad-corp", 0, 0), ("b", "u", 1, "xmr", "bad-corp-extra", 0, 0),
            ("c", "u", 1, "USD", 'say "hi"\\', 0, 0)]
    f = _flags(spark, rows, cfg)
    assert set(f) == {("a", "blocked_merchant"), ("a", "high_risk_currency")}
    assert f[("a", "blocked_merchant")] == 'merchant="bad-corp" is blocked'
    assert f[("a", "high_risk_currency")] == 'currency="XMR" is high-risk'


def test_go_quote_escapes(spark):
    from riskline.functions.exprs import go_quote

    v = spark.createDataFrame([('say "hi"\\',)], "s string").select(
        go_quote(F.col("s")).alias("q")).first()["q"]
    assert v == '"say \\"hi\\"\\\\"'


def test_all_four_fire_and_flag_ids_are_stable(spark):
    cfg = RulesConfig(amount_threshold=10000.0, velocity_window_seconds=60,
                      velocity_max_count=1, blocked_merchants=("bad-corp",),
                      high_risk_currencies=("XMR",), tau=0.5)
    rows = [("a", "u", 15000, "XMR", "bad-corp", 3, 0)]
    df = _mk(spark, rows)
    first = R.evaluate_rules(df, cfg).collect()
    again = R.evaluate_rules(df, cfg).collect()
    assert [r["rule_name"] for r in first] == ["amount_threshold", "velocity",
                                               "blocked_merchant", "high_risk_currency"]
    assert {r["flag_id"] for r in first} == {r["flag_id"] for r in again}


def test_blend_and_fail_open(spark):
    cfg = RulesConfig(**{**OFF, "tau": 0.5})
    ev = _mk(spark, [("a", "u", 1, "USD", "m", 0, 0), ("b", "u", 1, "USD", "m", 0, 0)])
    scores = spark.createDataFrame([("a", 0.9)], "event_id string, ml_score double")
    scored = R.attach_scores(ev, scores, "m1")
    f = {r["event_id"]: r for r in R.evaluate_rules(scored, cfg, with_score=True).collect()}
    assert set(f) == {"a"} and f["a"]["rule_value"] == "ml_score=0.9000 >= tau=0.5000 (model=m1)"
    d = {r["event_id"]: r for r in R.decisions(scored, R.evaluate_rules(scored, cfg, with_score=True)).collect()}
    assert d["a"]["decision"] == "FLAG" and d["a"]["evaluated_by"] == "v1+ml-m1"
    assert d["b"]["decision"] == "ALLOW" and d["b"]["evaluated_by"] == "v1"   # no score
    assert d["b"]["ml_score"] == 0.0
