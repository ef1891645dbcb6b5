"""As-of window operators: boundaries, ties, look-back, and brute force equality."""

import random

import pytest
from pyspark.sql import functions as F

from riskline.config import FeatureConfig
from riskline.operators.features import arrival_velocity, asof_features

S = 1_000_000
SCHEMA = "event_id string, user_id string, us long, amount double, created_us long"


def _df(spark, rows):
    df = spark.createDataFrame([(e, u, t, float(a), c) for e, u, t, a, c in rows], SCHEMA)
    return df.withColumn("amount", F.col("amount").cast("decimal(18,2)"))


def _by_id(df):
    return {r["event_id"]: r for r in df.collect()}


@pytest.mark.parametrize("skew_safe", [True, False])
def test_count_window_half_open(spark, skew_safe):
    # events at 0, 30, 90 s: a 100 s window at +90 holds all three, a 50 s window one
    rows = [("a", "u", 0, 1, 0), ("b", "u", 30 * S, 1, 30 * S), ("c", "u", 90 * S, 1, 90 * S)]
    cfg = FeatureConfig(count_windows_s=(50, 60, 100), stats_window_s=60, bucket_s=100)
    out = _by_id(asof_features(_df(spark, rows), cfg=cfg, skew_safe=skew_safe))
    assert out["c"]["velocity_100s"] == 3
    assert out["c"]["velocity_50s"] == 1
    # exactly w seconds back is outside the half-open window
    assert out["c"]["velocity_60s"] == 1 and out["b"]["velocity_60s"] == 2


@pytest.mark.parametrize("skew_safe", [True, False])
def test_amount_stats_and_previous(spark, skew_safe):
    rows = [("a", "u", 0, 100, 0), ("b", "u", 10 * S, 300, 10 * S)]
    out = _by_id(asof_features(_df(spark, rows), skew_safe=skew_safe))
    assert float(out["b"]["user_amt_sum_3600s"]) == 400.0
    assert float(out["b"]["user_amt_max_3600s"]) == 300.0
    assert out["b"]["prev_us"] == 0 and out["b"]["secs_since_prev"] == 10.0
    assert out["a"]["secs_since_prev"] == -1.0


def test_ties_count_but_are_not_previous(spark):
    rows = [("a", "u", 5 * S, 1, 5 * S), ("b", "u", 5 * S, 1, 5 * S)]
    out = _by_id(asof_features(_df(spark, rows)))
    assert out["a"]["velocity_60s"] == 2 and out["b"]["velocity_60s"] == 2
    assert out["a"]["secs_since_prev"] == -1.0 and out["b"]["secs_since_prev"] == -1.0


def test_unlimited_lookback_across_buckets(spark):
    day = 86400 * S
    rows = [("a", "u", 1 * S, 1, 1 * S), ("b", "u", 10 * day + 5 * S, 1, 10 * day + 5 * S)]
    out = _by_id(asof_features(_df(spark, rows)))
    assert out["b"]["prev_us"] == 1 * S
    assert out["b"]["velocity_86400s"] == 1


def test_arrival_velocity_closed_window(spark):
    rows = [("a", "u", 0, 1, 0), ("b", "u", 0, 1, 60 * S)]
    out = _by_id(arrival_velocity(_df(spark, rows), 60))
    assert out["b"]["velocity_count"] == 2      # [c - 60 s, c] includes the boundary


def _brute(rows, w_s):
    out = {}
    for e, u, t, a, _ in rows:
        same = [r for r in rows if r[1] == u]
        cnt = sum(1 for r in same if t - w_s * S < r[2] <= t)
        prev = max([r[2] for r in same if r[2] < t], default=None)
        out[e] = (cnt, prev)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bucketed_windows_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    day = 86400 * S
    rows = []
    for i in range(300):
        u = f"u{rnd.randint(0, 3)}"          # few users: dense histories, a hot user
        t = rnd.randint(0, 5 * day)
        if rnd.random() < 0.1 and rows:       # ties
            t = rows[-1][2]
        rows.append((f"e{i}", u, t, rnd.randint(1, 500), t))
    out = _by_id(asof_features(_df(spark, rows)))
    brute = _brute(rows, 86400)
    for e, (cnt, prev) in brute.items():
        assert out[e]["velocity_86400s"] == cnt
        assert out[e]["prev_us"] == prev
    b60 = _brute(rows, 3600)
    for e, (cnt, _p) in b60.items():
        assert out[e]["velocity_3600s"] == cnt


def test_arrival_features_equal_brute_force(spark):
    """Late and tied arrivals, one burst, several days: only what had arrived counts."""
    import numpy as np

    from riskline.operators.features import arrival_features

    rng = np.random.default_rng(3)
    us = np.sort(rng.integers(0, 4 * 86_400, 250)) * 10**6
    late = np.where(rng.random(250) < 0.3, rng.integers(0, 7200, 250), 0) * 10**6
    amt = rng.integers(1, 999, 250)
    rows = [(f"e{i}", "u" if i % 5 else "v", int(t), int(t + d), int(a))
            for i, (t, d, a) in enumerate(zip(us, late, amt))]
    df = spark.createDataFrame(rows, "event_id string, user_id string, us long, created_us long, amount int") \
        .withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    for r in arrival_features(df).collect():
        seen = [x for x in rows if x[1] == r["user_id"] and x[2] <= r["us"] and x[3] <= r["created_us"]]
        for w in (60, 3600, 86400):
            assert r[f"velocity_{w}s"] == sum(x[2] > r["us"] - w * 10**6 for x in seen)
        own = [x[4] for x in seen if x[2] > r["us"] - 3600 * 10**6]
        assert (float(r["user_amt_sum_3600s"]), float(r["user_amt_max_3600s"])) == (sum(own), max(own))
        assert r["prev_us"] == max((x[2] for x in seen if x[2] < r["us"]), default=None)


@pytest.mark.parametrize("bits", [(12, 6), (2, 1), (3, 2)])
def test_arrival_features_days_late_and_hot_user(spark, bits):
    """Lateness of days, ties in both times, a hot user and repeated rows; small trees make the
    ranges cross leaves and several tiers of nodes."""
    import numpy as np

    from riskline.operators.features import arrival_features

    rng = np.random.default_rng(7)
    n = 400
    us = np.sort(rng.integers(0, 6 * 86_400, n) // 40 * 40) * 10**6
    late = np.where(rng.random(n) < 0.4, rng.integers(0, 5 * 86_400, n), 0) // 60 * 60 * 10**6
    amt = rng.integers(1, 999, n)
    rows = [(f"e{i}", "hot" if i % 3 else f"u{i % 7}", int(t), int(t + d), int(a))
            for i, (t, d, a) in enumerate(zip(us, late, amt))]
    # the case of a previous event that had not arrived yet
    day = 86_400 * 10**6
    rows += [("A", "x", 0, 5 * day, 5), ("B", "x", 3 * day, 3 * day, 7), ("C", None, 5, 6, 1), ("D", None, 9, 9, 1)]
    df = spark.createDataFrame(rows + [("N", "x", None, 5, 1), ("M", "x", 5, None, 1)],
                               "event_id string, user_id string, us long, created_us long, amount int") \
        .withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    got = {r["event_id"]: r for r in arrival_features(df, leaf_bits=bits[0], fan_bits=bits[1]).collect()}
    assert len(got) == len(rows) + 2 and got["N"]["velocity_60s"] is None and got["B"]["secs_since_prev"] == -1.0
    for e, u, t, a, _ in rows:
        r = got[e]
        seen = [x for x in rows if x[1] == u and x[2] <= t and x[3] <= a]
        for w in (60, 3600, 86400):
            assert r[f"velocity_{w}s"] == sum(x[2] > t - w * 10**6 for x in seen), e
        own = [x[4] for x in seen if x[2] > t - 3600 * 10**6]
        assert (float(r["user_amt_sum_3600s"]), float(r["user_amt_max_3600s"])) == (sum(own), max(own))
        assert r["prev_us"] == max((x[2] for x in seen if x[2] < t), default=None), e


def test_partitions_follow_the_rows(spark, monkeypatch):
    """Windows run on as many partitions as the rows need, whatever the session's setting."""
    from riskline.operators import features, ordinal

    monkeypatch.setattr(ordinal, "PART_ROWS", 10)
    rows = [(f"e{i}", f"u{i % 7}", i * 3_600_000_000, i * 3_600_000_000, i) for i in range(300)]
    df = spark.createDataFrame(rows, "event_id string, user_id string, us long, created_us long, amount int") \
        .withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    assert ordinal.part_count(spark, 300) == 30
    out = features.asof_features(df)
    assert "hashpartitioning(user_id" in (plan := out._jdf.queryExecution().toString()) and ", 30)" in plan
    few = {r.event_id: r for r in features.asof_features(df, parts=1).collect()}
    assert {r.event_id: r for r in out.collect()} == few


def test_previous_event_is_aggregated_after_the_deal(spark):
    """An aggregate in the scan would hold every (user, day) of an input split in one task."""
    rows = [(f"e{i}", f"u{i % 7}", i * 20_000 * S, i, 0) for i in range(60)]
    plan = asof_features(_df(spark, rows), parts=5)._jdf.queryExecution().sparkPlan().toString().split("\n")
    latest = [i for i, line in enumerate(plan) if "partial_max(us" in line]
    assert latest and any("REPARTITION_BY_NUM" in line for line in plan[latest[-1] + 1:])
