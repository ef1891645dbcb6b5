"""Small helpers that no query runs by itself."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskline.functions.exprs import byte_cut
from riskline.operators import ingest as I
from riskline.operators import reports as RP
from riskline.operators import rules as R
from riskline.operators import sinks as S
from riskline.operators.features import arrival_velocity, asof_features


def test_membership_join_and_point_lookup(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "event_id string, x int")
    values = spark.createDataFrame([("b",), ("b",), ("c",)], "v string")
    assert sorted(r["x"] for r in R.membership_join(df, values, "event_id", "v").collect()) == [2, 3]
    assert [r["x"] for r in RP.get_event(df, "a").collect()] == [1]
    assert RP.get_event(df, "zzz").count() == 0


def test_reason_classes(spark):
    got = {r["reason"]: r["error_class"] for r in I.reason_classes(spark).collect()}
    assert got["storage_fetch_failed"] == "retryable" and got["hash_mismatch"] == "non-retryable"
    assert len(got) == 9


def test_binary_objects(spark):
    root = tempfile.mkdtemp(prefix="riskline-raw-")
    os.makedirs(f"{root}/raw/2024-01-02")
    with open(f"{root}/raw/2024-01-02/e1.json", "w") as f:
        f.write("body")
    got = S.read_binary_objects(spark, f"{root}/raw/*/*.json").collect()
    assert [(r["key"], r["content"]) for r in got] == [("raw/2024-01-02/e1.json", "body")]


def test_rules_yaml():
    pytest.importorskip("yaml")
    from riskline.config import load_rules_yaml

    path = os.path.join(tempfile.mkdtemp(), "rules.yaml")
    with open(path, "w") as f:
        f.write("rules:\n  amount_threshold: 10\n  blocked_merchants: [m]\n")
    cfg = load_rules_yaml(path)
    assert (cfg.amount_threshold, cfg.blocked_merchants, cfg.velocity_max_count) == (10.0, ("m",), 0)


def test_byte_cut(spark):
    df = spark.createDataFrame([("é" * 4,), ("abc",), (None,), ("ab€",)], "t string")
    got = [r["c"] for r in df.select(byte_cut(F.col("t"), 3).alias("c")).collect()]
    assert got == ["é", "abc", None, "ab"]


def test_checkpoint_folder_is_asked_for_off_a_local_master(monkeypatch):
    from riskline import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_windows_equal_brute_force_in_a_burst(spark):
    rng = np.random.default_rng(7)
    us = np.sort(rng.integers(0, 3 * 86_400 * 10**6, 400))
    us[50:60] = us[50]
    us[200:220] = us[200] + np.arange(20) * 3_600_000_000 // 20
    amt = rng.integers(1, 10_000, 400) / 100
    df = spark.createDataFrame([(f"e{i}", "u", int(t), float(a)) for i, (t, a) in enumerate(zip(us, amt))],
                               "event_id string, user_id string, us long, amount double") \
        .withColumn("amount", F.col("amount").cast("decimal(18,2)")).withColumn("created_us", F.col("us"))
    for safe in (True, False):
        got = {r["event_id"]: r for r in asof_features(df, skew_safe=safe).collect()}
        arrived = {r["event_id"]: r["velocity_count"] for r in
                   arrival_velocity(df, 3600, skew_safe=safe).collect()}
        for i, t in enumerate(us):
            r = got[f"e{i}"]
            for w in (60, 3600, 86400):
                assert r[f"velocity_{w}s"] == ((us > t - w * 10**6) & (us <= t)).sum()
            own = amt[(us > t - 3600 * 10**6) & (us <= t)]
            assert abs(float(r["user_amt_sum_3600s"]) - own.sum()) < 1e-6
            assert abs(float(r["user_amt_max_3600s"]) - own.max()) < 1e-9
            before = us[us < t]
            assert r["prev_us"] == (before.max() if len(before) else None)
            assert arrived[f"e{i}"] == ((us >= t - 3600 * 10**6) & (us <= t)).sum()


def test_decoding_rules(spark):
    """Names in any case, repeated fields, typed ids, number range, text behind the body."""
    base = '"amount":2,"currency":"USD","merchant":"m","timestamp":"2024-01-02T03:04:05Z"'
    cases = [
        ('{"user_id":"a",%s}' % base, (True, "a", 0)),
        ('{"User_ID":"a",%s}' % base, (True, "a", 0)),
        ('{"user_id":"a","USER_ID":"b",%s}' % base, (True, "b", 0)),
        ('{"u\u017fer_id":"a",%s}' % base, (True, "a", 0)),
        ('{"user_id":"a","user_id":null,%s}' % base, (True, "a", 0)),
        ('{"user_id":"a","user_id":5,%s}' % base, (False, None, None)),
        ('{"event_id":5,"user_id":"a",%s}' % base, (False, None, None)),
        ('{"event_id":null,"user_id":"a",%s}' % base, (True, "a", 0)),
        ('{"user_id":"a","amount":1e400,%s}' % base[11:], (False, None, None)),
        ('{"user_id":"a","metadata":{"x":1,"y":2},"Metadata":{"y":3,"z":4},%s}' % base, (True, "a", 3)),
        ('{"user_id":"a","metadata":[],%s}' % base, (False, None, None)),
        ('{"user_id":"a",%s} x' % base, (False, None, None)),
        ('{"user_id":"a",%s} {}' % base, (False, None, None)),
        (' {"user_id":"a",%s}\n' % base, (True, "a", 0)),
        ("null", (True, None, 0)), ("[]", (False, None, None)), ("", (False, None, None)), ("{", (False, None, None)),
        ("{}", (True, None, 0)), (None, (None, None, None)),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, payload string")
    for r in I.parse_events(df).collect():
        ok, user, keys = cases[r.i][1]
        assert (r.parse_ok, r.p_user_id) == (ok, user), cases[r.i]
        assert (r.p_metadata_keys or 0) == (keys or 0), cases[r.i]


def test_range_rate_by_hand(spark):
    """Restarts, gaps, extrapolation to both ends and down to the counter's zero."""
    from riskline.operators.metrics import range_rate

    S = 1_000_000
    rows = [("a", t * S, v) for t, v in ((15, 10), (30, 16), (45, 4), (60, 10), (200, 50))]
    rows += [("b", t * S, v) for t, v in ((10, 1), (40, 4), (50, 5))] + [("one", 20 * S, 3)]
    df = spark.createDataFrame(rows, "service string, ts_us long, value long")
    got = {(r.service, r.at_us // S): r for r in range_rate(df, 60, 30).collect()}
    assert not any(s == "one" for s, _ in got)
    a = got["a", 60]                    # 15..60: +6, restart +4, +6; 15 s to the start, 0 to the end
    assert a.n == 4 and abs(a.increase - 16 * (45 + 15 + 0) / 45) < 1e-12 and abs(a.rate - a.increase / 60) < 1e-12
    a = got["a", 90]                    # 45, 60: the gap to the end is longer than 1.1 distances: half of one
    assert a.n == 2 and abs(a.increase - 6 * (15 + min(15, 15 * 4 / 6) + 7.5) / 15) < 1e-12
    b = got["b", 60]                    # the counter would be below zero 10 s before its first sample
    assert b.n == 3 and abs(b.increase - 4 * (40 + min(10, 40 * 1 / 4) + 10) / 40) < 1e-12


def test_training_reads_equal_partitions(spark, monkeypatch):
    """The fit's input is dealt over as many partitions as its rows need."""
    from riskline.operators import ordinal, training

    seen = {}
    monkeypatch.setattr(ordinal, "PART_ROWS", 10)
    monkeypatch.setattr(training.GBTClassifier, "fit", lambda self, df: seen.update(
        parts=df.rdd.getNumPartitions(), rows=df.count(), columns=set(df.columns)))
    rows = [(f"e{i}", str(i % 2), [float(i)]) for i in range(200)]
    training.train_gbt(spark.createDataFrame(rows, "event_id string, label string, features array<float>").coalesce(1))
    assert seen == {"parts": 20, "rows": 200, "columns": {"fv", "y", "w"}}
