"""Keyed state: online features and claim ledger over restarts, lease timers, bounded history."""

import random

from pyspark.sql import functions as F

from riskline.config import RulesConfig
from riskline.operators import keystore as K
from riskline.operators import ledger as L
from riskline.operators import rules as R
from riskline.operators.features import arrival_features
from riskline.streaming import ledger_state as LS
from riskline.streaming import queries as Q
from riskline.streaming.online_features import online_features

S = 1_000_000
DAY = 86_400 * S


def _run(spark, df, build, root, files, tag):
    """Append ``df`` as further input files and run the stream over them, from its checkpoint."""
    Q.stage_files(df, f"{root}/in-{tag}", part_col="_at", n_files=files)
    src = Q.read_stream(spark, f"{root}/in-*", df.schema)

    def sink(batch, epoch):
        Q.write_batch(batch, f"{root}/out", epoch)

    with Q.keyed_state(spark, partitions=2):
        Q.run_available(build(src.drop("_at")), f"{root}/ckpt", sink=sink)


def _events(spark, rows):
    return spark.createDataFrame(rows, "event_id string, user_id string, us long, created_us long, amount int") \
        .withColumn("amount", F.col("amount").cast("decimal(18,2)")).withColumn("_at", F.col("created_us"))


def test_online_features_equal_batch_over_restarts(spark, tmp_path):
    """Late events, ties, a hot user, quiet days (pruned hours) and a restart between batches."""
    rng = random.Random(4)
    rows = []
    for i in range(260):
        t = (rng.randrange(0, 3 * 86_400) if i % 2 else rng.randrange(20 * 86_400, 22 * 86_400)) // 50 * 50 * S
        late = rng.choice([0, 0, 0, rng.randrange(0, 86_400) * S])
        rows.append((f"e{i}", "hot" if i % 3 else f"u{i % 4}", t, t + late, rng.randrange(1, 900)))
    rows += [("x0", "x", 0, 0, 1), ("x1", "x", 40 * DAY, 40 * DAY, 2), ("x2", "x", DAY, 41 * DAY, 3)]
    df = _events(spark, rows)
    cut = 10 * DAY
    root = str(tmp_path)
    build = lambda s: online_features(s, lateness_us=2 * DAY)
    _run(spark, df.filter(F.col("created_us") <= cut), build, root, 3, "a")
    _run(spark, df.filter(F.col("created_us") > cut), build, root, 3, "b")
    cols = ["event_id", "velocity_60s", "velocity_3600s", "velocity_86400s", "user_amt_sum_3600s", "user_amt_max_3600s",
            "prev_us", "secs_since_prev"]
    got = {r.event_id: r for r in spark.read.parquet(f"{root}/out").collect()}
    assert [e for e, r in got.items() if not r.exact] == ["x2"]         # 40 days late: left to the batch form
    for r in arrival_features(df.drop("_at")).collect():
        if r.event_id != "x2":
            assert [got[r.event_id][c] for c in cols] == [r[c] for c in cols], r.event_id
    assert got["x1"].prev_us == 0           # from the newest pruned time


def test_expired_leases_are_emitted_without_a_delivery(spark, tmp_path):
    rows = [("stuck", 0, 1, "retryable"), ("again", 0, 1, "retryable"), ("again", 61 * S, 2, "ok"),
            ("twice", 0, 1, "retryable"), ("twice", 70 * S, 2, "retryable"), ("young", 190 * S, 1, "retryable"),
            ("inside", 5 * S, 1, "retryable"), ("inside", 20 * S, 2, "ok"), ("done", 3 * S, 1, "ok"),
            (None, 4 * S, 1, "hash_mismatch"), (None, 9 * S, 2, "retryable"), ("clock", 202 * S, 1, "ok")]
    rows = [(e, DAY + t, n, o) for e, t, n, o in rows]
    df = spark.createDataFrame(rows, "event_id string, received_us long, delivery_no int, outcome string") \
        .withColumn("_at", F.col("received_us"))
    root = str(tmp_path)
    for tag, cond in (("a", f"received_us < {DAY + 50 * S}"), ("b", f"received_us BETWEEN {DAY + 50 * S} AND {DAY + 99 * S}"),
                      ("c", f"received_us > {DAY + 99 * S}")):
        _run(spark, df.filter(cond), LS.stream_claims, root, 2, tag)
    last = {r.event_id: r for r in LS.latest_claims(
        spark.read.schema(LS.OUT_SCHEMA + ", epoch int").parquet(f"{root}/out")).collect()}
    led = {r.event_id: r for r in L.claim_ledger(df.drop("_at")).collect()}
    assert set(last) == set(led)
    for e, r in led.items():
        assert [last[e][c] for c in ("status", "first_seen_us", "last_seen_us", "attempts", "error_reason")] == \
            [r[c] for c in ("status", "first_seen_us", "last_seen_us", "attempts", "error_reason")], e
    want = {r.event_id for r in L.stuck_events(L.claim_ledger(df.drop("_at")), F.lit(DAY + 200 * S)).collect()}
    assert {e for e, r in last.items() if r.expired} == want == {"stuck", "twice", "inside", None}


def test_velocity_reads_only_reachable_history(spark, tmp_path):
    """Same counts as over the whole history; the scan is bounded by the probes' times."""
    rng = random.Random(6)
    cfg = RulesConfig(velocity_window_seconds=600, velocity_max_count=1)
    rows = [(f"h{i}", rng.choice(["a", "b", "c", None]), rng.randrange(0, 30) * DAY + rng.randrange(0, 4) * 300 * S)
            for i in range(400)]
    path = str(tmp_path / "h")
    schema = "event_id string, user_id string, created_us long"
    spark.createDataFrame(rows, schema).write.parquet(path)
    history = spark.read.parquet(path)
    probes = [("p0", "a", 3 * DAY + 900 * S), ("p1", "a", 9 * DAY), ("p2", None, 9 * DAY + 600 * S), ("p3", "z", 5 * DAY),
              rows[7], rows[8]]
    df = R.with_velocity(spark.createDataFrame(probes, schema), cfg, history=history)
    every = set(rows) | set(probes)
    for r in df.collect():
        want = sum(u == r.user_id and r.created_us - 600 * S <= c <= r.created_us for _, u, c in every)
        assert r.velocity_count == want, r
    near = R.reachable(history, spark.createDataFrame(probes[:2], schema), 600 * S)
    got = near.collect()
    assert {r.user_id for r in got} == {"a"} and len(got) < 20
    plan = near._jdf.queryExecution().toString()
    assert "PushedFilters" in plan


def test_days_reads_named_folders_only(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(20).selectExpr("id AS v", "id div 2 AS day", "0 AS epoch")
    df.write.partitionBy("day", "epoch").parquet(path)
    got = K.days(spark, path, 3, 4, "v long")
    assert sorted(r.v for r in got.collect()) == [6, 7, 8, 9] and len(got.inputFiles()) <= 4
    assert K.days(spark, path, 50, 60, "v long").count() == 0


def test_claims_are_folded_on_rows():
    """A delivery costs one read and at most one write of its event's state, without a data frame."""
    from pyspark.sql import Row

    class Handle:
        def __init__(self):
            self.value, self.writes, self.timers = None, 0, set()

        def getValueState(self, *_):
            return self

        def get(self):
            return self.value

        def update(self, value):
            self.value, self.writes = value, self.writes + 1

        def registerTimer(self, at):
            self.timers.add(at)

        def deleteTimer(self, at):
            self.timers.remove(at)

    h = Handle()
    ledger = LS.ClaimLedger(60)
    ledger.init(h)
    row = Row("received_us", "delivery_no", "outcome")
    out = list(ledger.handleInputRows(("e",), iter([row(90 * S, 2, "retryable"), row(0, 1, "retryable")]), None))
    assert [(r.received_us, r.status, r.attempts, r.claimed) for r in out] == [
        (0, "processing", 1, True), (90 * S, "processing", 2, True)]
    assert h.writes == 1 and h.timers == {150_000}
    assert [r.status for r in ledger.handleInputRows(("e",), iter([row(200 * S, 3, "ok")]), None)] == ["success"]
    assert h.writes == 2 and not h.timers
    late = list(ledger.handleInputRows(("e",), iter([row(201 * S, None, None)]), None))
    assert [(r.status, r.claimed) for r in late] == [("success", False)] and h.writes == 2


def test_state_partitions_use_every_core(spark):
    assert Q.state_partitions(spark) == max(4, spark.sparkContext.defaultParallelism)


def test_processor_sizes_its_key_index_by_the_input(spark, tmp_path, monkeypatch):
    """A bucket of the processor's key indexes keeps its size when the input grows."""
    import datetime as dt

    import pytest

    from riskline.operators import ordinal
    from riskline.plans import catalog_streaming as CS

    class Stop(Exception):
        pass

    def index(spark, path, buckets, **_):
        raise Stop(buckets)

    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), i % 5, "click", float(i)) for i in range(240)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double") \
        .write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(ordinal, "PART_ROWS", 10)
    monkeypatch.setattr(CS.KS, "KeyIndex", index)
    with pytest.raises(Stop) as e:
        CS.process_stream(spark, str(tmp_path))
    assert e.value.args == (24,)


def test_pages_of_claims_give_the_updates_of_single_events(spark, tmp_path):
    """Events that share a key: the same updates and expired leases as with a key per event."""
    rng = random.Random(9)
    outcomes = ["ok", "retryable", "retryable", "hash_mismatch", None]
    rows = [(None if i % 13 == 0 else f"e{i % 13}", 2 * i * S + i % 3 * 1000, i % 4 or None, rng.choice(outcomes))
            for i in range(150)]
    # leases that end at, just before and just behind the last watermark
    rows += [("tie", 240 * S + 1000, 1, "retryable"), ("before", 240 * S, 1, "retryable"), ("behind", 240 * S + 2000, 1, "retryable"),
             ("clock", 300 * S + 2000, 1, "ok")]
    rows = [(e, DAY + t, n, o) for e, t, n, o in rows]
    df = spark.createDataFrame(rows, "event_id string, received_us long, delivery_no int, outcome string") \
        .withColumn("_at", F.col("received_us"))
    got = {}
    for name, pages in (("single", None), ("paged", 3)):
        root = str(tmp_path / name)
        build = lambda s: LS.stream_claims(s, disorder="1 millisecond", pages=pages)  # noqa: B023, E731
        for tag, cond in (("a", f"received_us < {DAY + 130 * S}"), ("b", f"received_us >= {DAY + 130 * S}")):
            _run(spark, df.filter(cond), build, root, 2, tag)
        got[name] = sorted(map(repr, spark.read.schema(LS.OUT_SCHEMA + ", epoch int").parquet(f"{root}/out").collect()))
    assert got["paged"] == got["single"] and len(got["single"]) > len(rows)


def test_claims_are_read_once_per_page():
    """A page costs one read and one write of state and one timer, however many events it holds."""
    import pandas as pd

    class Handle:
        def __init__(self):
            self.value, self.calls, self.timers = None, 0, set()

        def getValueState(self, *_):
            return self

        def get(self):
            self.calls += 1
            return self.value

        def update(self, value):
            self.value, self.calls = value, self.calls + 1

        def registerTimer(self, at):
            self.calls, self.timers = self.calls + 1, self.timers | {at}

        def deleteTimer(self, at):
            self.calls, self.timers = self.calls + 1, self.timers - {at}

    h = Handle()
    pages = LS.ClaimPages(60)
    pages.init(h)
    rows = pd.DataFrame({"event_id": [f"e{i}" for i in range(500)], "received_us": [i * S for i in range(500)],
                         "delivery_no": [1.0] * 499 + [None], "outcome": ["retryable", "ok"] * 250})
    out = pd.concat(pages.handleInputRows((0,), iter([rows]), None))
    assert len(out) == 500 and h.calls == 3 and h.timers == {60_000}
    again = pd.DataFrame({"event_id": ["e0"], "received_us": [70 * S], "delivery_no": [2], "outcome": ["ok"]})
    assert pd.concat(pages.handleInputRows((0,), iter([again]), None)).attempts.tolist() == [2]
    assert h.timers == {62_000}


def test_a_large_micro_batch_is_several_files(spark, tmp_path, monkeypatch):
    """Files follow the rows; those of one micro-batch are consecutive ranges, in order."""
    monkeypatch.setattr(Q, "FILE_ROWS", 100)
    assert Q.file_split(1) == 1 and Q.file_split(400) == 1 and Q.file_split(1001) == 3
    df = spark.range(1200).selectExpr("(id * 7919) % 1200 AS at")
    split = Q.file_split(df.count())
    Q.stage_files(df, f"{tmp_path}/in", part_col="at", split=split)
    src = Q.read_stream(spark, f"{tmp_path}/in", df.schema, files_per_trigger=split)
    seen = []
    Q.run_available(src, f"{tmp_path}/ckpt", sink=lambda b, e: seen.append(
        (e, *b.selectExpr("min(at)", "max(at)", "count(1)").first())))
    files = [n for n in K.children(spark, f"{tmp_path}/in") if n.startswith("part-")]
    assert split == 3 and len(files) == 12 and len(seen) == 4
    assert sum(s[3] for s in seen) == 1200 and all(a[2] < b[1] for a, b in zip(seen, seen[1:]))


def test_users_of_a_page_are_answered_together(spark, tmp_path):
    """Users share a page and a micro-batch is cut into slices of few rows: the same features as in
    the batch form, with ties, late events, users that stay quiet and a restart."""
    rng = random.Random(11)
    rows = []
    for i in range(300):
        t = (i // 60 * 4 * 86_400 + rng.randrange(0, 86_400) // 600 * 600) * S
        late = rng.choice([0, 0, 0, 0, rng.randrange(0, 86_400) // 600 * 600 * S])
        rows.append((f"e{i}", "hot" if i % 2 else f"u{rng.randrange(12)}" if i // 60 % 2 else "u0", t, t + late, rng.randrange(1, 900)))
    df = _events(spark, rows)
    cut = 9 * DAY
    root = str(tmp_path)
    build = lambda s: online_features(s, lateness_us=2 * DAY, pages=2, slice_rows=5)
    _run(spark, df.filter(F.col("created_us") <= cut), build, root, 2, "a")
    _run(spark, df.filter(F.col("created_us") > cut), build, root, 2, "b")
    cols = ["velocity_60s", "velocity_3600s", "velocity_86400s", "user_amt_sum_3600s", "user_amt_max_3600s", "prev_us"]
    got = {r.event_id: [r[c] for c in cols] for r in spark.read.parquet(f"{root}/out").filter("exact").collect()}
    want = {r.event_id: [r[c] for c in cols] for r in arrival_features(df.drop("_at")).collect()}
    assert got == want


def test_state_of_a_page_is_read_by_blocks():
    """State calls follow the blocks a micro-batch reaches, not its events or users."""
    import pandas as pd

    from riskline.config import FeatureConfig
    from riskline.streaming.online_features import HOUR_US, LATENESS_US, OnlineFeatures

    class State:
        def __init__(self):
            self.value, self.blocks, self.calls = None, {}, 0

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

        def getValue(self, key):
            self.calls += 1
            return self.blocks[key]

        def updateValue(self, key, value):
            self.calls, self.blocks[key] = self.calls + 1, value

        def getMapState(self, *_):
            return self

        getValueState = getMapState

    state = State()
    page = OnlineFeatures(FeatureConfig(), LATENESS_US, "user_id", 1 << 15)
    page.init(state)
    for day in (1, 2):
        us = [day * DAY + i * HOUR_US // 100 for i in range(2000)]
        rows = pd.DataFrame({"event_id": [f"{day}-{i}" for i in range(2000)], "user_id": [f"u{i % 50}" for i in range(2000)],
                             "us": us, "created_us": us, "cents_": [100] * 2000, "page_": [0] * 2000})
        out = pd.concat(page.handleInputRows((0,), iter([rows[:900], rows[900:]]), None))
        assert len(out) == 2000 and out["exact"].all()
    assert state.calls <= 3 * 4 + 2         # four blocks of a day: written, and read for the next day
