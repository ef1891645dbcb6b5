"""Registered queries: Structured Streaming runs.

Each key stages its input from the test tables as files in a fresh folder under the
shared checkpoint directory, runs the streaming query with ``availableNow`` (several
micro-batches, one file each) and returns what the sink holds. Where the stream must equal
its batch twin, the oracle is the batch twin's SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.config import TEST_RULES as C
from riskline.functions.exprs import from_micros, micros
from riskline.operators import ingest as I
from riskline.operators import keystore as KS
from riskline.operators import ledger as L
from riskline.operators import rules as R
from riskline.operators import sinks as S
from riskline.operators.features import arrival_features, feature_vector
from riskline.operators.ordinal import part_count
from riskline.plans import pipeline as PL
from riskline.plans import views as V
from riskline.plans.catalog_metrics import ALARM_RULES, alarm_sql, slide_sql
from riskline.plans.oracle_views import with_views
from riskline.plans.registry import register
from riskline.sources import fixtures as fx
from riskline.sources import wire
from riskline.streaming import alarms as AL
from riskline.streaming import ledger_state as LS
from riskline.streaming import queries as Q
from riskline.streaming.online_features import PAGE_EVENTS, online_features

_DAY_US = 86_400_000_000


def _day(us):
    return F.floor(us / F.lit(_DAY_US)).cast("long")


@register("stream_volume", with_views("""
SELECT CAST(floor(us / 300000000) * 300000000 AS BIGINT) AS window_start_us,
  CAST(count(*) AS BIGINT) AS n FROM txn GROUP BY 1""", "txn"))
def stream_volume(spark, sf_dir):
    """5-minute transaction counts as a watermarked streaming aggregation: state older
    than the watermark is dropped, each micro-batch writes the windows it changed, the last
    count of a window holds. Equals the batch twin on in-order input."""
    root = Q.run_dir(spark, "volume")
    t = fx.txn(spark, sf_dir).select("event_id", from_micros("us").cast("timestamp").alias("ts"))
    Q.stage_files(t, f"{root}/in", part_col="ts")
    src = Q.read_stream(spark, f"{root}/in", t.schema)
    agg = Q.windowed_counts_stream(src, "ts", "5 minutes")
    out = f"{root}/out"

    def sink(batch: DataFrame, epoch: int) -> None:
        Q.write_batch(batch, out, epoch)

    Q.run_available(agg, f"{root}/ckpt", sink=sink, mode="update")
    last = spark.read.parquet(out).groupBy("w").agg(F.max_by("n", "epoch").alias("n"))
    return last.select(micros(F.col("w.start")).alias("window_start_us"), "n")


def _latest(spark, path: str, keys: list[str], values: list[str]) -> DataFrame:
    """The last update of each window from a table of a stream's updates."""
    last = spark.read.parquet(path).groupBy(*keys).agg(F.max_by(F.struct(*values), "epoch").alias("_v"))
    return last.select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values])


@register("stream_rate", with_views(f"""
SELECT window_start_us, status, count(*) / 60.0 AS rate FROM (
  {slide_sql('ops_log', 'us', 60, 15, 'status')}) x GROUP BY 1, 2""", "ops_log"))
def stream_rate(spark, sf_dir):
    """T8 (A9): events per second by status in 1-minute windows sliding every 15 s, as a
    watermarked streaming aggregation; equals the batch twin on in-order input."""
    root = Q.run_dir(spark, "rate")
    t = fx.ops_log(spark, sf_dir).select("status", from_micros("us").cast("timestamp").alias("ts"))
    Q.stage_files(t, f"{root}/in", part_col="ts")
    src = Q.read_stream(spark, f"{root}/in", t.schema)
    agg = Q.windowed_counts_stream(src, "ts", "60 seconds", slide="15 seconds", by=("status",))
    Q.run_available(agg, f"{root}/ckpt", sink=lambda b, e: Q.write_batch(b, f"{root}/out", e), mode="update")
    last = _latest(spark, f"{root}/out", ["w", "status"], ["n"])
    return last.select(micros(F.col("w.start")).alias("window_start_us"), "status", (F.col("n") / 60.0).alias("rate"))


@register("stream_fraud_rate", with_views("""
SELECT w AS window_start_us, CAST(sum(f) AS BIGINT) AS flags, CAST(sum(p) AS BIGINT) AS processed,
  round(CASE WHEN sum(p) = 0 THEN NULL ELSE sum(f) * 100.0 / sum(p) END, 6) AS fraud_rate_pct FROM (
  SELECT CAST(floor(created_us / 300000000) * 300000000 AS BIGINT) AS w, 0 AS f, 1 AS p FROM txn
  UNION ALL SELECT CAST(floor(flagged_us / 300000000) * 300000000 AS BIGINT), 1, 0 FROM flags) x GROUP BY 1""", "txn", "flags"))
def stream_fraud_rate(spark, sf_dir):
    """T8 (A12): flags / processed x 100 per 5-minute window. The two streams are united into
    one of (time, is a flag), so one keyed count per window serves both sides and neither is
    buffered for a join; equals the batch twin on in-order input."""
    root = Q.run_dir(spark, "fraud-rate")
    ts = lambda c: from_micros(c).cast("timestamp").alias("ts")
    sides = {"flags": V.flags(spark, sf_dir).select(ts("flagged_us"), F.lit(True).alias("flag")),
             "events": fx.txn(spark, sf_dir).select(ts("created_us"), F.lit(False).alias("flag"))}
    streams = []
    for name, df in sides.items():
        Q.stage_files(df, f"{root}/{name}", part_col="ts")
        streams.append(Q.read_stream(spark, f"{root}/{name}", df.schema).withWatermark("ts", "1 day"))
    both = streams[0].unionByName(streams[1])
    agg = both.groupBy(F.window("ts", "300 seconds").alias("w")).agg(
        F.count_if("flag").alias("flags"), F.count_if(~F.col("flag")).alias("processed"))
    Q.run_available(agg, f"{root}/ckpt", sink=lambda b, e: Q.write_batch(b, f"{root}/out", e), mode="update")
    last = _latest(spark, f"{root}/out", ["w"], ["flags", "processed"])
    return last.select(micros(F.col("w.start")).alias("window_start_us"), "flags", "processed",
                       F.round(F.try_divide(F.col("flags") * 100.0, F.col("processed")), 6).alias("fraud_rate_pct"))


@register("stream_alarms", with_views(alarm_sql(
    "range(min(period_us), (SELECT max(us) // 1000 - 1 FROM ops_log) * 1000 // 300000000 * 300000000, 300000000)"), "ops_log"))
def stream_alarms(spark, sf_dir):
    """A17 as a stream: periods are closed by event-time timers, also where nothing arrived, up to
    the watermark; equals ``alarm_states`` on the periods that are over."""
    root = Q.run_dir(spark, "alarms")
    t = fx.ops_log(spark, sf_dir).select("service", "status", "us")
    Q.stage_files(t, f"{root}/in", part_col="us")
    src = Q.read_stream(spark, f"{root}/in", t.schema)
    rules = spark.createDataFrame(ALARM_RULES, "alarm string, service string, period_s int, threshold double, n_periods int")
    with Q.keyed_state(spark, partitions=4):
        Q.run_available(AL.stream_alarms(src, rules, disorder="1 millisecond"), f"{root}/ckpt",
                        sink=lambda b, e: Q.write_batch(b, f"{root}/out", e))
    return spark.read.schema(f"{AL.OUT_SCHEMA}, epoch int").parquet(f"{root}/out").drop("epoch")


def _claim_updates(spark, sf_dir):
    """Updates of the streaming ledger over the delivery stream, with their batch number."""
    root = Q.run_dir(spark, "claims")
    d = fx.deliveries(spark, sf_dir).drop("event_no")
    rows = d.count()
    split = Q.file_split(rows)
    Q.stage_files(d, f"{root}/in", part_col="received_us", split=split)
    src = Q.read_stream(spark, f"{root}/in", d.schema, files_per_trigger=split)
    out = f"{root}/out"

    def sink(batch: DataFrame, epoch: int) -> None:
        Q.write_batch(batch, out, epoch)

    # pages by the size of the input: a page keeps its size
    pages = max(8 * Q.state_partitions(spark), -(-rows // LS.PAGE_EVENTS))
    with Q.keyed_state(spark, partitions=Q.state_partitions(spark)):
        Q.run_available(LS.stream_claims(src, disorder="1 millisecond", pages=pages), f"{root}/ckpt", sink=sink)
    return spark.read.schema(LS.OUT_SCHEMA + ", epoch int").parquet(out)


@register("stream_claims", with_views(
    "SELECT event_id, status, first_seen_us, last_seen_us, attempts, error_reason FROM ledger",
    "ledger"))
def stream_claims(spark, sf_dir):
    """T2 streaming: the claim ledger as keyed state over the delivery stream in arrival order;
    the final state per event equals the batch fold."""
    return LS.latest_claims(_claim_updates(spark, sf_dir)).drop("expired")


@register("stream_stuck", with_views("""
SELECT event_id, last_seen_us, attempts FROM ledger WHERE status = 'processing'
  AND (last_seen_us + 60000000 + 999) // 1000 <= (SELECT max(received_us) // 1000 - 1 FROM deliveries)""",
                                     "ledger", "deliveries"))
def stream_stuck(spark, sf_dir):
    """T3 streaming: leases that ran out, emitted by timers without a further delivery, and not
    claimed again since; equals ``stuck_events`` but for the last millisecond (timers and
    watermark run on whole ones)."""
    return LS.latest_claims(_claim_updates(spark, sf_dir)).filter("expired").select(
        "event_id", "last_seen_us", "attempts")


@register("stream_envelopes", with_views("""
SELECT event_id, correlation_id, payload_mode, payload_inline, payload_sha256, s3_key,
  CAST(received_us AS VARCHAR) AS received_at FROM envelopes""", "envelopes"))
def stream_envelopes(spark, sf_dir):
    """S3: envelope messages as JSON lines from a stream; undecodable lines are
    discarded (ACKed), the rest parsed into envelope columns."""
    root = Q.run_dir(spark, "envelopes")
    env = wire.envelopes(spark, sf_dir)
    lines = env.select(F.to_json(F.struct(
        "event_id", "correlation_id", "payload_mode", "payload_inline", "payload_sha256",
        "s3_key", F.col("received_us").cast("string").alias("received_at"))).alias("value"),
        "received_us")
    bad = env.filter(F.col("payload_mode") == "BOGUS").select(
        F.lit("{broken").alias("value"), "received_us")
    Q.stage_files(lines.unionByName(bad), f"{root}/in", fmt="parquet", part_col="received_us")
    src = Q.read_stream(spark, f"{root}/in", lines.schema)
    parsed = src.select(F.from_json("value", I.ENVELOPE_SCHEMA).alias("m"),
                        F.try_parse_json("value").alias("_v")) \
        .filter(F.col("_v").isNotNull()).select("m.*")
    out = f"{root}/out"
    Q.run_available(parsed, f"{root}/ckpt", out=out)
    return spark.read.parquet(out)


@register("process_stream", with_views("SELECT * FROM outcomes", "outcomes"))
def process_stream(spark, sf_dir):
    """The processor as a stream: each micro-batch of envelopes goes through the stages
    and is logged under its batch number; the claim ledger over the logged deliveries of its
    events decides which delivery counts; the events stored by it (insert-if-absent) are
    evaluated against the stored history (the velocity window spans earlier batches). What a
    batch reads of log, events and flags is bounded by its own keys (key index) and days. A
    replayed batch writes the same rows again. On arrival-ordered input it equals the batch
    twin ``process_batch``."""
    root = Q.run_dir(spark, "process")
    env = wire.envelopes(spark, sf_dir)
    split = Q.file_split(env.count())
    Q.stage_files(env, f"{root}/in", part_col="received_us", split=split)
    src = Q.read_stream(spark, f"{root}/in", env.schema, files_per_trigger=split)
    objects = wire.objects(spark, sf_dir)
    t = fx.txn(spark, sf_dir)
    now = fx.now_us(t)
    scores = fx.scores(spark, sf_dir).select("event_id", "ml_score")
    events_path, flags_path = f"{root}/events", f"{root}/flags"
    stored_schema = ("event_id string, user_id string, amount decimal(18,2), currency string, "
                     "merchant string, us long, created_us long")
    # buckets by the size of the input: a bucket keeps its size and its Bloom words their use
    buckets = max(8, part_count(spark, t.count()))
    log = KS.KeyIndex(spark, f"{root}/log", buckets=buckets,
                      columns="received_us long, delivery_no int, outcome string, reason string")
    event_keys, flag_keys = (KS.KeyIndex(spark, f"{root}/{k}_keys", buckets=buckets) for k in ("event", "flag"))
    log_cols = ["event_id", "received_us", "delivery_no", "outcome", "reason"]
    decoded = ["p_user_id", "p_amount", "p_currency", "p_merchant", "p_us"]

    def claimed(rows: DataFrame) -> DataFrame:
        """The settled delivery of each event in a delivery log."""
        led = L.claim_ledger(rows)
        on = led.select("event_id", "status", F.col("last_seen_us").alias("received_us"))
        return S.first_writer(rows.join(on, ["event_id", "received_us"]), "event_id", ["delivery_no"])

    def asked(batch: DataFrame) -> DataFrame:
        """The objects in the range of the batch's keys: other dates are not read."""
        ends = batch.agg(F.min("s3_key").alias("lo"), F.max("s3_key").alias("hi")).first()
        return objects.filter(F.lit(False) if ends.lo is None else F.col("key").between(ends.lo, ends.hi))

    def sink(batch: DataFrame, epoch: int) -> None:
        # a micro-batch of one file or a few: its stages (decode, hash, validate) run on every core
        cores = Q.state_partitions(spark)
        # the rows that are kept leave the payloads behind
        p = PL.process_envelopes(batch if split >= cores else batch.repartition(cores), asked(batch), now).select(
            "event_id", "received_us", "delivery_no", *decoded, "reason", "error_class").persist()
        try:
            outcome = F.when(F.col("reason").isNull(), F.lit("ok")) \
                .when(F.col("error_class") == "retryable", F.lit("retryable")).otherwise(F.col("reason"))
            own = p.withColumn("outcome", outcome).select(*log_cols)
            # claims of the batch's events, with what earlier batches delivered of them
            known = log.rows(own, "event_id", epoch).select(*log_cols).unionByName(own)
            good = claimed(known).filter("status = 'success'").select("event_id", "received_us", "delivery_no")
            good = p.join(good, ["event_id", "received_us", "delivery_no"]).select(
                "event_id", F.col("p_user_id").alias("user_id"),
                F.col("p_amount").try_cast("decimal(18,2)").alias("amount"),
                F.col("p_currency").alias("currency"), F.col("p_merchant").alias("merchant"),
                F.col("p_us").alias("us"), F.col("received_us").alias("created_us"))
            new = KS.append_indexed(good, events_path, "event_id", ["created_us"], epoch, event_keys,
                                    day=_day(F.col("created_us")))
            ends = new.agg(F.min("created_us").alias("lo"), F.max("created_us").alias("hi")).first()
            if ends.lo is not None:
                # the days the velocity window of the new events can reach
                history = KS.days(spark, events_path, (ends.lo - C.velocity_window_seconds * 1_000_000) // _DAY_US,
                                  ends.hi // _DAY_US, stored_schema).filter(F.col("epoch") <= epoch)
                scored = R.with_velocity(new, C, history=history)
                scored = R.attach_scores(scored, scores, C.model_version)
                flags = R.evaluate_rules(scored, C, with_score=True)
                KS.append_indexed(flags, flags_path, "flag_id", ["flagged_us"], epoch, flag_keys)
            log.add(own, "event_id", epoch)
        finally:
            p.unpersist()

    Q.run_available(src, f"{root}/ckpt", sink=sink)
    n_flags = spark.read.parquet(flags_path).groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n_flags"))
    settled = claimed(log.everything().withColumnRenamed("key", "event_id"))
    return settled.join(n_flags, "event_id", "left").select(
        "event_id", "status", "reason", F.coalesce("n_flags", F.lit(0)).cast("bigint").alias("n_flags"))


_FEATURES = ("event_id, user_id, us, amount, velocity_60s, velocity_3600s, "
             "velocity_86400s, secs_since_prev, user_amt_sum_3600s, user_amt_max_3600s, currency, product_code, "
             "card_network, merchant, email_domain")


@register("stream_features", with_views(f"SELECT {_FEATURES}, label FROM arrival_features", "arrival_features"))
def stream_features(spark, sf_dir):
    """T4: online features from keyed state (blocks of hours of a page of users on RocksDB, pruned), in
    arrival order; equals the batch form ``arrival_features``, however the stream is cut into
    batches."""
    root = Q.run_dir(spark, "features")
    t = fx.late_txn(spark, sf_dir)
    rows = t.count()
    split = Q.file_split(rows)
    Q.stage_files(t, f"{root}/in", part_col="created_us", split=split)
    src = Q.read_stream(spark, f"{root}/in", t.schema, files_per_trigger=split)
    out = f"{root}/features"

    def sink(batch: DataFrame, epoch: int) -> None:
        Q.write_batch(feature_vector(batch, precomputed=True), out, epoch)

    # pages by the size of the input: a page keeps its size
    pages = max(8 * Q.state_partitions(spark), -(-rows // PAGE_EVENTS))
    with Q.keyed_state(spark, partitions=Q.state_partitions(spark)):
        Q.run_available(online_features(src, pages=pages), f"{root}/ckpt", sink=sink)
    return spark.read.parquet(out).drop("epoch")


@register("stream_flag_feed", with_views("""
SELECT * FROM flag_events WHERE flagged_us > (SELECT max(created_us) - 86400000000 FROM txn)""",
                                         "flag_events", "txn"))
def stream_flag_feed(spark, sf_dir):
    """T5: the flags table read as a stream (new files = new flags), filtered past the
    feed cursor; the stream checkpoint is the cursor."""
    root = Q.run_dir(spark, "feed")
    fe = V.flag_events(spark, sf_dir)
    Q.stage_files(fe, f"{root}/flags", part_col="flagged_us")
    src = Q.read_stream(spark, f"{root}/flags", fe.schema)
    cursor = fx.now_us(fx.txn(spark, sf_dir)) - F.lit(86_400_000_000)
    cur = spark.range(1).select(cursor.alias("c")).first()["c"]   # one number
    newer = src.filter(F.col("flagged_us") > F.lit(cur))
    out = f"{root}/out"
    Q.run_available(newer, f"{root}/ckpt", out=out)
    return spark.read.parquet(out)


@register("alert_stream", with_views("SELECT flag_id, event_id, rule_name, rule_value, flagged_us, ml_score FROM flags", "flags"))
def alert_stream(spark, sf_dir):
    """Each flag micro-batch is computed once (persisted) and fanned out to the
    flags table (insert-if-absent) and the alert topic (JSON messages)."""
    root = Q.run_dir(spark, "alerts")
    f = V.flags(spark, sf_dir)
    Q.stage_files(f, f"{root}/in", part_col="flagged_us")
    src = Q.read_stream(spark, f"{root}/in", f.schema)
    flags_path, alerts_path = f"{root}/flags", f"{root}/alerts"

    def sink(batch: DataFrame, epoch: int) -> None:
        S.fan_out(batch, [
            lambda b: S.append_if_absent(spark, b, flags_path, "flag_id", ["flagged_us"]),
            lambda b: Q.write_batch(S.alert_json(b), alerts_path, epoch, "json"),
        ])

    Q.run_available(src, f"{root}/ckpt", sink=sink)
    sent = spark.read.schema("flag_id string, value string").json(alerts_path)
    message = F.from_json("value", "flag_id string, event_id string, rule_name string, rule_value string, "
                                   "flagged_us long, ml_score double")
    return sent.select(message.alias("m")).select("m.*")


@register("stream_dedup_live", with_views("""
SELECT event_id, received_us, outcome FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY received_us, delivery_no) AS k
  FROM deliveries) WHERE k = 1""", "deliveries"))
def stream_dedup_live(spark, sf_dir):
    """T1 streaming: duplicate deliveries dropped within a one-hour watermark horizon."""
    root = Q.run_dir(spark, "dedup")
    d = fx.deliveries(spark, sf_dir).withColumn("ts", from_micros("received_us").cast("timestamp"))
    Q.stage_files(d, f"{root}/in", part_col="received_us")
    src = Q.read_stream(spark, f"{root}/in", d.schema)
    out = f"{root}/out"
    Q.run_available(Q.dedup_stream(src, "ts", "1 hour"), f"{root}/ckpt", out=out)
    return spark.read.parquet(out).select("event_id", "received_us", "outcome")


@register("parity_diff", with_views(f"""
SELECT {_FEATURES}, 'offline' AS side FROM (SELECT {_FEATURES} FROM late_features EXCEPT ALL SELECT {_FEATURES} FROM arrival_features) a
UNION ALL
SELECT {_FEATURES}, 'online' FROM (SELECT {_FEATURES} FROM arrival_features EXCEPT ALL SELECT {_FEATURES} FROM late_features) b""",
                                    "late_features", "arrival_features"))
def parity_diff(spark, sf_dir):
    """train/serve parity witness: features exported offline (complete: every event
    with ts <= t) against the online ones (only events that had arrived). ``exceptAll`` both
    ways; every row is a skewed feature vector (late arrivals, Q17), labelled with the side
    it came from."""
    t = fx.late_txn(spark, sf_dir)
    online = feature_vector(arrival_features(t), precomputed=True).drop("label")
    offline = feature_vector(t).drop("label").select(*online.columns)
    # both sides counted in one pass; what one side has more often comes out that many times
    both = offline.withColumn("_d", F.lit(1)).unionByName(online.withColumn("_d", F.lit(-1)))
    over = both.repartition(part_count(spark, 2 * t.count()), "event_id", "user_id", "us").groupBy(*offline.columns).agg(
        F.sum("_d").alias("_d")).filter("_d <> 0")
    return over.withColumn("side", F.when(F.col("_d") > 0, "offline").otherwise("online")).select(
        *offline.columns, "side", F.explode(F.array_repeat(F.lit(0), F.abs("_d").cast("int"))).alias("_")).drop("_")
