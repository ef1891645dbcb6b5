"""Transaction views derived from the shared test tables.

Each view is a pure projection (or union of projections) of ``events`` — no shuffle, so
Catalyst fuses it into the first stage of every query that reads it, and filters on the
derived columns still reach the Parquet scan where they map back to base columns.
The DuckDB text of the same views lives in :mod:`riskline.plans.oracle_views`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline.config import MERCHANT_TABLE
from riskline.functions.exprs import micros
from riskline.sources.tables import read_table

LATE_ARRIVAL_US = 7_200_000_000          # every 50th event arrives 2 h late
FAR_FUTURE_US = 86_400_000_000_000       # 1000 days, for the drift check fixture


def _case(col: Column, mapping: list[tuple[int, str]], default: str) -> Column:
    out = None
    for k, v in mapping:
        out = F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v))
    return out.otherwise(F.lit(default))


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One card transaction per event row (two clocks: ``us`` event, ``created_us`` arrival)."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    eid, uid = F.col("event_id"), F.col("user_id")
    us = micros("ts")
    return ev.select(
        F.concat(F.lit("evt-"), eid.cast("string")).alias("event_id"),
        eid.alias("event_no"),
        F.concat(F.lit("corr-"), eid.cast("string")).alias("correlation_id"),
        F.concat(F.lit("u"), uid.cast("string")).alias("user_id"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        _case(eid % 20, [(0, "XMR"), (1, "ZEC")], "USD").alias("currency"),
        _case(eid % 5, [(0, "W"), (1, "C"), (2, "R"), (3, "H")], "S").alias("product_code"),
        _case(uid % 4, [(0, "visa"), (1, "mastercard"), (2, "discover")],
              "american express").alias("card_network"),
        _case(uid % 3, [(0, "gmail.com"), (1, "yahoo.com")], "").alias("email_domain"),
        F.when((F.col("event_type") == "error") & (eid % 5 == 0), F.lit("1"))
         .otherwise(F.lit("0")).alias("label"),
        us.alias("us"),
        (us + (eid % 7) * 1000
         + F.when(eid % 50 == 0, F.lit(LATE_ARRIVAL_US)).otherwise(F.lit(0))).alias("created_us"),
    )


def merchant_expr(product_code: Column, card_network: Column) -> Column:
    """(product, network) lookup with the ``merchant_<P>_<N>`` default (original case)."""
    key = F.concat(F.lower(product_code), F.lit("+"), F.lower(card_network))
    out = None
    for k, v in MERCHANT_TABLE:
        out = F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v))
    return out.otherwise(F.concat(F.lit("merchant_"), product_code, F.lit("_"), card_network))


def txn_m(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = txn(spark, sf_dir)
    return t.withColumn("merchant", merchant_expr(F.col("product_code"), F.col("card_network")))


def late_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """txn_m with a hot user (a third of all events) and events that arrive days after their
    time, for the features an online service sees."""
    n = F.col("event_no")
    late = F.when(n % 50 == 10, F.lit(3 * 86_400_000_000)).when(n % 70 == 20, F.lit(26 * 3_600_000_000)).otherwise(F.lit(0))
    return txn_m(spark, sf_dir).withColumn("user_id", F.when(n % 3 == 0, F.lit("hot")).otherwise(F.col("user_id"))) \
        .withColumn("created_us", F.col("created_us") + late)


def raw_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """txn_m with one invalid field per residue 1..7 of ``event_no % 97`` and an
    over-long currency at residue 8."""
    t = txn_m(spark, sf_dir)
    r = F.col("event_no") % 97
    return t.select(
        "event_id", "event_no", "correlation_id",
        F.when(r == 1, F.lit("")).otherwise(F.col("user_id")).alias("user_id"),
        F.when(r == 2, F.lit(0).cast("decimal(18,2)")).otherwise(F.col("amount")).alias("amount"),
        F.when(r == 3, F.lit("")).when(r == 8, F.lit("DASH")).otherwise(F.col("currency"))
         .alias("currency"),
        F.when(r == 4, F.lit("")).otherwise(F.col("merchant")).alias("merchant"),
        F.when(r == 5, F.lit(None).cast("bigint"))
         .when(r == 6, F.col("us") + FAR_FUTURE_US).otherwise(F.col("us")).alias("us"),
        F.when(r == 7, F.lit(11)).otherwise(F.lit(4)).alias("metadata_keys"),
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At-least-once delivery log for the claim ledger: up to four deliveries per event,
    some without an outcome."""
    t = txn(spark, sf_dir).select("event_id", "event_no", "created_us")
    n = F.col("event_no")

    def later(rows, no: int, delay_s: Column, outcome: Column) -> DataFrame:
        return t.filter(rows).select(
            "event_id", "event_no", (F.col("created_us") + delay_s * 1_000_000).alias("received_us"),
            F.lit(no).alias("delivery_no"), outcome.alias("outcome"))

    first = later(F.lit(True), 1, F.lit(0), F.when(n % 10 == 0, "retryable")
                  .when(n % 25 == 3, "hash_mismatch").when(n % 70 == 11, F.lit(None)).otherwise("ok"))
    again = later(n % 10 == 0, 2, F.when(n % 20 == 0, 5).otherwise(90),
                  F.when(n % 100 == 10, "retryable").otherwise("ok"))
    duplicate = later(n % 30 == 7, 2, F.lit(30), F.lit("ok"))
    unknown = later(n % 140 == 11, 2, F.lit(10), F.lit("ok"))
    third = later(n % 100 == 10, 3, F.when(n % 400 == 10, 100).otherwise(200),
                  F.when(n % 200 == 10, "retryable").otherwise("ok"))
    fourth = later(n % 200 == 10, 4, F.lit(300), F.when(n % 600 == 10, F.lit(None)).otherwise("ok"))
    return first.unionByName(again).unionByName(duplicate).unionByName(unknown) \
        .unionByName(third).unionByName(fourth)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic proxy for a model score (no trained model ships with the reference)."""
    t = txn(spark, sf_dir)
    raw = (F.col("event_no") * 7919) % 800 + F.when(F.col("label") == "1", F.lit(150)) \
        .otherwise(F.lit(0))
    return t.select("event_id", "label",
                    (F.least(F.lit(999), raw).cast("double") / 1000).alias("ml_score"))


def ops_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One latency sample per event for the time-series metrics."""
    t = txn(spark, sf_dir)
    n = F.col("event_no")
    return t.select(
        "event_id", "correlation_id", "us",
        _case(n % 3, [(0, "ingest"), (1, "processor")], "eval").alias("service"),
        F.when(n % 40 == 9, F.lit("failure")).otherwise(F.lit("success")).alias("status"),
        (F.col("amount").cast("double") / 100).alias("latency_s"),
    )


def now_us(df: DataFrame, col: str = "created_us") -> Column:
    """"Now" of a job = max arrival time of its input, as a lazy scalar subquery."""
    return df.agg(F.max(col)).scalar()


def txn_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """txn_m with the wire ``metadata`` as JSON text: the ground-truth label is a string,
    except a number at ``event_no % 11 = 0``, JSON null at ``% 19 = 0`` and absent at
    ``% 13 = 0``; the card network is a number at ``% 17 = 0``."""
    t = txn_m(spark, sf_dir)
    n = F.col("event_no")

    def s(c: str) -> Column:
        return F.concat(F.lit('"'), F.col(c), F.lit('"'))

    network = F.when(n % 17 == 0, F.lit("4")).otherwise(s("card_network"))
    label = (F.when(n % 13 == 0, F.lit(""))
             .when(n % 11 == 0, F.concat(F.lit(',"is_fraud_ground_truth":'), F.col("label")))
             .when(n % 19 == 0, F.lit(',"is_fraud_ground_truth":null'))
             .otherwise(F.concat(F.lit(',"is_fraud_ground_truth":'), s("label"))))
    meta = F.concat(F.lit('{"product_code":'), s("product_code"),
                    F.lit(',"card_network":'), network,
                    F.lit(',"email_domain":'), s("email_domain"), label, F.lit("}"))
    return t.withColumn("metadata_json", meta)
