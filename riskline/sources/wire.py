"""Wire-level fixtures derived from the transaction view: JSON payloads, queue envelopes,
object-store payloads and IEEE-style CSV rows. DuckDB twins: ``oracle_views``.

Payload text is assembled field by field so both engines produce identical bytes (the
SHA-256 integrity check depends on it). A few rows are padded to 250 000 / 300 000 bytes
to exercise the object-store route, and one corruption per residue of ``event_no % 89``
produces each quarantine reason:
1 unknown mode, 2 missing inline payload, 3 missing object key, 4 wrong hash,
5 undecodable JSON, 6 object missing from the store, 7 amount 0 (fails validation),
8 amount as a string, 9 timestamp that is none, 10 body that is no object, 11 nanoseconds,
12 an offset of two hours, 13 amount beyond the store's range, 14 event id as a number,
15 a field name in other case, 16 a repeated field (the last counts), 17 amount beyond a double,
18 text behind the body.

Envelopes are delivered at least once: plain copies 30 s later, and for some of the failing
ones a sound delivery later (a missing object that arrived, a repaired body).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline.functions.exprs import from_micros
from riskline.operators.ingest import build_envelopes
from riskline.sources import fixtures as fx
from riskline.sources.tables import table_path

IEEE_EPOCH_US = 1_704_067_200_000_000     # 2024-01-01T00:00:00Z
WIRE_VERSION = "v4"                       # bump when the fixture definition changes


def _q(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def wire_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON event payload per transaction (``payload`` column)."""
    t = fx.txn_m(spark, sf_dir)
    n = F.col("event_no")
    r = n % 89
    amount = F.when(r == 7, F.lit("0.00")).when(r == 8, F.lit('"5"')) \
        .when(r == 13, F.lit("100000000000000000")).when(r == 17, F.lit("1e400")).otherwise(F.col("amount").cast("string"))
    second = "yyyy-MM-dd'T'HH:mm:ss"
    ts = F.when(r == 9, F.lit("yesterday")) \
        .when(r == 11, F.concat(F.date_format(from_micros("us"), second), F.lit(".123456789Z"))) \
        .when(r == 12, F.concat(F.date_format(from_micros(F.col("us") + 7_200_000_000), second),
                                F.lit("+02:00"))) \
        .otherwise(F.concat(F.date_format(from_micros("us"), second), F.lit("Z")))
    pad = (F.when(n % 997 == 0, F.concat(F.lit(',"pad":"'), F.repeat(F.lit("x"), 300000),
                                         F.lit('"')))
            .when(n % 997 == 1, F.concat(F.lit(',"pad":"'), F.repeat(F.lit("x"), 250000),
                                         F.lit('"')))
            .otherwise(F.lit("")))
    payload = F.concat(
        F.lit('{"event_id":'), F.when(r == 14, n.cast("string")).otherwise(_q(F.col("event_id"))),
        F.when(r == 15, F.lit(',"User_ID":')).when(r == 16, F.lit(',"USER_ID":"zzz","user_id":'))
         .otherwise(F.lit(',"user_id":')), _q(F.col("user_id")),
        F.lit(',"amount":'), amount,
        F.lit(',"currency":'), _q(F.col("currency")),
        F.lit(',"merchant":'), _q(F.col("merchant")),
        F.lit(',"timestamp":'), _q(ts),
        F.lit(',"metadata":{"product_code":'), _q(F.col("product_code")),
        F.lit(',"card_network":'), _q(F.col("card_network")),
        F.lit(',"email_domain":'), _q(F.col("email_domain")), F.lit("}"),
        pad, F.lit("}"), F.when(r == 18, F.lit(" x")).otherwise(F.lit("")))
    return t.select("event_id", "event_no", "correlation_id", "created_us",
                    F.when(r == 10, F.lit("[]")).otherwise(payload).alias("payload"))


def _stored(spark: SparkSession, sf_dir: str, name: str, build,
            marker: str = "_SUCCESS") -> str:
    """Materialise a derived wire table once per input folder in the shared checkpoint
    folder (envelopes sit in a queue / table and payloads in an object store in
    production; re-synthesising them in every query would dominate its cost)."""
    from riskline.operators.sinks import _exists
    from riskline.session import checkpoint_path

    path = checkpoint_path(spark, f"wire-{WIRE_VERSION}/{content_tag(spark, sf_dir)}/{name}")
    if not _exists(spark, f"{path}/{marker}"):
        build(path)
    return path


def content_tag(spark: SparkSession, sf_dir: str) -> str:
    """Names, lengths and times of the input's files: a changed input gets new tables."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    parts = []
    for f in sorted(spark.read.parquet(table_path(sf_dir, "events")).inputFiles()):
        p = jvm.org.apache.hadoop.fs.Path(f)
        status = p.getFileSystem(conf).getFileStatus(p)
        parts.append(f"{f}:{status.getLen()}:{status.getModificationTime()}")
    return hashlib.sha1("\n".join(parts).encode()).hexdigest()[:16]


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue envelopes as ingest builds them, with one corruption per residue."""
    n = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    path = _stored(spark, sf_dir, "envelopes", lambda p: _envelopes(spark, sf_dir)
                   .repartition(n, "event_id").write.mode("overwrite").parquet(p))
    return spark.read.parquet(path)


def _envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = build_envelopes(wire_events(spark, sf_dir), received_col="created_us")
    n = F.col("event_no")
    r = n % 89
    bad_json = F.lit("{not json")
    keys = ["event_id", "event_no", "correlation_id"]
    content = ["payload_mode", "payload_inline", "payload_sha256", "s3_key"]
    first = env.select(
        *keys,
        F.when(r == 1, F.lit("BOGUS")).when(r.isin(3, 6), F.lit("S3"))
         .otherwise(F.col("payload_mode")).alias("payload_mode"),
        F.when(r.isin(2, 3, 6), F.lit(None).cast("string")).when(r == 5, bad_json)
         .otherwise(F.col("payload_inline")).alias("payload_inline"),
        F.when(r == 4, F.lit("bad-hash")).when(r == 5, F.sha2(bad_json, 256))
         .otherwise(F.col("payload_sha256")).alias("payload_sha256"),
        F.when(r == 3, F.lit(None).cast("string"))
         .when(r == 6, F.concat(F.lit("raw/missing/"), F.col("event_id"), F.lit(".json")))
         .otherwise(F.col("s3_key")).alias("s3_key"),
        "received_us", F.lit(1).alias("delivery_no"))
    copies = first.filter(n % 31 == 4).withColumn("delivery_no", F.lit(2)).withColumn(
        "received_us", F.col("received_us") + 30_000_000)
    sound = env.filter((r == 6) & (n % 3 == 0) | (r == 5) & (n % 2 == 0)).select(
        *keys, *content, (F.col("received_us") + F.when(r == 6, 90).otherwise(10) * 1_000_000)
        .alias("received_us"), F.lit(3).alias("delivery_no"))
    return first.unionByName(copies).unionByName(sound)


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The object store's content: every oversized payload under its key, written by the
    S5 writer (``raw/<date>/``) and read back by the S4 reader."""
    from riskline.operators.sinks import read_payload_objects, write_payload_objects

    def build(root: str) -> None:
        env = build_envelopes(wire_events(spark, sf_dir), received_col="created_us")
        write_payload_objects(env, root)

    root = _stored(spark, sf_dir, "objects", build, marker="raw/_SUCCESS")
    return read_payload_objects(spark, root)


def csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IEEE-CIS style CSV fields as strings, with unparsable / empty values mixed in."""
    t = fx.txn_m(spark, sf_dir)
    n = F.col("event_no")
    secs = F.floor((F.col("us") - F.lit(IEEE_EPOCH_US)) / 1_000_000).cast("bigint")
    dt = (F.when(n % 37 == 0, F.lit("bad"))
           .otherwise(F.concat(secs.cast("string"),
                               F.when(n % 3 == 0, F.lit(".75")).otherwise(F.lit("")))))
    amt = (F.when(n % 41 == 0, F.lit("n/a")).when(n % 43 == 0, F.lit("-5.00"))
            .otherwise(F.col("amount").cast("string")))
    card1 = F.when(n % 47 == 0, F.lit("")).otherwise(F.substring(F.col("user_id"), 2, 20))
    fraud = F.when(n % 53 == 0, F.lit("")).otherwise(F.col("label"))
    return t.select("event_no", dt.alias("TransactionDT"), amt.alias("TransactionAmt"),
                    card1.alias("card1"), F.col("product_code").alias("ProductCD"),
                    F.col("card_network").alias("card4"),
                    F.col("email_domain").alias("P_emaildomain"), fraud.alias("isFraud"))
