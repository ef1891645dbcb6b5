"""Re-runnable sinks: S8 events insert-if-absent, S9 flags insert-if-absent, J2, S10 alert
fan-out, S12 feature export writer, S5 object-store payload writer.

Insert-if-absent = in-batch first writer (``row_number() = 1``) + ``left_anti`` against
the stored keys, then an append. Re-running a batch finds all its keys stored and appends
nothing, so a retried task or job cannot duplicate rows. Only the key column of the
stored table is read (column pruning), and with stored data partitioned by date the
anti join can be limited to the batch's dates.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def first_writer(batch: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the earliest by ``order``.

    A ``min_by`` aggregate rather than a ``row_number`` window: it is combined map-side,
    so a key with millions of copies leaves each task as one row before the shuffle
    (a window would sort every copy of the key in one task).
    """
    cols = [c for c in batch.columns if c != key]
    best = batch.groupBy(key).agg(
        F.min_by(F.struct(*cols), F.struct(*order)).alias("_w"))
    return best.select(key, *[F.col(f"_w.{c}").alias(c) for c in cols])


def new_rows(batch: DataFrame, stored_keys: DataFrame | None, key: str,
             order: list[str]) -> DataFrame:
    """Batch rows whose key is not stored yet (first writer within the batch)."""
    fresh = first_writer(batch, key, order)
    if stored_keys is None:
        return fresh
    return fresh.join(stored_keys.select(key), key, "left_anti")


def insert_if_absent(stored: DataFrame, batch: DataFrame, key: str,
                     order: list[str]) -> DataFrame:
    """The table after the insert: stored rows plus the new ones."""
    cols = stored.columns
    return stored.unionByName(new_rows(batch, stored, key, order).select(*cols))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def append_if_absent(spark: SparkSession, batch: DataFrame, path: str, key: str,
                     order: list[str], partition_by: list[str] | None = None) -> int:
    """S8 / S9 against a Parquet table at ``path``: append only unseen keys; returns the
    number of rows appended. Idempotent: a second call with the same batch appends 0."""
    stored = spark.read.parquet(path).select(key) if _exists(spark, path) else None
    rows = new_rows(batch, stored, key, order)
    # Materialise once in the shared checkpoint folder: the count and the append see
    # the same rows even if an executor is lost in between.
    rows = rows.checkpoint(eager=True)
    n = rows.count()
    if n:
        w = rows.write.mode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
    return n


def alert_json(flags: DataFrame) -> DataFrame:
    """One JSON alert message per stored flag (the AlertMessage fields)."""
    return flags.select("flag_id", F.to_json(F.struct(
        "flag_id", "event_id", "user_id", "rule_name", "rule_value",
        F.col("flagged_us"), "ml_score")).alias("value"))


def fan_out(df: DataFrame, writers: list) -> None:
    """Write one evaluated batch to N sinks, computing it once (persisted for the
    duration of the writes, released afterwards)."""
    df.persist()
    try:
        for w in writers:
            w(df)
    finally:
        df.unpersist()


def write_feature_export(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """S12 + K4: Parquet partitioned by split, or CSV in global time order (range
    partitioned on ts, sorted within partitions: part files concatenate in order)."""
    if fmt == "parquet":
        df.write.mode("overwrite").partitionBy("split").parquet(path)
    else:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        (df.repartitionByRange(n, "us", "event_id").sortWithinPartitions("us", "event_id")
           .write.mode("overwrite").option("header", True).csv(path))


FEATURE_TEXT = ("currency", "product_code", "card_network", "merchant", "email_domain")


def read_feature_csv(spark: SparkSession, path: str) -> DataFrame:
    """The feature file read by header name: numbers typed (empty or NA: null), the
    categoricals as text (empty or NA: ''), the label as int; ``place`` is the row's
    position over all part files in the order of their names."""
    from riskline.session import written

    header = spark.read.option("header", True).csv(path).columns
    raw = spark.read.option("header", True).option("enforceSchema", False) \
        .schema(", ".join(f"`{c}` string" for c in header)).csv(path)
    kept = {"event_id": "string", "us": "bigint", "label": "int"} | {
        c: "bigint" for c in header if c.startswith("velocity_")}
    known = lambda c: F.when(F.col(c).isin("", "NA", "NaN", "nan", "null"), F.lit(None)).otherwise(F.col(c))
    cols = [F.coalesce(known(c), F.lit("")).alias(c) if c in FEATURE_TEXT
            else known(c).try_cast(kept.get(c, "double")).alias(c) for c in header]
    rows = raw.select(*cols, F.regexp_extract("_metadata.file_name", "part-([0-9]+)", 1).cast("int").alias("_file"),
                      F.monotonically_increasing_id().alias("_id"))
    rows = written(rows, "feature-csv")
    from riskline.operators.ordinal import global_ordinal

    return global_ordinal(rows, ["_file", "_id"], "place").drop("_file", "_id")


def write_payload_objects(envelopes: DataFrame, root: str) -> None:
    """Oversized payloads under ``<root>/raw/<date>/`` (the object key's date part is
    the partition). Appends the keys that are not stored yet: objects of earlier calls
    stay, and a repeated call writes nothing."""
    spark = envelopes.sparkSession
    big = envelopes.filter(F.col("payload_mode") == "S3").select(
        F.regexp_extract("s3_key", r"^raw/([^/]+)/", 1).alias("date"),
        F.col("s3_key").alias("key"), F.col("payload").alias("content"))
    stored = read_payload_objects(spark, root) if _exists(spark, os.path.join(root, "raw/_SUCCESS")) \
        else None
    new_rows(big, stored, "key", ["content"]).select("date", "key", "content") \
        .write.mode("append").partitionBy("date").parquet(os.path.join(root, "raw"))


def read_payload_objects(spark: SparkSession, root: str) -> DataFrame:
    """The object table (key, content) for the claim-check join."""
    return spark.read.parquet(os.path.join(root, "raw")).select("key", "content")


def read_binary_objects(spark: SparkSession, pattern: str) -> DataFrame:
    """S4 over raw files: ``binaryFile`` source, key = path relative to the store root."""
    return spark.read.format("binaryFile").load(pattern).select(
        F.regexp_extract("path", r"(raw/.*)$", 1).alias("key"),
        F.col("content").cast("string").alias("content"))


def write_report(df: DataFrame, path: str) -> None:
    """A report (e.g. the SLO verdict) as JSON lines; rendering is not built."""
    df.coalesce(1).write.mode("overwrite").json(path)
