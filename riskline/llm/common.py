"""Helpers the operators share: inputs, written intermediate tables, native word arrays."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline.session import checkpoint_path

# Fixed by the operators' contracts.
SPACES = r"[\x20\x09-\x0D]+"
SHINGLE_WORDS = 5
SIMILARITY = 0.75

# Rows and bytes of a side that is broadcast; beyond either the join is left to Spark's joins.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20

PACK_ROWS = 1 << 16     # rows of a partition of ``packed``

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts the lineage with
    a table that survives lost executors, and gives later readers column pruning. Once the
    table is written, the shuffle files that led to it are removed."""
    spark = df.sparkSession
    path = checkpoint_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Bound the rows of one Arrow batch, so that a batch of long texts stays small."""
    now = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < now <= rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of other characters than blank, tab, line ends."""
    return F.array_remove(F.split(text, SPACES), "")


def plain_words(text: Column) -> Column:
    """Lower-cased runs of ASCII letters, digits and all non-ASCII characters.

    The two characters whose lower case contains an ASCII letter are replaced by another
    non-ASCII letter first, so only A-Z become a-z.
    """
    low = F.lower(F.regexp_replace(text, "[İK]", "ß"))
    return F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def kgrams(name: str, k: int) -> Column:
    """All runs of ``k`` consecutive elements of array column ``name``, joined by a blank;
    an empty array where it has fewer. Place i holds the run that starts at word i."""
    w = F.col(name)
    return F.when(F.size(w) >= k, F.transform(
        F.sequence(F.lit(1), F.size(w) - (k - 1)),
        lambda i: F.array_join(F.slice(w, i, k), " "))).otherwise(
        F.array().cast("array<string>"))


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (a written table) marked for broadcast if it has at most ``rows`` rows that hold at
    most ``size`` bytes of text, binary and fixed-width values; else unchanged, so that a shuffle
    join is planned."""
    wide = [f.name for f in df.schema.fields if f.dataType.simpleString() in ("string", "binary")]
    text = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in wide), F.lit(16 * len(df.columns)))
    n, b = df.limit(rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(text.cast("long")), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and b <= size else df


def packed(df: DataFrame, rows: int = PACK_ROWS) -> DataFrame:
    """``df`` (a written table) in partitions of about ``rows`` rows. One of up to ``rows`` rows is one
    partition, which is joined with others of its kind and grouped without an exchange, so that
    steps over little data do not cost as many tasks and files as the session has partitions."""
    return df.coalesce(max(1, -(-df.count() // rows)))


def rekey(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with the long columns ``keys`` replaced by their complements.

    An aggregate that is joined on its own key is read in the aggregate's partitions, and
    Spark cannot split a hot one. A join on the complement gets an exchange of its own on
    both sides, which adaptive execution splits.
    """
    return df.withColumns({k: F.bitwise_not(F.col(k)) for k in keys})


def join_split(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on long columns through exchanges that can be split; see ``rekey``."""
    return rekey(rekey(left, *keys).join(rekey(right, *keys), keys, how), *keys)
