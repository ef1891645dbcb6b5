"""Sharding along a Hilbert curve over metadata dimensions.

1. Each dimension (language, source, text size by default) is quantised to 2**BITS steps of about
   equally many rows: the distinct values are counted, running counts down their order give each
   value its step. Values keep their order, so a step is a range of values.
2. The steps of a row are a cell of a grid; its index on the Hilbert curve is computed with numpy
   in tasks. Cells next to each other on the curve differ by one step in one dimension.
3. Rows are ordered by (index, text hash, doc_id, ...) with the range-partitioned global ordinal,
   and the order is cut into runs of equal row counts (law ``rows``: counts differ by one at
   most): shard = floor(ordinal * shards / rows). Equal texts with equal metadata are neighbours.
4. ``write`` lays the shards out as files of ``file_rows`` rows that follow the curve, and a
   manifest of the least and greatest value of every dimension per file; ``files_for`` names the
   files that can hold rows of a box. A file covers a few neighbouring cells, so a filter on any
   of the dimensions prunes.

A hot value (a source with a third of all rows) is one row of the counted table and one step of
its dimension; its rows are spread by the other dimensions and, within a cell, by the rest of the
order key. The table of distinct values is joined back through an exchange that can be split.

Defined results: null text has size 1 and crc32 0, like an empty one; nulls in a dimension are a
value of their own that comes first; rows with a null doc_id and repeated rows are rows like
others (equal rows are interchangeable); an empty table gives an empty result; with fewer rows
than shards some shards stay empty; only doc_id, text and the dimensions are read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskline.llm.common import stored, text_or_empty
from riskline.operators.ordinal import global_ordinal, global_prefix_sums

SHARDS = 16         # fixed by the operator's contract
BITS = 8            # steps per dimension: 2**BITS
FILE_ROWS = 1 << 16
DIMENSIONS = ("lang", "source", "size")


def curve_index(steps: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of grid cells, shape (rows, dimensions), each step below 2**bits.

    From the highest bit down, the sub-cube of a point is read off in Gray code, and the
    lower bits are turned into the orientation of that sub-cube (reflected where the dimension's
    bit is set, exchanged with the first dimension where it is not).
    """
    x = steps.astype(np.int64).copy()
    n = x.shape[1]
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for d in range(n):
            is_set = (x[:, d] >> b) & 1 == 1
            swap = np.where(is_set, 0, (x[:, 0] ^ x[:, d]) & low)
            x[:, 0] ^= np.where(is_set, low, swap)
            x[:, d] ^= swap
    code = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for d in range(n):
            code = (code << 1) | ((x[:, d] >> b) & 1)
    for shift in (1, 2, 4, 8, 16, 32):              # Gray code to place
        code ^= code >> shift
    return code


def curve_column(steps: list[Column], bits: int) -> Column:
    """``curve_index`` of step columns; dimensions * bits must be at most 62."""
    if len(steps) * bits > 62:
        raise ValueError("dimensions * bits must be at most 62")

    @F.pandas_udf("long")
    def index(*cols: pd.Series) -> pd.Series:
        return pd.Series(curve_index(np.stack([c.to_numpy() for c in cols], axis=1), bits))

    return index(*steps)


def quantised(df: DataFrame, name: str, bits: int = BITS) -> DataFrame:
    """(``name``, ``_step``): the step of each distinct value, by running row counts."""
    counts = df.groupBy(name).agg(F.count(F.lit(1)).alias("_c")) \
        .withColumn("_known", F.col(name).isNotNull())
    run = global_prefix_sums(counts, ["_known", name], {"_end": F.col("_c")})
    n = run.agg(F.coalesce(F.max("_end"), F.lit(1))).first()[0]
    # the step of the value's middle row; integers only (rows * 2**bits must fit 63 bits)
    step = F.expr(f"((_end - (_c + 1) div 2) * {1 << bits}) div {int(n)}").cast("int")
    return run.select(name, F.least(step, F.lit((1 << bits) - 1)).alias("_step"))


def with_curve(rows: DataFrame, dimensions: tuple[str, ...], bits: int = BITS, out: str = "curve") -> DataFrame:
    """``rows`` with the Hilbert index ``out`` of the quantised ``dimensions``."""
    got = rows
    for i, name in enumerate(dimensions):
        steps = stored(quantised(rows, name, bits), f"steps-{name}") \
            .withColumnRenamed("_step", f"_step{i}").withColumnRenamed(name, "_value")
        # written, so its size is known: broadcast below Spark's threshold, else a skew join
        got = got.join(steps, got[name].eqNullSafe(steps["_value"]), "left").drop("_value")
    index = curve_column([F.col(f"_step{i}") for i in range(len(dimensions))], bits)
    return got.withColumn(out, index).drop(*[f"_step{i}" for i in range(len(dimensions))])


def _measured(docs: DataFrame, dimensions: tuple[str, ...], keep: list[str]) -> DataFrame:
    t = text_or_empty()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(t) + 1).cast("long").alias("size"),
                       F.crc32(t.cast("binary")).alias("text_crc32"), F.xxhash64(t).alias("_hash"),
                       *[F.col(c) for c in dimensions if c != "size"], *[F.col(c).alias(f"_doc_{c}") for c in keep])


def shards(docs: DataFrame, n_shards: int = SHARDS, dimensions: tuple[str, ...] = DIMENSIONS,
           bits: int = BITS, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, curve and the dimensions per row
    of ``docs``; columns ``keep`` of ``docs`` come along as ``_doc_<name>``."""
    rows = stored(_measured(docs, dimensions, list(keep)), "shard-rows")
    n = max(rows.count(), 1)
    order = ["curve", "_hash", "doc_id", *[d for d in dimensions]]
    placed = global_ordinal(with_curve(rows, dimensions, bits), order, out="_at")
    # the first ordinal of a shard is the least one that divides to it; integers only
    first = F.expr(f"(shard * {n}L + {n_shards - 1}) div {n_shards}")
    return placed.withColumn("shard", F.expr(f"(_at * {n_shards}) div {n}L").cast("int")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("_at") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve",
        *[c for c in dimensions if c != "size"], *[f"_doc_{c}" for c in keep])


def write(docs: DataFrame, path: str, n_shards: int = SHARDS, dimensions: tuple[str, ...] = DIMENSIONS,
          bits: int = BITS, file_rows: int = FILE_ROWS) -> DataFrame:
    """Write ``docs`` to ``path`` in shards and return the manifest: shard, part, file rows and
    ``min_<d>`` / ``max_<d>`` / ``nulls_<d>`` of every dimension.

    A file holds ``file_rows`` neighbours on the curve of one shard. Rows are dealt by (shard,
    part), keys of bounded size, so no task holds a whole shard.
    """
    names = [c for c in docs.columns]
    placed = shards(docs, n_shards, dimensions, bits, keep=tuple(names))
    out = placed.withColumn("_part", F.floor(F.col("slot") / file_rows).cast("int")).select(
        F.col("shard").alias("_shard"), "_part", F.col("slot").alias("_slot"), F.col("size").alias("_size"),
        *[F.col(f"_doc_{c}").alias(c) for c in names])
    out.repartition("_shard", "_part").sortWithinPartitions("_shard", "_part", "_slot") \
        .write.partitionBy("_shard", "_part").parquet(path)
    value = {d: F.col("_size" if d == "size" else d) for d in dimensions}
    back = docs.sparkSession.read.parquet(path)
    return back.groupBy(F.col("_shard").alias("shard"), F.col("_part").alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), *[f(v).alias(f"{p}_{d}") for d, v in value.items()
                                           for p, f in (("min", F.min), ("max", F.max))],
        *[F.count_if(v.isNull()).alias(f"nulls_{d}") for d, v in value.items()])


def files_for(manifest: DataFrame, **box) -> DataFrame:
    """Rows of ``manifest`` whose files can hold rows with each named dimension equal to a value,
    or within a (least, greatest) pair."""
    tests = []
    for d, want in box.items():
        lo, hi = want if isinstance(want, tuple) else (want, want)
        tests.append((F.col(f"max_{d}") >= lo) & (F.col(f"min_{d}") <= hi))
    return manifest.filter(reduce(lambda a, b: a & b, tests, F.lit(True)))
