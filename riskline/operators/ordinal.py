"""Scalable global order operations: W7 global ordinal, W8 global prefix sums, exact
percentiles.

A window without ``partitionBy`` moves every row into one task. Instead the rows are range
partitioned on the whole order key (ties of its first column are split by the next one) and
sorted within the ranges; a generated id then holds range and place of each row. The result
is written once, so the ids stay fixed whatever is recomputed later. Each range's offset is
the running total over a table with one row per range, so broadcasting it is safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskline.session import written

_PLACE_BITS = 33        # of monotonically_increasing_id: the place within the partition
PART_ROWS = 1 << 16     # rows per partition of a large table


def part_count(spark: SparkSession, rows: int) -> int:
    """Partitions for ``rows`` rows: a task's share (and the memory of its sorts) stays the same
    however large the table is; at least one per core."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // PART_ROWS))


def pass_count(spark: SparkSession, rows: int) -> int:
    """Partitions of a table that is kept and passed over very many times, each pass with a shuffle
    of as many partitions: the tasks and blocks of a pass cost more than its rows if they are many.
    Larger shares, then, beyond six per core."""
    few = max(6 * spark.sparkContext.defaultParallelism, -(-rows // (8 * PART_ROWS)))
    return min(part_count(spark, rows), few)


def _n_ranges(df: DataFrame, n: int | None) -> int:
    return n or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _ranged(df: DataFrame, order_cols: list[str], n: int) -> DataFrame:
    """``df`` with ``_rid`` (range, ascending in the order) and ``_pos`` (place in it)."""
    ids = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
             .withColumn("_id", F.monotonically_increasing_id()))
    return written(ids, "ranged").withColumn("_rid", F.shiftright("_id", _PLACE_BITS)) \
        .withColumn("_pos", F.col("_id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))).drop("_id")


def _prior(totals: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Per range the totals of all ranges before it (at most one row per range)."""
    before = Window.orderBy("_rid").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(totals.select("_rid", *[
        F.coalesce(F.sum(c).over(before), F.lit(0)).alias(out) for out, c in sums.items()]))


def global_ordinal(df: DataFrame, order_cols: list[str], out: str = "ordinal",
                   n_ranges: int | None = None) -> DataFrame:
    """0-based position of each row in the total order ``order_cols`` (unique)."""
    r = _ranged(df, order_cols, _n_ranges(df, n_ranges))
    sizes = r.groupBy("_rid").agg(F.count(F.lit(1)).alias("_n"))
    return (r.join(_prior(sizes, {"_off": "_n"}), "_rid")
             .withColumn(out, F.col("_off") + F.col("_pos")).drop("_rid", "_pos", "_off"))


def global_prefix_sums(df: DataFrame, order_cols: list[str], sums: dict[str, Column],
                       n_ranges: int | None = None) -> DataFrame:
    """Inclusive running sums down the total order ``order_cols`` (unique), e.g. cumulative
    TP / FP counts of a PR curve."""
    r = _ranged(df.select("*", *[v.alias(f"_v_{k}") for k, v in sums.items()]), order_cols,
                _n_ranges(df, n_ranges))
    totals = r.groupBy("_rid").agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in sums])
    local = Window.partitionBy("_rid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    out = r.select("*", *[F.sum(f"_v_{k}").over(local).alias(f"_l_{k}") for k in sums])
    out = out.join(_prior(totals, {f"_o_{k}": f"_t_{k}" for k in sums}), "_rid")
    for k in sums:
        out = out.withColumn(k, F.col(f"_o_{k}") + F.col(f"_l_{k}"))
    return out.drop("_rid", "_pos", *[f"_{p}_{k}" for k in sums for p in ("v", "l", "o")])


def _percentile(n: Column, p: float, first: Column, end: Column, value: Column) -> Column:
    """Aggregate: continuous percentile from distinct values that hold ranks
    ``first <= rank < end`` of ``n``."""
    pos = (n - 1) * F.lit(p)
    at = lambda rank: F.max(F.when((first <= rank) & (rank < end), value)).cast("double")
    lo, hi = at(F.floor(pos)), at(F.ceil(pos))
    share = F.max(pos - F.floor(pos))
    return lo + (hi - lo) * share


def exact_percentiles(df: DataFrame, value: str, probs: dict[str, float],
                      n_ranges: int | None = None) -> DataFrame:
    """Exact ``percentile_cont`` of ``value`` for each named probability, as one row.

    Spark's exact ``percentile`` buffers every value of the group in one task; here values
    are counted first (map-side combined), and running counts over the distinct values give
    the ranks each of them holds.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_c"))
    cum = global_prefix_sums(counts, [value], {"_end": F.col("_c")}, n_ranges)
    n = cum.agg(F.max("_end")).scalar()
    return cum.agg(*[_percentile(n, p, F.col("_end") - F.col("_c"), F.col("_end"), F.col(value)).alias(k)
                     for k, p in probs.items()])


def grouped_exact_percentiles(df: DataFrame, groups: list[str], value: str,
                              probs: dict[str, float], n_ranges: int | None = None) -> DataFrame:
    """Exact ``percentile_cont`` per group: one running count over the distinct (group,
    value) pairs in order, so a large group is spread over many ranges."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(
        F.count(F.lit(1)).alias("_c"))
    cum = global_prefix_sums(counts, [*groups, value], {"_end": F.col("_c")}, n_ranges)
    per = cum.groupBy(*groups).agg(F.min(F.col("_end") - F.col("_c")).alias("_before"),
                                   F.sum("_c").alias("_n"))
    j = cum.join(per, groups).withColumn("_last", F.col("_end") - F.col("_before"))
    return j.groupBy(*groups).agg(*[
        _percentile(F.col("_n"), p, F.col("_last") - F.col("_c"), F.col("_last"), F.col(value)).alias(k)
        for k, p in probs.items()])
