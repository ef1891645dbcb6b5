"""Global orders: many ranges, ties, percentiles."""

import numpy as np
from pyspark.sql import functions as F

from riskline.operators.ordinal import (exact_percentiles, global_ordinal, global_prefix_sums,
                                        grouped_exact_percentiles)


def test_a_thousand_ranges(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"))
    got = global_ordinal(df, ["k"], n_ranges=1000).collect()
    assert len(got) == 5000 and all(r.k == r.ordinal for r in got)


def test_ties_of_the_first_column_are_split(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 100 == 0, F.col("id")).otherwise(0).alias("v"),
                                    F.col("id").alias("tie"))
    got = global_ordinal(df, ["v", "tie"], n_ranges=16)
    rows = sorted(got.collect(), key=lambda r: r.ordinal)
    assert [(r.v, r.tie) for r in rows] == sorted((r.v, r.tie) for r in rows)
    assert [r.ordinal for r in rows] == list(range(20_000))
    parts = df.repartitionByRange(16, "v", "tie").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in parts.collect()) < 20_000 / 16 * 2


def test_prefix_sums(spark):
    df = spark.range(1000).select((F.lit(1000) - F.col("id")).alias("k"), F.lit(2).alias("x"))
    got = global_prefix_sums(df, ["k"], {"s": F.col("x")}, n_ranges=7).collect()
    assert all(r.s == 2 * r.k for r in got)


def test_percentiles(spark):
    rng = np.random.default_rng(5)
    v = np.concatenate([np.zeros(990), rng.normal(size=313)])
    df = spark.createDataFrame([(float(x), i % 3) for i, x in enumerate(v)] + [(None, 1)], "v double, g int")
    probs = {"a": 0.0, "b": 0.5, "c": 0.9, "d": 0.95, "e": 1.0}
    got = exact_percentiles(df, "v", probs, n_ranges=5).first()
    assert all(abs(got[k] - np.quantile(v, p)) < 1e-9 for k, p in probs.items())
    for r in grouped_exact_percentiles(df, ["g"], "v", probs, n_ranges=5).collect():
        own = v[np.arange(len(v)) % 3 == r.g]
        assert all(abs(r[k] - np.quantile(own, p)) < 1e-9 for k, p in probs.items())


def test_passes_over_a_large_table_have_few_partitions(spark, monkeypatch):
    from riskline.operators import ordinal

    monkeypatch.setattr(ordinal, "PART_ROWS", 10)
    cores = spark.sparkContext.defaultParallelism
    assert ordinal.pass_count(spark, 1) == cores
    assert ordinal.pass_count(spark, 60 * cores) == 6 * cores           # as many as the rows need
    assert ordinal.pass_count(spark, 480 * cores) == 6 * cores          # not 48 per core
    assert ordinal.pass_count(spark, 6400 * cores) == 80 * cores        # a share stays bounded
