"""Connected components of an edge table by alternating large-star and small-star steps.

Every step links the neighbours of a node to the smallest of them: a minimum per node,
combined before the shuffle, and a join that adaptive execution can split, so a hub with very
many neighbours makes no long task. Edges stay a table; only their number and checksum reach
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.llm.common import join_split, packed, stored


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select(F.col("u").alias("u"), "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return join_split(both.filter("v > u"), low, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    j = join_split(e, low, ["u"])
    return j.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v") \
        .union(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str, pack: bool = False) -> DataFrame:
    """(node, component) of every node with an edge to another; component is the smallest
    node of its connected component. Self-loops and null ends are ignored. ``pack``: partitions follow the number of edges."""
    written = lambda t: packed(stored(t, "edges")) if pack else stored(t, "edges")
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"),
                     F.col(a).isNull().alias("x"), F.col(b).isNull().alias("y"))
    e = written(e.filter("not x and not y and u <> v").select("u", "v").distinct())
    state = _state(e)
    while state[0]:
        e = written(_small_star(_large_star(e)))
        before, state = state, _state(e)
        if state == before:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
