"""Benchmark decontamination: size-partitioned MinHash containment search.

Items and documents are sets of 5-word shingles over lower-cased plain words; an item of one to
four words is a set of one shingle, its whole word sequence, and documents are cut into runs of
those lengths too, if such items exist. Items are partitioned by size (powers of two). An item's
sketch is its bottom-k MinHash, k depending on the size class: one more than the shingles an
item may miss at the containment asked for. A document that holds that share of an item
therefore holds at least one sketch shingle, however long the document is, so the candidate
search has recall 1.

Documents meet the sketches alone. The full item sets are joined only for the candidate pairs,
and only the candidates' documents are cut into shingles again: every candidate is verified by
exact shingle containment (on the shingles themselves, not on their hashes).

Defined results: items without words (null, empty) have no shingle and match nothing, as do such
documents; an item of one word matches every document that holds the word; rows that share a
doc_id (item_id) are one document (item); rows with a null id take no part; empty tables give an
empty result; only the id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskline.llm.common import (SHINGLE_WORDS, SIMILARITY, bounded, kgrams, plain_words, stored,
                                 text_or_empty)


def shingles(df: DataFrame, key: str, lengths: list[int], whole: bool = False) -> DataFrame:
    """key, h (64-bit hash), shingle: one row per place of a run of ``lengths`` words; with
    ``whole``, a text of fewer than SHINGLE_WORDS words is one run."""
    w = df.select(key, plain_words(text_or_empty()).alias("w"))
    runs = F.concat(*[kgrams("w", k) for k in lengths])
    if whole:
        short = (F.size("w") > 0) & (F.size("w") < SHINGLE_WORDS)
        runs = F.when(short, F.array(F.array_join("w", " "))).otherwise(runs)
    return w.select(key, F.explode(runs).alias("shingle")).select(key, F.xxhash64("shingle").alias("h"), "shingle")


def sketches(items: DataFrame, containment: float) -> DataFrame:
    """item_id, n_item, size_class, h, shingle, in_sketch: item sets with their bottom-k."""
    per = Window.partitionBy("item_id")
    sets = items.withColumn("n_item", F.count(F.lit(1)).over(per)).withColumn(
        "rank", F.row_number().over(per.orderBy("h", "shingle")))
    cls = F.ceil(F.log2("n_item")).cast("int")
    may_miss = F.floor(F.lit(1 - containment + 1e-9) * F.pow(F.lit(2.0), cls))
    return sets.withColumn("size_class", cls).withColumn("in_sketch", F.col("rank") <= may_miss + 1)


def candidates(docs: DataFrame, sets: DataFrame, lengths: list[int]) -> DataFrame:
    """doc_id, item_id of documents that hold a shingle of an item's sketch."""
    sketch = bounded(stored(sets.filter("in_sketch").select("item_id", "h", F.col("shingle").alias("item_shingle")),
                            "benchmark-sketches"))
    return shingles(docs, "doc_id", lengths).join(sketch, "h").filter("shingle = item_shingle") \
        .select("doc_id", "item_id").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, containment: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, n_item, n_shared, containment of all pairs at or above the limit."""
    docs = docs.filter("doc_id is not null").select("doc_id", "text")
    items = shingles(benchmark.filter("item_id is not null"), "item_id", [SHINGLE_WORDS], whole=True).distinct()
    sets = stored(sketches(items, containment), "benchmark-sets")
    # word counts of the short items that occur: at most four numbers
    n_words = F.size(F.split("shingle", " "))
    lengths = [SHINGLE_WORDS] + sorted(r[0] for r in sets.select(n_words.alias("n")).filter(
        F.col("n") < SHINGLE_WORDS).distinct().collect())
    pairs = stored(candidates(docs, sets, lengths), "benchmark-candidates")
    asked = bounded(stored(pairs.select("doc_id").distinct(), "benchmark-documents"))
    own = shingles(docs.join(asked, "doc_id", "left_semi"), "doc_id", lengths).distinct()
    shared = pairs.join(sets.select("item_id", "n_item", "h", "shingle"), "item_id") \
        .join(own, ["doc_id", "h", "shingle"], "left_semi") \
        .groupBy("doc_id", "item_id", "n_item").agg(F.count(F.lit(1)).alias("n_shared"))
    share = F.col("n_shared") / F.col("n_item")
    return shared.filter(F.col("n_shared") >= F.ceil(F.col("n_item") * F.lit(containment - 1e-9))) \
        .select("doc_id", "item_id", "n_item", "n_shared", F.round(share, 6).alias("containment"))


def clean(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    bad = contaminated(docs, benchmark, **kw).select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)
