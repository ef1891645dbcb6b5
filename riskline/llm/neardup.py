"""Near-duplicate documents by b-bit MinHash.

1. Per document, in one pass: the set of 5-word shingle hashes, PERMS minima, BANDS band keys
   over ROWS full minima each, and the signature that keeps the low BITS bits of each minimum,
   packed. Documents of equal word sequences (128-bit key) are one class, represented by the
   smallest doc_id.
2. Band keys that two or more classes share are candidate buckets. Within a bucket the packed
   signatures are compared by bit counts; the share of equal lanes, corrected for chance
   collisions of b bits, estimates the similarity. A bucket gives the edges of a spanning
   forest over pairs whose estimate is at least SIMILARITY - MARGIN: as many rows as members,
   never all pairs. Buckets above BLOCK members are dealt to tasks as pairs of blocks.
3. Components of these edges are groups that contain every link. Each group gets the full
   shingle sets (once per pair of blocks, blocks bounded by shingles) and links are confirmed
   on them; a pair is skipped only if other links already join its ends.
4. Components of the links give component_id.

A pair at similarity 0.75 is missed by all bands with probability 5e-6, and by the estimate
(five standard deviations) with less than 1e-6.

Defined results: null or empty text (or white space only) gives an empty set, linked with
nothing; fewer than five words give the whole sequence as one shingle; rows that share a
doc_id are one node (their texts count as linked); a null doc_id is kept, with a null
component; an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

from functools import partial
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.llm.common import (SHINGLE_WORDS, SIMILARITY, join_split, small_batches, stored,
                                 text_or_empty)
from riskline.llm.components import components
from riskline.llm.textops import Words, mix, signed, word_runs

PERMS, BANDS, ROWS, BITS = 128, 32, 4, 4
MARGIN = 0.2
BLOCK = 2048                # members of a bucket compared in one task
BLOCK_SHINGLES = 1 << 20    # shingles of a group confirmed in one task

_A = mix(np.arange(1, PERMS + 1, dtype=np.uint64)) | np.uint64(1)
_B = mix(np.arange(PERMS + 1, 2 * PERMS + 1, dtype=np.uint64))
_LANE = np.uint64(0x1111111111111111)


def shingle_sets(w: Words) -> Iterator[np.ndarray]:
    """The sorted shingle hashes of each row."""
    h, _ = w.windows(SHINGLE_WORDS)
    whole = None
    for r in range(w.rows):
        lo, hi = w.first[r], w.first[r + 1]
        if hi - lo >= SHINGLE_WORDS:
            yield np.unique(h[lo:hi - SHINGLE_WORDS + 1])
        elif hi > lo:
            whole = w.sequence_keys() if whole is None else whole
            yield whole[r, :1]
        else:
            yield np.zeros(0, np.uint64)


def minima(s: np.ndarray) -> np.ndarray:
    out = np.full(PERMS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 1024):
        np.minimum(out, (_A[:, None] * s[None, at:at + 1024] + _B[:, None]).min(axis=1), out=out)
    return out


def pack(m: np.ndarray) -> np.ndarray:
    """Low BITS bits of the (mixed) minima of shape (n, PERMS), as (n, PERMS * BITS / 64) words."""
    low = (mix(m.ravel()).reshape(m.shape) & np.uint64((1 << BITS) - 1)).reshape(len(m), -1, 64 // BITS)
    shift = (np.arange(64 // BITS) * BITS).astype(np.uint64)
    return np.bitwise_or.reduce(low << shift, axis=2)


def band_keys(m: np.ndarray) -> np.ndarray:
    parts = m.reshape(len(m), BANDS, ROWS)
    key = np.broadcast_to(mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(977)), parts.shape[:2]).copy()
    for j in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return key


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity from packed signatures: equal lanes by bit counts, less chance collisions."""
    x = a ^ b
    x = x | (x >> np.uint64(1))
    x = (x | (x >> np.uint64(2))) & _LANE
    equal = 1 - np.bitwise_count(x).sum(axis=-1) / PERMS
    chance = 2.0 ** -BITS
    return (equal - chance) / (1 - chance)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for w in word_runs(b["text"], lower=True):
            sets = list(shingle_sets(w))
            size = np.array([len(s) for s in sets], np.int64)
            m = np.stack([minima(s) for s in sets])
            key, bands = signed(w.sequence_keys()), signed(band_keys(m))
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"].slice(w.row0, w.rows), pa.array(key[:, 0]), pa.array(key[:, 1]),
                 pa.array(size), pa.array([x.tobytes() for x in pack(m)], pa.binary()),
                 pa.array(list(bands), pa.list_(pa.int64()))],
                names=["doc_id", "k0", "k1", "n_shingles", "signature", "bands"])


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str],
            edges: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Call ``edges`` with all rows of each group of a stream ordered by ``keys``."""
    rest: pa.Table | None = None

    def out(t: pa.Table) -> Iterator[pa.RecordBatch]:
        same = np.ones(t.num_rows, bool)
        for k in keys:
            v = t[k].to_numpy()
            same[1:] &= v[1:] == v[:-1]
        same[0] = False
        cut = np.append(np.flatnonzero(~same), t.num_rows)
        found = [edges(t.slice(lo, hi - lo)) for lo, hi in zip(cut[:-1], cut[1:]) if hi - lo > 1]
        if found:
            a, c = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c)], names=["a", "b"])

    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        t = t if rest is None else pa.concat_tables([rest, t])
        differs = np.zeros(t.num_rows, bool)
        for k in keys:
            v = t[k].to_numpy()
            differs |= v != v[-1]
        end = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
        if end:
            yield from out(t.slice(0, end).combine_chunks())
        rest = t.slice(end)
    if rest is not None and rest.num_rows:
        yield from out(rest.combine_chunks())


def _signatures(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t["signature"].to_pylist()), np.uint64).reshape(t.num_rows, -1)


def _alike(t: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the pairs whose estimate reaches ``least``."""
    sig, ids = _signatures(t), t["doc_id"].to_numpy()
    label, a, c = np.arange(len(ids)), [], []
    for i in range(len(ids) - 1):
        other = np.flatnonzero(label[i + 1:] != label[i]) + i + 1
        if not len(other):
            continue
        near = other[estimate(sig[i], sig[other]) >= least]
        for j in near[np.unique(label[near], return_index=True)[1]]:
            a.append(ids[i])
            c.append(ids[j])
            label[label == label[j]] = label[i]
    return np.array(a, np.int64), np.array(c, np.int64)


def _linked(t: pa.Table, least: float, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links, confirmed on full sets."""
    sig, ids = _signatures(t), t["doc_id"].to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in t["shingles"].to_pylist()]
    size = np.array([len(x) for x in sets])
    percent = round(100 * similarity)
    label, a, c = np.arange(len(ids)), [], []
    for i in range(len(ids) - 1):
        rest = slice(i + 1, None)
        fits = (label[rest] != label[i]) & (100 * np.minimum(size[rest], size[i])
                                            >= percent * np.maximum(size[rest], size[i]))
        other = np.flatnonzero(fits) + i + 1
        other = other[estimate(sig[i], sig[other]) >= least] if len(other) else other
        if not len(other):
            continue
        every = np.concatenate([sets[j] for j in other])
        at = np.searchsorted(sets[i], every)
        at[at == size[i]] = 0
        inter = np.add.reduceat(sets[i][at] == every, np.concatenate([[0], np.cumsum(size[other])[:-1]]))
        near = other[100 * inter >= percent * (size[i] + size[other] - inter)]
        for j in near[np.unique(label[near], return_index=True)[1]]:
            a.append(ids[i])
            c.append(ids[j])
            label[label == label[j]] = label[i]
    return np.array(a, np.int64), np.array(c, np.int64)


def _block_pairs(df: DataFrame, group: str, blocks: str) -> DataFrame:
    """Deal each member to all pairs of blocks its own block is in: columns lo, hi."""
    own = F.pmod(F.xxhash64("doc_id", group), F.col(blocks)).cast("int")
    df = df.withColumn("_own", own).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1)))
    return df.withColumn("lo", F.least("_own", "_other")).withColumn("hi", F.greatest("_own", "_other")) \
        .drop("_own", "_other", blocks)


def _by_group(df: DataFrame, keys: list[str], edges: Callable) -> DataFrame:
    dealt = df.repartition(*keys).sortWithinPartitions(*keys, "doc_id")
    return dealt.mapInArrow(partial(_groups, keys=keys, edges=edges), "a long, b long")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for w in word_runs(b["text"], lower=True):
            rows = [x.slice(w.row0, w.rows) for x in b.columns[:-1]]
            yield pa.RecordBatch.from_arrays(
                [*rows, pa.array([s.tobytes() for s in shingle_sets(w)], pa.binary())],
                names=[*b.schema.names[:-1], "shingles"])


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per row of ``docs``; see the module text."""
    small_batches(docs.sparkSession)
    least = similarity - MARGIN
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    sketch = stored(d.mapInArrow(
        _sketches, "doc_id long, k0 long, k1 long, n_shingles long, signature binary, "
                   "bands array<long>"), "sketches")
    classes = stored(sketch.filter("n_shingles > 0 and doc_id is not null").groupBy("k0", "k1").agg(
        F.min("doc_id").alias("first")), "classes")
    nodes = sketch.filter("n_shingles > 0").join(
        classes.withColumnRenamed("first", "doc_id"), ["doc_id", "k0", "k1"]) \
        .dropDuplicates(["doc_id", "k0", "k1"])
    nodes = stored(nodes.select("doc_id", "k0", "k1", "n_shingles", "signature", "bands"), "nodes")

    band = nodes.select("doc_id", F.explode("bands").alias("bucket"))
    shared = band.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1") \
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK)).drop("n")
    members = join_split(band, shared, ["bucket"]).groupBy("doc_id").agg(
        F.collect_list(F.struct("bucket", "blocks")).alias("in"))
    placed = members.join(nodes.select("doc_id", "signature"), "doc_id") \
        .select("doc_id", "signature", F.explode("in").alias("x")).select("doc_id", "signature", "x.*")
    alike = _by_group(_block_pairs(placed, "bucket", "blocks"), ["bucket", "lo", "hi"],
                      partial(_alike, least=least))
    groups = stored(components(alike, "a", "b"), "groups")

    in_group = nodes.select("doc_id", "k0", "k1", "n_shingles", "signature").join(
        groups.withColumnRenamed("node", "doc_id"), "doc_id")
    blocks = groups.join(nodes.select(F.col("doc_id").alias("node"), "n_shingles"), "node") \
        .groupBy("component").agg(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).alias("blocks"))
    dealt = join_split(in_group, blocks, ["component"])
    texts = d.filter("doc_id is not null").join(
        dealt.select("doc_id", "component", "blocks", "signature"), "doc_id") \
        .select("doc_id", "component", "blocks", "signature", "text")
    full = texts.mapInArrow(_sets, "doc_id long, component long, blocks long, signature binary, "
                                   "shingles binary")
    links = _by_group(_block_pairs(full, "component", "blocks"), ["component", "lo", "hi"],
                      partial(_linked, least=least, similarity=similarity))
    found = stored(components(links, "a", "b"), "components")

    # a class joins the component of its representative
    ids = classes.join(found.withColumnRenamed("node", "first"), "first", "left") \
        .select("k0", "k1", F.coalesce("component", "first").alias("smallest"))
    out = join_split(sketch.select("doc_id", "k0", "k1", "n_shingles"), ids, ["k0", "k1"], "left")
    smallest = F.when(F.col("n_shingles") > 0, F.col("smallest")).otherwise(F.col("doc_id"))
    smallest = F.when(F.col("doc_id").isNotNull(), F.coalesce(smallest, F.col("doc_id")))
    return out.select("doc_id", "n_shingles", smallest.alias("component_id"),
                      smallest.eqNullSafe(F.col("doc_id")).alias("kept"))


def keep_one(docs: DataFrame, **kw) -> DataFrame:
    """``docs`` with the row of the smallest doc_id of each component only."""
    kept = near_duplicates(docs, **kw).filter("kept").select("doc_id").distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi").select(*docs.columns)
