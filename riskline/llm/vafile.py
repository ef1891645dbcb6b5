"""Centroid clustering over a VA-file (vector approximation file).

1. Every kept vector becomes integers floor(256 * x) and is written once, hash-bucketed by a row
   key (``full``).
2. Each dimension is cut into 2**BITS cells at quantiles of a sample of SAMPLE rows (those of the
   smallest key hash). Every row's cell numbers are packed into 64 * BITS bits (``cells``).
3. A round reads the approximations alone. With |x|**2 the same for all centroids, the distance
   to centroid c is |x|**2 + |c|**2 - 2 x.c; a lookup table per dimension gives the least and the
   greatest term of every cell and centroid, and their sums are the interval of c. Centroids
   whose lower end is above the smallest upper end are out. A row with one centroid left is
   settled without its vector.
4. Only rows with more than one centroid left, or with another centroid than in the round
   before, fetch their vector: the narrow side of that join is shuffled, ``full`` is read in its
   buckets. Exact distances are computed for the centroids that are left. Rows that moved are
   taken from the sums of their old cluster and added to those of the new one, so sums stay
   exact without reading the others. The last pass fetches every vector, for its distance.

Rounds exchange written tables (``stored``); the driver sees the sample and, per round, one sum
per cluster and dimension. Integers are exact throughout (decimals beyond 64 bits in sums).

Defined results: vectors that are null, of another length, or with a null or non-finite
component are left out; components are clamped to +-2**27 (|x| of 524,288), so that a squared
distance fits 64 bits; repeated rows are vectors of their own (of equal ids, the smaller vector
starts first); a null vec_id is kept and starts a centroid only after all others; fewer vectors
than ``k`` give fewer centroids; an empty table gives an empty result; only vec_id and
embedding are read. Rows outside the sample's range of a dimension always fetch their vector.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import partial
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.llm.common import stored
from riskline.session import checkpoint_path

DIMS, K, ROUNDS = 64, 40, 5     # fixed by the operator's contract
BITS = 6                        # cells per dimension: 2**BITS
SAMPLE = 8192                   # rows the cells are fitted on; every row is indexed
LIMIT = 1 << 27
BUCKET_ROWS = 1 << 18           # rows of a bucket of ``full`` (64 MB)

OUT = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
       "centroid_sha256 string")


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(-1, dims)


def _binary(a: np.ndarray) -> pa.Array:
    """The rows of a matrix as byte strings."""
    a = np.ascontiguousarray(a)
    size = a.itemsize * a.shape[1]
    at = np.arange(len(a) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer(at), pa.py_buffer(a)])


def _quantise(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        e = b["embedding"]
        right = np.asarray(e.value_lengths().fill_null(-1)) == dims
        rows = b.filter(pa.array(right))
        values = rows["embedding"].flatten()
        x = np.asarray(values.fill_null(np.nan), dtype=np.float64).reshape(-1, dims)
        sound = np.isfinite(x).all(axis=1)
        v = np.clip(np.floor(256 * x[sound]), -LIMIT, LIMIT).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [rows["vec_id"].filter(pa.array(sound)), _binary(v)], names=["vec_id", "v"])


class Cells:
    """Cuts of the dimensions, packing of cell numbers and the lookup tables of centroids."""

    def __init__(self, sample: np.ndarray, bits: int):
        self.bits, self.dims = bits, sample.shape[1]
        share = np.arange(1, 1 << bits) / (1 << bits)
        #: a cell d, j holds low[d, j] .. high[d, j]
        cuts = np.sort(np.quantile(sample, share, axis=0, method="lower").astype(np.int64), axis=0).T
        self.cuts = cuts
        self.low = np.concatenate([sample.min(axis=0)[:, None], cuts], axis=1).astype(np.int64)
        self.high = np.concatenate([cuts - 1, sample.max(axis=0)[:, None]], axis=1).astype(np.int64)
        self.high = np.maximum(self.high, self.low)

    def pack(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Packed cell numbers, and which rows lie outside the fitted range."""
        cell = np.stack([np.searchsorted(self.cuts[d], v[:, d], side="right")
                         for d in range(self.dims)], axis=1)
        outside = ((v < self.low[:, 0]) | (v > self.high[:, -1])).any(axis=1)
        bit = (cell[:, :, None] >> np.arange(self.bits)) & 1
        return np.packbits(bit.reshape(len(v), -1).astype(np.uint8), axis=1), outside

    def unpack(self, packed: np.ndarray) -> np.ndarray:
        bit = np.unpackbits(packed, axis=1, count=self.dims * self.bits)
        return bit.reshape(len(packed), self.dims, self.bits) @ (1 << np.arange(self.bits))

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest -2 x c of each dimension, cell and centroid."""
        a = -2 * self.low[:, :, None] * centroids.T[:, None, :]
        b = -2 * self.high[:, :, None] * centroids.T[:, None, :]
        return np.minimum(a, b), np.maximum(a, b)

    def left(self, packed: np.ndarray, least: np.ndarray, most: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """(rows, centroids): whether a centroid's interval reaches the smallest upper end."""
        cell = self.unpack(packed)
        lower = np.repeat(norm[None], len(cell), axis=0)
        upper = lower.copy()
        for d in range(self.dims):
            lower += least[d, cell[:, d]]
            upper += most[d, cell[:, d]]
        return lower <= upper.min(axis=1, keepdims=True)


def _approximate(batches: Iterator[pa.RecordBatch], cells: Cells) -> Iterator[pa.RecordBatch]:
    for b in batches:
        packed, outside = cells.pack(_vectors(b["v"], cells.dims))
        yield pa.RecordBatch.from_arrays(
            [b["key"], _binary(packed), pa.array(outside), pa.array(np.full(b.num_rows, -1, np.int32))],
            names=["key", "cells", "outside", "cluster"])


def _bounds(batches: Iterator[pa.RecordBatch], cells: Cells, centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Add ``next``, the only centroid left (else -1), and ``maybe``, the centroids left."""
    least, most = cells.tables(centroids)
    norm = (centroids ** 2).sum(axis=1)
    for b in batches:
        packed = np.frombuffer(b"".join(b["cells"].to_pylist()), np.uint8).reshape(b.num_rows, -1)
        left = cells.left(packed, least, most, norm)
        left[np.asarray(b["outside"])] = True
        one = left.sum(axis=1) == 1
        nxt = np.where(one, left.argmax(axis=1), -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array(nxt), _binary(np.packbits(left, axis=1))],
            names=[*b.schema.names, "next", "maybe"])


def _nearest(v: np.ndarray, nxt: np.ndarray, maybe: pa.Array, centroids: np.ndarray) -> np.ndarray:
    """The centroid of each row: ``next`` if settled, else the nearest of those left."""
    out = nxt.copy()
    rows = np.flatnonzero(nxt < 0)
    if len(rows):
        left = np.unpackbits(np.frombuffer(b"".join(maybe.take(pa.array(rows)).to_pylist()), np.uint8)
                             .reshape(len(rows), -1), axis=1, count=len(centroids))
        at, c = np.nonzero(left)
        d = np.concatenate([((v[rows[at[i:i + 65536]]].astype(np.int64) - centroids[c[i:i + 65536]]) ** 2)
                            .sum(axis=1) for i in range(0, len(at), 65536)])
        order = np.lexsort((c, d, at))
        first = np.searchsorted(at, np.arange(len(rows)))      # ``at`` is ascending
        out[rows] = c[order[first]]
    return out


def _settle(batches: Iterator[pa.RecordBatch], dims: int, centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows with their centroid, and at the end the changes of the sums: per cluster a row with
    a null key and ``sums`` of all components and, last, of the rows."""
    change = np.zeros((len(centroids), dims + 1), np.int64)
    for b in batches:
        v = _vectors(b["v"], dims)
        was, now = np.asarray(b["cluster"]), _nearest(v, np.asarray(b["next"]), b["maybe"], centroids)
        moved = was != now
        x = np.concatenate([v[moved].astype(np.int64), np.ones((moved.sum(), 1), np.int64)], axis=1)
        np.add.at(change, now[moved], x)
        left = was[moved] >= 0
        np.subtract.at(change, was[moved][left], x[left])
        yield pa.RecordBatch.from_arrays(
            [b["key"], b["cells"], b["outside"], pa.array(now),
             pa.nulls(b.num_rows, pa.list_(pa.int64()))],
            names=["key", "cells", "outside", "cluster", "sums"])
    at = np.flatnonzero(change.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.binary()), pa.nulls(len(at), pa.bool_()),
         pa.array(at.astype(np.int32)), pa.array(list(change[at]), pa.list_(pa.int64()))],
        names=["key", "cells", "outside", "cluster", "sums"])


def _distances(batches: Iterator[pa.RecordBatch], dims: int, centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for b in batches:
        v = _vectors(b["v"], dims)
        c = _nearest(v, np.asarray(b["next"]), b["maybe"], centroids)
        d = ((v.astype(np.int64) - centroids[c]) ** 2).sum(axis=1)
        yield pa.RecordBatch.from_arrays([b["vec_id"], pa.array(c), pa.array(d)],
                                         names=["vec_id", "cluster", "distance"])


def _bucketed(df: DataFrame, rows: int) -> DataFrame:
    """``df`` (with a row key) written in hash buckets of ``key``: a join on the key reads it
    without an exchange. The table's name in the session's catalog is dropped at once."""
    spark = df.sparkSession
    wide = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // 4096))
    n = max(1, wide, -(-rows // BUCKET_ROWS))
    name = f"riskline_vectors_{uuid.uuid4().hex}"
    df.repartition(n, "key").write.bucketBy(n, "key").sortBy("key").option(
        "path", checkpoint_path(spark, f"llm/{name}")).saveAsTable(name)
    out = spark.table(name)
    out.schema                          # resolved before the name goes; the files stay
    spark.sql(f"DROP TABLE {name}")
    return out


def _starts(full: DataFrame, k: int, dims: int) -> np.ndarray:
    digest = F.coalesce(F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256), F.lit("~"))
    first = full.select(digest.alias("h"), "v").withColumn("o", F.hex("v")).orderBy("h", "o").limit(k)
    rows = [(r.h, np.frombuffer(r.v, np.int32)) for r in first.collect()]
    rows.sort(key=lambda r: (r[0], r[1].tolist()))
    return np.stack([r[1] for r in rows]).astype(np.int64) if rows else np.zeros((0, dims), np.int64)


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, bits: int = BITS,
            sample: int = SAMPLE, stats: list | None = None) -> DataFrame:
    """Columns ``OUT``, a row per kept vector. With ``stats`` (a list) each round appends
    (rows, rows that fetched their vector)."""
    spark = vectors.sparkSession
    src = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                         F.col("embedding").cast("array<double>").alias("embedding"))
    ints = src.mapInArrow(partial(_quantise, dims=dims), "vec_id long, v binary")
    full = _bucketed(ints.withColumn("key", F.monotonically_increasing_id()), vectors.count())
    centroids = _starts(full, k, dims)
    if not len(centroids):
        return spark.createDataFrame([], OUT)
    seen = full.select("v", F.xxhash64("key").alias("h")).orderBy("h").limit(sample).collect()
    cells = Cells(np.stack([np.frombuffer(r.v, np.int32) for r in seen]), bits)
    state = stored(full.mapInArrow(partial(_approximate, cells=cells),
                                   "key long, cells binary, outside boolean, cluster int"), "va-cells")
    schema = "key long, cells binary, outside boolean, cluster int, next int, maybe binary"
    names = ["key", "cells", "outside", "cluster"]
    totals = [[0] * (dims + 1) for _ in centroids]
    for _ in range(rounds):
        bounded = stored(state.mapInArrow(partial(_bounds, cells=cells, centroids=centroids), schema), "va-bounds")
        fetch = F.col("next") != F.col("cluster")      # still open (-1), or another centroid
        fetch = fetch | (F.col("next") < 0)
        got = bounded.filter(fetch).join(full.select("key", "v"), "key")
        fetched = stored(got.select(*names, "next", "maybe", "v").mapInArrow(
            partial(_settle, dims=dims, centroids=centroids),
            "key long, cells binary, outside boolean, cluster int, sums array<long>"), "va-fetched")
        if stats is not None:
            stats.append((bounded.count(), fetched.filter("key IS NOT NULL").count()))
        change = fetched.filter("sums IS NOT NULL").select("cluster", F.posexplode("sums").alias("i", "x")) \
            .groupBy("cluster", "i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
        for r in change.collect():
            totals[r.cluster][r.i] += int(r.x)
        centroids = np.array([[s // t[-1] for s in t[:-1]] if t[-1] else list(c)
                              for t, c in zip(totals, centroids.tolist())], np.int64)
        state = bounded.filter(~fetch).select(*names).unionByName(
            fetched.filter("key IS NOT NULL").select(*names))
    last = state.mapInArrow(partial(_bounds, cells=cells, centroids=centroids), schema)
    out = stored(last.select("key", "next", "maybe").join(full, "key").select("vec_id", "next", "maybe", "v").mapInArrow(
        partial(_distances, dims=dims, centroids=centroids), "vec_id long, cluster int, distance long"), "va-out")
    sums = {r.cluster: int(r.s) for r in out.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    largest = (1 << 63) - 1
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    per = spark.createDataFrame(
        [(c, min(s, largest), min(sum(sums.values()), largest), digest[c]) for c, s in sorted(sums.items())],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(per), "cluster").select(*[c.split()[0] for c in OUT.split(", ")])
