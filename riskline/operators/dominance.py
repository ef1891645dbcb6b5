"""Aggregates bounded by two times: of the rows in a range of positions, only those that had
arrived by a given time.

Positions are places in one global order, so a user of any size is cut like all others. A
tree of fixed widths lies over them: a leaf takes ``2**leaf_bits`` positions, every node above
it ``2**fan_bits`` nodes of the tier below. A range of positions falls into at most two pieces
per tier (a run of children of one node), and only up to the tier where both of its ends lie
under one node: short ranges stay in one or two leaves, whatever the table's size.

* A leaf's rows fit a task's memory. Its pieces are answered from a merge-sort tree in numpy: a
  level holds blocks of ``2**l`` positions, each in the order of arrival with running count, sum
  and maxima.
* A node above is swept in the order of arrival with one running value per child. Only nodes
  that pieces ask for are read. Their arrivals are cut into blocks of ``block_us``, swept on
  their own: what arrived before a block enters it as one row per child, so a node of very many
  rows is many tasks too.

Rows and pieces are dealt by node (and block of arrivals), never by user.
"""

from __future__ import annotations

from functools import partial
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskline.operators.ordinal import part_count

LEAF_BITS, FAN_BITS = 12, 6
BLOCK_US = 3_600_000_000
NONE = -(1 << 63)               # maximum of no rows
SWEEP_ROWS = 4096               # rows of a sweep handled at once

_OUT = ["_row", "_which", "n", "total", "largest", "latest"]
_OUT_SCHEMA = "_row long, _which int, n long, total long, largest long, latest long"


def pieces(ranges: DataFrame, rows: int, leaf_bits: int = LEAF_BITS, fan_bits: int = FAN_BITS) -> DataFrame:
    """Cut ranges (``_row``, ``_which``, ``arrival``, ``lo``, ``hi``) of ``rows`` positions into
    runs of children: columns _row, _which, arrival, tier, node, c1, c2 (end exclusive)."""
    out: list[Column] = []
    tier, width = 0, 0                       # a child of this tier holds 2**width positions
    while tier == 0 or (rows >> width) > 0:
        k = leaf_bits if tier == 0 else fan_bits
        mask = (1 << k) - 1
        x = F.shiftright(F.col("lo") + ((1 << width) - 1), width)
        y = F.shiftright("hi", width)
        nx, ny = F.shiftright(x, k), F.shiftright(y, k)
        cx, cy = x.bitwiseAND(F.lit(mask).cast("long")), y.bitwiseAND(F.lit(mask).cast("long"))

        def piece(cond: Column, node: Column, c1: Column, c2: Column) -> Column:
            return F.when((x < y) & cond, F.struct(
                F.lit(tier).alias("tier"), node.alias("node"), c1.cast("int").alias("c1"), c2.cast("int").alias("c2")))

        out += [piece(nx == ny, nx, cx, cy), piece((nx < ny) & (cx > 0), nx, cx, F.lit(1 << k)),
                piece((nx < ny) & (cy > 0), ny, F.lit(0), cy)]
        tier, width = tier + 1, width + k
    cut = F.filter(F.array(*out), lambda p: p.isNotNull())
    return ranges.select("_row", "_which", "arrival", F.explode(cut).alias("p")).select(
        "_row", "_which", "arrival", "p.*")


class _Leaf:
    """Merge-sort tree over the rows of one leaf."""

    def __init__(self, c: np.ndarray, arrival: np.ndarray, cents: np.ndarray, us: np.ndarray):
        bits = max(int(c.max()).bit_length(), 1)
        size = 1 << bits
        self.arrivals = np.sort(arrival)
        rank = np.full(size, size, np.int64)             # missing positions arrive last of all
        rank[c] = np.searchsorted(self.arrivals, arrival, "left")
        val, time = np.full(size, NONE), np.full(size, NONE)
        val[c], time[c] = cents, us
        one = np.zeros(size, np.int64)
        one[c] = 1
        money = np.where(one > 0, val, 0)
        self.size, self.levels = size, []
        for level in range(bits + 1):
            shape = (-1, 1 << level)
            order = np.argsort(rank.reshape(shape), axis=1, kind="stable")
            at = lambda x: np.take_along_axis(x.reshape(shape), order, axis=1)
            blocks = size >> level
            keys = at(rank) + np.arange(blocks)[:, None] * (size + 1)
            self.levels.append((keys.ravel(), np.cumsum(at(one), axis=1).ravel(), np.cumsum(at(money), axis=1).ravel(),
                                np.maximum.accumulate(at(val), axis=1).ravel(),
                                np.maximum.accumulate(at(time), axis=1).ravel()))

    def ask(self, c1: np.ndarray, c2: np.ndarray, arrival: np.ndarray) -> list[np.ndarray]:
        q = len(c1)
        out = [np.zeros(q, np.int64), np.zeros(q, np.int64), np.full(q, NONE), np.full(q, NONE)]
        # ranks are left places, so every row of an equal arrival lies below the right place
        by = np.searchsorted(self.arrivals, arrival, "right")
        lo, hi = c1.astype(np.int64), np.minimum(c2, self.size).astype(np.int64)
        for level, (keys, n, total, largest, latest) in enumerate(self.levels):
            open_ = lo < hi
            if not open_.any():
                break
            for side, odd in ((lo, open_ & (lo & 1 == 1)), (hi, open_ & (hi & 1 == 1))):
                rows = np.flatnonzero(odd)
                if len(rows):
                    block = lo[rows] if side is lo else hi[rows] - 1
                    end = np.searchsorted(keys, block * (self.size + 1) + by[rows], "left") - 1
                    some = end >= (block << level)
                    rows, end = rows[some], end[some]
                    out[0][rows] += n[end]
                    out[1][rows] += total[end]
                    out[2][rows] = np.maximum(out[2][rows], largest[end])
                    out[3][rows] = np.maximum(out[3][rows], latest[end])
            lo, hi = (lo + 1) >> 1, hi >> 1
        return out


def _runs(pdf: pd.DataFrame, keys: list[str]) -> Iterator[tuple[int, int]]:
    same = np.ones(len(pdf), bool)
    for k in keys:
        v = pdf[k].to_numpy()
        same[1:] &= v[1:] == v[:-1]
    cut = np.flatnonzero(~same[1:]) + 1
    return zip([0, *cut], [*cut, len(pdf)])


def _frame(pdf: pd.DataFrame, got: list[np.ndarray]) -> pd.DataFrame:
    return pd.DataFrame(dict(zip(_OUT, [pdf["_row"].to_numpy(), pdf["_which"].to_numpy(), *got])))


def _ask_leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches sorted by (node, asks): a leaf's rows come before the pieces that ask it."""
    node, parts, leaf = None, [], None
    for pdf in batches:
        for lo, hi in _runs(pdf, ["node"]):
            run = pdf.iloc[lo:hi]
            if run["node"].iat[0] != node:
                node, parts, leaf = run["node"].iat[0], [], None
            asks = run["asks"].to_numpy()
            if not asks.all():
                parts.append(run[~asks])
            if asks.any():
                if leaf is None:
                    d = pd.concat(parts) if parts else run.iloc[:0]
                    if not len(d):
                        continue                        # nothing arrived under this node
                    leaf = _Leaf(*(d[x].to_numpy(np.int64) for x in ("c1", "arrival", "total", "latest")))
                    parts = []
                q = run[asks]
                yield _frame(q, leaf.ask(*(q[x].to_numpy(np.int64) for x in ("c1", "c2", "arrival"))))


def _sweep(batches: Iterator[pd.DataFrame], fan: int) -> Iterator[pd.DataFrame]:
    """Batches sorted by (tier, node, block, arrival, asks): running values per child."""
    keys = ["tier", "node", "block"]
    now, state = None, None
    for pdf in batches:
        for lo, hi in _runs(pdf, keys):
            first = tuple(pdf[k].iat[lo] for k in keys)
            if first != now:
                now = first
                state = [np.zeros(fan, np.int64), np.zeros(fan, np.int64), np.full(fan, NONE), np.full(fan, NONE)]
            for a in range(lo, hi, SWEEP_ROWS):
                part = pdf.iloc[a:min(a + SWEEP_ROWS, hi)]
                asks = part["asks"].to_numpy()
                at, child = np.arange(len(part)), part["c1"].to_numpy(np.int64)
                data = ~asks
                grids = []
                for i, (name, add) in enumerate((("n", True), ("total", True), ("largest", False), ("latest", False))):
                    g = np.full((len(part) + 1, fan), 0 if add else NONE, np.int64)
                    g[0] = state[i]
                    g[at[data] + 1, child[data]] = part[name].to_numpy(np.int64)[data]
                    g = np.cumsum(g, axis=0) if add else np.maximum.accumulate(g, axis=0)
                    state[i] = g[-1].copy()
                    grids.append(g[1:][asks])
                if asks.any():
                    q = part[asks]
                    c = np.arange(fan)
                    inside = (c >= q["c1"].to_numpy()[:, None]) & (c < q["c2"].to_numpy()[:, None])
                    yield _frame(q, [np.where(inside, g, 0).sum(axis=1) if i < 2 else np.where(inside, g, NONE).max(axis=1)
                                     for i, g in enumerate(grids)])


def _leaves(data: DataFrame, asked: DataFrame, leaf_bits: int, parts: int) -> DataFrame:
    zero = F.lit(0).cast("long")
    mask = F.lit((1 << leaf_bits) - 1).cast("long")
    rows = data.select(F.shiftright("pos", leaf_bits).alias("node"), F.lit(False).alias("asks"), "arrival",
                       F.col("pos").bitwiseAND(mask).cast("int").alias("c1"), F.lit(0).alias("c2"),
                       F.col("cents").alias("total"), F.col("us").alias("latest"),
                       zero.alias("_row"), F.lit(0).alias("_which"))
    asks = asked.filter("tier = 0").select("node", F.lit(True).alias("asks"), "arrival", "c1", "c2", zero.alias("total"),
                                           zero.alias("latest"), "_row", "_which")
    return rows.unionByName(asks).repartition(parts, "node").sortWithinPartitions("node", "asks") \
        .mapInPandas(_ask_leaves, _OUT_SCHEMA)


def _nodes(data: DataFrame, asked: DataFrame, tiers: list[int], leaf_bits: int, fan_bits: int, block_us: int,
           parts: int) -> DataFrame:
    """Pieces above the leaves. Only nodes that are asked are read."""
    key = ["tier", "node"]
    block = F.floor(F.col("arrival") / F.lit(block_us)).cast("long")
    asks = asked.filter("tier > 0").withColumn("block", block)
    groups = asks.select(*key, "block").distinct()
    width = lambda t: leaf_bits + (t - 1) * fan_bits
    mask = F.lit((1 << fan_bits) - 1).cast("long")
    under = F.array(*[F.struct(F.lit(t).alias("tier"), F.shiftright("pos", width(t) + fan_bits).alias("node"),
                               F.shiftright("pos", width(t)).bitwiseAND(mask).cast("int").alias("c1")) for t in tiers])
    rows = data.select("arrival", "cents", "us", F.explode(under).alias("p")).select(
        "p.*", block.alias("block"), "arrival", F.lit(1).cast("long").alias("n"), F.col("cents").alias("total"),
        F.col("cents").alias("largest"), F.col("us").alias("latest"))
    values = ["n", "total", "largest", "latest"]
    own = rows.join(groups, [*key, "block"], "left_semi")
    # what arrived before a block: one row per child
    per = rows.join(groups.select(*key).distinct(), key, "left_semi").groupBy(*key, "c1", "block").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("largest").alias("largest"), F.max("latest").alias("latest"))
    wanted = groups.join(per.select(*key, "c1").distinct(), key).select(
        *key, "c1", "block", *[F.lit(None).cast("long").alias(v) for v in values], F.lit(True).alias("_want"))
    before = Window.partitionBy(*key, "c1").orderBy("block").rangeBetween(Window.unboundedPreceding, -1)
    carried = per.withColumn("_want", F.lit(False)).unionByName(wanted).select(
        *key, "c1", "block", "_want", F.sum("n").over(before).alias("n"), F.sum("total").over(before).alias("total"),
        F.max("largest").over(before).alias("largest"), F.max("latest").over(before).alias("latest")) \
        .filter("_want AND n > 0").withColumn("arrival", F.col("block") * F.lit(block_us) - 1)
    cols = [*key, "block", "arrival", "c1", *values]
    known = own.select(*cols).unionByName(carried.select(*cols)).select(
        *cols, F.lit(False).alias("asks"), F.lit(0).alias("c2"), F.lit(0).cast("long").alias("_row"), F.lit(0).alias("_which"))
    zero = [F.lit(0).cast("long").alias(v) for v in values]
    asks = asks.select(*key, "block", "arrival", "c1", *zero, F.lit(True).alias("asks"), "c2", "_row", "_which")
    return known.unionByName(asks).repartition(parts, *key, "block").sortWithinPartitions(*key, "block", "arrival", "asks") \
        .mapInPandas(partial(_sweep, fan=1 << fan_bits), _OUT_SCHEMA)


def range_values(data: DataFrame, asked: DataFrame, *, leaf_bits: int = LEAF_BITS, fan_bits: int = FAN_BITS,
                 block_us: int = BLOCK_US) -> DataFrame:
    """Answers of the pieces ``asked`` (a written table, see :func:`pieces`) over ``data``
    (``pos``, ``arrival``, ``cents``, ``us``): a row per piece with n, total (of cents), largest
    (cents) and latest (us), the last two ``NONE`` without a row."""
    parts = part_count(data.sparkSession, data.count() + asked.count())
    out = _leaves(data, asked, leaf_bits, parts)
    tiers = sorted(r.tier for r in asked.select("tier").distinct().collect() if r.tier)     # a handful
    return out.unionByName(_nodes(data, asked, tiers, leaf_bits, fan_bits, block_us, parts)) if tiers else out
