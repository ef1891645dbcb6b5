"""VA-file clustering against plain Lloyd rounds, and its cells."""

import hashlib
import random

import numpy as np

from riskline.llm import vafile


def plain(rows, k, rounds, dims):
    """rows: (vec_id, vector or None) -> {(vec_id, vector): (cluster, distance, inertia of it, of all, digest)}"""
    kept = [(i, [min(max(int(np.floor(256 * np.float64(x))), -(1 << 27)), 1 << 27) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    name = lambda i: "~" if i is None else hashlib.sha256(f"2:{i}".encode()).hexdigest()
    cents = [list(v) for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    dist = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    near = lambda v: min((dist(v, c), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(cents)):
            mine = [v for o, (_, v) in zip(own, kept) if o == j]
            if mine:
                cents[j] = [sum(x) // len(mine) for x in zip(*mine)]
    got = [(i, v, *near(v)) for i, v in kept]
    per = {j: sum(d for *_, d, c in got if c == j) for j in range(len(cents))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted((str(i), c, d, per[c], sum(per.values()), digest[c]) for i, _, d, c in got)


def out(df):
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)
                  for r in df.collect())


def edge_rows(rng, dims):
    groups = [[rng.uniform(-2, 2) for _ in range(dims)] for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, .05) for x in groups[i % 6 if i % 3 else 0]]) for i in range(300)]
    rows += [(1000, [0.0] * dims), (1001, [0.0] * dims), (1001, [0.0] * dims), (1002, [1e30] + [0.0] * (dims - 1)),
             (1003, [-7e8] * dims), (1004, None), (1005, []), (1006, [0.5] * (dims - 1)), (1007, [None] + [0.1] * (dims - 1)),
             (1008, [float("nan")] * dims), (1009, [float("inf")] + [0.0] * (dims - 1)), (None, [0.25] * dims)]
    return rows


def test_equals_lloyd(spark):
    rng = random.Random(3)
    for dims, k, sample in ((64, 8, 8192), (3, 500, 50)):
        rows = [(i, v, 7, "x") for i, v in edge_rows(rng, dims)]
        d = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster int, key string").repartition(5)
        stats = []
        got = out(vafile.cluster(d, k=k, rounds=3, dims=dims, sample=sample, stats=stats))
        assert got == plain([r[:2] for r in rows], k, 3, dims)
        assert stats[0][1] == stats[0][0] == len(got)      # the first sums need every vector


def test_separated_groups_settle_from_cells(spark):
    """Far groups: after the first round no vector is fetched again."""
    rng = random.Random(5)
    groups = [[rng.choice((-3, 3)) for _ in range(64)] for _ in range(4)]
    rows = [(i, [x + rng.gauss(0, .1) for x in groups[i % 4]]) for i in range(400)]
    stats = []
    starts = sorted(range(400), key=lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest())[:40]
    assert {i % 4 for i in starts} == set(range(4))
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert len(vafile.cluster(d, k=1, stats=stats).collect()) == 400
    assert [f for _, f in stats[1:]] == [0] * (len(stats) - 1)


def test_empty_and_unfit(spark):
    schema = "vec_id long, embedding array<float>"
    assert vafile.cluster(spark.createDataFrame([], schema)).count() == 0
    assert vafile.cluster(spark.createDataFrame([(1, None), (2, [1.0])], schema)).count() == 0
    assert [c.split()[0] for c in vafile.OUT.split(", ")] == vafile.cluster(spark.createDataFrame([], schema)).columns


def test_cells_bound_distances():
    rng = np.random.default_rng(2)
    v = rng.integers(-150, 150, (500, 16)).astype(np.int32)
    cells = vafile.Cells(v[:200], 4)
    packed, outside = cells.pack(v)
    cell = cells.unpack(packed)
    assert packed.shape == (500, 8)
    inside = ~outside
    for d in range(16):
        assert (cells.low[d, cell[inside, d]] <= v[inside, d]).all() and (v[inside, d] <= cells.high[d, cell[inside, d]]).all()
    c = rng.integers(-150, 150, (9, 16)).astype(np.int64)
    left = cells.left(packed, *cells.tables(c), (c ** 2).sum(axis=1))
    best = ((v[:, None].astype(np.int64) - c[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert left[np.arange(500), best][inside].all() and left[inside].mean() < .8


def test_full_vectors_are_read_in_buckets(spark):
    """The fetch shuffles the narrow side alone."""
    d = spark.createDataFrame([(i, [float(i)] * 4) for i in range(50)], "vec_id long, embedding array<float>")
    ints = vafile._bucketed(d.selectExpr("vec_id AS key", "cast('x' AS binary) AS v"), 50)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = d.selectExpr("vec_id AS key").repartition(3).join(ints, "key")._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.count("Exchange hashpartitioning(key") == 1 and "SelectedBucketsCount" in physical
