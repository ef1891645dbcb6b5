"""Hilbert sharding: the curve, the contract's law, pruning, edge rows."""

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from riskline.llm import hilbert
from tests.llm.helpers import edge_docs, empty_docs


@pytest.mark.parametrize("dims,bits", [(1, 5), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(dims, bits):
    grid = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    at = hilbert.curve_index(grid, bits)
    assert sorted(at) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(at)], axis=0)).sum(axis=1) == 1).all()


def steps(values, bits):
    """Plain quantisation: the step of the middle row of each value's run, nulls first."""
    key = lambda v: (v is not None, v.encode() if isinstance(v, str) else v)
    out, end = {}, 0
    for v in sorted(set(values), key=key):
        c = values.count(v)
        end += c
        out[v] = min((1 << bits) - 1, (end - (c + 1) // 2) * (1 << bits) // len(values))
    return out


def check(rows, docs, shards):
    texts = defaultdict(list)
    for r in docs:
        data = (r.text or "").encode()
        texts[r.doc_id].append((len(data) + 1, zlib.crc32(data)))
    got = defaultdict(list)
    slots = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.size, r.text_crc32))
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in texts.items()}
    n = [len(slots[s]) for s in range(shards)]
    assert sum(n) == len(docs) and max(n) - min(n) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_edge_rows(spark):
    d = edge_docs(spark)
    extra = spark.createDataFrame([(None, "null id", None, None, 1, 1, "w", "f", 1)] * 2, d.schema)
    d = d.union(extra).cache()
    docs = d.collect()
    for shards in (16, 3, 100):
        rows = hilbert.shards(d, shards, bits=4).collect()
        check(rows, docs, shards)
    # the order is that of a plain computation of steps and curve
    size = lambda r: len((r.text or "").encode()) + 1
    by = [steps([r.lang for r in docs], 4), steps([r.source for r in docs], 4), steps([size(r) for r in docs], 4)]
    cell = np.array([[by[0][r.lang], by[1][r.source], by[2][size(r)]] for r in docs])
    want = sorted(hilbert.curve_index(cell, 4).tolist())
    assert [r.curve for r in sorted(rows, key=lambda r: (r.shard, r.slot))] == want


def test_whole_table(spark, sf):
    from riskline.llm.catalog import op12_hilbert_shards
    from riskline.sources.tables import read_table
    check(op12_hilbert_shards(spark, sf).collect(), read_table(spark, sf, "documents").collect(), 16)


def test_empty(spark):
    assert hilbert.shards(empty_docs(spark)).count() == 0


def test_equal_texts_are_neighbours(spark):
    rng = random.Random(4)
    rows = [(i, f"text {rng.randrange(40)}", "en", "s") for i in range(400)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    crc = [r.text_crc32 for r in sorted(hilbert.shards(d).collect(), key=lambda r: (r.shard, r.slot))]
    assert sum(a != b for a, b in zip(crc, crc[1:])) == len(set(crc)) - 1


def test_files_prune_on_every_dimension(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, "x" * int(2 ** rng.uniform(0, 12)), rng.choice(["de", "en", "fr", None]),
             "hot" if rng.random() < .33 else f"s{rng.randrange(40):02}") for i in range(4000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    path = str(tmp_path / "out")
    m = hilbert.write(d, path, n_shards=4, file_rows=50).cache()
    assert m.agg({"rows": "sum"}).first()[0] == 4000 and m.agg({"rows": "max"}).first()[0] == 50
    back = spark.read.parquet(path)
    assert sorted((r.doc_id, r.text) for r in back.select("doc_id", "text").collect()) == [r[:2] for r in rows]
    files = m.count()
    for box, least in (({"lang": "de"}, .5), ({"source": "hot"}, .6), ({"source": "s07"}, .35),
                       ({"size": (1, 8)}, .55), ({"lang": "fr", "size": (1, 8)}, .25)):
        chosen = hilbert.files_for(m, **box)
        assert chosen.count() <= least * files, box
        inside = back.withColumn("size", __import__("pyspark").sql.functions.octet_length("text") + 1)
        for c, w in box.items():
            inside = inside.filter(inside[c].between(*(w if isinstance(w, tuple) else (w, w))))
        need = {(r[0], r[1]) for r in inside.select("_shard", "_part").distinct().collect()}
        assert need <= {(r.shard, r.part) for r in chosen.collect()}
