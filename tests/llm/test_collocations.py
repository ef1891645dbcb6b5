"""Quotient filters and phrase collocations against plain counts."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskline.llm import collocations, quotient
from tests.llm.helpers import edge_docs, empty_docs


@pytest.mark.parametrize("high,low", [(1, 2), (5, 10), (17, 34), (31, 62)])
def test_permutation_is_invertible(high, low):
    rng = np.random.default_rng(1)
    lay = quotient.Layout(high, low)
    h = rng.integers(0, 1 << high, 4000).astype(np.uint64)
    l = rng.integers(0, 1 << low, 4000).astype(np.uint64)
    a, b = lay.permute(h, l)
    assert a.max() < 1 << high and b.max() < 1 << low
    x, y = lay.invert(a, b)
    assert (x == h).all() and (y == l).all()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 31), st.integers(1, 62), st.integers(0, 6), st.integers(1, 3), st.randoms(use_true_random=False))
def test_filters_merge_exactly(high, low, prefix_bits, shards, rng):
    prefix_bits = min(prefix_bits, high)
    lay = quotient.Layout(high, low)
    total: Counter = Counter()
    mergers: dict = {}
    for _ in range(shards):
        n = rng.randrange(0, 200)
        keys = [(rng.randrange(1 << high) if rng.random() < .8 else 0, rng.randrange(1 << low)) for _ in range(n)]
        weight = [rng.choice([1, 2, 254, 255, 256, 10**12]) for _ in range(n)]
        for k, w in zip(keys, weight):
            total[k] += w
        h, l = lay.permute(np.array([k[0] for k in keys], np.uint64), np.array([k[1] for k in keys], np.uint64))
        s = quotient.counted(h, l, np.array(weight, np.int64), low_bits=rng.choice([low, 64]))
        for p, data in quotient.segments(lay, prefix_bits, *s):
            mergers.setdefault(p, quotient.Merger(lay, prefix_bits)).add(data)
    got = Counter()
    for m in mergers.values():
        for h, l, c in zip(*(x.tolist() for x in m.keys())):
            assert (h, l) not in got
            got[h, l] = c
    assert got == total


def test_filter_is_compact():
    rng = np.random.default_rng(3)
    lay = quotient.Layout(20, 40)
    s = quotient.counted(*lay.permute(rng.integers(0, 1 << 20, 100_000).astype(np.uint64),
                                      rng.integers(0, 1 << 40, 100_000).astype(np.uint64)))
    assert len(quotient.pack(lay, 0, 0, *s)) < 7.5 * len(s[0])      # 60-bit keys with their counts


def plain(rows, least, top):
    """rows of (text, lang) -> the contract's rows, in plain Python."""
    f: Counter = Counter()
    n: Counter = Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[(lang, *w[i:i + k])] += 1
    cands = [c for c, a in f.items() if len(c) in (3, 4) and a >= least]
    longer: dict = {}
    for c in cands:
        if len(c) == 4:
            for part in ((c[0], *c[1:3]), (c[0], *c[2:4])):
                longer[part] = max(longer.get(part, 0), f[c])
    out = []
    for c in cands:
        if 100 * longer.get(c, 0) >= 50 * f[c]:
            continue
        a, w = f[c], c[1:]
        score, k = min((1_000_000 * a * a // (f[(c[0], *w[:k])] * f[(c[0], *w[k:])]), k) for k in range(1, len(w)))
        out.append((c[0], score, a, " ".join(w), f[(c[0], *w[:k])], f[(c[0], *w[k:])]))
    res = []
    for lang in n:
        best = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[1], -o[2], o[3].encode()))[:top]
        res += [(lang, i + 1, o[3], o[2], o[4], o[5], n[lang], o[1]) for i, o in enumerate(best)]
    return sorted(res)


def result(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


def texts(rng, n):
    vocab = [f"w{i}" for i in range(60)] + ["ß", "éa", " x", "İ", "ꙮ"]
    out = []
    for i in range(n):
        words = [rng.choice(vocab if rng.random() < .5 else vocab[:8]) for _ in range(rng.randrange(0, 60))]
        if i % 3 == 0:
            words[1:1] = ["New", "York", "City"]
        if i % 4 == 0:
            words += ["new", "york"]
        out.append("".join(w + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "!"]) for w in words))
    return out


def test_equals_plain_counts(spark):
    rng = random.Random(8)
    rows = [(t, rng.choice(["en", "en", "de", None, "und"])) for t in texts(rng, 300)]
    rows += [(None, "en"), ("", "fr"), (" \t\n", None), ("one", "it"), ("Hot word " * 20_000, "en"), *rows[:40]]
    d = spark.createDataFrame([(i, t, g, 0, "x") for i, (t, g) in enumerate(rows)],
                              "doc_id long, text string, lang string, a int, word string").repartition(6)
    for least, top in ((10, 2000), (3, 25), (1, 7)):
        assert result(collocations.collocations(d, least, top)) == plain(rows, least, top)


def test_many_segments_and_chunks(spark, monkeypatch):
    """Small chunks and ranges: filters of one range come from many chunks."""
    monkeypatch.setattr(collocations, "CHUNK_TOKENS", 50)
    monkeypatch.setattr(collocations, "SEGMENT_TOKENS", 200)
    rows = [(t, "en") for t in texts(random.Random(2), 200)]
    d = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    assert result(collocations.collocations(d, 4, 500)) == plain(rows, 4, 500)


def test_edge_rows_and_empty(spark):
    d = edge_docs(spark)
    assert result(collocations.collocations(d, 2, 50)) == plain([(r.text, r.lang) for r in d.collect()], 2, 50)
    assert result(collocations.collocations(empty_docs(spark))) == []
