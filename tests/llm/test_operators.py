"""Operators against brute force on edge rows; empty tables give empty results."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from riskline.llm import decontaminate, licenses, neardup, pii, quality, subdedup, toxicity, urlfilter, warc
from riskline.llm.components import components
from tests.llm.helpers import edge_docs, edge_texts, empty_docs, prose, words


@pytest.fixture(scope="module")
def docs(spark):
    return edge_docs(spark).cache()


def test_quality_base_measures(docs):
    got = {(r.doc_id): r for r in quality.quality_rules(docs).collect()}
    assert quality.quality_rules(docs).count() == docs.count()
    for i, t in enumerate(edge_texts()):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        seen, dup = set(), 0
        for line in (t or "").split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        wins = [tuple(w[j:j + 3]) for j in range(len(w) - 2)]
        many = {x for x in wins if wins.count(x) > 1} if len(wins) < 3000 else \
            {x for x, n in __import__("collections").Counter(wins).items() if n > 1}
        under = {j + k for j, x in enumerate(wins) if x in many for k in range(3)}
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), dup, len(under)), i
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", t or ""))
        assert r.base_failed == (len(w) < 50 or 100 * len(under) > 50 * len(w))


def test_quality_boilerplate_and_copies(spark):
    """Lines on many different documents go and depleted documents are rejected; a group of
    exact copies is not boilerplate; clean keeps extra columns."""
    import random
    rng = random.Random(5)
    legal = " ".join(f"right{j}" for j in range(90))
    rows = [(i, prose(rng, 100) + "\n" + legal) for i in range(30)]
    rows += [(100 + i, legal + "\nshort end") for i in range(2)]
    rows += [(200 + i, "a text that was copied " * 2 + " ".join(f"c{j}" for j in range(60))) for i in range(40)]
    d = spark.createDataFrame([(i, t, "host", len(t), "x", "y") for i, t in rows],
                              "doc_id long, text string, source string, n_chars int, removed string, _hash string")
    got = {r.doc_id: r for r in quality.quality_rules(d).collect()}
    assert all(got[i].kept and got[i].n_words_left == 100 for i in range(30))
    assert not got[100].kept and not got[101].kept and not got[100].base_failed
    assert all(got[200 + i].kept for i in range(40))
    out = {r.doc_id: r for r in quality.clean(d).collect()}
    assert set(out) == set(range(30)) | set(range(200, 240))
    assert "right1" not in out[0].text and out[0].n_chars == len(out[0].text) and out[0].removed == "x"


def test_quality_keeps_near_copies(spark):
    """Lines of near copies are not boilerplate, whatever line each copy has edited; a footer
    of the same host still goes."""
    import random
    rng = random.Random(15)
    foot = "all rights reserved by the owner of this site"
    rows = []
    for group, n_lines in enumerate((12, 3)):
        base = [[f"g{group}x{i}w{j}" for j in range(240 // n_lines)] for i in range(n_lines)]
        for copy in range(100):
            lines = [list(x) for x in base]
            lines[copy % n_lines][rng.randrange(240 // n_lines)] = f"edit{copy}"
            rows.append((1000 * group + copy, "\n".join(map(" ".join, lines))))
    rows += [(5000 + i, prose(rng, 80) + "\n" + foot) for i in range(60)]
    d = spark.createDataFrame([(i, t, "host") for i, t in rows], "doc_id long, text string, source string")
    out = {r.doc_id: r.text for r in quality.clean(d).collect()}
    text = dict(rows)
    assert set(out) == set(text)
    assert all(out[i] == (t if i < 5000 else t[:-len(foot) - 1]) for i, t in rows)
    assert {r.doc_id for r in neardup.keep_one(quality.clean(d)).collect()} == {0, 1000} | set(range(5000, 5060))


def _families(rng):
    """Families of texts with 0 to 12 random edits in 240 words over 12 lines, and other pages."""
    rows = []
    for family in range(2):
        base = [f"f{family}w{j}" for j in range(240)]
        for copy in range(150):
            w = list(base)
            for at in rng.sample(range(240), rng.randrange(13)):
                w[at] = f"e{rng.randrange(10**9)}"
            rows.append((1000 * family + copy, "\n".join(" ".join(w[i:i + 20]) for i in range(0, 240, 20))))
    return rows + [(5000 + i, prose(rng, 80)) for i in range(40)]


def test_quality_varied_near_copies(spark):
    """Groups by few chosen members equal those of all pairs; no member of a family is lost."""
    import random
    rows = _families(random.Random(21))
    d = spark.createDataFrame([(i, t, "host") for i, t in rows], "doc_id long, text string, source string")
    sets = {i: {tuple(w[j:j + 5]) for j in range(len(w) - 4)} for i, t in rows for w in [t.split()]}
    links = {(a, b) for a in sets for b in sets if a < b and a // 1000 == b // 1000
             and 100 * len(sets[a] & sets[b]) >= 55 * len(sets[a] | sets[b])}
    label = {i: i for i in sets}
    for a, b in sorted(links):
        x, y = label[a], label[b]
        if x != y:
            label = {i: min(x, y) if v in (x, y) else v for i, v in label.items()}
    own = d.select("doc_id", F.xxhash64("text").alias("text_hash"))
    texts = own.select("text_hash").distinct()
    got = {r.doc_id: r.group for r in own.join(quality.near_groups(d, texts), "text_hash").collect()}
    group_of = lambda i: got.get(i, ("alone", i))
    joined = sum(group_of(a) == group_of(b) for a, b in links) / len(links)
    assert joined >= .99, joined
    for a in sets:                                        # and nothing is joined that no chain links
        for b in (0, 1000, 77, 1077):
            if group_of(a) == group_of(b):
                assert label[a] == label[b]
    kept = {r.doc_id for r in quality.clean(d).collect()}
    assert kept == set(sets)


def test_quality_passes_shrink(spark, monkeypatch):
    """Once a bucket's texts are one group no later pass reads them, and full sets are kept only
    of texts that share a bucket."""
    import random
    rng = random.Random(22)
    rows = [(i, " ".join(f"a{j}" if j != 5 * (i % 40) else f"e{i}" for j in range(240))) for i in range(80)]
    rows += [(1000 + i, prose(rng, 80)) for i in range(60)]
    d = spark.createDataFrame([(i, t, "host") for i, t in rows], "doc_id long, text string, source string")
    texts = quality.stored(d.select(F.xxhash64("text").alias("text_hash")), "t")
    n, plain = {}, quality.stored

    def counted(df, name):
        out = plain(df, name)
        n.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(quality, "stored", counted)
    family = d.filter("doc_id < 1000").select(F.xxhash64("text").alias("text_hash"))
    got = quality.near_groups(d, texts).join(family, "text_hash")
    assert got.count() == 80 and got.select("group").distinct().count() == 1
    assert n["near-open"][0] > 500 and n["near-open"][-1] < 50
    assert 80 <= n["line-shingles"][0] < 100


def test_quality_passes_follow_rows(spark, monkeypatch):
    """Passes over few rows write few files, however many partitions a shuffle has."""
    import random
    rows = _families(random.Random(23))
    d = spark.createDataFrame([(i, t, "host") for i, t in rows], "doc_id long, text string, source string")
    texts = quality.stored(d.select(F.xxhash64("text").alias("text_hash")), "t")
    files, plain = {}, quality.stored

    def counted(df, name):
        out = plain(df, name)
        files.setdefault(name, []).append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(quality, "stored", counted)
    settings = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert quality.near_groups(d, texts).count() > 250
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    later = [n for k in ("near-texts", "near-likely", "near-joined", "near-groups") for n in files[k]]
    assert max(later) == 1 and max(files["near-open"][1:]) == 1, files


def test_quality_hot_host(spark):
    """A footer on 1 % of a hot host's documents goes; a line on fewer than 200 of them stays."""
    body = "array_join(transform(sequence(1, 60), j -> concat('w', id, 'x', j)), ' ')"
    d = spark.range(21_000).selectExpr(
        "id AS doc_id", "'hot' AS source", f"concat({body}, CASE WHEN id % 100 = 0 THEN '\nall rights reserved here' "
        "WHEN id % 200 = 1 THEN '\nthe end of it' ELSE '' END) AS text")
    n = {r.source: (r.a, r.b, r.n) for r in quality.clean(d).groupBy("source").agg(*map(F.expr, (
        "count_if(text LIKE '%reserved%') AS a", "count_if(text LIKE '%the end%') AS b", "count(1) AS n"))).collect()}
    assert n == {"hot": (0, 105, 21_000)}


def test_substring_repeats(docs):
    rows = docs.select("doc_id", "text").collect()
    first: dict = {}
    by = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        w = by[r.doc_id] = words(r.text)
        for i in range(len(w) - 12):
            first.setdefault(tuple(w[i:i + 13]), r.doc_id)
    for r in subdedup.remove_repeats(docs).collect():
        w = by[r.doc_id]
        gone = {i + j for i in range(len(w) - 12) if first[tuple(w[i:i + 13])] < r.doc_id for j in range(13)}
        kept = [x for i, x in enumerate(w) if i not in gone]
        assert (r.n_words, r.n_removed) == (len(w), len(gone))
        assert r.kept_sha256 == hashlib.sha256(b" ".join(kept)).hexdigest()


def test_longest_repeats(spark):
    import random
    rng = random.Random(2)
    shared = prose(rng, 60)
    d = spark.createDataFrame([(1, shared + " a b c"), (2, "x y " + shared), (3, prose(rng, 90))],
                              "doc_id long, text string")
    got = {(r.doc_id, r.start, r.length) for r in subdedup.longest_repeats(d, 13).collect()}
    want = [(i, 52 if i < 9 else 26 if i < 35 else 13) for i in range(48)]
    assert got == {(1, i, n) for i, n in want} | {(2, 2 + i, n) for i, n in want}


def _sets(rows):
    for r in rows:
        w = words(r.text, True)
        if len(w) >= 5:
            yield r.doc_id, frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        else:
            yield r.doc_id, frozenset([tuple(w)] if w else [])


def test_near_duplicates(docs):
    sets = dict(_sets(docs.select("doc_id", "text").collect()))
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= 75 * len(sets[a] | sets[b]):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (
            len(sets[r.doc_id]), find(r.doc_id), find(r.doc_id) == r.doc_id)
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d in sets if find(d) == d}


def test_estimate_is_collision_corrected():
    import numpy as np
    rng = np.random.default_rng(3)
    for j in (0.2, 0.5, 0.75, 0.9):
        n = 4000
        both = int(n * 2 * j / (1 + j))
        pool = rng.integers(0, 2**63, 2 * n - both, dtype=np.uint64)
        sig = [neardup.pack(neardup.minima(np.unique(x))[None])[0] for x in (pool[:n], pool[n - both:])]
        assert abs(float(neardup.estimate(*sig)) - j) < 0.2


def test_blocks_and_groups_keep_all_links(docs, monkeypatch):
    """Small blocks split buckets and groups over several tasks; the result stays the same."""
    want = sorted(map(tuple, neardup.near_duplicates(docs).collect()))
    monkeypatch.setattr(neardup, "BLOCK", 3)
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 200)
    assert sorted(map(tuple, neardup.near_duplicates(docs).collect())) == want


def test_components_of_a_long_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components(e, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_decontamination(spark):
    import random
    rng = random.Random(9)
    items = [(i, prose(rng, 20 + i)) for i in range(8)] + [(90, None), (91, " ,; "), (92, "")]
    docs = [(i, prose(rng, 3000) + " " + items[i][1].upper() + ". " + prose(rng, 5)) for i in range(8)]
    half = items[3][1].split()
    docs += [(20, prose(rng, 500)), (21, None), (22, ""), (23, " ".join(half[:10])), (0, docs[0][1])]
    d = spark.createDataFrame([(*x, "k", 1) for x in docs], "doc_id long, text string, shingle string, h int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(d, b).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(i, i) for i in range(8)}
    assert all(r.containment == 1 for r in got)
    assert {r.doc_id for r in decontaminate.clean(d, b).collect()} == {20, 21, 22, 23}
    assert decontaminate.contaminated(d, b.limit(0)).count() == 0


def test_decontamination_finds_items_of_few_words(spark):
    items = [(1, "Forty-two"), (2, "the blue heron sings"), (3, "heron"), (4, "a b c d e"), (4, "x"), (None, "null id")]
    docs = [(1, "He said: forty two, twice. Forty two."), (2, "so the Blue HERON sings."), (3, "the blue heron, it sings"),
            (4, "herons"), (5, "a b c d"), (6, "a b c d e"), (7, "x"), (None, "heron"), (8, None), (9, "null id")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in decontaminate.contaminated(d, b).collect())
    # item 4 has two rows: its set holds both shingles, and one of two is less than 0.75
    assert got == [(1, 1, 1, 1), (2, 2, 1, 1), (2, 3, 1, 1), (3, 3, 1, 1)]


def test_decontamination_reads_whole_item_sets_for_candidates_only(spark):
    """Documents that hold item shingles outside every sketch are no candidates."""
    import random
    rng = random.Random(3)
    items = [(i, prose(rng, 400)) for i in range(6)]
    docs = [(i, " ".join(items[i % 6][1].split()[7 * i:7 * i + 9])) for i in range(40)]      # slices of items
    docs += [(100 + i, "x " + t) for i, t in items]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    sets = decontaminate.sketches(decontaminate.shingles(b, "item_id", [5]).distinct(), .75).cache()
    pairs = {(r.doc_id, r.item_id) for r in decontaminate.candidates(d, sets, [5]).collect()}
    whole = {(r.doc_id, r.item_id) for r in decontaminate.shingles(d, "doc_id", [5]).join(
        sets.select("item_id", "h"), "h").select("doc_id", "item_id").distinct().collect()}
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(d, b).collect()}
    assert found == {(100 + i, i) for i in range(6)} and found <= pairs < whole


def test_license_places(docs):
    got = {r.doc_id: r for r in licenses.license_scan(docs).collect()}
    for i, t in enumerate(edge_texts()):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = [(j, label) for label, phrase in licenses.BASE for j in range(len(w))
              if w[j:j + len(phrase.split())] == phrase.split()]
        r = got[i]
        assert (r.n_words, r.n_base) == (len(w), len(at)), i
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in at}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
        assert 0 <= r.score <= 1


def test_license_rows_that_share_an_id(spark):
    rows = [(1, "under the mit license"), (1, "cc by nc and more words here"), (1, "under the mit license"), (None, "cc by nc")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_words, r.n_base, r.labels) for r in licenses.license_scan(d).collect())
    assert got == [("1", 4, 1, "mit"), ("1", 4, 1, "mit"), ("1", 7, 1, "cc-by-nc"), ("None", 3, 1, "cc-by-nc")]


def test_license_versions_and_families_are_told_apart(spark):
    short = "Licensed under the GNU {}General Public License, version {}."
    long = ("You can redistribute it and/or modify it under the terms of the GNU {}General Public License as published "
            "by the Free Software Foundation, either version {} of the License, or (at your option) any later version.")
    kinds = [("gpl-2", "", "2"), ("gpl-3", "", "3"), ("lgpl-3", "Lesser ", "3"), ("agpl-3", "Affero ", "3"),
             ("lgpl-2", "Lesser ", "2"), ("lgpl-2", "Lesser ", "2.1")]
    rows = [(i, "This program " + form.format(k, v) + " See the file.", label)
            for i, (form, (label, k, v)) in enumerate((f, x) for f in (short, long) for x in kinds)]
    rows.append((99, "licensed under the gnu general public license", ""))      # no version: no label
    d = spark.createDataFrame(rows, "doc_id long, text string, label string")
    got = {r.doc_id: r.labels for r in licenses.license_scan(d).collect()}
    assert got == {i: label for i, _, label in rows}


def test_license_templates_with_edits(spark):
    t = dict(licenses.TEMPLATES)
    bsd = t["bsd"].split()
    edited = " ".join(bsd[:6] + ["also"] + bsd[6:])
    d = spark.createDataFrame([(1, "x y " + t["mit"] + " z"), (2, edited), (3, "use this software")],
                              "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.license_scan(d).collect()}
    assert got == {1: "mit", 2: "bsd", 3: ""}


def test_url_filter_edges(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://"), (4, "HTTP://WWW.Spam-Farm.example.org:80/a/?utm_x=1&b=2#t"),
            (5, "https://spam-farm.example.org/a?b=2"), (6, "http://x.net/"), (7, "http://x.net"),
            (8, "http://a.example.net/en/1"), (9, "http://example.com/de/"), (10, "http://EXAMPLE.org/fr/?q"),
            (4, "HTTP://WWW.Spam-Farm.example.org:80/a/?utm_x=1&b=2#t")]
    p = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, block int")
    listed = spark.createDataFrame([("spam-farm.example.org/a?b=2",), (None,)], "canonical string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, r.listed) for r in urlfilter.url_filter(p, listed).collect()}
    assert got[1] == ("", "", None, "allow", False) == got[2] == got[3]
    assert got[4] == ("www.spam-farm.example.org:80", "/a/", None, "block", True)
    assert got[5][3:] == ("block", True)
    assert got[6][2:4] == ("net/", "block") and got[7][2:4] == (None, "allow")
    assert got[8][2:4] == ("example.net/en/", "allow") and got[9][2:4] == ("example.com/de/", "block")
    assert got[10][:4] == ("example.org", "/fr/", "org/fr/", "allow")
    assert urlfilter.url_filter(p, listed).count() == len(rows)
    assert urlfilter.url_filter(p.limit(0), listed.limit(0)).count() == 0


def test_bloom_has_no_false_negatives_and_few_false_hits(spark):
    from pyspark.sql import functions as F
    listed = spark.range(5000).select(F.concat(F.lit("h/"), "id").alias("canonical"))
    bloom = urlfilter.bloom_filter(listed, 256)
    assert bloom.count() <= 256
    both = spark.range(20000).select(F.concat(F.lit("h/"), "id").alias("canonical"), "id")
    hit = " AND ".join(f"w{i} & m{i} = m{i}" for i in range(4))
    n = urlfilter.with_bits(both, 256).join(bloom, "block").filter(hit).groupBy(
        (F.col("id") < 5000).alias("own")).count().collect()
    n = {r.own: r["count"] for r in n}
    assert n[True] == 5000 and n.get(False, 0) < 600


def test_url_filter_without_a_broadcast(spark):
    """A filter beyond the broadcast bound gives the same rows through a join by block."""
    rows = [(i, f"https://h{i % 90}.example/p{i}") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    listed = urlfilter.parts(pages.filter("page_id % 3 = 0")).select(urlfilter.canonical().alias("canonical"))
    a, b = (sorted(map(tuple, urlfilter.url_filter(pages, listed, max_blocks=m).collect())) for m in (1 << 18, 1))
    assert a == b and len(a) == 400


def test_warc_round_trip(spark):
    import base64
    big = "päge " * 60_000
    rows = [(1, "u1", "same"), (2, "u2", "same"), (3, "u3", None), (4, "u\r\n4", ""), (5, "u5", big),
            (6, None, "a\r\n\r\nWARC/1.1\r\n"), (7, "u7", big), (7, "u7", big), (None, "u8", "alone")]
    p = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, tag string")
    every = warc.archive_round_trip(spark, p).collect()
    got = {r.page_id: r for r in every}
    assert len(every) == 9 and len(got) == 8            # a record per row, also for equal rows
    assert [r.record_type for r in every if r.page_id == 7] == ["response"] * 2
    for i, _, html in rows:
        data = (html or "").encode()
        assert got[i].payload_bytes == len(data)
        assert got[i].payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert got[i].digest_ok in (True, None)
    assert {i: got[i].refers_to for i in got if got[i].record_type == "revisit"} == {1: 2, 3: 4, 5: 7}
    assert warc.archive_round_trip(spark, p.limit(0)).count() == 0


def test_warc_chunks_carry_digests(spark, tmp_path):
    p = spark.createDataFrame([(1, "u", "x" * 200_000)], "page_id long, url string, html string")
    m = warc.write_archives(p, f"file://{tmp_path}/w")
    rows = warc.read_archives(m, f"file://{tmp_path}/w").orderBy("chunk_no").collect()
    assert len(rows) > 3 and [r.last for r in rows] == [False] * (len(rows) - 1) + [True]
    h = hashlib.sha1()
    for r in rows:
        h.update(r.data)
        assert r.payload_digest == warc.digest_text(h)
    assert rows[-1].payload_bytes == 200_000


BASE = [(0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), (1, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        (2, r"[0-9]([\x20-]?[0-9])+"), (3, r"\+[0-9][\x20().0-9-]+[0-9]")]


def _base_spans(text):
    for kind, pattern in BASE:
        for m in re.finditer(pattern, text):
            s, d = m.group(), re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(x) > 255 for x in s.split(".")):
                continue
            if kind == 2 and not (13 <= len(d) <= 19 and pii.luhn(d)):
                continue
            if kind == 3 and not 9 <= len(d) <= 15:
                continue
            yield kind, *m.span()


def test_personal_data(docs, spark, sf):
    import random
    rng = random.Random(4)
    parts = list("0123456789....  --()++@@ab_é") + ["12.3.4.5", "555-123-4567", "4111111111111111", "a@b.co"]
    texts = edge_texts() + ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(3000)]
    for t in texts:
        found = pii.spans(t or "")
        assert [(s.kind, s.start, s.end) for s in found if s.base] == sorted(_base_spans(t or "")), t
    got = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    for i, t in enumerate(edge_texts()):
        base = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in sorted(_base_spans(t or "")))
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) <= set(got[i].spans.split(",")) | {""}
    masked = pii.mask(docs)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    text = {r.doc_id: r.text for r in masked.collect()}
    assert text[0] is None and "[EMAIL]" in text[29] and "@" not in text[29] and "[CARD]" in text[29]


def test_long_secrets_are_masked_whole(spark):
    import random
    rng = random.Random(12)
    chars = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    key = lambda n: "".join(rng.choice(chars) for _ in range(n))
    values = [key(300), key(36) + "." + key(150) + "." + key(43), key(40) + "x4111111111111111x" + key(40), key(24)]
    rows = [(i, f"The api_key={v}, was sent. Ask for it.") for i, v in enumerate(values * 10)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.text for r in pii.mask(d).collect()} == {"The api_key=[SECRET], was sent. Ask for it."}


def test_reliabilities_find_the_bad_labeler():
    import numpy as np
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.4
    right = [0.9, 0.99, 0.85, 0.5, 0.8]
    votes = np.stack([np.where(rng.random(4000) < r, truth, ~truth) for r in right], axis=1).astype(int)
    pattern, n = np.unique(votes, axis=0, return_counts=True)
    p, table = pii.reliabilities(pattern, n)
    own = {tuple(x): q for x, q in zip(pattern, p)}
    assert np.mean([(own[tuple(v)] > 0.5) == t for v, t in zip(votes, truth)]) > 0.95
    assert abs(table[3, 1, pii.YES] - 0.5) < 0.1 < table[0, 1, pii.YES] - 0.5


def test_toxicity_pairs_and_edges(spark):
    """Held-out accuracy where only the pair of insult and group is toxic."""
    import random
    import zlib
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(1500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        extra = (["scumbag"] if a else []) + (["neighbours"] if b else [])
        w = [f"w{rng.randrange(200)}" for _ in range(30)] + extra
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, int(a and b)))
    rows += [(2000, None), (2001, ""), (2002, "scumbag neighbours"), (2002, "scumbag neighbours")]
    labels += [(2000, None), (9999, 1)]
    d = spark.createDataFrame([(*r, 0.5, 1) for r in rows], "doc_id long, text string, score double, toxic int")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.toxicity_scores(d, lab).collect()
    assert len(got) == len(rows)
    own = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id < 1500]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.predicted == own[r.doc_id] for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in got)
    same = toxicity.toxicity_scores(d.limit(3), lab.limit(0)).collect()
    assert all(r.score < 0.5 for r in same)


def test_toxicity_terms_that_tell_only_in_pairs(spark):
    """Neither mention nor insult separates the labels, only the pair; and 500 other insults
    that are each on few documents."""
    import random
    rng = random.Random(8)
    name = lambda n: "".join(chr(97 + int(c)) for c in f"{n:04d}")
    rows, labels = [], []
    for i in range(4000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        w = [name(rng.randrange(800)) for _ in range(30)] + ["scum"] * a + ["folk"] * b
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, int(a == b)))
    held = lambda got: [r for r in got if r.held_out]
    schema = "doc_id long, text string"
    got = held(toxicity.toxicity_scores(spark.createDataFrame(rows, schema),
                                        spark.createDataFrame(labels, "doc_id long, toxic int")).collect())
    assert sum(r.predicted == dict(labels)[r.doc_id] for r in got) / len(got) > 0.95
    rare = [(i, " ".join(["q" + name(i // 2 % 500)] * (i % 2) + [name(rng.randrange(800)) for _ in range(30)]))
            for i in range(12_000)]
    got = held(toxicity.toxicity_scores(spark.createDataFrame(rare, schema), spark.createDataFrame(
        [(i, i % 2) for i, _ in rare], "doc_id long, toxic int")).collect())
    assert sum(r.predicted == r.doc_id % 2 for r in got) / len(got) > 0.95


def test_empty_tables(spark):
    e = empty_docs(spark)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    for out in (quality.quality_rules(e), quality.clean(e), subdedup.remove_repeats(e), neardup.near_duplicates(e),
                licenses.license_scan(e), pii.personal_data(e), pii.mask(e), toxicity.toxicity_scores(e, labels),
                decontaminate.contaminated(e, spark.createDataFrame([], "item_id long, text string"))):
        assert out.count() == 0
