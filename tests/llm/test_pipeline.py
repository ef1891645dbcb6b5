"""The pipeline's stages against their operators on the small tables, and run() against plain
Python on a fixture."""

import base64
import hashlib
import random
import re
from collections import Counter

import corpus_pipeline
from riskline.llm import bpe, catalog, decontaminate, neardup, pii, quality
from riskline.sources.tables import read_table
from tests.llm.helpers import prose

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def test_stages(spark, sf):
    docs = read_table(spark, sf, "documents")
    columns = docs.columns
    verdict = {r.doc_id for r in quality.quality_rules(docs).filter("kept").collect()}
    one = corpus_pipeline.quality_rules(spark, docs, sf).cache()
    assert one.columns == columns and {r.doc_id for r in one.collect()} == verdict
    two = corpus_pipeline.near_dedup(spark, one, sf).cache()
    smallest = {r.component_id for r in neardup.near_duplicates(one).collect()}
    assert two.columns == columns and {r.doc_id for r in two.collect()} == smallest
    three = corpus_pipeline.decontamination(spark, two, sf).cache()
    bad = {r.doc_id for r in decontaminate.contaminated(two, read_table(spark, sf, "benchmark")).collect()}
    assert three.columns == columns and {r.doc_id for r in three.collect()} == smallest - bad
    four = corpus_pipeline.personal_data(spark, three, sf).cache()
    assert four.columns == columns and four.count() == three.count()
    assert not any(s.base for r in four.collect() for s in pii.spans(r.text))
    five = {r.doc_id: r for r in corpus_pipeline.token_ids(spark, four, sf).collect()}
    path, pattern = catalog.tokenizer()
    codec = bpe.BytePairCodec(bpe.read_ranks(path), pattern)
    for r in four.collect():
        assert five[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
        assert five[r.doc_id].n_tokens == len(codec.encode(r.text)) // 4
    got = {(r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == {(d, r.ids_sha256) for d, r in five.items()}


# --- run() against plain Python, without the operators ------------------------------------------
def _set(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.translate(ASCII_LOWER))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def _groups(sets, percent):
    """Smallest key of each component of the links, sets by key."""
    label = {k: k for k in sets}
    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if label[a] != label[b] and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((label[a], label[b]))
                label = {k: x if v == y else v for k, v in label.items()}
    return label


def _norm(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ").lower()


def plain_quality(rows):
    """rows of (doc_id, text, host) -> kept rows without their boilerplate lines."""
    texts = {(h, t or "") for _, t, h in rows}
    docs_of = Counter(h for h, _ in texts)
    held = {(h, _norm(x), t) for h, t in texts for x in t.split("\n") if _norm(x)}

    def often(pairs):
        n = Counter((h, x) for h, x, _ in pairs)
        return {k for k, c in n.items() if c >= 20 and (c >= .05 * docs_of[k[0]] or c >= 200)}

    first = often(held)
    some = {t for h, x, t in held if (h, x) in first}
    label = _groups({t: _set(t) for t in some}, 55)
    gone = often({(h, x, label[t]) for h, x, t in held if (h, x) in first})
    out = []
    for i, t, h in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        wins = Counter(tuple(w[j:j + 3]) for j in range(len(w) - 2))
        again = {j + k for j in range(len(w) - 2) if wins[tuple(w[j:j + 3])] > 1 for k in range(3)}
        if len(w) < 50 or 100 * len(again) > 50 * len(w):
            continue
        left = [x for x in t.split("\n") if i is None or (h, _norm(x)) not in gone]
        if sum(len(x.split()) for x in left) >= .3 * len(w):
            out.append((i, "\n".join(left), h))
    return out


def plain_dedup(rows):
    sets = {}
    for i, t, _ in rows:
        if i is not None:
            sets.setdefault(i, _set(t))
    label = _groups(sets, 75)
    return [r for r in rows if r[0] is None or label[r[0]] == r[0]]


def plain_decontaminate(rows, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(ASCII_LOWER))
    runs = lambda w, k: {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    bad = set()
    for item in items:
        w = cut(item or "")
        k = min(5, len(w))
        for i, t, _ in rows:
            if w and i is not None and 4 * len(runs(w, k) & runs(cut(t), k)) >= 3 * len(runs(w, k)):
                bad.add(i)
    return [r for r in rows if r[0] not in bad]


def _fixture():
    rng = random.Random(31)
    foot = [" ".join(f"foot{a}x{b}" for b in range(12)) for a in range(5)]
    host = [(i, prose(rng, 80) + "\n" + "\n".join(foot), "h") for i in range(30)]
    host += [(40, "\n".join(foot) + "\nfive more words are here", "h")]                      # depleted
    base = prose(rng, 120).split()
    copies = []
    for i in range(26):                                                                    # a large group of near copies
        w = list(base)
        for at in rng.sample(range(120), i % 3):
            w[at] = f"edit{i}x{at}"
        copies.append((100 + i, "\n".join(" ".join(w[j:j + 20]) for j in range(0, 120, 20)), "k"))
    item = prose(rng, 25)
    rest = [(200, prose(rng, 60) + " " + item.upper() + ". " + prose(rng, 5), "a"), (201, prose(rng, 70) + " blue heron sings", "a"),
            (202, None, "a"), (203, "", None), (204, "too few words", None), (205, "same words again " * 30, None),
            (206, prose(rng, 400), None), (None, prose(rng, 66), "a"), (None, prose(rng, 67), None),
            (207, prose(rng, 60) + " write to jo.do@example.com or +1 (555) 010-9999 now", "a"), (208, "é ü " + prose(rng, 90), "a")]
    rest += [rest[6], rest[-1], (209, rest[6][1], "b"), (210, "ß" * 300 + " " + prose(rng, 20_000), "a")]
    return host + copies + rest, [item, "Blue  heron, sings", None, "", " .,"]


def test_run_equals_plain_python(spark, tmp_path):
    """Nulls, empty and repeated rows, near copies, depletion, short benchmark items, a long text
    and an extra column, through run() and through plain counts, Jaccard and containment."""
    import tiktoken
    rows, items = _fixture()
    folder = str(tmp_path)
    spark.createDataFrame([(i, t, "en", h, len(t or ""), "x") for i, t, h in rows],
                          "doc_id long, text string, lang string, source string, n_chars long, removed string") \
        .repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    one = plain_quality(rows)
    two = plain_dedup(one)
    three = plain_decontaminate(two, items)
    assert {r[0] for r in rows} - {r[0] for r in one} == {40, 202, 203, 204, 205}
    assert {r[0] for r in two} - {r[0] for r in three} == {200, 201} and 100 in {r[0] for r in three}
    got = corpus_pipeline.run(spark, folder).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in three)
    path, pattern = catalog.tokenizer()
    lines = (x.split() for x in open(path, "rb").read().splitlines() if x)
    enc = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in lines}, special_tokens={})
    want = Counter()
    for i, t, _ in three:
        if i != 207:                        # masked by the classifier
            ids = enc.encode_ordinary(t)
            want[i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(),
                 hashlib.sha256(t.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got if r.doc_id != 207) == want
    masked = next(r for r in got if r.doc_id == 207)
    text = enc.decode(list(masked.ids))
    assert "example.com" not in text and "010-9999" not in text and text.startswith(dict((r[0], r[1]) for r in three)[207][:200])


def test_run_on_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
