"""Quality rules: cross-document line frequency per host.

Lines are normalised (white space collapsed, lower case) and hashed; for every host and
line the distinct documents are counted, where rows with the same whole text count as one
document, so that a group of exact copies does not look like boilerplate. Among the texts that hold
such a line, near copies (linked by a Jaccard similarity of 5-word shingles of GROUP_SIMILARITY
or more) count once too, or every member of a large group of them would be depleted: text is
boilerplate if it recurs in documents that differ otherwise. GROUP_SIMILARITY is 0.55, the
similarity of two texts that share 1 - MIN_LEFT of their words; at 0.75, members of a group with
many edits would be no copies and deplete those with few. ``near_copies=False`` counts distinct
whole texts only. A line is boilerplate if at least ``min_docs`` documents and
``min_share`` of the host's distinct texts hold it, or ``enough_docs`` documents whatever the
size of the host (None: the share always counts). Boilerplate lines are removed; a document that keeps less than ``min_left`` of its
words is depleted and rejected, as are documents that fail the base rules.

Defined results: null or empty text has no words and no lines (base_failed); a null host is
a host of its own; repeated rows are judged one by one and give equal rows; rows with a
null doc_id are judged, but lose no lines; an empty table gives an empty result; only doc_id,
text and source are read, other columns are ignored (``clean`` hands them on).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.llm.common import (SHINGLE_WORDS, SPACES, bounded, join_split, packed, stored,
                                 text_or_empty, words)
from riskline.llm.components import components

MIN_DOCS = 20
MIN_SHARE = 0.05
ENOUGH_DOCS = 200
MIN_LEFT = 0.3
MIN_WORDS = 50
SYMBOLS = "[#*$%&|<>]"      # fixed by the contract
GROUP_SIMILARITY = 0.55
BANDS = 16      # two minima each: a pair at 0.55 shares none with probability 0.003, at 0.75 2e-6
SKETCH = 64     # minima compared before full sets
SPLITS = 4      # ways in which a pass after the first one splits a bucket, by two minima each


def base_measures(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = docs.select("doc_id", text_or_empty().alias("t")).select(
        "doc_id", "t", words(F.col("t")).alias("w"))
    lines = F.filter(F.split("t", "\n"), lambda x: F.length(F.regexp_replace(x, SPACES, "")) > 0)
    s = w.select(
        "doc_id", F.xxhash64("t").alias("text_hash"),
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("lines"), _windows(F.col("w")).alias("s"))
    p = s.select("*", _repeated(F.col("s")).alias("p"))
    return p.select(
        "doc_id", "text_hash", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _covered(F.col("p")).cast("long").alias("n_repeat_words"))


def _windows(w):
    """(hash, start) of all 3-word windows, ordered, so that equal windows are neighbours."""
    return F.sort_array(F.when(F.size(w) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"),
                           i.alias("i")))).otherwise(
        F.array().cast("array<struct<h:bigint,i:int>>")))


def _repeated(s):
    """Ordered starts of the windows that occur twice or more."""
    same = lambda j, k: F.coalesce(F.get(s, j)["h"] == F.get(s, k)["h"], F.lit(False))
    at = F.filter(F.when(F.size(s) > 0, F.sequence(F.lit(0), F.size(s) - 1)).otherwise(
        F.array().cast("array<int>")), lambda j: same(j, j - 1) | same(j, j + 1))
    return F.sort_array(F.transform(at, lambda j: F.get(s, j)["i"]))


def _covered(p):
    """Words under windows of three that start at the ordered places ``p``."""
    gaps = F.zip_with(F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0))), F.slice(p, 2, F.size(p)),
                      lambda a, b: F.least(F.lit(3), b - a))
    return F.when(F.size(p) == 0, 0).otherwise(
        F.aggregate(gaps, F.lit(3), lambda x, y: x + y))


def _lines(docs: DataFrame) -> DataFrame:
    """One row per line with a word: doc_id, host, text_hash, line_hash, line_words."""
    d = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("\0")).alias("host"),
                    text_or_empty().alias("t"))
    x = d.select("doc_id", "host", F.xxhash64("t").alias("text_hash"),
                 F.explode(F.split("t", "\n")).alias("line"))
    x = x.select("doc_id", "host", "text_hash",
                 F.lower(F.trim(F.regexp_replace("line", SPACES, " "))).alias("n"))
    return x.filter("n <> ''").select(
        "doc_id", "host", "text_hash", F.xxhash64("n").alias("line_hash"),
        F.size(F.split("n", " ")).alias("line_words"))


def _shingles(w):
    """Distinct hashes of the 5-word windows; fewer words are one shingle."""
    k = SHINGLE_WORDS
    return F.when(F.size(w) >= k, F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.size(w) - k),
        lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)])))).otherwise(
        F.array(F.xxhash64(F.array_join(w, " "))))


def _minima(sets: DataFrame, classes: int) -> DataFrame:
    """``sets`` (text_hash, s in order) with m: the least hash of each of ``classes`` classes (0: none).
    The highest bits of a hash are its class, so in an ordered set a class is a run."""
    shift = 65 - classes.bit_length()
    cls = lambda x: F.shiftrightunsigned(x, shift).cast("int")
    first = sets.select("*", F.filter("s", lambda x, i: (i == 0) | (cls(x) != cls(F.get("s", i - 1)))).alias("f"))
    # f is named twice, or the optimizer would compute it once per class
    m = F.when(F.size("f") > 0, F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda c: F.coalesce(
        F.get(F.filter("f", lambda x: cls(x) == c), F.lit(0)), F.lit(0).cast("long"))))
    return first.select(*sets.columns, m.alias("m"))


def _links(likely: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those pairs of ``likely`` (a written table text_hash, rep and more) whose full shingle sets
    reach ``similarity``."""
    reps = bounded(likely.select("rep").distinct())
    full = sets.select("text_hash", "s")
    other = full.toDF("rep", "r").join(reps, "rep", "left_semi")
    shared = full.join(bounded(likely), "text_hash").join(other, "rep").select(
        *likely.columns, F.size(F.array_intersect("s", "r")).alias("n"), (F.size("s") + F.size("r")).alias("total"))
    percent = round(100 * similarity)
    return shared.filter(100 * F.col("n") >= percent * (F.col("total") - F.col("n"))).select(likely.columns)


def near_groups(docs: DataFrame, texts: DataFrame, similarity: float = GROUP_SIMILARITY) -> DataFrame:
    """text_hash, group of those ``texts`` (a written column text_hash) that are near copies.

    Each band keeps the least shingle hash of two of 2 * BANDS classes of hashes; texts with an
    equal band share a bucket. The first pass compares every text of a bucket with the bucket's
    first text in an order that all buckets share (a hash of the text, so one text is the first of
    many buckets and the pairs are few). The next passes read the buckets that still hold two
    groups. Texts that share no more than a passage meet in such buckets, so a pass splits each of
    them in SPLITS ways by two more minima, of each bucket and pass its own, and compares with the
    first text of every part. Passes end when one finds no link. They cost members times SPLITS,
    never all pairs.

    Texts carry a sketch, a byte of each of SKETCH minima. A linked pair has fewer equal bytes than
    the share asked for less four standard deviations almost never, and most others have fewer; the
    pairs that are left are compared on full sets, which are kept only of texts that share a
    bucket. Components of the links are the groups, so a text need not be like all of its group."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def sets_of(ids: DataFrame) -> DataFrame:
        t = docs.select(text_or_empty().alias("t")).select(F.xxhash64("t").alias("text_hash"), "t") \
            .join(bounded(ids), "text_hash", "left_semi")
        w = t.select("text_hash", words(F.translate("t", upper, upper.lower())).alias("w"))
        return w.select("text_hash", F.sort_array(_shingles(F.col("w"))).alias("s"))

    # texts are made smaller before their rows are compared
    minima = stored(_minima(sets_of(texts), 2 * BANDS).drop("s").dropDuplicates(["text_hash"]), "line-minima")
    bucket = lambda i: F.xxhash64(i, F.get("m", 2 * i), F.get("m", 2 * i + 1))
    bands = minima.select("text_hash", F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), bucket)).alias("bucket"))
    shared = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    members = packed(stored(join_split(bands, shared, ["bucket"]), "near-buckets"))
    ids = packed(stored(members.select("text_hash").distinct(), "near-texts"))
    sketch = F.transform("m", lambda x: x.bitwiseAND(F.lit(127)).cast("tinyint"))
    sets = stored(_minima(sets_of(ids).dropDuplicates(["text_hash"]), SKETCH).withColumn("m", sketch), "line-shingles")
    own = packed(stored(sets.select("text_hash", "m").join(bounded(members), "text_hash")
                        .withColumn("group", F.col("text_hash")), "near-open"))
    groups = ids.select("text_hash", F.col("text_hash").alias("group"))
    enough = max(1, int(SKETCH * similarity - 4 * (SKETCH * similarity * (1 - similarity)) ** .5))
    alike = F.size(F.filter(F.zip_with("m", "rep_m", lambda x, y: x == y), lambda e: e))
    turn, n_links = 0, 1
    while n_links or turn == 1:
        if turn:
            buckets = own.groupBy("bucket").agg(F.min("group").alias("lo"), F.max("group").alias("hi")) \
                .filter("lo < hi").drop("lo", "hi")
            own = packed(stored(join_split(own, buckets, ["bucket"]), "near-open"))
            at = lambda i, k: F.get("m", F.pmod(F.xxhash64("bucket", F.lit(SPLITS * turn) + i, F.lit(k)), F.lit(SKETCH)).cast("int"))  # noqa: B023, E731
            part = F.explode(F.transform(F.sequence(F.lit(1), F.lit(SPLITS)), lambda i: F.xxhash64("bucket", i, at(i, 0), at(i, 1))))
            order = F.xxhash64("text_hash", "part", F.lit(turn))
        else:
            part, order = F.col("bucket"), F.xxhash64("text_hash", F.lit(turn))
        parts = own.select("text_hash", "group", "m", part.alias("part"))
        first = parts.groupBy("part").agg(F.min("group").alias("lo"), F.max("group").alias("hi"), F.min_by(F.struct(
            F.col("text_hash").alias("rep"), F.col("group").alias("rep_group"), F.col("m").alias("rep_m")), order).alias("r")) \
            .filter("lo < hi").select("part", "r.*")
        pairs = join_split(parts, first, ["part"]).filter(F.col("group") != F.col("rep_group")).filter(alike >= enough)
        likely = packed(stored(pairs.select("text_hash", "rep", "group", "rep_group").distinct(), "near-likely"))
        links = packed(stored(_links(likely, sets, similarity), "near-links"))
        n_links = links.count()
        if n_links:
            joined = bounded(packed(stored(components(links, "group", "rep_group", pack=True)
                                           .withColumnRenamed("node", "group"), "near-joined")))
            merged = lambda t: join_split(t, joined, ["group"], "left").withColumn(  # noqa: B023, E731
                "group", F.coalesce("component", "group")).drop("component")
            own = merged(own)
            groups = packed(stored(merged(groups).select("text_hash", "group"), "near-groups"))
        turn += 1
    return groups


def boilerplate(docs: DataFrame, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE,
                enough_docs: int | None = ENOUGH_DOCS, near_copies: bool = True,
                lines: DataFrame | None = None) -> DataFrame:
    """host, line_hash, n_docs of the lines above the limits. ``lines``: those of ``docs``, written."""
    lines = stored(_lines(docs), "all-lines") if lines is None else lines
    # a line has at least as many rows as distinct texts: most lines need no distinct texts
    many = stored(lines.groupBy("host", "line_hash").agg(F.count(F.lit(1)).alias("n"))
                  .filter(F.col("n") >= min_docs).drop("n"), "many-lines")
    held = stored(lines.join(bounded(many), ["host", "line_hash"], "left_semi")
                  .select("host", "line_hash", "text_hash").distinct(), "held")
    hosts = docs.select(F.coalesce(F.col("source").cast("string"), F.lit("\0")).alias("host"),
                        F.xxhash64(text_or_empty()).alias("text_hash")).distinct() \
        .groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    hosts = stored(hosts, "hosts")

    def often(count) -> DataFrame:
        counts = count.groupBy("host", "line_hash").agg(F.count(F.lit(1)).alias("n_docs")) \
            .filter(F.col("n_docs") >= min_docs)
        high = F.col("n_docs") >= min_share * F.col("host_docs")
        if enough_docs is not None:
            high = high | (F.col("n_docs") >= enough_docs)
        return counts.join(hosts, "host").filter(high).select("host", "line_hash", "n_docs")

    if not near_copies:
        return often(held)
    # near copies only lower a count, so lines below the limits need no second look
    above = stored(often(held), "lines").drop("n_docs")
    held = stored(held.join(bounded(above), ["host", "line_hash"]), "held")
    groups = near_groups(docs, stored(held.select("text_hash").distinct(), "texts"))
    return often(held.join(groups, "text_hash", "left").select(
        "host", "line_hash", F.coalesce("group", "text_hash").alias("text_hash")).distinct())


def removed_lines(docs: DataFrame, **limits) -> DataFrame:
    """doc_id, text_hash, removed (set of line hashes), n_removed_words per touched text."""
    lines = stored(_lines(docs), "all-lines")
    above = stored(boilerplate(docs, lines=lines, **limits), "boilerplate")
    hit = lines.join(bounded(above), ["host", "line_hash"]).groupBy("doc_id", "host", "text_hash", "line_hash").agg(
        F.first("line_words").alias("line_words"), F.count(F.lit(1)).alias("times"))
    # rows that repeat a doc_id and text count their lines together; the share stays the same
    return hit.groupBy("doc_id", "text_hash").agg(
        F.collect_set("line_hash").alias("removed"),
        F.sum(F.col("line_words") * F.col("times")).alias("gone"))


def judged(docs: DataFrame, min_left: float = MIN_LEFT, **limits) -> DataFrame:
    """Measures and verdict per distinct (doc_id, text_hash), with the set of line hashes to
    remove (null: none) and the number of rows (copies) it stands for."""
    base = base_measures(docs)
    rows = base.groupBy("doc_id", "text_hash").agg(
        F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")])
    out = rows.join(removed_lines(docs, **limits), ["doc_id", "text_hash"], "left")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - F.coalesce(F.expr("gone div copies"), F.lit(0))
    return out.select("doc_id", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", failed.alias("base_failed"),
                      (~failed & (left >= min_left * F.col("n_words"))).alias("kept"),
                      left.alias("n_words_left"), "removed", "copies")


def quality_rules(docs: DataFrame, **limits) -> DataFrame:
    """Base measures and verdict per row of ``docs``; see the module text."""
    out = judged(docs, **limits).drop("text_hash", "removed")
    return out.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))) \
        .drop("copies")


def clean(docs: DataFrame, **limits) -> DataFrame:
    """The kept documents without their boilerplate lines, all columns of ``docs``."""
    good = judged(docs, **limits).filter("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("removed").alias("_removed"))
    own = docs.select(F.struct("*").alias("_row"), F.xxhash64(text_or_empty()).alias("_own"))
    j = own.join(good, F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_hash")))
    norm = lambda x: F.lower(F.trim(F.regexp_replace(x, SPACES, " ")))
    text = F.when(F.col("_removed").isNull(), F.col("_row.text")).otherwise(F.array_join(F.filter(
        F.split("_row.text", "\n"),
        lambda x: ~F.array_contains(F.col("_removed"), F.xxhash64(norm(x)))), "\n"))
    j = j.select("_row", "_removed", text.alias("_text"))
    new = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("_removed").isNull(), F.col("_row.n_chars")).otherwise(
            F.length("_text")).cast(docs.schema["n_chars"].dataType)
    return j.select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
