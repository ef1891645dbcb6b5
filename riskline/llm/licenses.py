"""License scan by diagonal voting.

All rolling word k-gram hashes of all texts are joined to the places of the same k-grams in
a fixed set of license templates. A hit at word p of a text and word q of a template votes
for the diagonal p - q. Votes are counted per diagonal; neighbouring diagonals of a template
are merged (words inserted or left out shift the diagonal), and a merged span is verified by
the share of the template's places that it covers. The short base phrases are templates that
must be covered whole on one diagonal.

Notices of one family differ in a word (a version, "lesser", "affero"), which a share outvotes.
So from each template of another label that shares half of its k-grams or more, a span must be
told apart: of every run of places whose k-grams the other template does not have, it must cover
one.

Defined results: null or empty text has no words, labels '' and score 0; rows that share a
doc_id are judged each by its own text, a result row per row; an empty table gives an empty
result; only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskline.llm.common import kgrams, plain_words, text_or_empty

K = 3

# Phrases and labels of the contract.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Opening or notice sentences of public licenses.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files the software to deal in the software "
            "without restriction"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this "
                 "file except in compliance with the license"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("lgpl-2", "licensed under the gnu lesser general public license version 2"),
    ("lgpl-3", "licensed under the gnu lesser general public license version 3"),
    ("agpl-3", "licensed under the gnu affero general public license version 3"),
    ("gpl-2", "you can redistribute it and or modify it under the terms of the gnu general public "
              "license as published by the free software foundation either version 2 of the "
              "license or at your option any later version"),
    ("gpl-3", "you can redistribute it and or modify it under the terms of the gnu general public "
              "license as published by the free software foundation either version 3 of the "
              "license or at your option any later version"),
    ("lgpl-2", "you can redistribute it and or modify it under the terms of the gnu lesser general "
               "public license as published by the free software foundation either version 2 of "
               "the license or at your option any later version"),
    ("lgpl-2", "you can redistribute it and or modify it under the terms of the gnu lesser general "
               "public license as published by the free software foundation either version 2 1 of "
               "the license or at your option any later version"),
    ("lgpl-3", "you can redistribute it and or modify it under the terms of the gnu lesser general "
               "public license as published by the free software foundation either version 3 of "
               "the license or at your option any later version"),
    ("agpl-3", "you can redistribute it and or modify it under the terms of the gnu affero general "
               "public license as published by the free software foundation either version 3 of "
               "the license or at your option any later version"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with "
            "or without fee is hereby granted"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)

MIN_COVER = 0.7


def telling_places(k: int = K) -> dict[int, list[list[int]]]:
    """Per template the sets of places of which a span must cover one each: runs of k-grams that
    a template of another label, sharing at least half of this one's, does not have."""
    texts = [*BASE, *TEMPLATES]
    grams = [[" ".join(w[q:q + k]) for q in range(len(w) - k + 1)] for w in (x[1].split() for x in texts)]
    out: dict[int, list[list[int]]] = {}
    for t, own in enumerate(grams):
        sets = []
        for other, theirs in enumerate(grams):
            if len(BASE) <= other != t and texts[other][0] != texts[t][0] \
                    and 2 * len(set(own) & set(theirs)) >= len(set(own)):
                run: list[int] = []
                for q, g in enumerate([*own, None]):
                    if g is not None and g not in theirs:
                        run.append(q)
                    elif run:
                        sets, run = [*sets, run], []
        out[t] = [] if t < len(BASE) else sets
    return out


def template_grams(spark: SparkSession, k: int = K) -> DataFrame:
    """template, label, base, n_grams, slack, telling, gram, q: a few hundred rows, fixed above."""
    rows, telling = [], telling_places(k)
    for t, (label, text, base) in enumerate([(*x, True) for x in BASE]
                                            + [(*x, False) for x in TEMPLATES]):
        w = text.split()
        n = len(w) - k + 1
        rows += [(t, label, base, n, 0 if base else max(1, len(w) // 6), telling[t], " ".join(w[q:q + k]), q)
                 for q in range(n)]
    return spark.createDataFrame(rows, "template int, label string, base boolean, n_grams int, slack int, "
                                       "telling array<array<int>>, gram string, q int")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash (rows that share a doc_id are told apart by it), w."""
    return docs.select("doc_id", text_or_empty().alias("t")).select(
        "doc_id", F.xxhash64("t").alias("text_hash"), plain_words(F.col("t")).alias("w"))


def spans(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, text_hash, template, label, base, first_word, cover, told: merged diagonals with
    their cover, and whether they are told apart from the templates like theirs."""
    t = template_grams(docs.sparkSession, k).withColumn("h", F.xxhash64("gram"))
    # votes are sets, so a repeated row adds none to those of its like
    grams = _keyed(docs).select("doc_id", "text_hash", F.posexplode(kgrams("w", k)).alias("p", "text_gram")) \
        .withColumn("h", F.xxhash64("text_gram"))
    votes = grams.join(F.broadcast(t.drop("telling")), "h").filter("text_gram = gram") \
        .withColumn("diagonal", F.col("p") - F.col("q"))
    lines = votes.groupBy("doc_id", "text_hash", "template", "label", "base", "n_grams", "slack", "diagonal") \
        .agg(F.collect_set("q").alias("places"))
    by = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by) > F.col("slack"), F.lit(True))
    merged = lines.withColumn("new", new.cast("int")).withColumn(
        "span", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    got = merged.groupBy("doc_id", "text_hash", "template", "label", "base", "n_grams", "span").agg(
        F.min("diagonal").cast("long").alias("first_word"),
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))
    # a row per template
    got = got.join(F.broadcast(t.select("template", "telling").dropDuplicates(["template"])), "template")
    return got.select("doc_id", "text_hash", "template", "label", "base", "first_word",
                      (F.size("places") / F.col("n_grams")).alias("cover"),
                      F.forall("telling", lambda x: F.arrays_overlap(x, "places")).alias("told"))


def license_scan(docs: DataFrame, min_cover: float = MIN_COVER) -> DataFrame:
    """One row per row of ``docs``; see the module text and the contract's columns."""
    s = spans(docs)
    whole = F.col("base") & (F.col("cover") == 1)
    found = whole | (~F.col("base") & (F.col("cover") >= min_cover) & F.col("told"))
    names = lambda c: F.array_join(F.sort_array(F.collect_set(F.when(c, F.col("label")))), ",")
    hits = s.groupBy("doc_id", "text_hash").agg(
        F.count(F.when(whole, 1)).alias("n_base"),
        F.min(F.when(whole, F.col("first_word"))).alias("first_word"),
        F.max(F.when(whole, F.col("first_word"))).alias("last_word"),
        names(whole).alias("base_labels"), names(found).alias("labels"),
        F.round(F.max("cover"), 6).alias("score"))
    size = _keyed(docs).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"),
                               F.size("w").cast("long").alias("n_words"))
    out = size.join(hits, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash")), "left")
    empty = lambda c, v: F.coalesce(F.col(c), F.lit(v)).alias(c)
    return out.select(F.col("_id").alias("doc_id"), "n_words", empty("n_base", 0), "first_word",
                      "last_word", empty("base_labels", ""), empty("labels", ""),
                      empty("score", 0.0))
