"""Exact substring de-duplication by level-wise doubling.

A run of ``length`` words can repeat only if its parts repeat. Level one takes runs of half
the length and hashes, of every ``length``-word window, one of them: the smallest hash in it
(equal windows choose equal parts, so nothing is lost, while about a quarter of the places
is shuffled). Windows whose part occurs in one document only are dropped there. Level two
doubles the surviving parts to the full length (a last step shorter than double overlaps
itself) and finds, per window, the smallest doc_id that holds it. ``longest_repeats`` goes
on doubling until no candidate survives.

Documents whose whole word sequence equals that of a smaller doc_id are known from a 128-bit
key of the sequence; all their windows start there too, so they take no part in the levels.
Window keys have 64 bits.

Each step ends in a written table, whose shuffles are then removed, so the disk in use is that
of the largest step. Counts per key are combined before the shuffle, and survivors are joined back by shuffle
joins that Spark can split, so a passage that a third of all documents share makes no long
task.

Defined results: null and empty texts have no words; a text of fewer words than a window
holds none; a row with a null doc_id keeps all words and removes none elsewhere; rows that
share a doc_id are one document, covered places are pooled by word number; an empty table
gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from functools import partial
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.llm.common import join_split, small_batches, stored, text_or_empty
from riskline.llm.textops import Words, mix, signed, word_runs

WINDOW = 13
_MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)


def _sequences(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for w in word_runs(b["text"]):
            n = w.counts()
            key = signed(w.sequence_keys())
            long = n >= length
            ids = b["doc_id"].slice(w.row0, w.rows).filter(pa.array(long))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(key[long, 0]), pa.array(key[long, 1])], names=["doc_id", "k0", "k1"])


def _doc_of(w: Words) -> np.ndarray:
    return np.repeat(np.arange(w.rows), w.counts())


def _parts(w: Words, part: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of the chosen part of every window, the window's start, its row."""
    h, _ = w.windows(part)
    n = len(w.hashes) - length + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none
    chosen = h[:n].copy()
    for j in range(1, length - part + 1):
        np.minimum(chosen, h[j:n + j], out=chosen)
    _, whole = w.windows(length)
    start = np.flatnonzero(whole)
    return chosen[start], start, _doc_of(w)[start]


def _part_rows(batches: Iterator[pa.RecordBatch], part: int, length: int) -> Iterator[pa.RecordBatch]:
    """Distinct (part hash, doc_id) of every document."""
    for b in batches:
        ids = b["doc_id"].to_numpy(zero_copy_only=False)
        for w in word_runs(b["text"]):
            h, _, row = _parts(w, part, length)
            if len(h):
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                h, row = h[new], row[new]
                order = np.lexsort((h, row))
                h, row = h[order], row[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(h[new])), pa.array(ids[w.row0 + row[new]].astype(np.int64))],
                    names=["h", "doc_id"])


def _member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array ``of``."""
    at = np.searchsorted(of, values)
    at[at == len(of)] = 0
    return of[at] == values if len(of) else np.zeros(len(values), bool)


def _window_rows(batches: Iterator[pa.RecordBatch], part: int, length: int) -> Iterator[pa.RecordBatch]:
    """(window key, doc_id, start) of the windows whose part survived."""
    for b in batches:
        ids = b["doc_id"].to_numpy(zero_copy_only=False)
        lists = b["parts"]
        for w in word_runs(b["text"]):
            h, start, row = _parts(w, part, length)
            if not len(h):
                continue
            half, _ = w.windows(part)
            keep = np.zeros(len(h), bool)
            bounds = np.searchsorted(row, np.arange(w.rows + 1))
            for r in range(w.rows):
                lo, hi = bounds[r], bounds[r + 1]
                if hi > lo and lists[w.row0 + r].is_valid:
                    alive = np.sort(lists[w.row0 + r].values.to_numpy()).view(np.int64)
                    keep[lo:hi] = _member(signed(h[lo:hi]), alive)
            start, row = start[keep], row[keep]
            key = mix(half[start] * _MULTIPLIER + half[start + length - part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(key)), pa.array(ids[w.row0 + row].astype(np.int64)),
                 pa.array((start - w.first[row]).astype(np.int32))], names=["h", "doc_id", "start"])


def _digests(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Per document: words, covered words and the kept words' digest and text."""
    for b in batches:
        n_words, n_removed, sha, texts = [], [], [], []
        for text, starts, copy in zip(b["text"], b["starts"], b["is_copy"]):
            words = (text.as_py() or "").encode().split()
            n = len(words)
            if copy.as_py() and n >= length:
                kept: list[bytes] = []
            elif starts.is_valid:
                edge = np.zeros(n + length + 1, np.int64)
                at = starts.values.to_numpy()
                at = at[at + length <= n]
                np.add.at(edge, at, 1)
                np.add.at(edge, at + length, -1)
                kept = [words[i] for i in np.flatnonzero(np.cumsum(edge)[:n] == 0)]
            else:
                kept = words
            joined = b" ".join(kept)
            n_words.append(n)
            n_removed.append(n - len(kept))
            sha.append(hashlib.sha256(joined).hexdigest())
            texts.append(joined)
        yield pa.RecordBatch.from_arrays(
            [b["doc_id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(sha, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def _copies(d: DataFrame, length: int) -> DataFrame:
    """doc_id of documents whose word sequence is that of a smaller doc_id."""
    seq = stored(d.filter("doc_id is not null").mapInArrow(
        partial(_sequences, length=length), "doc_id long, k0 long, k1 long"), "sequences")
    first = seq.groupBy("k0", "k1").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    return join_split(seq, first.filter("n > 1"), ["k0", "k1"]).filter("first < doc_id") \
        .select("doc_id").distinct().withColumn("is_copy", F.lit(True))


def repeated_windows(d: DataFrame, copies: DataFrame, length: int) -> DataFrame:
    """(h, doc_id, start) of the windows of ``length`` words whose part is in two documents."""
    part = (length + 1) // 2
    rows = d.join(copies, "doc_id", "left").filter("doc_id is not null and is_copy is null") \
        .select("doc_id", "text").mapInArrow(partial(_part_rows, part=part, length=length),
                                             "h long, doc_id long")
    alive = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    parts = stored(join_split(rows, alive, ["h"], "left_semi").groupBy("doc_id").agg(
        F.collect_list("h").alias("parts")), "parts")
    return d.join(parts, "doc_id", "left").filter("parts is not null").mapInArrow(
        partial(_window_rows, part=part, length=length), "h long, doc_id long, start int")


def remove_repeats(docs: DataFrame, length: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256; see the module text."""
    small_batches(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    copies = stored(_copies(d, length), "copies")
    windows = repeated_windows(d, copies, length)
    first = windows.groupBy("h").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")) \
        .filter("first < last").select("h", "first")
    covered = stored(join_split(windows, first, ["h"]).filter("first < doc_id")
                     .groupBy("doc_id").agg(F.collect_list("start").alias("starts")), "covered")
    full = d.join(covered, "doc_id", "left").join(copies, "doc_id", "left")
    return full.select("doc_id", "text", "starts", "is_copy").mapInArrow(
        partial(_digests, length=length),
        "doc_id long, n_words long, n_removed long, kept_sha256 string")


def longest_repeats(docs: DataFrame, length: int = WINDOW) -> DataFrame:
    """doc_id, start, length of every window that repeats in another document: the largest of
    ``length``, twice, four times, ... at which the window that starts there repeats.

    A window of twice the length is the pair of the windows at its start and its middle, so
    every level joins the one before with itself; it ends when no candidate survives.
    """
    spark = docs.sparkSession
    small_batches(spark)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    none = spark.createDataFrame([], "doc_id long, is_copy boolean")

    def surviving(windows: DataFrame) -> DataFrame:
        alive = windows.groupBy("h").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")) \
            .filter("a < b").select("h")
        return stored(join_split(windows, alive, ["h"], "left_semi"), "windows")

    level, out = surviving(repeated_windows(d, none, length)), None
    while level.limit(1).count():
        middle = level.select("doc_id", (F.col("start") - length).alias("start"), F.col("h").alias("h2"))
        double = level.join(middle, ["doc_id", "start"]).select(
            F.xxhash64("h", "h2").alias("h"), "doc_id", "start")
        longer = surviving(double)
        ended = level.join(longer, ["doc_id", "start"], "left_anti").select(
            "doc_id", "start", F.lit(length).alias("length"))
        out = ended if out is None else out.union(ended)
        level, length = longer, 2 * length
    return out if out is not None else level.select("doc_id", "start", F.lit(length).alias("length"))
