"""Toxicity scores by a factorization machine over hashed terms.

Terms of a text are its lower-cased words and the first four and five bytes of longer words
(inflected and compounded insults share a stem), hashed to BUCKETS buckets. From the labelled
rows that are not held out, Spark counts per bucket the toxic and other documents; every bucket
in MIN_DOCS documents is a feature. A factorization machine learns a weight for each and a
vector whose inner products weigh pairs of terms, so an insult beside the mention of a group
counts differently from either alone. A feature's value grows with what its bucket tells by
itself (log-likelihood ratio), which keeps thousands of chance words small, but is never below
FLOOR: terms that tell something only in pairs are learnt too. All texts are scored with the
model inside Spark tasks. (Spark ML's FMClassifier makes a dense gradient of all weights for
every row, which rules out more than a few hundred features.)

The training sample is bounded: at most about SAMPLE labelled rows, chosen by a hash of the
id; counts of buckets and the fit, in one task, use that sample. Labels, language, source and id are never
inputs of a score.

Defined results: empty and null texts have no terms and score by the intercept alone; rows
are scored one by one; labels without a document, with null or other values than 0 and 1 are
ignored, of several labels of one document the largest counts; with no label of one of the
two classes, or no feature, every score is the share of toxic rows (0 without any row); an empty table gives
an empty result; of documents only doc_id and text are read.
"""

from __future__ import annotations

from functools import partial
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskline.llm.common import small_batches, stored, text_or_empty
from riskline.llm.textops import NOT_LETTERS, word_runs

BUCKETS = 1 << 20
MIN_DOCS = 5    # documents of the training rows; fewer tell nothing about others
EVIDENCE = 10.0
FLOOR = 0.2
FACTORS = 6
SAMPLE = 20_000
ITERATIONS = 80
STEP, DECAY, START = 0.1, 1e-4, 0.05
FOLDS = 5       # fixed by the contract


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def _terms(w) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every distinct term of each row."""
    row = np.repeat(np.arange(w.rows), w.counts())
    rows, terms = [row], [w.hashes]
    for n in (4, 5):
        at, h = w.prefixes(n)
        rows.append(row[at])
        terms.append(h)
    code = np.concatenate(rows).astype(np.int64) * BUCKETS \
        + (np.concatenate(terms) % np.uint64(BUCKETS)).astype(np.int64)
    code = np.unique(code)
    return code // BUCKETS, code % BUCKETS


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        toxic = b["toxic"].to_numpy(zero_copy_only=False)
        for w in word_runs(b["text"], True, NOT_LETTERS):
            row, bucket = _terms(w)
            own, at = np.unique(bucket, return_inverse=True)
            pos = np.bincount(at, toxic[w.row0 + row], len(own)).astype(np.int64)
            n = np.bincount(at, minlength=len(own))
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(pos), pa.array(n - pos)],
                                             names=["bucket", "pos", "neg"])


def _chosen(w, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place in the sorted array ``chosen`` of the terms that are in it."""
    row, bucket = _terms(w)
    at = np.searchsorted(chosen, bucket)
    at[at == len(chosen)] = 0
    own = chosen[at] == bucket
    return row[own], at[own]


def _features(batches: Iterator[pa.RecordBatch], chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for w in word_runs(b["text"], True, NOT_LETTERS):
            row, at = _chosen(w, chosen)
            ends = np.cumsum(np.bincount(row, minlength=w.rows))
            yield pa.RecordBatch.from_arrays(
                [b["toxic"].slice(w.row0, w.rows).cast(pa.int32()),
                 pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), pa.array(at, pa.int32()))],
                names=["toxic", "x"])


def _sums(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values``; a run may be empty."""
    end = np.zeros((1, *values.shape[1:]), values.dtype)
    out = np.add.reduceat(np.concatenate([values, end]), np.cumsum(count) - count)
    out[count == 0] = 0
    return out


def fit(toxic: np.ndarray, count: np.ndarray, at: np.ndarray, value: np.ndarray) -> tuple[float, np.ndarray]:
    """Bias and (linear, factors) weights by Adam over all rows, values multiplied in.

    Row r holds the features ``at`` of the r-th run of ``count``; ``value`` is per feature."""
    f = np.float32
    k, value = len(value), value.astype(f)[:, None]
    w = np.random.default_rng(7).normal(0, START, (k, 1 + FACTORS)).astype(f)
    w[:, 0] = 0
    row = np.repeat(np.arange(len(count), dtype=np.int32), count)
    by_feature = np.argsort(at, kind="stable")
    row_of, per = row[by_feature], np.bincount(at, minlength=k)
    bias = np.full(1, np.log(toxic.mean() / (1 - toxic.mean())))
    state = [(x, np.zeros_like(x), np.zeros_like(x)) for x in (w, bias)]
    for step in range(1, ITERATIONS + 1):
        u = w * value
        own = u[:, 0] - (u[:, 1:] ** 2).sum(axis=1) / 2
        total = np.stack([_sums(u[at, 1 + j], count) for j in range(FACTORS)], axis=1)
        z = bias[0] + _sums(own[at], count) + (total ** 2).sum(axis=1) / 2
        error = ((1 / (1 + np.exp(-np.clip(z, -50, 50))) - toxic) / len(toxic)).astype(f)
        g = np.empty_like(w)
        g[:, 0] = _sums(error[row_of], per)
        for j in range(FACTORS):
            g[:, 1 + j] = _sums((error * total[:, j])[row_of], per) - g[:, 0] * u[:, 1 + j]
        for (x, m, v), d in zip(state, (g * value + f(DECAY) * w, error.sum(keepdims=True))):
            m += 0.1 * (d - m)
            v += 0.001 * (d * d - v)
            x -= (STEP * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(x.dtype)
    return float(bias[0]), w * value


def _fitted(batches: Iterator[pa.RecordBatch], value: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row with the weights, learnt from all rows of the one task."""
    toxic, count, at = [], [], []
    for b in batches:
        toxic.append(b["toxic"].to_numpy(zero_copy_only=False))
        count.append(np.diff(b["x"].offsets.to_numpy()))
        at.append(b["x"].flatten().to_numpy(zero_copy_only=False))
    bias, w = fit(*map(np.concatenate, (toxic, count, at)), value)
    yield pa.RecordBatch.from_arrays([pa.array([bias]), pa.array([w.tobytes()], pa.binary())],
                                     names=["bias", "weights"])


def _scores(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    bias, linear, factors, chosen = (model[k] for k in ("bias", "linear", "factors", "chosen"))
    own = linear - (factors ** 2).sum(axis=1) / 2
    for b in batches:
        out = [np.zeros(0)]
        for w in word_runs(b["text"], True, NOT_LETTERS):
            z = np.full(w.rows, bias)
            if len(chosen):
                row, at = _chosen(w, chosen)
                count = np.bincount(row, minlength=w.rows)
                total = _sums(factors[at].astype(float), count)
                z += _sums(own[at].astype(float), count) + (total ** 2).sum(axis=1) / 2
            out.append(1 / (1 + np.exp(-np.clip(z, -50, 50))))
        yield pa.RecordBatch.from_arrays([b["doc_id"], b["held_out"], pa.array(np.concatenate(out))],
                                         names=["doc_id", "held_out", "score"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """Weights of the machine, learnt from at most about ``sample`` rows not held out."""
    own = labels.filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = own.count()
    if n > sample:
        own = own.filter(F.pmod(F.xxhash64("doc_id"), F.lit(n)) < sample)
    rows = docs.select("doc_id", text_or_empty().alias("text")) \
        .join(F.broadcast(own.select("doc_id", "toxic")), "doc_id").select("text", "toxic")
    rows = stored(rows, "toxicity-sample")
    total = rows.agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg")).first()
    pos, neg = total["pos"] or 0, total["neg"] or 0
    none = {"linear": np.zeros(0), "factors": np.zeros((0, FACTORS)), "chosen": np.zeros(0, np.int64)}
    share = np.clip(pos / max(1, pos + neg), 1e-9, 1 - 1e-9)
    none |= {"bias": float(np.log(share / (1 - share)))}
    if not pos or not neg:
        return none
    counts = rows.mapInArrow(_counts, "bucket long, pos long, neg long") \
        .groupBy("bucket").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")) \
        .filter(F.col("p") + F.col("n") >= MIN_DOCS)
    # log-likelihood ratio of bucket and label
    ln = lambda x, of: F.when(x > 0, x * F.log(x / of)).otherwise(0.0)
    share = (F.col("p") + F.col("n")) / F.lit(pos + neg)
    ratio = ln(F.col("p"), share * pos) + ln(F.col("n"), share * neg) \
        + ln(pos - F.col("p"), (1 - share) * pos) + ln(neg - F.col("n"), (1 - share) * neg)
    found = counts.select("bucket", ratio.alias("ratio")).orderBy("bucket").toArrow()  # at most BUCKETS rows
    chosen, ratio = (found[c].to_numpy() for c in ("bucket", "ratio"))
    if not len(chosen):
        return none
    value = np.maximum(FLOOR, ratio / (ratio + EVIDENCE))
    model = rows.mapInArrow(partial(_features, chosen=chosen), "toxic int, x array<int>") \
        .coalesce(1).mapInArrow(partial(_fitted, value=value), "bias double, weights binary").first()
    w = np.frombuffer(model["weights"], np.float32).reshape(len(chosen), 1 + FACTORS)
    return {"bias": model["bias"], "linear": w[:, 0], "factors": w[:, 1:], "chosen": chosen}


def toxicity_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs``."""
    small_batches(docs.sparkSession)
    model = train(docs, labels, sample)
    d = docs.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                    text_or_empty().alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    scored = d.mapInArrow(partial(_scores, model=model), f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
