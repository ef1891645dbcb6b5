"""Phrase collocations from n-grams counted in counting quotient filters.

1. One pass over the texts: a chunk of up to CHUNK_TOKENS tokens is written with word numbers of
   its own, and its words with their counts. No token is shuffled as text.
2. The chunks' words are added up per language; words with at least ``min_count`` occurrences
   get a global number (a word of fewer cannot be in a candidate, whose words all occur at least
   as often as it). Each chunk gets the global numbers of its own words back.
3. Per chunk, pairs and triples of global numbers are packed into keys of 3 * b bits (b: bits of
   the largest number), permuted, and counted in quotient filters, one per range of quotients.
   Filters of the same range are brought together and merged; keys of at least ``min_count`` are
   turned back into word numbers. Counts are exact (see ``quotient``).
4. Scores, the cut of the lowest score and the rule on longer candidates are joins of these
   counts; arithmetic is in 38-digit decimals, exact for counts up to 10**12.

Skew: a frequent word or n-gram is one row per chunk; joins on word numbers go through exchanges
that can be split; the best of each language are chosen in two steps, first per salt.

Defined results: null text is empty, a null language is ``und`` (and one with it); repeated rows
and rows with a null doc_id count like others; texts without words and empty tables give no rows;
only text and lang are read.
"""

from __future__ import annotations

from functools import partial
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskline.llm.common import join_split, small_batches, stored
from riskline.llm.quotient import Layout, Merger, counted, segments
from riskline.operators.ordinal import global_ordinal

MIN_COUNT, TOP = 10, 2000       # fixed by the operator's contract
CHUNK_TOKENS = 1 << 20          # tokens of a chunk, about (an Arrow batch is not cut)
SEGMENT_TOKENS = 1 << 21        # tokens whose n-grams one range of quotients takes, about

#: A-Z lower-cased, tabs to blanks, separators of pieces to a byte that UTF-8 never has
_BREAK = b"\xff"
_TABLE = bytes(c + 32 if 65 <= c <= 90 else 255 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c
               for c in range(256))


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows (chunk, tokens, langs, words, counts): the chunk's tokens as numbers from 1 with 0
    between pieces; language, word and count of number i + 1 at place i."""
    part, seq = TaskContext.get().partitionId(), 0
    held: dict[str, list[pa.Array]] = {}
    size = 0

    def out() -> pa.RecordBatch:
        tokens, names, n = [], [], 0
        for lang, arrays in held.items():
            coded = pa.concat_arrays(arrays).dictionary_encode()
            known = coded.dictionary
            word = np.asarray(pc.and_(pc.greater(pc.binary_length(known), 0), pc.not_equal(known, _BREAK)))
            number = np.zeros(len(known) + 1, np.int32)
            number[:-1][word] = np.arange(n + 1, n + 1 + word.sum())
            gap = np.append(np.asarray(pc.equal(pc.binary_length(known), 0)), False)    # between blanks
            at = np.asarray(coded.indices)
            tokens.append(number[at[~gap[at]]])
            names.append(pa.StructArray.from_arrays(
                [pa.repeat(lang, int(word.sum())), known.filter(pa.array(word)).cast(pa.large_string())], names=["lang", "word"]))
            n += int(word.sum())
        ids = np.concatenate(tokens)
        both = pa.concat_arrays(names)
        count = np.bincount(ids, minlength=n + 1)[1:]
        words = pa.StructArray.from_arrays([*both.flatten(), pa.array(count)], names=["lang", "word", "n"])
        return pa.RecordBatch.from_arrays(
            [pa.array([(part << 32) | seq]), pa.array([ids.tobytes()], pa.binary()),
             pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), words)], names=["chunk", "tokens", "words"])

    for b in batches:
        for lang in b["lang"].unique():
            texts = b["text"].filter(pc.equal(b["lang"], lang)).to_pylist()
            data = "\n".join(texts).encode().translate(_TABLE).replace(_BREAK, b" \xff ") + b" \xff"
            words = pc.split_pattern(pa.array([data], pa.large_binary()), " ").flatten()
            held.setdefault(lang.as_py(), []).append(words)
            size += len(words)
        if size >= most:
            yield out()
            held, size, seq = {}, 0, seq + 1
    if held:
        yield out()


def _ngrams(ids: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all pairs (high limb 0) and triples of word numbers; 0 ends a piece."""
    x, y = ids[:-1], ids[1:]
    pair = (x > 0) & (y > 0)
    two = (x << np.uint64(b)) | y
    three = pair[:-1] & pair[1:]
    return (np.concatenate([np.zeros(pair.sum(), np.uint64), ids[:-2][three]]),
            np.concatenate([two[pair], two[1:][three]]))


def _filters(batches: Iterator[pa.RecordBatch], bits: int, prefix_bits: int) -> Iterator[pa.RecordBatch]:
    """Filters of each chunk: rows (segment, filter)."""
    layout = Layout(bits, 2 * bits)
    for b in batches:
        for tokens, local, number in zip(b["tokens"], b["local"], b["number"]):
            local, number = (np.asarray(x.values) for x in (local, number))
            tokens = np.frombuffer(tokens.as_py(), np.int32)
            table = np.zeros(max(int(tokens.max()), int(local.max(initial=0))) + 1, np.uint64)
            table[local] = number.astype(np.uint64)
            high, low = layout.permute(*_ngrams(table[tokens], bits))
            got = segments(layout, prefix_bits, *counted(high, low, low_bits=2 * bits))
            if got:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s for s, _ in got], pa.int64()), pa.array([f for _, f in got], pa.binary())],
                    names=["segment", "filter"])


def _merged(batches: Iterator[pa.RecordBatch], bits: int, prefix_bits: int, least: int) -> Iterator[pa.RecordBatch]:
    """Rows (w1, w2, w3, a) of the n-grams with at least ``least`` occurrences, from filters
    ordered by segment; w1 is 0 for pairs."""
    layout = Layout(bits, 2 * bits)

    def out(m: Merger) -> pa.RecordBatch:
        high, low, count = m.keys()
        many = count >= least
        high, low = high[many].astype(np.int64), low[many].astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(high), pa.array(low >> bits), pa.array(low & ((1 << bits) - 1)), pa.array(count[many])],
            names=["w1", "w2", "w3", "a"])

    merger, now = None, None
    for b in batches:
        for segment, data in zip(b["segment"].to_pylist(), b["filter"]):
            if segment != now:
                if merger is not None:
                    yield out(merger)
                merger, now = Merger(layout, prefix_bits), segment
            merger.add(data.as_py())
    if merger is not None:
        yield out(merger)


def vocabulary(words: DataFrame, least: int) -> DataFrame:
    """(lang, word, f, number): words of at least ``least`` occurrences, numbered from 1."""
    total = words.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    return global_ordinal(total, ["lang", "word"], out="_at").select(
        "lang", "word", "f", (F.col("_at") + 1).alias("number"))


def ngram_counts(chunks: DataFrame, words: DataFrame, vocab: DataFrame, least: int) -> DataFrame:
    """(w1, w2, w3, a) of all pairs (w1 = 0) and triples of numbered words with a >= ``least``."""
    top = vocab.agg(F.max("number"), F.sum("f")).first()
    if top[0] is None:
        return chunks.sparkSession.createDataFrame([], "w1 long, w2 long, w3 long, a long")
    bits = int(top[0]).bit_length()
    prefix_bits = min(bits, max(0, int(-(-top[1] // SEGMENT_TOKENS) - 1).bit_length()))
    known = words.join(vocab.select("lang", "word", "number"), ["lang", "word"]) \
        .groupBy("chunk").agg(F.collect_list("local").alias("local"), F.collect_list("number").alias("number"))
    filters = chunks.select("chunk", "tokens").join(known, "chunk").select("tokens", "local", "number").mapInArrow(
        partial(_filters, bits=bits, prefix_bits=prefix_bits), "segment long, filter binary")
    return filters.repartition("segment").sortWithinPartitions("segment").mapInArrow(
        partial(_merged, bits=bits, prefix_bits=prefix_bits, least=least), "w1 long, w2 long, w3 long, a long")


def _score(left: str, right: str) -> Column:
    """floor(1000000 a a / (l r)); exact, since no product exceeds 38 digits."""
    return F.expr(f"(1000000BD * cast(a AS decimal(13,0)) * cast(a AS decimal(13,0))) div "
                  f"(cast({left} AS decimal(13,0)) * cast({right} AS decimal(13,0)))")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 or 3 words."""
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    src = docs.select(text.alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    chunks = stored(src.mapInArrow(
        partial(_chunks, most=CHUNK_TOKENS),
        "chunk long, tokens binary, words array<struct<lang:string,word:string,n:long>>"), "chunks")
    words = chunks.select("chunk", F.posexplode("words").alias("at", "x")).select(
        "chunk", (F.col("at") + 1).alias("local"), "x.*")
    n = stored(words.groupBy("lang").agg(F.sum("n").alias("n")), "lang-words")
    vocab = stored(vocabulary(words, min_count), "vocabulary")
    counts = stored(ngram_counts(chunks, words, vocab, min_count), "ngrams")

    pairs = counts.filter("w1 = 0").select(F.col("w2").alias("p"), F.col("w3").alias("q"), F.col("a").alias("f2"))
    triples = counts.filter("w1 > 0")

    def single(df: DataFrame, word: str, f: str, cols: tuple[str, ...] = ()) -> DataFrame:
        """``df`` with the count ``f`` of the word numbered ``word`` and columns of its row."""
        v = vocab.select(F.col("number").alias(word), F.col("f").alias(f),
                         *[F.col(c).alias(f"{c}_{word}") for c in cols])
        return join_split(df, v, [word])

    def double(df: DataFrame, first: str, second: str, f: str) -> DataFrame:
        return join_split(df, pairs.select(F.col("p").alias(first), F.col("q").alias(second),
                                           F.col("f2").alias(f)), [first, second])

    longest = triples.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), "a").union(
        triples.select("w2", "w3", "a")).groupBy("w2", "w3").agg(F.max("a").alias("longer"))
    two = join_split(counts.filter("w1 = 0"), longest, ["w2", "w3"], "left").filter(
        "longer IS NULL OR 100 * longer < 50 * a")
    two = single(single(two, "w2", "l", ("lang", "word")), "w3", "r", ("word",))
    two = two.select(F.col("lang_w2").alias("lang"), F.concat_ws(" ", "word_w2", "word_w3").alias("phrase"),
                     "a", "l", "r", _score("l", "r").alias("score"))
    three = single(single(single(triples, "w1", "l1", ("lang", "word")), "w2", "_f", ("word",)), "w3", "r2", ("word",))
    three = double(double(three, "w1", "w2", "l2"), "w2", "w3", "r1")
    three = three.withColumn("s1", _score("l1", "r1")).withColumn("s2", _score("l2", "r2"))
    early = F.col("s1") <= F.col("s2")
    three = three.select(F.col("lang_w1").alias("lang"), F.concat_ws(" ", "word_w1", "word_w2", "word_w3").alias("phrase"),
                         "a", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                         F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"),
                         F.least("s1", "s2").alias("score"))
    found = two.unionByName(three).withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    first = found.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))) \
        .filter(F.col("_r") <= top)
    best = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")) \
        .filter(F.col("rank") <= top)
    # a row per language; as long as no broadcast is forced its size is Spark's to judge
    return best.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
