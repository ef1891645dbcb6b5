"""Registered queries of the subpackage, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from typing import Callable, NamedTuple

from pyspark.sql import DataFrame, SparkSession

from riskline.llm import (bpe, collocations, decontaminate, hilbert, licenses, neardup, oracles, pii, quality, subdedup,
                          toxicity, urlfilter, vafile, warc)
from riskline.sources.tables import read_table


VOCABULARY = "byte_bpe_multi_50k.tiktoken"


class Entry(NamedTuple):
    fn: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None


def tokenizer() -> tuple[str, str]:
    """Path of the vocabulary and the pattern of the installed public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"]))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"),
                                      read_table(spark, sf_dir, "benchmark"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url"])
    return urlfilter.url_filter(pages, urlfilter.listed_on_hosts(pages))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(spark, read_table(spark, sf_dir, "pages")).drop("digest_ok")


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read_table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subdedup.remove_repeats(read_table(spark, sf_dir, "documents"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read_table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(read_table(spark, sf_dir, "documents"), *tokenizer())


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"),
                                    read_table(spark, sf_dir, "labels"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.cluster(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]))


def op12_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.shards(read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source"]))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents", ["text", "lang"]))


def entries() -> dict[str, Entry]:
    return {
        "op1_quality_rules": Entry(op1_quality_rules, oracles.quality_sql()),
        "op2_decontamination": Entry(op2_decontamination, oracles.decontamination_sql()),
        "op3_url_filter": Entry(op3_url_filter, oracles.url_sql()),
        "op4_warc": Entry(op4_warc, oracles.warc_sql()),
        "op5_personal_data": Entry(op5_personal_data),
        "op6_substring_dedup": Entry(op6_substring_dedup, oracles.substring_sql()),
        "op7_minhash_near_dedup": Entry(op7_minhash_near_dedup, oracles.near_duplicate_sql()),
        "op8_license_scan": Entry(op8_license_scan, oracles.license_sql()),
        "op9_byte_bpe": Entry(op9_byte_bpe),
        "op10_toxicity": Entry(op10_toxicity),
        "op11_centroid_clustering": Entry(op11_centroid_clustering, oracles.cluster_sql()),
        "op12_hilbert_shards": Entry(op12_hilbert_shards),      # DuckDB has no crc32: brute force in tests
        "op13_collocations": Entry(op13_collocations, oracles.collocation_sql()),
    }
