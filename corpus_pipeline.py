"""A corpus pipeline over ``documents``: quality rules, near-duplicate removal, benchmark
decontamination, masking of personal data and token ids.

Each stage is (spark, docs, sf_dir) -> DataFrame; ``run`` writes a stage's result as Parquet
in the shared checkpoint folder and rereads it as the next one's ``docs``. All stages but the
last return the columns of ``documents``; the last returns a row of token ids per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskline.llm import bpe, decontaminate, neardup, pii, quality
from riskline.llm.catalog import tokenizer
from riskline.llm.common import stored
from riskline.session import prepare
from riskline.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go, and documents that fail the rules or are depleted."""
    prepare(spark)
    return quality.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of the smallest doc_id."""
    prepare(spark)
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go."""
    prepare(spark)
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind."""
    prepare(spark)
    return pii.mask(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of ids and decoded text, ids."""
    prepare(spark)
    path, pattern = tokenizer()
    return bpe.encode_documents(docs, path, pattern, ids_out=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("token_ids", token_ids),
]

# The span classifier and the encoder have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
