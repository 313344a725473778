"""Documents to packed sequences in five stages, each written as Parquet and reread by the next one.

Every stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns documents with the columns it
was given, but for the last one, which returns the packed pieces. Rows, nulls and ties are treated as the
operators' modules say; rows that the mix repeats are packed once each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lensmill.llm import bpe, mixing, ngram_join, packing, pii, quality_classifier
from lensmill.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays."""
    return ngram_join.one_of_each(docs, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights; a document is there as often as the mix takes it."""
    return mixing.mix(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences of 1024 tokens."""
    path, ranks = bpe.public_path("byte_bpe_50k.json"), bpe.public_path("byte_bpe_50k.tiktoken")
    return packing.pack(docs, path, ranks, end_id=2, capacity=1024)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("personal_data", personal_data),
    ("mix_sources", mixture),
    ("best_fit_packing", sequences),
]

#: The classifier and the tokenizer have no counterpart in SQL: tests hold every stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
