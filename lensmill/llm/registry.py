"""The operators as queries over the test tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lensmill.llm import (
    alignment,
    bpe,
    fingerprints,
    html_text,
    lexical_search,
    minmax,
    mixing,
    ngram_join,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    sharding,
    token_counts,
)
from lensmill.llm.common import new_path, table

Query = Callable[[SparkSession, str], DataFrame]


def _bpe_50k() -> dict[str, str]:
    return {"path": bpe.public_path("byte_bpe_50k.json"), "ranks_path": bpe.public_path("byte_bpe_50k.tiktoken")}


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents")).drop("source")


def op2_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), **_bpe_50k(), end_id=2, capacity=1024)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(quality_classifier.fold(F.col("doc_id")) == 0, F.lit(False))
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality_classifier.score(documents, labels, learn=~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edits(table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), n_shards=8)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components_of(table(spark, sf_dir, "documents"), percent=80)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache of its own, so that every text counts; a standing job names a lasting folder."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), new_path(spark, "token-cache"), **_bpe_50k())


def op11_minmax_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, sf_dir, "documents"), percent=85, width=3)


def op12_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, ranks, b = (bpe.public_path(f) for f in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))
    return alignment.align_documents(table(spark, sf_dir, "documents"), a, b, a_ranks=ranks)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_pack_sequences": op2_pack_sequences,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_fingerprints": op4_fingerprints,
    "op5_html_text": op5_html_text,
    "op6_personal_data": op6_personal_data,
    "op7_shards": op7_shards,
    "op8_quality_rules": op8_quality_rules,
    "op9_ngram_join": op9_ngram_join,
    "op10_token_counts": op10_token_counts,
    "op11_minmax_near_duplicates": op11_minmax_near_duplicates,
    "op12_align_tokenizers": op12_align_tokenizers,
    "op13_lexical_search": op13_lexical_search,
}

SQL: dict[str, str] = {
    "op1_mix_sources": f"select * exclude (source) from ({mixing.mix_sql()})",
    "op11_minmax_near_duplicates": minmax.near_duplicates_sql(percent=85, width=3),
    "op13_lexical_search": lexical_search.search_sql(),
}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # at the repository's top; it imports this package

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return QUERIES | {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
