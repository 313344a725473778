"""Token counts with a digest cache.

Every text is reduced to the digest of its normalised content (null is empty; nothing else is changed, as any
other change could alter the count). Digests are joined to the counts stored for this tokenizer's version; only
distinct digests without a count are encoded, and their counts are appended to the cache, a Parquet folder
partitioned by tokenizer version. A lost executor repeats its part of the append; Spark's commit keeps it whole.

Copies are folded before the shuffle (one row per digest and task), so a text that makes up a third of all
rows is encoded once. Edge cases: a null text has 0 bytes and 0 tokens; null or repeated doc_ids are
returned as they come; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lensmill.llm import bpe
from lensmill.llm.common import stored, whole_text

CACHE = "digest binary, n_tokens long, tokenizer string"


def _digested(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", whole_text(F.col("text")).alias("text")).withColumn(
        "digest", F.unhex(F.sha2("text", 256))
    )


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def cached_counts(spark: SparkSession, cache: str, version: str) -> DataFrame | None:
    """(digest, n_tokens) of one tokenizer's version; None where the cache does not exist yet."""
    if not _exists(spark, cache):
        return None
    rows = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == version)
    # Two jobs may have appended the same digest at the same time.
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def fill_cache(documents: DataFrame, cache: str, path: str, ranks_path: str | None = None) -> str:
    """Encodes the distinct texts the cache lacks and appends their counts. Returns the tokenizer's version."""
    version = bpe.version(path)
    texts = _digested(documents).select("digest", "text")
    known = cached_counts(documents.sparkSession, cache, version)
    if known is not None:
        texts = texts.join(known, "digest", "left_anti")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = bpe.encoder(path, ranks_path)
        for batch in batches:
            counts = [len(ids(text)) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(counts, pa.int64())], names=["digest", "n_tokens"]
            )

    misses = texts.dropDuplicates(["digest"]).mapInArrow(encode, "digest binary, n_tokens long")
    misses.withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache)
    return version


def token_counts(
    documents: DataFrame, cache: str, path: str, ranks_path: str | None = None, limit: int = 1024
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit. ``cache``: a folder that all executors see."""
    version = fill_cache(documents, cache, path, ranks_path)
    # Stored, so that both sides of the join are plain shuffles, of which Spark splits a hot digest.
    counts = stored(cached_counts(documents.sparkSession, cache, version), "token-counts")
    rows = _digested(documents).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
    return rows.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
