"""What tasks hold at once stays small."""

import tracemalloc

import numpy as np
import pyarrow as pa

from lensmill.llm import bpe, ngram_join, pii
from lensmill.llm.common import BATCH_ROWS
from lensmill.llm.components import components


def _rows_at_once(spark):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], names=["n"])

    return max(r.n for r in spark.range(0, 9000, 1, 1).mapInArrow(run, "n long").collect())


def test_few_texts_a_batch(spark, make):
    key, rows = BATCH_ROWS
    documents = make([(1, "one two three four five six", "en", "a")])
    spark.conf.unset(key)
    try:
        pii.redact(documents)
        assert _rows_at_once(spark) == rows
        spark.conf.set(key, 7)
        ngram_join.one_of_each(documents)
        assert spark.conf.get(key) == "7"
    finally:
        spark.conf.unset(key)


def test_parts_hold_few_bytes():
    texts = ["a b " * n for n in (10, 200_000, 3, 30_000, 30_000, 30_000, *[1] * 1500)]
    batch = pa.RecordBatch.from_pydict({"text": texts, "other": texts[::-1]})
    for names in (["text"], ["text", "other"]):
        parts = list(ngram_join._parts(batch, *names))
        assert [t for p in parts for t in p.column("text").to_pylist()] == texts
        for part in parts:
            most = max(sum(map(len, part.column(c).to_pylist())) for c in names)
            assert len(part) == 1 or (most <= ngram_join.BYTES_AT_ONCE and len(part) <= ngram_join.TEXTS_AT_ONCE)
    assert list(ngram_join._parts(batch.slice(0, 0), "text")) == []
    # A slice's columns begin somewhere in their buffers.
    assert sum(map(len, ngram_join._parts(batch.slice(1, 9), "text"))) == 9


def test_counting_takes_little_room():
    values = np.random.default_rng(1).integers(0, 1 << 20, 1 << 20).astype(np.uint64) << np.uint64(40)
    want, counts = np.unique(values, return_counts=True)
    tracemalloc.start()
    try:
        found, n = ngram_join._repeated(values)
        assert tracemalloc.get_traced_memory()[1] < 3 * values.nbytes
    finally:
        tracemalloc.stop()
    assert found.tolist() == want[counts > 1].tolist() and n.tolist() == counts[counts > 1].tolist()
    assert not len(ngram_join._repeated(values[:0])[0])


def test_components_are_few_files(spark):
    conf = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        found = components(spark.range(3000).selectExpr("id as a", "id - id % 3 as b"))
        assert {r.node: r.component for r in found.collect()} == {k: k - k % 3 for k in range(3000)}
        assert len(found.inputFiles()) <= spark.sparkContext.defaultParallelism
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_encoder_loads_the_plain_library_when_needed(monkeypatch):
    import tokenizers

    path, loaded = bpe.public_path("byte_bpe_50k.json"), []

    class Plain:
        @staticmethod
        def from_file(path, load=tokenizers.Tokenizer.from_file):
            loaded.append(path)
            return load(path)

    monkeypatch.setattr(tokenizers, "Tokenizer", Plain)
    bpe.encoder.cache_clear()
    try:
        encode = bpe.encoder(path, bpe.public_path("byte_bpe_50k.tiktoken"))
        assert encode("some words") and not loaded
        assert bpe.encoder(path)("some words") == encode("some words") and loaded == [path]
    finally:
        bpe.encoder.cache_clear()
