"""Every stage of the pipeline against its own input."""

import re

import corpus_pipeline
from lensmill.llm import pii, quality_classifier
from lensmill.llm.common import stored

from .test_ngram_join import brute
from .test_tokens import _LIBRARY, ids

SF = "/root/testdata/sf0.001"


def test_stages(spark, small):
    docs, before = small, None
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF), "test-stage")
        rows, earlier = docs.collect(), before.collect()
        if name != "best_fit_packing":
            assert docs.columns == small.columns
        if name == "quality_classifier":
            labels = spark.read.parquet(f"{SF}/labels.parquet")
            scores = {r.doc_id: r.predicted for r in quality_classifier.score(before, labels).collect()}
            assert sorted(r.doc_id for r in rows) == sorted(i for i, p in scores.items() if p)
        if name == "ngram_jaccard_join":
            assert sorted(r.doc_id for r in rows) == sorted({c for _, c in brute([(r.doc_id, r.text) for r in earlier]).values()})
        if name == "personal_data":
            assert len(rows) == len(earlier) and not any(pii.base_spans(r.text) for r in rows)
            clean = {r.doc_id: r.text for r in earlier if not pii.all_spans(r.text)[1]}
            assert all(r.text == clean.get(r.doc_id, r.text) and r.n_chars == len(r.text) for r in rows)
        if name == "mix_sources":
            words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
            total, mixed = sum(words(r.text) for r in earlier), sum(words(r.text) for r in rows)
            assert abs(total - mixed) <= 0.1 * total
            assert {tuple(r) for r in rows} <= {tuple(r) for r in earlier}
        if name == "best_fit_packing":
            assert sum(r.length for r in rows) == sum(len(ids(_LIBRARY, r.text)) + 1 for r in earlier)


def test_empty_table_and_nulls(spark, edges, small):
    columns = small.columns
    for frame in (edges.select(columns), small.limit(0)):
        docs = frame
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF), "test-stage")
        assert (docs.count() > 0) == (frame is not small and frame.count() > 0)
