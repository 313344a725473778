"""The quality classifier on held-out labels, and quality rules against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lensmill.llm import quality_classifier, quality_rules, registry

from .conftest import EDGE_ROWS

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_accuracy(spark, labels):
    rows = registry.op3_quality_classifier(spark, SF).collect()
    known = {r.doc_id: r.quality for r in labels.collect()}
    assert len(rows) == 1000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(known[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in known]
    assert len(held) > 50
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    # Clean documents stay.
    assert sum(p for a, p in held if a == 1) == sum(a for a, _ in held)


def test_score_depends_on_the_text_alone(spark, labels):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    other = documents.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")})
    a = {r.doc_id: r.score for r in quality_classifier.score(documents, labels).collect()}
    assert a == pytest.approx({r.doc_id: r.score for r in quality_classifier.score(other, labels).collect()}, abs=1e-5)


def test_scores_equal_brute_force_neighbours(spark, labels):
    """Cosines with every labelled vector, one by one; own text and its copies left out."""
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    space = quality_classifier.fit(documents, labels)
    got = {r.doc_id: r.score for r in quality_classifier.score(documents, labels).collect()}
    for row in documents.limit(120).collect():
        own = space.project(quality_classifier.term_counts(row.text or "")[None])[0]
        digest = quality_classifier.text_digest(row.text or "")
        voters = [(float(own @ v), y) for v, y, d in zip(space.vectors, space.labels, space.digests, strict=True) if d != digest]
        near = sorted(voters, key=lambda c: -c[0])[:15]
        weights = [max(c, 0) ** 32 for c, _ in near]
        want = sum(w * y for w, (_, y) in zip(weights, near, strict=True)) / sum(weights) if sum(weights) > 1e-9 else space.labels.mean()
        assert got[row.doc_id] == pytest.approx(want, abs=2e-3)


def test_own_label_is_no_input(spark, labels):
    """Turning one document's label changes other scores, but not its own."""
    documents = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    some = labels.join(documents.select("doc_id"), "doc_id")
    first = some.orderBy("doc_id").first()
    turned = some.withColumn("quality", F.when(F.col("doc_id") == first.doc_id, 1 - F.col("quality")).otherwise(F.col("quality")).cast("int"))
    alone = documents.where(F.col("doc_id") == first.doc_id)
    a, b = (quality_classifier.fit(documents, x) for x in (some, turned))
    text = alone.first().text or ""
    counts, digest = quality_classifier.term_counts(text)[None], quality_classifier.np.array([quality_classifier.text_digest(text)])
    assert a.score(counts, digest, 15, 32.0) == pytest.approx(b.score(counts, digest, 15, 32.0), abs=1e-6)


def test_topics_in_another_script_are_told_apart(spark, make):
    """Texts that differ in Cyrillic letters alone."""
    words = ["молоко сыр масло хлеб творог сметана", "поезд вокзал рельсы вагон билет станция"]
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choices(words[k % 2].split(), k=30)), "ru", "a") for k in range(80)]
    frame = make(rows)
    known = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int")
    found = {r.doc_id: r.score for r in quality_classifier.score(frame, known).collect()}
    assert all(abs(found[k] - k % 2) < 0.2 for k in range(60, 80))


def test_classifier_edges(spark, edges, empty, labels):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    scored = quality_classifier.score(edges, labels).collect()  # some labels meet these doc_ids
    assert sorted((r.doc_id for r in scored), key=str) == sorted((i for i, *_ in EDGE_ROWS), key=str)
    assert all(0 <= r.score <= 1 for r in scored)
    none = labels.limit(0)
    assert {r.score for r in quality_classifier.score(edges, none).collect()} == {0.5}
    assert quality_classifier.score(empty, labels).count() == 0
    kept = quality_classifier.keep_good(edges, none)
    assert kept.columns == edges.columns and kept.count() == len(EDGE_ROWS)
    many = quality_classifier.score(documents, labels.unionAll(labels).unionAll(spark.createDataFrame([(None, 1, 0), (5, None, 0)], labels.schema)))
    assert many.count() == 1000


def brute_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {k for i, w in enumerate(windows) if counts[w] > 1 for k in range(i, i + 5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_measures_equal_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in registry.op8_quality_rules(spark, SF).collect():
        assert tuple(r)[1:7] == brute_measures(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_rules_edges(edges, empty, labels):
    rows = [tuple(r)[:7] for r in quality_rules.judge(edges, labels).collect()]
    assert sorted(rows, key=repr) == sorted([(i, *brute_measures(t)) for i, t, _, _ in EDGE_ROWS], key=repr)
    assert quality_rules.judge(empty, labels).count() == 0
    assert all(r.kept != r.base_failed for r in quality_rules.judge(edges, labels.limit(0)).collect())


def test_exact_binomial_test():
    for n, k, p in [(40, 0, 0.1), (40, 1, 0.1), (300, 7, 0.05), (10, 9, 0.5)]:
        tail = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality_rules.refutes(k, n, p, tail * 1.001) and not quality_rules.refutes(k, n, p, tail * 0.999)


def test_thresholds_limit_false_rejections(spark, make):
    """Enough labels: junk goes, and of the good documents of every stratum at most alpha; too few: all stay."""
    good = [(i, "plain words " + " ".join(f"w{i}x{k}" for k in range(20)), "en" if i % 2 else "de", "a") for i in range(3000)]
    junk = [(i, " ".join(f"j{i}x{k} ***" for k in range(20)), "en" if i % 2 else "de", "a") for i in range(3000, 3300)]
    few = [(i, " ".join(f"f{i}x{k} ***" for k in range(20)), "xx", "a") for i in range(4000, 4010)]
    marks = [(i, int(i < 3000), 0) for i in (*range(3300), *range(4000, 4010))]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in quality_rules.judge(make(good + junk + few), labels).collect()}
    assert all(rows[i].kept for i in range(3000))
    assert not any(rows[i].kept for i in range(3000, 3300)) and rows[3000].broken == "symbols"
    assert all(rows[i].kept for i in range(4000, 4010))
