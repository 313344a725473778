import re

import pytest

from checks.compare import connect, rows_match
from lensmill.llm import mixing, registry

from .conftest import EDGE_ROWS

SF = "/root/testdata/sf0.001"


def fill(sizes: dict, weights: dict, epochs: int = 3) -> dict:
    """Water-filling by clamping in rounds."""
    total, clamped = sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in clamped]
        left = total - sum(clamped.values())
        shares = {s: left * weights[s] / sum(weights[f] for f in free) for s in free}
        over = [s for s in free if shares[s] > epochs * sizes[s]]
        if not over:
            return clamped | shares
        clamped |= {s: epochs * sizes[s] for s in over}


def test_equals_sql(spark):
    frame = registry.op1_mix_sources(spark, SF)
    got = [tuple(r) for r in frame.collect()]
    assert rows_match(frame.columns, got, connect(SF), registry.SQL["op1_mix_sources"]) == ""


def test_no_python_in_the_plan(spark):
    plan = registry.op1_mix_sources(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_edges(edges):
    rows = mixing.mix_report(edges).collect()
    assert len(rows) == len(EDGE_ROWS)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(r.size for r in rows) == sorted(words(t) for _, t, _, _ in EDGE_ROWS)
    sizes, taken, targets, largest = {}, {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        targets[r.source] = r.target
        largest[r.source] = max(largest.get(r.source, 0), r["size"])
        assert r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"]
    names = sorted(s for s in sizes if s is not None) + [None]
    want = fill(sizes, {s: k % 3 + 1 for k, s in enumerate(names)})
    for s in sizes:
        assert targets[s] == pytest.approx(want[s])
        # Two rows are alike and are cut together.
        assert abs(taken[s] - targets[s]) <= max(6, largest[s])


def test_reruns_agree_and_rows_are_repeated(small):
    report = {r.doc_id: r.copies for r in mixing.mix_report(small).collect()}
    assert report == {r.doc_id: r.copies for r in mixing.mix_report(small.repartition(5)).collect()}
    mixed = mixing.mix(small)
    assert mixed.columns == small.columns
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {k: c for k, c in report.items() if c}


def test_hot_source_meets_its_target(make):
    rows = [(i, "w " * (1 + i % 9), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(2000)]
    found = mixing.mix_report(make(rows)).groupBy("source", "target").sum("taken").collect()
    assert all(abs(r["sum(taken)"] - r.target) <= 5 for r in found)


def test_empty(empty):
    assert mixing.mix_report(empty).count() == 0 and mixing.mix(empty).count() == 0
