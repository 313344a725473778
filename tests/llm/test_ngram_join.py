import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lensmill.llm import ngram_join, registry, signature_tree
from lensmill.llm.components import components
from lensmill.llm.shingles import shingle_sets

from .conftest import EDGE_ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def brute(rows):
    """doc_id -> (number of shingles, component) by comparing all that share a shingle; rows: unique doc_ids."""
    sets, parent, having = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}, defaultdict(list)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        for j, n in Counter(j for s in sets[i] for j in having[s]).items():
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            having[s].append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


def copies(n=160, seed=3):
    """Families of near copies around the threshold, and documents that share a passage only."""
    rng, rows = random.Random(seed), []
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(60)]
    for k in range(n):
        if k % 4 == 0:
            base = [word() for _ in range(rng.randrange(20, 200))]
        text = list(base)
        for _ in range(rng.randrange(0, 1 + len(base) // 25)):
            text[rng.randrange(len(text))] = word()
        if k % 5 == 0:
            text = [word() for _ in range(40)] + passage
        rows.append((k, " ".join(text)))
    return rows


def test_sets_equal_brute_force():
    texts = [t or "" for _, t, _, _ in EDGE_ROWS] + [t for _, t in copies(40)]
    sets = shingle_sets(texts)
    assert [len(sets.of(i)) for i in range(len(texts))] == [len(shingles(t)) for t in texts]


@pytest.mark.parametrize("block_items", [4096, 3])
def test_components_equal_brute_force(make, block_items):
    rows = copies()
    found = ngram_join.components_of(make([(i, t, "en", "a") for i, t in rows]), block_items=block_items).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows)


def test_whole_table_equals_brute_force(spark, small):
    found = registry.op9_ngram_join(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute([(r.doc_id, r.text) for r in small.collect()])


def test_edges(edges, empty):
    rows = sorted(map(tuple, ngram_join.components_of(edges).collect()), key=repr)
    want = [(i, len(shingles(t)), 1 if i in (1, 2) else i) for i, t, _, _ in EDGE_ROWS]
    assert rows == sorted(want, key=repr)
    assert ngram_join.components_of(empty).count() == 0


def test_one_of_each(make, edges, empty):
    rows = copies()
    kept = ngram_join.one_of_each(make([(i, t, "en", "a") for i, t in rows]))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in brute(rows).values()})
    assert kept.columns == edges.columns
    # Two rows with doc_id 2 and one with 1 are one text; a repeated row stays once.
    assert ngram_join.one_of_each(edges).count() == len(EDGE_ROWS) - 2
    assert ngram_join.one_of_each(make([EDGE_ROWS[1]] * 3)).count() == 1
    assert ngram_join.one_of_each(empty).count() == 0


def test_tree_prunes_no_link():
    sets = shingle_sets([t for _, t in copies(120)])
    own = [sets.of(i) for i in range(120)]
    want = {(i, j) for i in range(120) for j in range(i) if _jaccard(own[i], own[j]) >= 0.8}
    groups = signature_tree.Groups()
    for a, b in signature_tree.links(own, list(range(120)), [0] * 120, 80):
        assert (max(a, b), min(a, b)) in want
        groups.join(groups.root(a), groups.root(b))
    assert all(groups.root(i) == groups.root(j) for i, j in want)


def _jaccard(a, b):
    n = len(np.intersect1d(a, b))
    return n / (len(a) + len(b) - n)


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(100, 140)] + [(1000 + 7 * k, 1000) for k in range(1, 30)] + [(5, 5)]
    found = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {k: 100 for k in range(100, 141)} | {1000 + 7 * k: 1000 for k in range(30)}


def test_documents_that_stay_do_not_travel(spark):
    """Without broadcasts, only the documents a bitmap can't rule out meet the list of those that go."""
    rows = [(i, f"some words of text number {i % 900} and more of {i % 900} here") for i in range(1000)] + [(5000, None), (5000, None)]
    rows += [(6000, "twice the very same row of this table")] * 2
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = ngram_join.one_of_each(documents)
        got = sorted(r.doc_id for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert got == [*range(900), 5000, 5000, 6000]
    # One branch of the result holds no exchange: the documents that stay.
    assert any("Exchange" not in part and "NOT pythonUDF" in part for part in plan.split(":- ")), plan
