import math
import re
from collections import Counter

import numpy as np
import pytest

from lensmill.llm import lexical_search, registry
from lensmill.llm.lexical_search import search

from .conftest import EDGE_ROWS

TERM = re.compile(lexical_search.TERM_SQL)


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(documents, items, best=10):
    """documents: (doc_id, text), items: (item_id, text) -> sorted result rows."""
    counts = [(i, Counter(terms(t))) for i, t in documents]
    lengths = [sum(c.values()) for _, c in counts]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for (doc, c), length in zip(counts, lengths, strict=True):
            m = 10 + 90 * length * n // total if total else 0
            found = [(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))), c[t]) for t in set(terms(text)) if t in c]
            score = sum(w * (1000000000 * tf // (1000 * tf + 8 * m)) for w, tf in found)
            if score > 0:
                scored.append((-score, math.inf if doc is None else doc, doc))
        out += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(sorted(scored, key=lambda r: r[:2])[:best])]
    return sorted(out, key=repr)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_whole_query_equals_brute_force(spark, small):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in small.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got(registry.op13_lexical_search(spark, "/root/testdata/sf0.001")) == want


ITEMS = [(1, "One TWO one, five"), (1, "One TWO one, five"), (1, "words"), (2, None), (3, " .;"), (None, "É x here"), (4, "absent")]


@pytest.mark.parametrize("at_once", [1 << 20, 3])
def test_edges(spark, edges, at_once):
    items = spark.createDataFrame([(i, t, "x", 9) for i, t in ITEMS], "item_id long, text string, score string, rank int")
    want = brute([(i, t) for i, t, _, _ in EDGE_ROWS], ITEMS, best=3)
    assert got(search(edges, items, best=3, terms_at_once=at_once)) == want


def test_empty_tables(spark, empty, edges):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert search(empty, items).collect() == []
    assert search(edges, items.limit(0)).collect() == []
    assert search(edges, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_one_stratum_with_most_documents_and_ties(spark, make):
    """Documents of one length are one stratum; equal scores go by doc_id, beyond the limit of the first visits too."""
    rows = [(k, f"common w{k % 7} filler{k % 3} x", "en", "a") for k in range(500)] + [(900 + k, "common " * (k + 1), "en", "b") for k in range(60)]
    items = [(k, f"w{k} common filler1") for k in range(9)]
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert got(search(make(rows), frame)) == brute([r[:2] for r in rows], items)


def test_bounds_are_never_below_scores():
    """A piece's bound of an item holds for every document in it."""
    import pyarrow as pa

    rng = np.random.default_rng(5)
    groups = sorted({(int(t), int(f)) for t, f in zip(rng.integers(0, 30, 90), rng.integers(1, 5, 90), strict=True)})
    taken, starts, places = {}, [0], []
    for term, _ in groups:
        free = [d for d in range(40) if d not in taken.setdefault(term, set())]
        own = sorted(rng.choice(free, size=min(len(free), int(rng.integers(1, 9))), replace=False).tolist())
        taken[term] |= set(own)
        places += own
        starts.append(len(places))
    row = pa.table(
        {
            "piece": [0], "m": [70], "doc_ids": [list(range(40))], "terms": [[t for t, _ in groups]],
            "tfs": [[f for _, f in groups]], "starts": [starts], "places": [places],
        }
    ).to_batches()[0]
    weight = rng.integers(0, 9000, 30)
    piece = lexical_search._Piece({k: row.column(k)[0] for k in row.schema.names}, weight)
    own = [np.sort(rng.choice(30, size=k, replace=False)) for k in (1, 4, 12)]
    asked = lexical_search.Asked([0, 1, 2], np.cumsum([0, 1, 4, 12]), np.concatenate(own), {})
    for bound, of in zip(piece.bounds(asked), own, strict=True):
        scores = piece.scores(of)
        want = np.zeros(40, np.int64)
        for k, (term, tf) in enumerate(groups):
            if term in of:
                want[places[starts[k] : starts[k + 1]]] += weight[term] * (10**9 * tf // (1000 * tf + 8 * 70))
        assert (scores == want).all() and bound >= scores.max()
        top = [i for _, _, i in piece.best(of, 5, 0)]
        assert top == [i for i in sorted(range(40), key=lambda i: (-want[i], i)) if want[i] > 0][:5]
