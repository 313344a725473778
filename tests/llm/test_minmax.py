import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lensmill.llm import minmax, registry
from lensmill.llm.shingles import shingle_sets

from .conftest import EDGE_ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 3]) for k in range(len(words) - 2)} if len(words) >= 3 else {tuple(words)} - {()}


def brute(rows, percent=85):
    """doc_id -> (number of shingles, component); rows: unique doc_ids."""
    sets, parent, having = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}, defaultdict(list)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        for j, n in Counter(j for s in sets[i] for j in having[s]).items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            having[s].append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


def families(n, seed, edits):
    """Copies with a few words changed, at all distances around the limit; some share a long passage only."""
    rng, rows = random.Random(seed), []
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(80)]
    for k in range(n):
        if k % 12 == 0:
            base = [word() for _ in range(rng.randrange(5, 160))]
        text = list(base)
        for _ in range(rng.randrange(0, edits(len(base)))):
            text[rng.randrange(len(text))] = word()
        if k % 9 == 0:
            text = [word() for _ in range(50)] + passage
        rows.append((k, " ".join(text)))
    return rows


def got(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


@pytest.mark.parametrize("block", [minmax.BLOCK, 3])
def test_components_equal_brute_force(make, block):
    rows = families(240, 5, lambda n: 2 + n // 12)
    assert got(minmax.near_duplicates(make([(i, t, "en", "a") for i, t in rows]), block=block)) == brute(rows)


def test_one_large_family_in_which_few_pairs_link(make):
    """Links form long chains: what the stars miss is found in the blocks."""
    rng = random.Random(11)
    text, rows = [f"w{rng.randrange(900)}" for _ in range(120)], []
    for k in range(150):
        text = list(text)
        text[rng.randrange(len(text))] = f"x{k}"
        rows.append((k, " ".join(text)))
    rng.shuffle(rows)
    assert got(minmax.near_duplicates(make([(i, t, "en", "a") for i, t in rows]))) == brute(rows)


def test_whole_table_equals_brute_force(spark, small):
    found = registry.op11_minmax_near_duplicates(spark, "/root/testdata/sf0.001").collect()
    want = brute([(r.doc_id, r.text) for r in small.collect()])
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == {i: (n, c, i == c) for i, (n, c) in want.items()}


def test_edges(edges, empty, make):
    rows = sorted(map(tuple, minmax.near_duplicates(edges).collect()), key=repr)
    one = lambda i: 1 if i in (1, 2) else i
    assert rows == sorted(((i, len(shingles(t)), one(i), one(i) == i) for i, t, _, _ in EDGE_ROWS), key=repr)
    assert minmax.near_duplicates(empty).count() == 0
    null = make([(None, "the same few words here", "en", "a")] * 2 + [(4, "the same few words here", "en", "a")])
    assert {tuple(r) for r in minmax.near_duplicates(null).collect()} == {(None, 3, 4, False), (4, 3, 4, True)}


def test_minima_and_maxima_estimate_without_bias():
    """Over many pairs of sets the share of equal values is their Jaccard index, with less variance than minima alone."""
    rng = np.random.default_rng(8)
    errors, minima = [], []
    for _ in range(150):
        n, common = 200, int(rng.integers(60, 190))
        values = rng.integers(0, 1 << 63, 2 * n - common, dtype=np.uint64)
        a, b = values[:n], values[n - common :]
        both = minmax.min_max(np.concatenate((a, b)), np.array([0, n]))
        same = both[0] == both[1]
        errors.append(same.mean() - common / len(values))
        minima.append(same[: minmax.PERMUTATIONS].mean() - common / len(values))
    assert abs(np.mean(errors)) < 0.01
    assert np.std(errors) < 0.85 * np.std(minima)
    assert both.shape == (2, 2 * minmax.PERMUTATIONS)
    assert (minmax.band_keys(both)[0] != minmax.band_keys(both)[1]).any()


def test_bands_find_pairs_at_the_limit():
    """Pairs at an index of 0.85 share a band."""
    rng = np.random.default_rng(2)
    for n in (6, 37, 370):
        for _ in range(100):
            apart = -(-15 * n // 185) if n > 6 else 0
            values = rng.integers(0, 1 << 63, n + apart + (n == 6), dtype=np.uint64)
            a, b = values[:n], values[apart:] if n > 6 else values
            both = minmax.min_max(np.concatenate((a, b)), np.array([0, n]))
            keys = minmax.band_keys(both)
            if 100 * (n - apart) >= 85 * len(values):
                assert (keys[0] == keys[1]).any()


def test_intersections_equal_brute_force():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 5000, int(rng.integers(0, 4000)), dtype=np.uint64)) for _ in range(14)]
    got = minmax.intersections(sets[:6], sets[6:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[6:]] for a in sets[:6]]


def test_sets_equal_brute_force():
    texts = [t or "" for _, t, _, _ in EDGE_ROWS]
    sets = shingle_sets(texts, 3)
    assert [len(sets.of(i)) for i in range(len(texts))] == [len(shingles(t)) for t in texts]
