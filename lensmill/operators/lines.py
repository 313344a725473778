"""Order-preserving alignment of two lists of lines, in time near linear in their length.

Lines at both ends that are equal are paired. Of what is left, lines that occur once on either side are candidates for
anchors, and the longest run of them that ascends on both sides is taken; between anchors the same is done again, where
more lines occur once. A stretch without such lines pairs the n-th occurrence of a line with the n-th on the other side,
again along the longest ascending run. Of several longest runs the one is taken whose every anchor, from the last one
backwards, has the latest place on the left.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

import numpy as np

#: Levels of stretches between anchors; below, only n-th occurrences are paired. Keeps odd inputs near linear too.
DEPTH = 32


def ascending(places: Sequence[int]) -> list[int]:
    """Indices of the longest ascending run of distinct numbers."""
    tails: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for i, place in enumerate(places):
        k = bisect_left(tails, place)
        before.append(last[k - 1] if k else -1)
        tails[k : k + 1] = [place]
        last[k : k + 1] = [i]
    run, i = [], last[-1] if last else -1
    while i >= 0:
        run.append(i)
        i = before[i]
    return run[::-1]


def _once(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes that occur a single time, ascending, and where."""
    values, at, counts = np.unique(codes, return_index=True, return_counts=True)
    return values[counts == 1], at[counts == 1]


def _occurrences(codes: np.ndarray) -> np.ndarray:
    """How often each place's code has occurred before."""
    order = np.argsort(codes, kind="stable")
    ordered = codes[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(codes) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    out = np.empty(len(codes), np.int64)
    out[order] = np.arange(len(codes)) - np.repeat(starts, np.diff(np.append(starts, len(codes))))
    return out


def _common(left: np.ndarray, at_left: np.ndarray, right: np.ndarray, at_right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the values both sides have, by place on the left. Values are distinct on either side."""
    _, i, j = np.intersect1d(left, right, assume_unique=True, return_indices=True)
    order = np.argsort(at_left[i])
    return at_left[i][order], at_right[j][order]


def same_occurrence(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of each code's n-th occurrence on both sides, by place on the left."""
    times = len(left) + len(right) + 1
    keys = [c * times + _occurrences(c) for c in (left, right)]
    return _common(keys[0], np.arange(len(left)), keys[1], np.arange(len(right)))


def aligned(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (ascending on both sides) of the lines that are paired. Lines are given as codes."""
    pairs: list[tuple[int, int]] = []
    waiting = [(0, len(left), 0, len(right), 0)]
    while waiting:
        a, b, c, d, depth = waiting.pop()
        n = min(b - a, d - c)
        differ = np.flatnonzero(left[a : a + n] != right[c : c + n])
        head = int(differ[0]) if len(differ) else n
        pairs += zip(range(a, a + head), range(c, c + head), strict=True)
        a, c, n = a + head, c + head, n - head
        differ = np.flatnonzero(left[b - n : b][::-1] != right[d - n : d][::-1])
        tail = int(differ[0]) if len(differ) else n
        pairs += zip(range(b - tail, b), range(d - tail, d), strict=True)
        b, d = b - tail, d - tail
        if a == b or c == d:
            continue
        i, j = _common(*_once(left[a:b]), *_once(right[c:d])) if depth < DEPTH else ([], [])
        if not len(i):
            i, j = same_occurrence(left[a:b], right[c:d])
        run = ascending(j.tolist())
        if not run:
            continue
        anchors = [(a + int(i[k]), c + int(j[k])) for k in run]
        pairs += anchors
        if depth < DEPTH:
            edges = [(a - 1, c - 1), *anchors, (b, d)]
            waiting += [(x + 1, u, y + 1, v, depth + 1) for (x, y), (u, v) in zip(edges[:-1], edges[1:], strict=True)]
    found = np.array(sorted(pairs), np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def changes(left: Sequence[str], right: Sequence[str]) -> list[tuple[str, int | None, int | None]]:
    """(change, place on the left, place on the right) of every line that is not paired in order: ``moved`` where the
    other side has the line elsewhere, else ``removed`` or ``added``."""
    codes: dict[str, int] = {}
    of_left, of_right = (np.array([codes.setdefault(x, len(codes)) for x in side], np.int64) for side in (left, right))
    i, j = aligned(of_left, of_right)
    rest_left, rest_right = np.setdiff1d(np.arange(len(left)), i), np.setdiff1d(np.arange(len(right)), j)
    x, y = same_occurrence(of_left[rest_left], of_right[rest_right])
    moved = list(zip(rest_left[x].tolist(), rest_right[y].tolist(), strict=True))
    return [
        *(("moved", p, q) for p, q in moved),
        *(("removed", p, None) for p in np.delete(rest_left, x).tolist()),
        *(("added", None, q) for q in np.delete(rest_right, y).tolist()),
    ]
