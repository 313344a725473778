"""Signature trees over shingle sets, and the dual traversal that joins a tree with another or with itself.

A leaf holds a few sets; every node holds the OR of its sets' bitmaps, the range of their sizes, the largest number of
shingles that a set has beyond its bits (collisions), and the cluster they all belong to, if it is one. The overlap of a
set under node u with one under node v is at most the number of bits that both bitmaps have, plus the smaller of the
two collision counts, and at most either one's largest size. Pairs of nodes whose bound is below the least overlap that
their smallest sizes need are pruned, and so are pairs within one cluster: they are connected already.
"""

from __future__ import annotations

import numpy as np

from lensmill.llm.shingles import linked

LEAF = 8
FANOUT = 4


def bitmaps(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """One bitmap of ``bits`` bits (a power of two) per set, as rows of 64-bit words."""
    out = np.zeros((len(sets), bits), bool)
    for row, values in zip(out, sets, strict=True):
        row[values & np.uint64(bits - 1)] = True
    return np.packbits(out, axis=1, bitorder="little").view(np.uint64)


class Tree:
    """Levels of nodes over sets given in the order of the leaves."""

    def __init__(self, maps: np.ndarray, sizes: np.ndarray, clusters: np.ndarray):
        slack = sizes - np.bitwise_count(maps).sum(1).astype(np.int64)
        self.levels = [(maps, sizes, sizes, slack, clusters)]
        step = LEAF
        while len(self.levels[-1][0]) > 1:
            maps, low, high, slack, clusters = self.levels[-1]
            at = np.arange(0, len(maps), step)
            one = np.minimum.reduceat(clusters, at) == np.maximum.reduceat(clusters, at)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(maps, at, axis=0),
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                    np.maximum.reduceat(slack, at),
                    np.where(one, np.minimum.reduceat(clusters, at), -1),
                )
            )
            step = FANOUT

    def step(self, level: int) -> int:
        return LEAF if level == 1 else FANOUT


def candidates(a: Tree, b: Tree, percent: int, same: bool):
    """Pairs (i, j) of sets that the bounds can't rule out, level by level; i < j where both trees are the same one."""
    level = max(len(a.levels), len(b.levels)) - 1
    left, right = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while True:
        la, lb = min(level, len(a.levels) - 1), min(level, len(b.levels) - 1)
        kept = []
        for k in range(0, len(left), 8192):
            kept.append(_possible(a.levels[la], b.levels[lb], left[k : k + 8192], right[k : k + 8192], percent))
        keep = np.concatenate(kept) if kept else np.zeros(0, bool)
        left, right = left[keep], right[keep]
        if level == 0:
            break
        # Children of both nodes; a tree with fewer levels stays at its root meanwhile.
        left, right = _children(a, level, left, right)
        right, left = _children(b, level, right, left)
        if same:
            up = left <= right
            left, right = left[up], right[up]
        level -= 1
    apart = left < right if same else np.ones(len(left), bool)
    return left[apart], right[apart]


def _children(tree: Tree, level: int, own: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if level >= len(tree.levels):
        return own, other
    step, n = tree.step(level), len(tree.levels[level - 1][0])
    below = (own[:, None] * step + np.arange(step)).ravel()
    beside = np.repeat(other, step)
    return below[below < n], beside[below < n]


def _possible(u: tuple, v: tuple, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    maps_u, low_u, high_u, slack_u, cluster_u = (x[i] for x in u)
    maps_v, low_v, high_v, slack_v, cluster_v = (x[j] for x in v)
    fits = (100 * high_u >= percent * low_v) & (100 * high_v >= percent * low_u)
    fits &= (cluster_u != cluster_v) | (cluster_u < 0)
    most = np.bitwise_count(maps_u & maps_v).sum(1).astype(np.int64) + np.minimum(slack_u, slack_v)
    most = np.minimum(most, np.minimum(high_u, high_v))
    return fits & (most >= -(-percent * (low_u + low_v) // (100 + percent)))


class Groups:
    """Disjoint clusters of one task."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        path = []
        while (up := self.parent.get(x, x)) != x:
            path.append(x)
            x = up
        for y in path:
            self.parent[y] = x
        return x

    def join(self, x: int, y: int) -> None:
        self.parent[max(x, y)] = min(x, y)


#: Bits of a set's bitmap per shingle, at least.
BITS_PER_SHINGLE = 2
#: Sets up to which a block is joined pair by pair, without trees.
TINY = 12


def width(size: int) -> int:
    """Bits of a set's own bitmap: a power of two, 256 at least."""
    return 1 << max(8, (BITS_PER_SHINGLE * size - 1).bit_length())


def bitmap(values: np.ndarray) -> bytes:
    return bitmaps([values], width(len(values)))[0].tobytes()


def _order(sizes: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Leaves hold sets of about one size, and of those the ones alike in ``key``."""
    return np.lexsort((key, np.floor(np.log(sizes) / np.log(1.1))))


def _fold(maps: np.ndarray) -> np.ndarray:
    """Bitmaps of half the width: the upper half is laid over the lower one."""
    half = maps.shape[1] // 2
    return maps[:, :half] | maps[:, half:]


def partners(maps: list[bytes], sizes: list[int], clusters: list[int], side: list[int], percent: int) -> list[int]:
    """Indices of the sets that may have a partner, judged by their bitmaps alone. side: as in ``links``.

    Sets are joined per width of their bitmaps, and with those of twice the width, laid over; with links at half
    of the size at least, other widths can't meet.
    """
    if percent < 50:
        raise ValueError("percent must be 50 at least")
    if len(maps) <= TINY:
        return sorted({i for pair in tiny_pairs(maps, sizes, clusters, side, percent) for i in pair})
    all_sizes, all_clusters, sides = np.array(sizes, np.int64), np.array(clusters, np.int64), np.array(side)
    widths = np.array([len(m) for m in maps])
    trees: dict[tuple[int, int], tuple[np.ndarray, Tree, Tree | None]] = {}
    for w in np.unique(widths).tolist():
        for k in np.unique(sides).tolist():
            of = np.flatnonzero((widths == w) & (sides == k))
            if len(of):
                own = np.frombuffer(b"".join(maps[i] for i in of), np.uint64).reshape(len(of), -1)
                order = _order(all_sizes[of], own[:, 0].astype(np.int64))
                of, own = of[order], own[order]
                wide = Tree(own, all_sizes[of], all_clusters[of])
                narrow = Tree(_fold(own), all_sizes[of], all_clusters[of]) if w > 32 else None
                trees[w, k] = of, wide, narrow
    found: set[int] = set()
    for (w, k), (of, wide, _) in trees.items():
        for (w2, k2), (of2, wide2, narrow2) in trees.items():
            alone = len(np.unique(sides)) == 1
            if not alone and k == k2:
                continue
            if w2 == w and k2 >= k:
                left, right = candidates(wide, wide2, percent, k == k2)
            elif w2 == 2 * w and narrow2 is not None:
                left, right = candidates(wide, narrow2, percent, False)
            else:
                continue
            found.update(of[left].tolist(), of2[right].tolist())
    return sorted(found)


def tiny_pairs(
    maps: list[bytes], sizes: list[int], clusters: list[int], side: list[int], percent: int
) -> list[tuple[int, int]]:
    """Pairs of a small block that the bitmaps can't rule out, by comparing all of them."""
    numbers = [int.from_bytes(m, "little") for m in maps]
    found, two_sides = [], len(set(side)) > 1
    for i in range(len(maps)):
        for j in range(i):
            small, large = (i, j) if sizes[i] <= sizes[j] else (j, i)
            n, m = sizes[small], sizes[large]
            if clusters[i] == clusters[j] or (two_sides and side[i] == side[j]) or 100 * n < percent * m:
                continue
            x, y, bits = numbers[small], numbers[large], 8 * len(maps[small])
            if len(maps[large]) > len(maps[small]):
                y = (y >> bits) | (y & ((1 << bits) - 1))
            slack = min(n - x.bit_count(), m - y.bit_count())
            if min((x & y).bit_count() + slack, n) >= -(-percent * (n + m) // (100 + percent)):
                found.append((i, j))
    return found


def links(sets: list[np.ndarray], clusters: list[int], side: list[int], percent: int) -> list[tuple[int, int]]:
    """Linked pairs of clusters that connect all clusters which have a linked pair of sets.

    side: 0 and 1 are two blocks that are joined with each other; all equal, a block is joined with itself.
    """
    clusters_of = np.array(clusters, np.int64)
    sizes = np.array([len(s) for s in sets], np.int64)
    # Similar sets have the same smallest digest often.
    first = np.array([int(s[0]) >> 1 for s in sets], np.int64)
    bits = 1 << int(max(8, min(12, int(2 * np.median(sizes)).bit_length())))
    maps = bitmaps(sets, bits)
    trees, orders = [], []
    for k in sorted(set(side)):
        of = np.flatnonzero(np.array(side) == k)
        order = of[_order(sizes[of], first[of])]
        orders.append(order)
        trees.append(Tree(maps[order], sizes[order], clusters_of[order]))
    left, right = candidates(trees[0], trees[-1], percent, len(trees) == 1)
    groups, found = Groups(), []
    for i, j in zip(orders[0][left].tolist(), orders[-1][right].tolist(), strict=True):
        x, y = groups.root(clusters[i]), groups.root(clusters[j])
        if x != y and linked(sets[i], sets[j], percent):
            groups.join(x, y)
            found.append((clusters[i], clusters[j]))
    return found
