"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Documents become pieces of at most ``capacity`` tokens; only longer documents are cut, into full pieces after a
first shorter one. Full pieces are sequences of their own. The other pieces are dealt into regions by a hash
of their number, so that no key, source or group of copies weighs on one region, and each region is packed by
several islands that share its pieces and differ in their seeds:

* an individual is a list of bins; the first ones come from best-fit in decreasing and in shuffled orders;
* a crossover injects whole well-filled bins of one parent into the other, removes the bins that now hold a
  piece twice, and best-fits the displaced pieces, longest first;
* after each epoch every island hands its elite to the next island of its region (a join on region and island)
  and goes on from its own elite, the migrant and fresh individuals.

Regions are bounded (``region_items``), so a task's memory does not grow with the table. Waste per region is a
few sequences in thousands.

Edge cases: a null or empty text is a piece of one end token; repeated rows are packed once each; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, WindowSpec, functions as F

from lensmill.llm import bpe
from lensmill.llm.common import small_batches, stored, whole_text

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Of an island's state between epochs: per bin its pieces, as one array with bin numbers in piece order.
ELITE = "region long, island int, n_bins int, filled double, bins array<int>"


def cut_lengths(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: full ones, the first may be shorter."""
    first = total % capacity or min(total, capacity)
    bounds = [0, *range(first, total + 1, capacity)] if total else []
    return [(a, b - a) for a, b in zip(bounds, bounds[1:], strict=False)]


def cut(
    documents: DataFrame, path: str, ranks_path: str | None, end_id: int, capacity: int, keep_ids: bool = False
) -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids_crc32 and, if wanted, the ids themselves."""
    small_batches(documents.sparkSession)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = bpe.encoder(path, ranks_path)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.array([*encode(text), end_id], "<u4")
                for k, (start, length) in enumerate(cut_lengths(len(ids), capacity)):
                    part = ids[start : start + length]
                    rows.append((doc_id, k, start, length, zlib.crc32(part.tobytes())) + ((part,) if keep_ids else ()))
            columns = list(zip(*rows, strict=True)) or [()] * (6 if keep_ids else 5)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=False)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)],
            )

    rows = documents.select(F.col("doc_id").cast("long"), whole_text(F.col("text")).alias("text"))
    return rows.mapInArrow(pieces, PIECES + (", ids array<int>" if keep_ids else ""))


class Bins:
    """Bins of one individual, with the bins of each free space at hand.

    ``spaces`` has bit s set where some bin has exactly s free, so best fit is the lowest set bit from the
    piece's length on.
    """

    def __init__(self, lengths: list[int], capacity: int, bins: list[list[int]]):
        self.lengths, self.capacity, self.bins = lengths, capacity, bins
        self.free = [capacity - sum(lengths[i] for i in b) for b in bins]
        self.by_space: dict[int, list[int]] = {}
        self.spaces = 0
        for b, space in enumerate(self.free):
            self._offer(b, space)

    def _offer(self, b: int, space: int) -> None:
        if space:
            self.by_space.setdefault(space, []).append(b)
            self.spaces |= 1 << space

    def best_fit(self, pieces: list[int]) -> Bins:
        for i in pieces:
            length = self.lengths[i]
            fitting = self.spaces >> length
            if fitting:
                space = length + (fitting & -fitting).bit_length() - 1
                there = self.by_space[space]
                b = there.pop()
                if not there:
                    self.spaces &= ~(1 << space)
                self.bins[b].append(i)
            else:
                b, space = len(self.bins), self.capacity
                self.bins.append([i])
                self.free.append(space)
            self.free[b] = space - length
            self._offer(b, space - length)
        return self

    def fitness(self) -> tuple[int, float]:
        """Fewer bins first; of equally many, those that are filled most unevenly. Smaller is better."""
        return len(self.bins), -sum((1 - f / self.capacity) ** 2 for f in self.free)


def crossover(into: Bins, other: Bins, rng: np.random.Generator) -> Bins:
    """A child: well-filled bins of ``other`` whole, the bins of ``into`` that do not touch them, the rest best-fitted."""
    full = [b for b, f in zip(other.bins, other.free, strict=True) if f <= other.capacity // 100]
    start, stop = sorted(rng.integers(0, len(full) + 1, 2).tolist())
    injected = full[start:stop]
    taken = {i for b in injected for i in b}
    kept = [b for b in into.bins if taken.isdisjoint(b)]
    here = taken.union(*kept)
    displaced = [i for b in into.bins for i in b if i not in here]
    displaced.sort(key=into.lengths.__getitem__, reverse=True)
    return Bins(into.lengths, into.capacity, [list(b) for b in injected + kept]).best_fit(displaced)


def evolve(lengths: list[int], elites: list[list[int]], seed: list[int], capacity: int, generations: int) -> Bins:
    """One epoch of one island, from the elites given and fresh individuals."""
    rng = np.random.default_rng(seed)
    order = sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True)
    population = []
    for elite in elites:
        bins: list[list[int]] = [[] for _ in range(max(elite, default=-1) + 1)]
        for i, b in enumerate(elite):
            bins[b].append(i)
        population.append(Bins(lengths, capacity, bins))
    if not population:
        population.append(Bins(lengths, capacity, []).best_fit(order))
    # Nearly decreasing orders keep the long pieces first and differ among the short ones.
    blurred = np.argsort([-lengths[i] * rng.uniform(0.9, 1) for i in range(len(lengths))]).tolist()
    population.append(Bins(lengths, capacity, []).best_fit(blurred))
    for _ in range(generations):
        a, b = rng.permutation(len(population))[:2].tolist()
        child = crossover(population[a], population[b], rng)
        worst = max(range(len(population)), key=lambda k: population[k].fitness())
        if child.fitness() <= population[worst].fitness():
            population[worst] = child
    return min(population, key=Bins.fitness)


def _epoch(islands: DataFrame, epoch: int, seed: int, capacity: int, generations: int) -> DataFrame:
    """islands: region, island, lengths, elites (array of arrays of bin numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                best = evolve(row["lengths"], row["elites"], [seed, epoch, row["region"], row["island"]], capacity, generations)
                place = np.zeros(len(row["lengths"]), np.int32)
                for b, pieces in enumerate(best.bins):
                    place[pieces] = b
                n_bins, filled = best.fitness()
                yield pa.RecordBatch.from_pylist(
                    [{"region": row["region"], "island": row["island"], "n_bins": n_bins, "filled": filled, "bins": place.tolist()}],
                    pa.schema([("region", pa.int64()), ("island", pa.int32()), ("n_bins", pa.int32()), ("filled", pa.float64()), ("bins", pa.list_(pa.int32()))]),
                )

    return islands.mapInArrow(run, ELITE)


def place(
    pieces: DataFrame,
    capacity: int = 1024,
    region_items: int = 8192,
    n_islands: int = 3,
    epochs: int = 2,
    generations: int = 5,
    seed: int = 5,
) -> DataFrame:
    """(item, sequence_id, offset) for pieces (item, length), each shorter than the capacity; items are unique."""
    n_regions = max(1, -(-pieces.count() // region_items))
    regions = stored(
        pieces.groupBy(F.pmod(F.xxhash64("item"), F.lit(n_regions)).alias("region"))
        .agg(F.sort_array(F.collect_list(F.struct("item", F.col("length").cast("int").alias("length")))).alias("of"))
        .select("region", F.col("of.item").alias("items"), F.col("of.length").alias("lengths")),
        "pack-regions",
    )
    tasks = max(1, min(n_regions * n_islands, 100_000))
    islands = regions.select("region", "lengths", F.explode(F.sequence(F.lit(0), F.lit(n_islands - 1))).alias("island"))
    none = F.array().cast("array<array<int>>")
    elite = None
    for epoch in range(epochs):
        if elite is None:
            begun = islands.withColumn("elites", none)
        else:
            # An island's own elite and that of its neighbour.
            moved = elite.select("region", F.explode(F.array("island", F.pmod(F.col("island") + 1, F.lit(n_islands)))).alias("island"), "bins")
            begun = islands.join(moved.groupBy("region", "island").agg(F.collect_list("bins").alias("elites")), ["region", "island"])
        dealt = begun.repartition(tasks, "region", "island")
        elite = stored(_epoch(dealt, epoch, seed, capacity, generations), "pack-elites")
    best = elite.groupBy("region").agg(F.min_by("bins", F.struct("n_bins", "filled", "island")).alias("bins"))
    return best.join(regions, "region").select("region", F.explode(F.arrays_zip("items", "lengths", "bins")).alias("of")).select(
        F.col("of.items").alias("item"),
        (F.col("region") * region_items * 64 + F.col("of.bins")).alias("sequence_id"),
        F.col("of.lengths").alias("length"),
    )


def pack(
    documents: DataFrame,
    path: str,
    ranks_path: str | None = None,
    end_id: int = 2,
    capacity: int = 1024,
    keep_ids: bool = False,
    **search,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32 (and ids), sequence_id, offset."""
    cut_up = cut(documents, path, ranks_path, end_id, capacity, keep_ids)
    pieces = stored(cut_up.withColumn("item", F.monotonically_increasing_id()), "pack-pieces")
    placed = place(pieces.where(F.col("length") < capacity).select("item", "length"), capacity, **search)
    # Sequences are small groups: at most as many pieces as tokens.
    at = F.sum("length").over(_in_sequence()) - F.col("length")
    offsets = placed.withColumn("offset", at.cast("long")).drop("length")
    shared = pieces.where(F.col("length") < capacity).join(offsets, "item")
    alone = pieces.where(F.col("length") >= capacity).withColumns(
        {"sequence_id": -1 - F.col("item"), "offset": F.lit(0).cast("long")}
    )
    return shared.unionByName(alone).drop("item")


def _in_sequence() -> WindowSpec:
    return Window.partitionBy("sequence_id").orderBy("item").rowsBetween(Window.unboundedPreceding, Window.currentRow)
