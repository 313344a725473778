"""Exact Jaccard self-join on word shingles, with signature trees.

Two texts link when their sets of shingles have a Jaccard index of ``percent`` or more. Equal sets are one node. All
links are found, but as only the connected components matter, links inside a component that is known already are not
looked for:

1. *Stars.* Nodes that share one of a few smallest digests are compared with one node of that group, exactly.
   This connects most near copies, also in a group of any size, with one comparison a node.
2. *Blocks.* A link at Jaccard t needs a common shingle among the first n - ceil(t n) + 1 of each set in any global
   order. Frequent shingles are put last in that order, so passages that many documents share seldom count. A
   shingle is a block if nodes of different components have it there; blocks with the same members are folded.
3. *Trees.* Each block is joined by dual traversal of signature trees over bitmaps of a few bits per shingle. The
   few nodes that have a possible partner are joined again with their sets, where pairs are tested exactly. A block
   beyond ``block_items`` nodes is divided, and every pair of its parts is a task of its own.

Texts are read again where sets are needed, filtered by a bitmap of fixed size before they are parsed; what passes the
bitmap by chance is removed by the join that follows. For candidates alone, texts travel to where sets are compared.

Edge cases: a null or empty text has no shingles and is a component of its own, with its own doc_id (or null); rows
alike in everything are separate rows of one component; a component of null doc_ids alone has a null id; an empty table
gives an empty result; extra columns are ignored by ``components_of`` and kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from lensmill.llm import signature_tree
from lensmill.llm.common import job, narrow, small_batches, stored, whole_text
from lensmill.llm.components import components
from lensmill.llm.fingerprints import mix
from lensmill.llm.shingles import linked, set_digest, shingle_sets

_U = np.uint64
#: Bits of the bitmaps that filter texts and shingles: 4 MB, whatever the table's size.
BITMAP_BITS = 25
#: A shingle is frequent from this share of documents on; so there are fewer than its inverse times the mean set size.
FREQUENT = 0.0002
N_MINIMA = 4
#: Texts and their bytes that are made into sets at once, which takes some 40 times these bytes; a longer text goes alone.
TEXTS_AT_ONCE = 512
BYTES_AT_ONCE = 1 << 18
#: Shingles that a task counts at once.
COUNTED_AT_ONCE = 4_000_000


def _parts(batch: pa.RecordBatch, *texts: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices that hold few texts and few bytes in each column named."""
    ends = [np.cumsum(pc.binary_length(batch.column(c)).to_numpy(zero_copy_only=False)) for c in texts]
    at = 0
    while at < len(batch):
        fit = [int(np.searchsorted(e, (e[at - 1] if at else 0) + BYTES_AT_ONCE, "right")) for e in ends]
        to = max(at + 1, min(*fit, at + TEXTS_AT_ONCE))
        yield batch.slice(at, to - at)
        at = to


def _batched(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for part in _parts(batch, "text"):
        yield part, part.column("text").to_pylist()


def _repeated(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values that are there twice or more, and how often; sorts in place, since tasks have little room."""
    values.sort()
    found, counts = np.unique(values[1:][values[1:] == values[:-1]], return_counts=True)
    return found, counts + 1


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


def _frequent(texts: DataFrame) -> np.ndarray:
    """Shingles of at least FREQUENT of all documents, ascending. Each task counts its own and reports what is common there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0

        def common() -> pa.RecordBatch:
            together = np.concatenate(waiting or [np.zeros(0, _U)])
            waiting.clear()
            values, counts = _repeated(together)
            often = counts >= max(2, FREQUENT * n)
            rows = [_longs(np.concatenate((values[often], [_U(0)]))), pa.array(np.concatenate((counts[often], [n])), pa.int64())]
            # The last row counts documents.
            return pa.RecordBatch.from_arrays([*rows, pa.array([False] * int(often.sum()) + [True])], names=["shingle", "n", "total"])

        for batch in batches:
            for _, part in _batched(batch):
                waiting.append(shingle_sets(part).values)
                n += len(part)
                if sum(map(len, waiting)) > COUNTED_AT_ONCE:
                    yield common()
                    n = 0
        yield common()

    counted = texts.select("text").mapInArrow(run, "shingle long, n long, total boolean")
    sums = stored(counted.groupBy("shingle", "total").agg(F.sum("n").alias("n")).where("total or n >= 8"), "join-counts")
    n = sums.where("total").agg(F.sum("n")).first()[0] or 0
    often = sums.where(~F.col("total") & (F.col("n") >= FREQUENT * n)).select("shingle").toArrow()
    return np.sort(often.column("shingle").to_numpy().view(_U))


def _sets(documents: DataFrame, percent: int) -> DataFrame:
    """Per row: doc_id, text_key, digest, size, prefix, minima and bitmap. Without shingles the digest is null."""
    texts = documents.select(F.col("doc_id").cast("long"), whole_text(F.col("text")).alias("text"))
    with job(documents.sparkSession):
        often = documents.sparkSession.sparkContext.broadcast(_frequent(texts))
    multipliers = mix(np.arange(1, N_MINIMA + 1).astype(_U)) | _U(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = often.value
        for batch in batches:
            for part, texts in _batched(batch):
                sets = shingle_sets(texts)
                at = np.searchsorted(last, sets.values) if len(last) else None
                frequent = last[np.minimum(at, len(last) - 1)] == sets.values if len(last) else np.zeros(len(sets.values), bool)
                digests, prefixes, minima, maps = [], [], [], []
                for i in range(len(texts)):
                    own = sets.of(i)
                    n = len(own)
                    length = n - -(-percent * n // 100) + 1 if n else 0
                    later = frequent[sets.offsets[i] : sets.offsets[i + 1]]
                    ordered = np.concatenate((own[~later][:length], own[later])) if later.any() else own
                    prefixes.append(ordered[:length].view(np.int64))
                    digests.append(set_digest(own) if n else None)
                    maps.append(signature_tree.bitmap(own) if n else None)
                    minima.append([int(v) for v in (own[:, None] * multipliers).min(0).view(np.int64)] if n else [])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_key"),
                        pa.array(digests, pa.binary()),
                        pa.array(np.diff(sets.offsets), pa.int64()),
                        pa.array(prefixes, pa.list_(pa.int64())),
                        pa.array(minima, pa.list_(pa.int64())),
                        pa.array(maps, pa.binary()),
                    ],
                    names=["doc_id", "text_key", "digest", "size", "prefix", "minima", "bitmap"],
                )

    found = texts.withColumn("text_key", F.xxhash64("text")).mapInArrow(
        run, "doc_id long, text_key long, digest binary, size long, prefix array<long>, minima array<long>, bitmap binary"
    )
    return stored(found, "join-sets")


def _node(seed: int) -> Column:
    return F.when(F.col("digest").isNotNull(), F.xxhash64(F.lit(seed), "digest"))


def _without_collisions(sets: DataFrame) -> int:
    """A seed under which different digests have different 64-bit nodes."""
    for seed in range(64):
        nodes = sets.where("digest is not null").groupBy(_node(seed).alias("node"))
        if not nodes.agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a != b").limit(1).count():
            return seed
    raise ValueError("no seed separates the sets")


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Bits of all keys (one long column), as an array of fixed size."""
    bits = keys.select(F.pmod(F.col(keys.columns[0]), F.lit(1 << BITMAP_BITS)).alias("bit"))
    words = bits.groupBy(F.expr("cast(bit div 32 as int)").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit % 32 as int)))").alias("bits")
    )
    rows = words.toArrow()
    out = np.zeros(1 << (BITMAP_BITS - 5), np.uint32)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return out


def _has(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = keys & ((1 << BITMAP_BITS) - 1)
    return (bitmap[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1 == 1


def _texts_of(documents: DataFrame, keys: DataFrame, seed: int) -> DataFrame:
    """(node, text) of the texts whose key is in ``keys`` (text_key), and of a few others."""
    spark = documents.sparkSession
    bitmap = spark.sparkContext.broadcast(_bitmap(keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            wanted = _has(bitmap.value, batch.column("text_key").to_numpy())
            for part, texts in _batched(batch.filter(pa.array(wanted))):
                sets = shingle_sets(texts)
                rows = []
                # Copies in one task are one text.
                for i, key in enumerate(part.column("text_key").to_pylist()):
                    if key not in seen and len(sets.of(i)):
                        seen.add(key)
                        rows.append((set_digest(sets.of(i)), i))
                digests, places = list(zip(*rows, strict=True)) or [(), ()]
                columns = [pa.array(digests, pa.binary()), part.column("text").take(pa.array(places, pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["digest", "text"])

    texts = documents.select(whole_text(F.col("text")).alias("text")).withColumn("text_key", F.xxhash64("text"))
    found = texts.mapInArrow(run, "digest binary, text string")
    return found.select(_node(seed).alias("node"), "text")


def _texts(documents: DataFrame, nodes: DataFrame, wanted: DataFrame, seed: int) -> DataFrame:
    """(node, text) for the nodes wanted. nodes: (node, text_key). Texts travel, not sets: they take less room."""
    keys = nodes.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("text_key").alias("text_key"))
    found = _texts_of(documents, keys.select("text_key"), seed).join(wanted, "node", "left_semi")
    return stored(found.dropDuplicates(["node"]), "join-texts")


def _tested(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The rows of pairs (a, b, and what else) whose sets link, by an exact test."""
    names = pairs.columns

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _parts(whole, "of_a", "of_b"):
                sides = [shingle_sets(batch.column(c).to_pylist()) for c in ("of_a", "of_b")]
                keep = [linked(sides[0].of(i), sides[1].of(i), percent) for i in range(len(batch))]
                yield batch.select(names).filter(pa.array(keep, pa.bool_()))

    with_a = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("of_a")), "a")
    with_b = with_a.join(texts.select(F.col("node").alias("b"), F.col("text").alias("of_b")), "b")
    return with_b.select(*names, "of_a", "of_b").mapInArrow(test, pairs.schema)


def _stars(documents: DataFrame, sets: DataFrame, nodes: DataFrame, percent: int, seed: int) -> DataFrame:
    """Verified links (a, b) of nodes with one node of those that share one of their minima, another one per minimum."""
    n = N_MINIMA * sets.count()
    minima = sets.where("size > 0").select("node", "size", F.posexplode("minima").alias("k", "value"))
    lead = minima.groupBy("k", "value").agg(
        F.min_by(F.struct("node", "size"), F.xxhash64("node", "k")).alias("lead"),
        F.min("node").alias("low"),
        F.max("node").alias("high"),
    )
    lead = stored(narrow(lead.where("low != high").select("k", "value", "lead"), n), "join-leads")
    near = (100 * F.col("size") >= percent * F.col("lead.size")) & (100 * F.col("lead.size") >= percent * F.col("size"))
    pairs = minima.join(lead, ["k", "value"]).where((F.col("node") != F.col("lead.node")) & near)
    pairs = stored(narrow(pairs.select(F.col("node").alias("a"), F.col("lead.node").alias("b")).distinct(), n), "join-pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = _texts(documents, nodes, wanted, seed)
    return stored(_tested(pairs, texts, percent), "join-stars", result=True)


def _blocks(sets: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """(block, node, cluster, members): nodes of different clusters that share a shingle of their prefixes, and are not
    alone there with their size."""
    known = sets.where("size > 0")
    spread = known.select(F.explode("prefix").alias("block"), "node").groupBy("block").agg(
        F.min("node").alias("low"), F.max("node").alias("high")
    )
    shared = stored(spread.where("low != high").select("block"), "join-shared")
    bitmap = sets.sparkSession.sparkContext.broadcast(_bitmap(shared))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column("prefix")
            keys = prefix.flatten().to_numpy()
            row = np.repeat(np.arange(len(batch)), prefix.value_lengths().to_numpy())
            kept = _has(bitmap.value, keys)
            rows = batch.select(["node", "size"]).take(pa.array(row[kept]))
            yield pa.RecordBatch.from_arrays([pa.array(keys[kept], pa.int64()), *rows.columns], names=["block", "node", "size"])

    found = known.select("prefix", "node", "size").mapInArrow(run, "block long, node long, size long")
    found = found.join(shared, "block", "left_semi").distinct()
    # Linked sets differ little in size, so a member's next smaller or next larger one must be near.
    by_size = Window.partitionBy("block").orderBy("size")
    near = lambda a, b: 100 * a >= percent * b
    found = (
        found.withColumns({"down": F.lag("size").over(by_size), "up": F.lead("size").over(by_size)})
        .where(near(F.col("down"), F.col("size")) | near(F.col("size"), F.col("up")))
        .select("block", "node")
    )
    clustered = found.join(clusters.withColumnRenamed("component", "cluster"), "node", "left")
    members = stored(clustered.select("block", "node", F.coalesce("cluster", "node").alias("cluster")), "join-members")
    folded = members.groupBy("block").agg(
        F.count("*").alias("members"),
        F.bit_xor(F.xxhash64("node")).alias("digest"),
        F.min("cluster").alias("low"),
        F.max("cluster").alias("high"),
    )
    # Within one cluster there is nothing to find; of blocks with the same members one is enough.
    chosen = folded.where("low != high").groupBy("members", "digest").agg(F.min("block").alias("block"))
    return stored(members.join(stored(chosen.drop("digest"), "join-chosen"), "block"), "join-blocks", result=True)


def _per_task(rows: DataFrame, columns: list[str], schema: str, join: Callable[[pa.Table], list[tuple]]) -> DataFrame:
    """Applies ``join`` to the rows of every (block, i, j); it returns rows of ``schema``, whose columns are all long."""
    names = [c.split()[0] for c in schema.split(", ")]

    def out(found: list[tuple]) -> pa.RecordBatch:
        by_column = list(zip(*found, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in by_column], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if waiting is None else pa.concat_tables([waiting, table]).combine_chunks()
            ids = [table.column(c).to_numpy() for c in ("block", "i", "j")]
            new = np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([x[1:] != x[:-1] for x in ids])))).tolist()
            yield out([r for a, b in zip(new[:-1], new[1:], strict=True) for r in join(table.slice(a, b - a))])
            waiting = table.slice(new[-1])
        yield out(join(waiting) if waiting is not None else [])

    by = ["block", "i", "j"]
    return rows.select(*by, *columns).repartition(*by).sortWithinPartitions(*by).mapInArrow(run, schema)


def _tree_links(
    documents: DataFrame, sets: DataFrame, blocks: DataFrame, nodes: DataFrame, percent: int, seed: int, block_items: int
) -> DataFrame:
    """Verified links (a, b) between clusters."""
    parts = F.ceil(F.col("members") / block_items)
    dealt = blocks.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("node"), parts))
    beside = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other")
    tasks = dealt.select("block", "node", "cluster", "part", beside).select(
        "block", "node", "cluster", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part"
    )
    wanted = blocks.select("node").distinct()
    maps = sets.select("node", "size", "bitmap").join(wanted, "node", "left_semi").groupBy("node").agg(
        F.min("size").alias("size"), F.min("bitmap").alias("bitmap")
    )
    kept = ["block", "i", "j", "node", "cluster", "part"]

    more = ["other", "other_cluster", "pair"]

    def possible(group: pa.Table) -> list[tuple]:
        """Of a small block its possible pairs, of a large one the members that have a possible partner."""
        rows = [group.column(c).to_pylist() for c in kept]
        asked = [group.column(c).to_pylist() for c in ("bitmap", "size", "cluster", "part")]
        if len(group) <= signature_tree.TINY:
            pairs = signature_tree.tiny_pairs(*asked, percent)
            return [(*(r[i] for r in rows), rows[3][j], rows[4][j], 1) for i, j in pairs]
        return [(*(r[i] for r in rows), 0, 0, 0) for i in signature_tree.partners(*asked, percent)]

    asked = _per_task(
        tasks.join(maps, "node"),
        ["node", "cluster", "part", "size", "bitmap"],
        ", ".join(f"{c} long" for c in kept + more),
        possible,
    )
    found = stored(asked, "join-partners")
    of = lambda f, x, y: F.when(F.col("node") < F.col("other"), F.col(x)).otherwise(F.col(y)).alias(f)
    pairs = found.where("pair = 1").select(
        of("a", "node", "other"), of("b", "other", "node"), of("cluster_a", "cluster", "other_cluster"), of("cluster_b", "other_cluster", "cluster")
    )
    pairs = stored(pairs.distinct(), "join-pairs")
    few = found.where("pair = 0").select(*kept)
    # What is left of many blocks is alike: one of them is enough.
    task = F.struct("block", "i", "j")
    left = few.groupBy(task.alias("task")).agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "node", "part")).alias("y"),
    )
    chosen = stored(left.groupBy("n", "x", "y").agg(F.min("task").alias("task")).select("task.*"), "join-chosen")
    few = stored(few.join(chosen, ["block", "i", "j"]), "join-partners")
    wanted = few.select("node").unionAll(pairs.select(F.explode(F.array("a", "b")).alias("node"))).distinct()
    texts = _texts(documents, nodes, wanted, seed)

    def exact(group: pa.Table) -> list[tuple]:
        sets = shingle_sets(group.column("text").to_pylist())
        own = [sets.of(k) for k in range(len(group))]
        return signature_tree.links(own, group.column("cluster").to_pylist(), group.column("part").to_pylist(), percent)

    links = _per_task(few.join(texts, "node"), ["cluster", "part", "text"], "a long, b long", exact)
    single = _tested(pairs, texts, percent).select(F.col("cluster_a").alias("a"), F.col("cluster_b").alias("b"))
    return stored(links.unionAll(single), "join-links", result=True)


def _joined(documents: DataFrame, percent: int, block_items: int) -> DataFrame:
    """Per row: doc_id, text_key, size and cluster (null without shingles). What a step stores goes when its result is there."""
    spark = documents.sparkSession
    small_batches(spark)
    with job(spark):
        sets = _sets(documents, percent)
        seed = _without_collisions(sets)
        sets = sets.withColumn("node", _node(seed))
        nodes = sets.where("size > 0").select("node", "text_key")
        with job(spark):
            stars = _stars(documents, sets, nodes, percent, seed)
        with job(spark):
            first = stored(components(stars), "join-clusters", result=True)
        with job(spark):
            blocks = _blocks(sets, first, percent)
        with job(spark):
            links = _tree_links(documents, sets, blocks, nodes, percent, seed, block_items)
        second = stored(components(links), "join-clusters").select(F.col("node").alias("cluster"), F.col("component").alias("top"))
        rows = sets.select("doc_id", "text_key", "size", "node").join(first, "node", "left")
        rows = rows.withColumn("cluster", F.coalesce("component", "node")).join(second, "cluster", "left")
        rows = rows.select("doc_id", "text_key", "size", F.coalesce("top", "cluster").alias("cluster"))
        return stored(narrow(rows, sets.count()), "join-rows", result=True)


def components_of(documents: DataFrame, percent: int = 80, block_items: int = 4096) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest doc_id it is connected with by links)."""
    with job(documents.sparkSession):
        rows = _joined(documents, percent, block_items)
        least = rows.where("cluster is not null").groupBy("cluster").agg(F.min("doc_id").alias("least"))
        found = rows.join(stored(least, "join-least"), "cluster", "left").select(
            "doc_id",
            F.col("size").alias("n_shingles"),
            F.when(F.col("cluster").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
        )
        return stored(found, "join-components", result=True)


def one_of_each(documents: DataFrame, percent: int = 80, block_items: int = 4096) -> DataFrame:
    """The documents, all columns as they are: of each component the one with the smallest doc_id, of several such rows
    the one with the smallest text digest, and of rows alike in both just one. Documents without shingles stay."""
    with job(documents.sparkSession):
        rows = _joined(documents, percent, block_items)
        n = rows.count()
        rows = rows.where("cluster is not null")
        rows = rows.select(F.col("doc_id").alias("its_id"), F.col("text_key").alias("its_key"), "cluster")
        pairs = rows.groupBy("cluster", "its_id", "its_key").agg(F.count("*").alias("rows"))
        first = pairs.groupBy("cluster").agg(F.min(F.struct("its_id", "its_key")).alias("first"))
        first = stored(narrow(first, n), "join-first")
        kept = F.col("first").eqNullSafe(F.struct("its_id", "its_key"))
        # Only what goes and what is there several times meets the documents.
        special = pairs.join(first, "cluster").select("its_id", "its_key", "rows", kept.alias("kept")).where("rows > 1 or not kept")
        special = stored(narrow(special.drop("rows"), n), "join-special", result=True)
    whole = documents.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("row_id"),
        F.xxhash64(whole_text(F.col("text"))).alias("row_key"),
    )
    same = F.col("row_id").eqNullSafe(F.col("its_id")) & (F.col("row_key") == F.col("its_key"))
    # Documents that a bitmap of these keys rules out stay as they are and do not travel; what passes it by chance is told by the join.
    bitmap = documents.sparkSession.sparkContext.broadcast(_bitmap(special.select(F.xxhash64("its_id", "its_key").alias("key"))))

    @F.arrow_udf("boolean")
    def passes(keys: pa.Array) -> pa.Array:
        return pa.array(_has(bitmap.value, keys.to_numpy(zero_copy_only=False)))

    whole = whole.withColumn("passes", passes(F.xxhash64("row_id", "row_key")))
    asked = whole.where("passes")
    out = whole.where("not passes").select("row.*").unionAll(asked.join(special, same, "left").where("kept is null").select("row.*"))
    repeated = special.where("kept")
    if repeated.limit(1).count():
        once = asked.join(repeated, same).dropDuplicates(["row_id", "row_key"]).select("row.*")
        out = out.unionAll(once)
    return out
