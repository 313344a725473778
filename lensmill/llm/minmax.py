"""Near-duplicates by min-max hashing.

Texts become sets of word shingles; equal sets are one node, named by a number that is fixed when the table of nodes is
written. A permutation of the shingles' digests gives two values of a set, its minimum and its maximum. Each of the two
agrees between two sets with probability of their Jaccard index, so ``PERMUTATIONS`` permutations give twice as many
values, at half the hashing. ``ROWS`` values are a band; sets with an equal band are candidates. With 40 bands of 6 a
pair at an index of 0.85 is no candidate with probability 5.9e-9, and less above.

1. *Stars.* Each band's bucket has a lead, one of its nodes chosen by a digest; of its leads a node is compared with the one
   it shares most bands with. This connects most copies, one comparison a node, in buckets of any size.
2. *Blocks.* A bucket whose nodes are in one component has nothing left to find. In the others, without those that have the
   members of another one, all nodes of different components are compared, in blocks of ``BLOCK`` by ``BLOCK`` nodes, each of
   which is a task's work. The sizes of all intersections in a block are a product of its two incidence matrices.

Every link is confirmed by an exact comparison of the full sets: texts of nodes with candidates are fetched, and travel as
texts, which take less room than their sets' digests. Blocks report only links that connect components.

Edge cases: a null or empty text has no shingles, no links, and is a component of its own with its own doc_id (or null);
equal texts and repeated rows are one component; a component of null doc_ids alone has a null id; sets too small to link
with a different one are only found equal; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lensmill.llm.common import job, stored, whole_text
from lensmill.llm.components import components
from lensmill.llm.fingerprints import mix
from lensmill.llm.shingles import linked, set_digest, shingle_sets
from lensmill.llm.signature_tree import Groups

_U = np.uint64
PERMUTATIONS = 120
ROWS = 6
BANDS = 2 * PERMUTATIONS // ROWS
#: Nodes of a part of a bucket; two parts are compared at a time.
BLOCK = 512
#: Columns of an incidence matrix that are multiplied at a time.
COLUMNS = 4096
TEXTS_AT_ONCE = 256

_FACTORS = mix(np.arange(1, PERMUTATIONS + 1).astype(_U) * _U(0x9E3779B97F4A7C15)) | _U(1)


def min_max(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Row per set: the minima, then the maxima, under all permutations. Sets are ``values[starts[i] : starts[i + 1]]``
    and not empty; starts has no end."""
    out = np.empty((2 * PERMUTATIONS, len(starts)), _U)
    for k, by in enumerate(_FACTORS):
        own = values * by
        out[k] = np.minimum.reduceat(own, starts)
        out[PERMUTATIONS + k] = np.maximum.reduceat(own, starts)
    return np.ascontiguousarray(out.T)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """Digests of each row's bands; those of different bands differ. A band has as many minima as maxima, of different permutations."""
    both = signatures.reshape(len(signatures), 2, BANDS, ROWS // 2)
    # The maxima of a band are those of the next one's permutations.
    parts = np.concatenate((both[:, 0], np.roll(both[:, 1], 1, axis=1)), axis=2)
    keys = np.broadcast_to(mix(np.arange(1, BANDS + 1).astype(_U)), (len(signatures), BANDS)).copy()
    for k in range(ROWS):
        keys = mix(keys * _U(3) + parts[:, :, k])
    return keys


_SETS = "doc_id long, digest binary, size long, text_key binary, keys array<long>"


def _sets(documents: DataFrame, percent: int, width: int) -> DataFrame:
    """Per row: doc_id, digest and size of its set, key of its text, and its band keys where it can link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                sets = shingle_sets(batch.column("text").to_pylist(), width)
                sizes = np.diff(sets.offsets)
                # A set with one shingle more is the likest one.
                able = np.flatnonzero((sizes > 0) & (100 * sizes >= percent * (sizes + 1)))
                keys = [None] * len(batch)
                if len(able):
                    values = np.concatenate([sets.of(i) for i in able])
                    both = min_max(values, np.cumsum(sizes[able]) - sizes[able])
                    for i, own in zip(able.tolist(), band_keys(both).view(np.int64), strict=True):
                        keys[i] = own
                digests = [set_digest(sets.of(i)) if sizes[i] else None for i in range(len(batch))]
                columns = [pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), batch.column("text_key")]
                columns.append(pa.array(keys, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=[c.split()[0] for c in _SETS.split(", ")])

    return stored(_texts(documents).mapInArrow(run, _SETS), "minmax-sets")


def _texts(documents: DataFrame) -> DataFrame:
    texts = documents.select(F.col("doc_id").cast("long"), whole_text(F.col("text")).alias("text"))
    return texts.withColumn("text_key", F.unhex(F.md5("text")))


def _nodes(sets: DataFrame) -> DataFrame:
    """(node, digest, least, text_key, keys) per distinct set; least: its smallest doc_id; text_key: of one
    of its texts."""
    some = sets.where("size > 0").groupBy("digest").agg(F.min(F.struct("text_key", "keys")).alias("one"), F.min("doc_id").alias("least"))
    return stored(some.select(F.monotonically_increasing_id().alias("node"), "digest", "least", "one.*"), "minmax-nodes")


def _buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, node, lead): nodes that share a band with others; lead: one of them."""
    bands = nodes.select(F.explode("keys").alias("bucket"), "node")
    leads = bands.groupBy("bucket").agg(F.count("*").alias("n"), F.min_by("node", F.xxhash64("node")).alias("lead"))
    leads = stored(leads.where("n > 1").select("bucket", "lead"), "minmax-leads")
    return stored(bands.join(leads, "bucket"), "minmax-buckets")


def _fetched(documents: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) of the nodes wanted."""
    keys = nodes.join(wanted, "node", "left_semi").select("node", "text_key")
    found = _texts(documents).select("text_key", "text").join(keys, "text_key").select("node", "text")
    # Copies of a text would each be found.
    return stored(found.dropDuplicates(["node"]), "minmax-texts")


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """The rows of pairs (a, b) that link, by their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                sides = [shingle_sets(batch.column(c).to_pylist(), width) for c in ("of_a", "of_b")]
                keep = [linked(sides[0].of(i), sides[1].of(i), percent) for i in range(len(batch))]
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_a = pairs.select("a", "b").join(texts.select(F.col("node").alias("a"), F.col("text").alias("of_a")), "a")
    with_b = with_a.join(texts.select(F.col("node").alias("b"), F.col("text").alias("of_b")), "b")
    return stored(with_b.mapInArrow(run, "a long, b long"), "minmax-links", result=True)


def _stars(buckets: DataFrame) -> DataFrame:
    """(a, b): every node with the lead it shares most bands with."""
    shared = buckets.where("node != lead").groupBy(F.col("node").alias("a"), F.col("lead").alias("b")).agg(F.count("*").alias("n"))
    return stored(shared.groupBy("a").agg(F.max_by("b", F.struct("n", "b")).alias("b")), "minmax-stars", result=True)


def _mixed(buckets: DataFrame, clusters: DataFrame) -> DataFrame:
    """(bucket, node, cluster, n) of buckets with several clusters, one bucket of those with the same members."""
    rows = buckets.join(clusters.withColumnRenamed("component", "cluster"), "node", "left")
    rows = stored(rows.select("bucket", "node", F.coalesce("cluster", "node").alias("cluster")), "minmax-members")
    digest = [F.bit_xor(F.xxhash64("node")), F.bit_xor(F.xxhash64(F.lit(1), "node"))]
    folded = rows.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("cluster").alias("low"), F.max("cluster").alias("high"), *(d.alias(f"x{k}") for k, d in enumerate(digest))
    )
    chosen = folded.where("low != high").groupBy("n", "x0", "x1").agg(F.min("bucket").alias("bucket"))
    return stored(rows.join(stored(chosen.select("bucket", "n"), "minmax-chosen"), "bucket"), "minmax-mixed")


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The number of common values of every set on the left with every set on the right, by products of 0/1 matrices.

    Values that one set alone has add nothing and are left out first; counts are below 2 ** 24, so floats are exact.
    """
    out = np.zeros((len(left), len(right)), np.float32)
    sides = [np.concatenate(s) if s else np.zeros(0, _U) for s in (left, right)]
    owners = [np.repeat(np.arange(len(s)), [len(x) for x in s]) for s in (left, right)]
    both = np.intersect1d(*(np.unique(s) for s in sides), assume_unique=True)
    places = [np.searchsorted(both, s) for s in sides]
    here = [both[np.minimum(p, len(both) - 1)] == s if len(both) else np.zeros(len(s), bool) for p, s in zip(places, sides, strict=True)]
    places, owners = ([x[h] for x, h in zip(xs, here, strict=True)] for xs in (places, owners))
    for at in range(0, len(both), COLUMNS):
        n = min(COLUMNS, len(both) - at)
        matrices = []
        for p, o, rows in zip(places, owners, (len(left), len(right)), strict=True):
            some = (p >= at) & (p < at + n)
            matrix = np.zeros((rows, n), np.float32)
            matrix[o[some], p[some] - at] = 1
            matrices.append(matrix)
        out += matrices[0] @ matrices[1].T
    return out.astype(np.int64)


def _joined_groups(clusters: np.ndarray, pairs: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of clusters, of the linked pairs given, that connect as much as all of them."""
    groups, found = Groups(), []
    for a, b in np.unique(np.sort(clusters[pairs], axis=1), axis=0).tolist():
        x, y = groups.root(a), groups.root(b)
        if x != y:
            groups.join(x, y)
            found.append((a, b))
    return found


def _block_links(documents: DataFrame, nodes: DataFrame, mixed: DataFrame, percent: int, width: int, block: int) -> DataFrame:
    """(a, b): clusters that linked nodes of a bucket connect."""
    parts = F.ceil(F.col("n") / block)
    dealt = mixed.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("node"), parts))
    beside = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other")
    tasks = dealt.select("bucket", "node", "cluster", "part", beside).select(
        "bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "cluster"
    )
    by = ["bucket", "i", "j"]

    def compare(group: pa.Table) -> list[tuple[int, int]]:
        clusters, part, i, j = (group.column(c).to_numpy() for c in ("cluster", "part", "i", "j"))
        if (clusters == clusters[0]).all():
            return []
        sets = shingle_sets(group.column("text").to_pylist(), width)
        own, sizes = [sets.of(k) for k in range(len(group))], np.diff(sets.offsets)
        left, right = np.flatnonzero(part == i[0]), np.flatnonzero(part == j[0])
        common = intersections([own[k] for k in left], [own[k] for k in right])
        links = 100 * common >= percent * (sizes[left][:, None] + sizes[right][None, :] - common)
        links &= clusters[left][:, None] != clusters[right][None, :]
        x, y = np.nonzero(links)
        return _joined_groups(clusters, np.column_stack((left[x], right[y])))

    def out(found: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if waiting is None else pa.concat_tables([waiting, rows])
            ids = [rows.column(c).to_numpy() for c in by]
            new = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in ids])) + 1
            for a, b in zip([0, *new[:-1].tolist()], new.tolist(), strict=False):
                yield out(compare(rows.slice(a, b - a)))
            waiting = rows.slice(int(new[-1]) if len(new) else 0)
        if waiting is not None and len(waiting):
            yield out(compare(waiting))

    texts = _fetched(documents, nodes, mixed.select("node").distinct())
    rows = tasks.join(texts, "node").repartition(*by).sortWithinPartitions(*by)
    return stored(rows.select(*by, "part", "cluster", "text").mapInArrow(run, "a long, b long"), "minmax-links", result=True)


def _clusters(documents: DataFrame, nodes: DataFrame, percent: int, width: int, block: int) -> DataFrame:
    """(node, component) of nodes with links."""
    spark = documents.sparkSession
    with job(spark):
        buckets = _buckets(nodes.where("keys is not null"))
        with job(spark):
            stars = _stars(buckets)
        with job(spark):
            ends = stars.select(F.explode(F.array("a", "b")).alias("node")).distinct()
            links = _confirmed(stars, _fetched(documents, nodes, ends), percent, width)
        with job(spark):
            first = stored(components(links), "minmax-clusters", result=True)
        with job(spark):
            more = _block_links(documents, nodes, _mixed(buckets, first), percent, width, block)
        # A cluster is named by one of its nodes, so links of clusters and of nodes are one graph.
        return stored(components(links.unionAll(more)), "minmax-clusters", result=True)


def near_duplicates(documents: DataFrame, percent: int = 85, width: int = 3, block: int = BLOCK) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest doc_id it is connected with by links), kept (whether that
    is its own). Sets of ``width``-word shingles link at a Jaccard index of ``percent`` or more."""
    with job(documents.sparkSession):
        sets = _sets(documents, percent, width)
        nodes = _nodes(sets)
        clusters = _clusters(documents, nodes, percent, width, block)
        of_nodes = nodes.select("node", "digest", "least").join(clusters, "node", "left")
        of_nodes = stored(of_nodes.select("digest", "least", F.coalesce("component", "node").alias("cluster")), "minmax-of-nodes")
        least = stored(of_nodes.groupBy("cluster").agg(F.min("least").alias("component_id")), "minmax-least")
        found = stored(of_nodes.join(least, "cluster").select("digest", "component_id"), "minmax-found")
        linked_rows = sets.where("size > 0").join(found, "digest").select("doc_id", "size", "component_id")
        alone = sets.where("size = 0").select("doc_id", "size", F.col("doc_id").alias("component_id"))
        rows = linked_rows.unionAll(alone).withColumnRenamed("size", "n_shingles")
        kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
        return stored(rows.select("*", kept), "minmax-result", result=True)


def near_duplicates_sql(percent: int = 85, width: int = 3) -> str:
    """The same result, for a table whose doc_ids are distinct."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+')"
    return f"""
with recursive words as (select doc_id, {words} as w from documents),
shingles as (
  select distinct doc_id, unnest(case
    when len(w) >= {width} then list_transform(range(1, len(w) - {width} + 2), lambda k: array_to_string(w[k : k + {width - 1}], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] end) as s
  from words
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as both_have from shingles a join shingles b using (s) group by all),
links as (
  select a, b from common join sizes x on a = x.doc_id join sizes y on b = y.doc_id
  where 100 * both_have >= {percent} * (x.n + y.n - both_have)
),
reached (doc_id, top) as (select a, b from links union select r.doc_id, l.b from reached r join links l on r.top = l.a),
least as (select doc_id, min(top) as component_id from reached group by doc_id)
select doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(component_id, doc_id) as component_id,
  doc_id = coalesce(component_id, doc_id) as kept
from documents left join sizes using (doc_id) left join least using (doc_id)
"""
