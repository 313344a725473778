"""Ranked lexical search over a length-stratified index.

The score of a document for an item is the sum, over the item's terms, of ``w * ((SCALE * tf) div (1000 * tf + 8 * m))``.
Besides tf it depends on the document by its length normaliser m alone, so documents of equal m form a stratum, and a
term's postings are kept by tf within it: the impact of all documents of one (stratum, term, tf) is computed once.

* *Index.* One pass over the texts counts terms; a table row is a piece of a stratum with at most PIECE postings: its
  doc_ids, and per (term, tf) the places of the documents in that list. Pieces are dealt by ranges of (m, digest), so
  a stratum that holds a third of all documents is many pieces.
* *Bounds.* No document of a piece scores above the sum of the highest impacts that the item's terms have there.
* *Visits.* Every item first visits the pieces with its highest bounds; the last of its best scores there is a lower
  limit of its result. Then all other pieces are visited in the order they are stored, but for items whose bound there is
  below the limit, which grows further within a task. So no document that belongs to a result is passed over.

Only the terms that items ask for are indexed, but lengths, counts and document frequencies are those of all documents.
An item's terms go to every task; items are dealt into rounds of at most some TERMS_AT_ONCE terms, so what is sent
has a bound.

Edge cases: a null or empty text, or one without terms, is no document of the count N and scores nothing; an item
without terms has no rows; items alike in id and text are one item, items alike in id alone are ranked each on its own;
repeated documents are ranked each; of equal scores a null doc_id comes last; with fewer than ``best`` documents above
0 all of them are returned; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from lensmill.llm.common import job, stored, whole_text

#: ASCII letters and digits and all that is not ASCII; in UTF-8 that can be told byte by byte.
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")
TERM_SQL = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000
#: Postings of a piece, unless one document has more.
PIECE = 1 << 20
#: Documents of a piece.
PIECE_DOCUMENTS = 1 << 16
#: Terms of items that one round sends to the tasks, about.
TERMS_AT_ONCE = 1 << 20
#: Pieces an item visits first.
FIRST = 4


def terms(text: str) -> list[bytes]:
    """All terms of a text, A-Z lower-cased, in order and with repeats."""
    return _TERM.findall(text.encode().lower())


class Asked(NamedTuple):
    """Items of one round. Item i asks for the terms ``of[starts[i] : starts[i + 1]]``, numbers in ``vocabulary``."""

    ids: list[int | None]
    starts: np.ndarray
    of: np.ndarray
    vocabulary: dict[bytes, int]


def _items(items: DataFrame) -> DataFrame:
    """(item_id, terms) of distinct items with terms, numbered in the stored table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(t))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array(found, pa.list_(pa.binary()))], names=["item_id", "terms"]
            )

    texts = items.select(F.col("item_id").cast("long"), whole_text(F.col("text")).alias("text")).distinct()
    return stored(texts.mapInArrow(run, "item_id long, terms array<binary>").where("size(terms) > 0"), "search-items")


def _asked(items: DataFrame, rounds: int, k: int) -> Asked:
    of_round = F.pmod(F.xxhash64("item_id", "terms"), F.lit(rounds)) == k
    rows = items.where(of_round).toArrow()
    own = rows.column("terms").to_pylist()
    vocabulary = {t: i for i, t in enumerate(sorted({t for ts in own for t in ts}))}
    of = np.array([vocabulary[t] for ts in own for t in ts], np.int64)
    return Asked(rows.column("item_id").to_pylist(), np.cumsum([0, *map(len, own)]), of, vocabulary)


def _counted(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) per document: its number of terms, and those of the vocabulary with their counts."""
    sent = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value.get
        for batch in batches:
            lengths, found, counts = [], [], []
            for text in batch.column("text"):
                own = _TERM.findall(text.as_buffer().to_pybytes().lower())
                lengths.append(len(own))
                known = [(k, n) for t, n in Counter(own).items() if (k := number(t)) is not None]
                found.append([k for k, _ in known])
                counts.append([n for _, n in known])
            of = pa.list_(pa.int32())
            columns = [batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(found, of), pa.array(counts, of)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "tfs"])

    texts = documents.select(F.col("doc_id").cast("long"), whole_text(F.col("text")).alias("text"))
    counted = texts.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")
    return stored(counted, "search-counts")


def normaliser(n: Column, n_documents: int, n_terms: int) -> Column:
    """m of a document with n terms; in decimals, as 64 bits could overflow with very many documents."""
    wide = lambda x: F.lit(x).cast("decimal(20,0)")
    product = n.cast("decimal(14,0)") * wide(90 * n_documents)
    return F.lit(10) + F.call_function("div", product, wide(max(n_terms, 1)))


def weights(n_documents: int, frequencies: np.ndarray) -> np.ndarray:
    """w of terms by the number of documents that hold them."""
    return np.array([math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1))) for df in frequencies.tolist()], np.int64)


_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
_INDEX = "piece long, m long, doc_ids array<long>, terms array<int>, tfs array<int>, starts array<int>, places array<int>"


def _index(counted: DataFrame) -> DataFrame:
    """Pieces of strata. counted: with m."""

    def piece(number: int, rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        lists = rows.column("terms").chunk(0)
        owner = np.repeat(np.arange(len(rows)), lists.value_lengths().to_numpy())
        own, tfs = lists.flatten().to_numpy(), rows.column("tfs").chunk(0).flatten().to_numpy()
        order = np.lexsort((owner, tfs, own))
        own, tfs, owner = own[order], tfs[order], owner[order]
        new = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (tfs[1:] != tfs[:-1]))))
        starts = np.append(new, len(own))
        lists = [pa.array([x.astype(np.int32)], _INTS) for x in (own[new], tfs[new], starts, owner)]
        ids = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows.column("doc_id").chunk(0))
        columns = [pa.array([number]), rows.column("m").chunk(0)[:1], ids, *lists]
        return pa.RecordBatch.from_arrays(columns, names=["piece", "m", "doc_ids", "terms", "tfs", "starts", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: list[pa.Table] = []
        size = n = 0
        for batch in batches:
            m, lengths = batch.column("m").to_numpy(), batch.column("terms").value_lengths().to_numpy()
            at = 0
            for i in range(len(batch)):
                last = m[i - 1] if i else waiting[-1].column("m")[0].as_py() if waiting else m[0]
                if m[i] != last or (n and (size + lengths[i] > PIECE or n == PIECE_DOCUMENTS)):
                    if i > at:
                        waiting.append(pa.Table.from_batches([batch.slice(at, i - at)]))
                    yield piece(number, pa.concat_tables(waiting))
                    waiting, at, size, n, number = [], i, 0, 0, number + 1
                size, n = size + int(lengths[i]), n + 1
            waiting.append(pa.Table.from_batches([batch.slice(at)]))
        if n:
            yield piece(number, pa.concat_tables(waiting))

    spread = F.xxhash64("doc_id", "terms", "tfs")
    dealt = counted.withColumn("spread", spread).repartitionByRange("m", "spread").sortWithinPartitions("m", "spread")
    return stored(dealt.drop("spread").mapInArrow(run, _INDEX), "search-index")


class _Piece:
    """A row of the index, with impacts."""

    def __init__(self, row: dict[str, pa.Scalar], weight: np.ndarray):
        values = {k: row[k].values.to_numpy() for k in ("terms", "tfs", "starts", "places")}
        self.number, self.doc_ids = row["piece"].as_py(), row["doc_ids"].values
        self.terms, self.starts, self.places = values["terms"], values["starts"], values["places"]
        tf = values["tfs"].astype(np.int64)
        self.impacts = weight[self.terms] * (SCALE * tf // (1000 * tf + 8 * row["m"].as_py()))
        # Groups are ordered by term; of a term that is not here the two ends are equal.
        every = np.arange(len(weight))
        self.begin, self.end = np.searchsorted(self.terms, every), np.searchsorted(self.terms, every, "right")
        self.highest = np.zeros(len(weight), np.int64)
        here = np.flatnonzero(self.end > self.begin)
        self.highest[here] = np.maximum.reduceat(self.impacts, self.begin[here])

    def bounds(self, asked: Asked) -> np.ndarray:
        return np.add.reduceat(self.highest[asked.of], asked.starts[:-1])

    def scores(self, own: np.ndarray) -> np.ndarray:
        """Of all documents of the piece, for the terms of one item."""
        out = np.zeros(len(self.doc_ids), np.int64)
        for a, b in zip(self.begin[own].tolist(), self.end[own].tolist(), strict=True):
            if b > a:
                # A document has one tf of a term, so no place is there twice.
                lengths = self.starts[a + 1 : b + 1] - self.starts[a:b]
                out[self.places[self.starts[a] : self.starts[b]]] += np.repeat(self.impacts[a:b], lengths)
        return out

    def best(self, own: np.ndarray, best: int, limit: int) -> list[tuple[int, float, int | None]]:
        """(score, -doc_id, doc_id) of at most ``best`` documents with ``limit`` or more."""
        scores = self.scores(own)
        if len(scores) > best:
            limit = max(limit, int(np.partition(scores, len(scores) - best)[len(scores) - best]))
        found = np.flatnonzero(scores >= max(limit, 1))
        ids = self.doc_ids.take(pa.array(found)).to_pylist()
        rows = [(s, -math.inf if i is None else -i, i) for s, i in zip(scores[found].tolist(), ids, strict=True)]
        return heapq.nlargest(best, rows)


def _pieces(batches: Iterator[pa.RecordBatch], weight: np.ndarray) -> Iterator[_Piece]:
    for batch in batches:
        for i in range(len(batch)):
            yield _Piece({k: batch.column(k)[i] for k in batch.schema.names}, weight)


def _rows(found: dict[int, list[tuple]]) -> pa.RecordBatch:
    rows = [(k, i, s) for k, best in found.items() for s, _, i in best]
    columns = list(zip(*rows, strict=True)) or [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "doc_id", "score"])


def _merged(rows: DataFrame, best: int) -> DataFrame:
    """The best rows of every item with their rank."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def _first_pieces(index: DataFrame, asked, weight, n_items: int) -> dict[int, list[int]]:
    """piece -> items that visit it first: the pieces with an item's highest bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = asked.value
        bounds, numbers = np.zeros((0, n_items), np.int64), np.zeros(0, np.int64)
        for piece in _pieces(batches, weight.value):
            bounds = np.vstack((bounds, piece.bounds(items)))
            numbers = np.append(numbers, piece.number)
            if len(numbers) > 4 * FIRST:
                bounds, numbers = highest(bounds, numbers)
        if len(numbers):
            bounds, numbers = highest(bounds, numbers)
            where = np.nonzero(bounds)
            columns = [where[1], numbers[where[0]], bounds[where]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "piece", "bound"])

    def highest(bounds: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds below an item's FIRST highest ones become 0; pieces without any go."""
        if len(numbers) > FIRST:
            least = np.partition(bounds, len(numbers) - FIRST, axis=0)[len(numbers) - FIRST]
            bounds = np.where(bounds >= least, bounds, 0)
        some = bounds.any(1)
        return bounds[some], numbers[some]

    found = index.mapInArrow(run, "item long, piece long, bound long")
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "piece")
    rows = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= FIRST).toArrow()
    out: dict[int, list[int]] = {}
    for item, piece in zip(rows.column("item").to_pylist(), rows.column("piece").to_pylist(), strict=True):
        out.setdefault(piece, []).append(item)
    return out


def _visit(index: DataFrame, asked, weight, best: int, limits: np.ndarray, only: dict[int, list[int]] | None) -> DataFrame:
    """(item, doc_id, score): per task an item's best documents. only: piece -> the items that visit it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, least = asked.value, limits.copy()
        found: dict[int, list[tuple]] = {}
        for piece in _pieces(batches, weight.value):
            bounds = piece.bounds(items)
            visitors = np.flatnonzero(bounds >= np.maximum(least, 1)).tolist()
            for k in visitors if only is None else only.get(piece.number, []):
                own = items.of[items.starts[k] : items.starts[k + 1]]
                rows = heapq.nlargest(best, found.get(k, []) + piece.best(own, best, int(least[k])))
                if rows:
                    found[k] = rows
                    least[k] = max(least[k], rows[-1][0] if len(rows) == best else 0)
        yield _rows(found)

    wanted = index if only is None else index.where(F.col("piece").isin(list(only)))
    # Few files hold many pieces: a piece is little to read and much to score.
    spark = index.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    wanted = wanted.repartition(tasks, "piece")
    return wanted.mapInArrow(run, "item long, doc_id long, score long")


def _round(documents: DataFrame, asked: Asked, best: int) -> DataFrame:
    spark = documents.sparkSession
    counted = _counted(documents, asked.vocabulary)
    n_documents, n_terms = counted.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    rows = counted.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    frequencies = np.zeros(len(asked.vocabulary), np.int64)
    frequencies[rows.column("term").to_numpy()] = rows.column("count").to_numpy()
    weight = spark.sparkContext.broadcast(weights(n_documents, frequencies))
    with_m = counted.where("size(terms) > 0").select("doc_id", normaliser(F.col("n"), n_documents, n_terms).alias("m"), "terms", "tfs")
    index = _index(with_m)
    items = spark.sparkContext.broadcast(asked._replace(vocabulary={}))
    first = _first_pieces(index, items, weight, len(asked.ids))
    limits = np.zeros(len(asked.ids), np.int64)
    if first:
        begun = _merged(_visit(index, items, weight, best, limits, first), best)
        last = begun.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") == best).toArrow()
        limits[last.column("item").to_numpy()] = last.column("least").to_numpy()
    ranked = _merged(_visit(index, items, weight, best, limits, None), best)
    ids = spark.createDataFrame(list(enumerate(asked.ids)), "item long, item_id long")
    return stored(ranked.join(ids, "item").select("item_id", "rank", "doc_id", "score"), "search-ranked")


def search(documents: DataFrame, items: DataFrame, best: int = 10, terms_at_once: int = TERMS_AT_ONCE) -> DataFrame:
    """Per item its ``best`` documents: item_id, rank, doc_id, score. items: (item_id, text)."""
    spark = documents.sparkSession
    with job(spark):
        asked = _items(items)
        n = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
        rounds = -(-n // terms_at_once)
        found = [_round(documents, one, best) for k in range(rounds) if (one := _asked(asked, rounds, k)).ids]
        none = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
        return stored(reduce(DataFrame.unionAll, found, none), "search-result", result=True)


def search_sql(best: int = 10) -> str:
    """The same result for tables ``documents`` and ``benchmark`` whose ids are distinct."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    found = f"unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '{TERM_SQL}'))"
    return f"""
with words as (select doc_id, {found} as term from documents),
postings as (select doc_id, term, count(*) as tf from words group by all),
lengths as (select doc_id, count(*) as n from words group by all),
total as (select count(*) as docs, sum(n)::bigint as terms from lengths),
normal as (select doc_id, 10 + (90 * n * docs) // terms as m from lengths, total),
asked as (select distinct item_id, {found} as term from benchmark),
weight as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from postings, total where term in (select term from asked) group by term, docs
),
scored as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from asked join weight using (term) join postings using (term) join normal using (doc_id) group by all
),
ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score
  from scored where score > 0
)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= {best}
"""
