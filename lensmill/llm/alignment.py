"""Alignment of two tokenizers over the same text, and how often their tokens meet.

Tokenizer A is a byte-level BPE (.json, given a space and the text), B a sentencepiece model (given the text; it adds
the space itself). The tokens of both are intervals of one byte string. Intervals are coalesced: all tokens of A and B are
sorted by start, a running maximum of the ends is kept, and a new group begins where a start reaches the maximum of all
ends before it. Within a group every pair of an A and a B token whose bytes overlap is a link.

Documents are encoded and aligned once, in one pass; the links of a document are stored as its distinct id pairs with
their multiplicities. An id pair's count is the number of documents that hold it, an aggregation that combines in the
tasks. To score the links, the frequent pairs (at most ``sent`` of them, from a threshold found by a histogram of the
counts) go to every task as sorted arrays; links of rarer pairs are joined by shuffle. By this no frequent pair, which
nearly every document holds, is a hot key of a join, and what is sent has a bound.

Edge cases: a null or empty text, and one whose joined token bytes under A or B are not a space and the text (a
normaliser changed it, or it holds U+2581), has zeros and an empty digest; rows are kept as they are, also repeated ones
and those with null doc_ids, and each row counts as a document; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lensmill.llm import bpe
from lensmill.llm.common import job, stored, whole_text

#: Id pairs that are sent to every task: 17 bytes each.
SENT = 1 << 20
#: An id pair (a, b) is the number a * WIDE + b.
WIDE = 1 << 32
TEXTS_AT_ONCE = 256


class Tokenizer(NamedTuple):
    """encode: text -> ids. starts, data: the bytes of id i are ``data[starts[i] : starts[i + 1]]``."""

    encode: Callable[[str], list[int]]
    starts: np.ndarray
    data: np.ndarray

    def lengths(self, ids: np.ndarray) -> np.ndarray:
        return self.starts[ids + 1] - self.starts[ids]

    def bytes_of(self, ids: np.ndarray) -> bytes:
        """The joined bytes of a sequence of tokens."""
        lengths = self.lengths(ids)
        ends = np.cumsum(lengths)
        place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
        return self.data[np.repeat(self.starts[ids], lengths) + place].tobytes()


def _with_table(encode: Callable[[str], list[int]], entries: list[bytes]) -> Tokenizer:
    return Tokenizer(encode, np.cumsum([0, *map(len, entries)]), np.frombuffer(b"".join(entries), np.uint8))


def _byte_characters() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable Latin-1 characters for themselves, the
    other bytes, in order, for the characters from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=2)
def _library(path: str) -> Callable[[str], list[int]]:
    """The ``tokenizers`` library's way of encoding, special strings as plain text."""
    from tokenizers import Tokenizer as Library

    library = Library.from_file(path)
    library.no_truncation()
    library.no_padding()
    library.encode_special_tokens = True
    return lambda text: library.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def byte_level(path: str, ranks_path: str | None = None) -> Tokenizer:
    """A byte-level .json vocabulary; special strings are plain text. ranks_path: the same vocabulary as ranks, with
    which texts are encoded faster and to the same ids; then the library is only loaded for a text that needs it."""
    with open(path) as file:
        stated = json.load(file)
    vocabulary = stated["model"]["vocab"] | {t["content"]: t["id"] for t in stated["added_tokens"]}
    stands_for = _byte_characters()
    entries = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        entries[i] = bytes(stands_for[c] for c in token) if all(c in stands_for for c in token) else token.encode()
    fast = bpe.ranked(path, ranks_path) if ranks_path else None
    if fast is None:
        return _with_table(_library(path), entries)

    def encode(text: str) -> list[int]:
        try:
            return fast.encode_ordinary(text)
        except ValueError:
            return _library(path)(text)

    return _with_table(encode, entries)


@lru_cache(maxsize=2)
def pieces(path: str) -> Tokenizer:
    """A sentencepiece model with byte fallback."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    entries = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece) if model.is_byte(i) else None
        entries.append(bytes.fromhex(byte[1]) if byte else piece.replace("▁", " ").encode())
    return _with_table(lambda text: model.encode(text, num_threads=1), entries)


class Alignment(NamedTuple):
    """Of one text. links: one id pair per link, as a number."""

    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    n_groups: int
    links: np.ndarray


def coalesce(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The group of each interval; they are given by ascending start."""
    if not len(starts):
        return np.zeros(0, np.int64)
    reached = np.maximum.accumulate(ends)
    return np.cumsum(np.concatenate(([0], starts[1:] >= reached[:-1])))


def align(text: str | None, a: Tokenizer, b: Tokenizer) -> Alignment | None:
    """None where the tokens' bytes are not a space and the text."""
    if not text:
        return None
    ids_a, ids_b = np.array(a.encode(" " + text), np.int64), np.array(b.encode(text), np.int64)
    whole = b" " + text.encode()
    if a.bytes_of(ids_a) != whole or b.bytes_of(ids_b) != whole:
        return None
    end_a, end_b = np.cumsum(a.lengths(ids_a)), np.cumsum(b.lengths(ids_b))
    start_a, start_b = end_a - a.lengths(ids_a), end_b - b.lengths(ids_b)
    starts, ends = np.concatenate((start_a, start_b)), np.concatenate((end_a, end_b))
    order = np.lexsort((ends, starts))
    groups = np.empty(len(order), np.int64)
    groups[order] = coalesce(starts[order], ends[order])
    group_a, group_b = groups[: len(ids_a)], groups[len(ids_a) :]
    # The B tokens that overlap an A token follow each other.
    first = np.searchsorted(end_b, start_a, "right")
    n = np.searchsorted(start_b, end_a, "left") - first
    before = np.cumsum(n) - n
    beside = np.arange(n.sum()) + np.repeat(first - before, n)
    return Alignment(ids_a, ids_b, group_a, group_b, int(groups.max()) + 1, np.repeat(ids_a, n) * WIDE + ids_b[beside])


@lru_cache(maxsize=1)
def _signed(n: int) -> list[np.ndarray]:
    """The numbers below n as texts that end in a comma, a bar and a semicolon."""
    return [np.array([f"{i}{sign}" for i in range(n)], object) for sign in ",|;"]


def written(found: Alignment) -> str:
    """``a1,a2|b1;a3|b2,b3``: the ids of each group's A and B tokens."""
    comma, bar, semicolon = _signed(max(1 << 16, 1 << int(max(found.a.max(), found.b.max())).bit_length()))
    # A's tokens of a group come before B's: merged by (group, side), in order.
    order = np.argsort(np.concatenate((2 * found.group_a, 2 * found.group_b + 1)), kind="stable")
    last_a, last_b = (np.append(g[1:] != g[:-1], True) for g in (found.group_a, found.group_b))
    texts = np.concatenate((np.where(last_a, bar[found.a], comma[found.a]), np.where(last_b, semicolon[found.b], comma[found.b])))
    return "".join(texts[order].tolist())[:-1]


_ALIGNED = (
    "row_id long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " pairs array<long>, times array<int>"
)


def _aligned(documents: DataFrame, a_path: str, b_path: str, a_ranks: str | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(a_path, a_ranks), pieces(b_path)
        none = np.zeros(0, np.int64)
        for batch in (whole.slice(at, TEXTS_AT_ONCE) for whole in batches for at in range(0, len(whole), TEXTS_AT_ONCE)):
            rows = []
            for text in batch.column("text"):
                found = align(text.as_py(), a, b)
                if found is None:
                    rows.append((0, 0, 0, 0, "", none, none))
                    continue
                pairs, times = np.unique(found.links, return_counts=True)
                digest = hashlib.sha256(written(found).encode()).hexdigest()
                rows.append((len(found.a), len(found.b), found.n_groups, len(found.links), digest, pairs, times.astype(np.int32)))
            *numbers, digests, pairs, times = zip(*rows, strict=True) if rows else [()] * 7
            columns = [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in numbers), pa.array(digests, pa.string())]
            columns += [pa.array(pairs, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _ALIGNED.split(", ")[1:8]] + ["times"])

    texts = documents.select(F.col("doc_id").cast("long"), whole_text(F.col("text")).alias("text"))
    found = texts.mapInArrow(run, _ALIGNED.split(", ", 1)[1])
    # The number is fixed by being written; no two rows share it.
    return stored(found.select(F.monotonically_increasing_id().alias("row_id"), "*"), "alignment")


def _counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold the pair, and whether no pair of the same A id is held by more."""
    counts = stored(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "alignment-counts")
    a = F.expr(f"pair div {WIDE}L")
    most = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return stored(counts.join(most, a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "alignment-pairs")


def _threshold(counts: DataFrame, sent: int) -> int:
    """The least power of two from which on at most ``sent`` pairs are as frequent."""
    sizes = counts.groupBy(F.floor(F.log2("n")).alias("power")).count().collect()
    for power in range(64):
        if sum(r["count"] for r in sizes if r.power >= power) <= sent:
            return 1 << power
    raise AssertionError("no pair is held by so many documents")


def _scored(aligned: DataFrame, counts: DataFrame, sent: int) -> DataFrame:
    """(row_id, count_sum, n_best)."""
    least = _threshold(counts, sent)
    rows = counts.where(F.col("n") >= least).orderBy("pair").toArrow()
    frequent = tuple(rows.column(c).to_numpy() for c in ("pair", "n", "best"))
    known = counts.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = known.value
        for batch in batches:
            own, times = batch.column("pairs"), batch.column("times").flatten().to_numpy().astype(np.int64)
            of = np.repeat(np.arange(len(batch)), own.value_lengths().to_numpy())
            own = own.flatten().to_numpy()
            at = np.minimum(np.searchsorted(pair, own), max(len(pair) - 1, 0))
            here = pair[at] == own if len(pair) else np.zeros(len(own), bool)
            sums, bests = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            np.add.at(sums, of[here], times[here] * n[at[here]])
            np.add.at(bests, of[here], times[here] * best[at[here]])
            offsets = np.searchsorted(of[~here], np.arange(len(batch) + 1)).astype(np.int32)
            left = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x[~here], pa.int64())) for x in (own, times)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), pa.array(sums), pa.array(bests), *left], names=["row_id", "count_sum", "n_best", "pairs", "times"]
            )

    found = aligned.select("row_id", "pairs", "times").mapInArrow(
        run, "row_id long, count_sum long, n_best long, pairs array<long>, times array<long>"
    )
    found = stored(found, "alignment-frequent")
    rare = found.select("row_id", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("row_id", "link.*")
    rare = rare.withColumnRenamed("pairs", "pair").join(counts.where(F.col("n") < least), "pair")
    held = F.when(F.col("best"), F.col("times")).otherwise(0)
    rest = rare.select("row_id", (F.col("times") * F.col("n")).alias("count_sum"), held.alias("n_best"))
    sums = found.select("row_id", "count_sum", "n_best").unionAll(rest).groupBy("row_id")
    return sums.agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))


def align_documents(
    documents: DataFrame, a_path: str, b_path: str, a_ranks: str | None = None, sent: int = SENT
) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    with job(documents.sparkSession):
        aligned = _aligned(documents, a_path, b_path, a_ranks)
        scored = _scored(aligned, _counts(aligned), sent)
        rows = aligned.drop("pairs", "times").join(scored, "row_id")
        columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        return stored(rows.select(*columns), "alignment-result", result=True)


def id_pairs(
    documents: DataFrame, a_path: str, b_path: str, a_ranks: str | None = None
) -> DataFrame:
    """(a, b, n, best): the id pairs of the whole table, with the number of documents that hold each."""
    with job(documents.sparkSession):
        counts = _counts(_aligned(documents, a_path, b_path, a_ranks))
        rows = counts.select(F.expr(f"pair div {WIDE}L").alias("a"), F.expr(f"pair % {WIDE}L").alias("b"), "n", "best")
        return stored(rows, "alignment-result", result=True)
