"""Quality by voting of nearest labelled neighbours in a latent semantic space.

Terms are pairs of character classes, hashed pairs of code points beyond ASCII (so other scripts are told apart), words that
repeat the word before, words seen earlier in the text and the text's length class. Counts are weighted by log and entropy, and a truncated singular value decomposition of the labelled
sample gives the latent space. The labelled vectors and the projection go to every task; their size is fixed by
``per_class`` and ``n_latent`` (about a megabyte). Every document is projected and its cosines with all labelled
vectors are computed exactly, in blocks; the nearest ones vote with weights that grow with their similarity. A labelled text
has no vote on itself or its exact copies, so no document's own label is an input of its score.

Only the fit is bounded: at most ``per_class`` labelled documents per class, those with the smallest hash of doc_id, are
learned from. Every document is scored from its whole text. Language, source, doc_id and labels are no inputs.

Edge cases: a null text is empty and scored like any other; of several labels of a doc_id the lowest counts; labels
without a document and null labels are left out; where nothing is labelled every score is 0.5, and a text that is
like no labelled one gets the mean of the labels; an empty table gives an empty result; extra columns are ignored by
``score`` and kept by ``keep_good``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lensmill.llm.common import small_batches, stored, whole_text
from lensmill.llm.fingerprints import mix

PUNCTUATION = b".,!#*$%&|"


def _classes() -> np.ndarray:
    """Byte -> character class: lower-case letters and some marks alone, the rest in groups."""
    of = np.full(256, 26 + len(PUNCTUATION), np.uint16)  # other marks
    of[ord("a") : ord("z") + 1] = np.arange(26)
    for k, mark in enumerate(PUNCTUATION):
        of[mark] = 26 + k
    groups = [range(ord("A"), ord("Z") + 1), range(ord("0"), ord("9") + 1), (32, 9, 11, 12, 13), (10,), range(128, 256)]
    for k, group in enumerate(groups, 27 + len(PUNCTUATION)):
        of[list(group)] = k
    return of


_CLASS = _classes()
N_CLASSES = int(_CLASS.max()) + 1
N_PAIRS = N_CLASSES**2
N_LENGTHS = 32
#: Buckets of pairs of code points of which one at least is beyond ASCII.
N_OTHER = 1024
N_OWN = N_PAIRS + 2 + N_LENGTHS
N_TERMS = N_OWN + N_OTHER


def term_counts(text: str) -> np.ndarray:
    """Counts of all terms of a whole text."""
    data = text.encode()
    counts = np.zeros(N_TERMS, np.float32)
    classes = _CLASS[np.frombuffer(data, np.uint8)]
    if len(classes) > 1:
        counts[:N_PAIRS] = np.bincount(classes[:-1] * np.uint16(N_CLASSES) + classes[1:], minlength=N_PAIRS)
    words = data.split()
    counts[N_PAIRS] = sum(map(eq, words, words[1:]))
    counts[N_PAIRS + 1] = len(words) - len(set(words))
    counts[N_PAIRS + 2 + min(len(words).bit_length(), N_LENGTHS - 1)] = 1
    if len(data) > len(text) > 1:
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
        other = (codes[:-1] | codes[1:]) > 127
        keys = mix(codes[:-1][other] << np.uint64(32) | codes[1:][other]) % np.uint64(N_OTHER)
        counts[N_OWN:] = np.bincount(keys.astype(np.int64), minlength=N_OTHER)
    return counts


def text_digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


class Space:
    """The fitted space: term weights, projection, labelled vectors and their labels."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, digests: np.ndarray, n_latent: int, seed: int = 11):
        n = len(counts)
        share = counts / np.maximum(counts.sum(0), 1)
        entropy = -(share * np.log(np.maximum(share, 1e-12))).sum(0) / np.log(max(n, 2))
        self.weights = (1 - entropy).clip(0, 1).astype(np.float32)
        matrix = self._weighted(counts)
        rng = np.random.default_rng(seed)
        base = rng.standard_normal((N_TERMS, min(n_latent + 16, n, N_TERMS))).astype(np.float32)
        for _ in range(4):  # subspace iteration towards the leading right singular vectors
            base = np.linalg.qr(matrix.T @ (matrix @ base))[0]
        _, _, right = np.linalg.svd(matrix @ base, full_matrices=False)
        self.projection = (base @ right.T[:, :n_latent]).astype(np.float32)
        self.vectors, self.labels, self.digests = self.project(counts), labels.astype(np.float32), digests

    def _weighted(self, counts: np.ndarray) -> np.ndarray:
        rows = np.log1p(counts) * self.weights
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)

    def project(self, counts: np.ndarray) -> np.ndarray:
        rows = self._weighted(counts) @ self.projection
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)

    def score(self, counts: np.ndarray, digests: np.ndarray, n_neighbours: int, sharpness: float) -> np.ndarray:
        """Weighted share of label 1 among each row's nearest labelled vectors of other texts."""
        cosines = self.project(counts) @ self.vectors.T
        cosines[digests[:, None] == self.digests[None, :]] = -1
        k = min(n_neighbours, len(self.labels))
        nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weights = np.take_along_axis(cosines, nearest, 1).clip(0) ** sharpness
        total = weights.sum(1)
        votes = (weights * self.labels[nearest]).sum(1)
        return np.where(total > 1e-9, votes / np.maximum(total, 1e-9), self.labels.mean()).clip(0, 1)


def fold(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(doc_id.cast("string")) % folds


def fit(
    documents: DataFrame, labels: DataFrame, learn: Column | None = None, per_class: int = 2048, n_latent: int = 24
) -> Space | None:
    """Fits on at most ``per_class`` labelled documents per class; ``learn``: condition on the labels' rows."""
    known = labels.where("quality in (0, 1) and doc_id is not null")
    known = (known if learn is None else known.where(learn)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    order = F.xxhash64("doc_id")
    chosen = [known.where(F.col("quality") == q).orderBy(order, "doc_id").limit(per_class) for q in (0, 1)]
    sample = stored(chosen[0].unionAll(chosen[1]), "quality-sample")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = [np.flatnonzero(c := term_counts(t)).astype(np.int32).tobytes() + c[c > 0].tobytes() for t in texts]
            columns = [batch.column("doc_id"), batch.column("quality"), pa.array(found, pa.binary()), pa.array(map(text_digest, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "quality", "terms", "digest"])

    # At most 2 * per_class rows; of rows with one doc_id one counts.
    texts = documents.select(F.col("doc_id").cast("long"), whole_text(F.col("text")).alias("text")).join(sample, "doc_id")
    texts = texts.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    rows = texts.select("doc_id", "quality", "text").mapInArrow(counted, "doc_id long, quality int, terms binary, digest long")
    found = sorted({r["doc_id"]: (r["quality"], bytes(r["terms"]), r["digest"]) for r in rows.collect()}.items())
    if not found:
        return None
    counts = np.zeros((len(found), N_TERMS), np.float32)
    for row, (_, (_, terms, _)) in zip(counts, found, strict=True):
        half = len(terms) // 2
        row[np.frombuffer(terms[:half], np.int32)] = np.frombuffer(terms[half:], np.float32)
    return Space(counts, np.array([q for _, (q, _, _) in found]), np.array([d for _, (_, _, d) in found]), n_latent)


def _scores(space: Space | None, texts: list[str], n_neighbours: int, sharpness: float, block: int = 512) -> np.ndarray:
    if space is None:
        return np.full(len(texts), 0.5)
    found = [np.zeros(0)]
    for own in (texts[a : a + block] for a in range(0, len(texts), block)):
        counts, digests = np.stack([term_counts(t) for t in own]), np.array([text_digest(t) for t in own])
        found.append(space.score(counts, digests, n_neighbours, sharpness))
    return np.concatenate(found)


def score(
    documents: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    threshold: float = 0.3,
    n_neighbours: int = 15,
    sharpness: float = 32.0,
    **fitting,
) -> DataFrame:
    """Per document: doc_id, score, predicted."""
    small_batches(documents.sparkSession)
    space = documents.sparkSession.sparkContext.broadcast(fit(documents, labels, learn, **fitting))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _scores(space.value, batch.column("text").to_pylist(), n_neighbours, sharpness)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"])

    rows = documents.select(F.col("doc_id").cast("long"), whole_text(F.col("text")).alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def keep_good(
    documents: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    threshold: float = 0.3,
    n_neighbours: int = 15,
    sharpness: float = 32.0,
    **fitting,
) -> DataFrame:
    """The documents, all columns as they are, that score at least the threshold."""
    small_batches(documents.sparkSession)
    space = documents.sparkSession.sparkContext.broadcast(fit(documents, labels, learn, **fitting))
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(_scores(space.value, texts, n_neighbours, sharpness) >= threshold))

    return documents.mapInArrow(run, documents.schema)
