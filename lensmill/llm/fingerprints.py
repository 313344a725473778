"""Document fingerprints by locally consistent parsing.

A text is parsed bottom-up. On each level runs of one name are folded, deterministic coin tossing reduces every name
to one of six labels that depends on a few names before it, and local maxima of the labels begin phrases. A phrase is
named by a digest of its names, and the names are the next level's text. Where a phrase begins depends on its
neighbourhood alone, so equal substrings are parsed alike except near their ends, whatever their offset.

The fingerprint holds the name of the whole text and, per level, the smallest digests among its distinct phrase
names: level 3 (phrases of some 20 to 30 characters), and lower levels for texts that have few of them. Likeness is
estimated on the lowest level that both have: of the smallest digests of the union, the share found in both,
turned from a Jaccard index into the share of common phrases (2 j / (1 + j)). Equal fingerprints have likeness 1.

All texts of a batch are parsed as one array in which a text's first character always begins a phrase.

For the comparison with the next document, rows are dealt by ranges of doc_id in one shuffle of the texts; the first
document of a range is also sent to the range before it, so no range waits for another.

Edge cases: a null text is empty; the empty text has a fingerprint of its own; null doc_ids come last; rows with equal
doc_ids follow each other in the order of their texts; in a table of one document it is its own next one; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lensmill.llm.common import whole_text

LEVELS = 3
#: Digests per level, and phrases below which a text also has the next lower level.
SKETCH = 48
FEW = 16
#: Characters that are parsed as one array.
BATCH_CHARS = 1 << 20

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@lru_cache(maxsize=1)
def _powers() -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(256, _ODD))


#: Lowest set bit of a byte.
_LOW = np.array([8, *((k & -k).bit_length() - 1 for k in range(1, 256))], np.uint8)


def _labels(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Four rounds of coin tossing: labels below 6 that differ between neighbours. first: where texts begin."""
    differ = names[1:] ^ names[:-1]
    low = np.bitwise_count((differ & (~differ + _U(1))) - _U(1)).astype(np.uint8)
    labels = np.empty(len(names), np.uint8)
    labels[1:] = 2 * low + ((names[1:] >> low.astype(_U)) & _U(1)).astype(np.uint8)
    labels[first] = (names[first] & _U(1)).astype(np.uint8)
    for _ in range(3):
        low = _LOW[labels[1:] ^ labels[:-1]]
        after = 2 * low + ((labels[1:] >> np.minimum(low, 7)) & 1)
        start = labels[first] & 1
        labels[1:] = after
        labels[first] = start
    return labels


def next_level(names: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and texts of the phrases. names: of the level below; text: the number of each name's text, ascending."""
    # Runs of one name become one name that also stands for the length.
    head = np.empty(len(names), bool)
    head[0] = True
    np.logical_or(names[1:] != names[:-1], text[1:] != text[:-1], out=head[1:])
    at = np.flatnonzero(head)
    length = np.diff(at, append=len(names))
    names, text = names[at], text[at]
    runs = length > 1
    if runs.any():
        names[runs] = mix(names[runs] ^ (length[runs].astype(_U) * _ODD))
    first = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
    labels = _labels(names, first)
    begins = np.zeros(len(names), bool)
    if len(names) > 2:
        begins[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    # The last name of a text has no right neighbour of its own and begins nothing.
    begins[first[1:] - 1] = False
    begins[first] = True
    starts = np.flatnonzero(begins)
    place = np.arange(len(names)) - np.repeat(starts, np.diff(starts, append=len(names)))
    phrase = np.add.reduceat(mix(names) * _powers()[np.minimum(place, 255)], starts)
    return mix(phrase), text[starts]


def _smallest(names: np.ndarray, text: np.ndarray, n: int, k: int) -> list[np.ndarray]:
    """Per text, its k smallest distinct digests of 32 bits."""
    digest = (names >> _U(32)).astype(np.uint32)
    order = np.lexsort((digest, text))
    digest, text = digest[order], text[order]
    new = np.concatenate(([True], (digest[1:] != digest[:-1]) | (text[1:] != text[:-1])))[: len(text)]
    digest, text = digest[new], text[new]
    ends = np.searchsorted(text, np.arange(n), side="right")
    begins = np.concatenate(([0], ends[:-1]))
    return [digest[a : min(b, a + k)] for a, b in zip(begins, ends, strict=True)]


Sketch = tuple[int, dict[int, np.ndarray]]  # name of the whole text; level -> smallest digests


def sketches(texts: list[str]) -> list[Sketch]:
    """Fingerprints of many texts at once."""
    n = len(texts)
    lengths = np.array([len(t) for t in texts])
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    names, text = mix(points.astype(_U) + _ODD), np.repeat(np.arange(n), lengths)
    roots = np.zeros(n, _U)
    found: list[dict[int, np.ndarray]] = [{} for _ in range(n)]
    counts = {}
    by_level = {}
    level = 0
    while len(names):
        level += 1
        names, text = next_level(names, text)
        count = np.bincount(text, minlength=n)
        if level <= LEVELS:
            counts[level], by_level[level] = count, _smallest(names, text, n, SKETCH)
        # A text that is one phrase has its name; it has no levels above.
        done = count[text] == 1
        roots[text[done]] = names[done]
        names, text = names[~done], text[~done]
    for i in range(n):
        for k in range(LEVELS, 0, -1):
            if k not in by_level or not len(by_level[k][i]):
                found[i][k] = np.array([int(roots[i]) >> 32], np.uint32)
            else:
                found[i][k] = by_level[k][i]
            if k in counts and counts[k][i] >= FEW:
                break
    return list(zip(roots.tolist(), found, strict=True))


def written(sketch: Sketch) -> str:
    """A fingerprint as text: the whole name, then level:digests."""
    root, levels = sketch
    return f"{root:016x}" + "".join(f" {k}:{levels[k].astype('>u4').tobytes().hex()}" for k in sorted(levels))


def read(fingerprint: str) -> Sketch:
    root, *levels = fingerprint.split(" ")
    parts = (part.split(":") for part in levels)
    return int(root, 16), {int(k): np.frombuffer(bytes.fromhex(h), ">u4").astype(np.uint32) for k, h in parts}


def likeness(a: Sketch, b: Sketch) -> float:
    """Estimated share of common phrases, from the fingerprints alone."""
    if a[0] == b[0]:
        return 1.0
    level = min(set(a[1]) & set(b[1]))  # all have the highest level
    x, y = a[1][level], b[1][level]
    union = np.union1d(x, y)[:SKETCH]
    j = int(np.isin(union, np.intersect1d(x, y)).sum()) / len(union)
    return 2 * j / (1 + j)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the beginning of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


OUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def _compare(rows: list[tuple], following: list[tuple]) -> pa.RecordBatch:
    """rows and following: (doc_id, text) of documents and of the ones after them."""
    changed = [edited(t, u) for (_, t), (_, u) in zip(rows, following, strict=True)]
    own = [t for _, t in rows]
    made = sketches([*own, *changed, following[-1][1]])
    n = len(rows)
    mine, theirs, after = made[:n], made[n : 2 * n], [*made[1:n], made[-1]]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([i for i, _ in rows], pa.int64()),
            pa.array([len(t) for t in own], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array([written(s) for s in mine], pa.string()),
            pa.array([written(s) for s in theirs], pa.string()),
            pa.array([likeness(a, b) for a, b in zip(mine, theirs, strict=True)], pa.float64()),
            pa.array([likeness(a, b) for a, b in zip(mine, after, strict=True)], pa.float64()),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range in order; the first of the range after it comes last, marked as such."""
    waiting: list[tuple] = []
    size, ended = 0, False
    for batch in batches:
        for doc_id, text, visitor in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "visitor")), strict=True):
            if ended:
                continue  # further rows with the visitor's doc_id
            waiting.append((doc_id, text))
            size += len(text)
            if visitor:
                ended = True
            elif size < BATCH_CHARS or len(waiting) < 2:
                continue
            yield _compare(waiting[:-1], waiting[1:])
            waiting, size = waiting[-1:], len(text)


def compare_with_edits(documents: DataFrame, n_ranges: int | None = None) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and its likeness to that and to the next document."""
    spark = documents.sparkSession
    n_ranges = n_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    last = (1 << 63) - 1
    rows = documents.select(
        F.col("doc_id").cast("long"),
        whole_text(F.col("text")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(last)).alias("key"),
    )
    cuts = [k / n_ranges for k in range(n_ranges)]
    found = rows.agg(F.min("key"), F.percentile_approx("key", cuts, 100 * n_ranges)).first()
    bounds = sorted({found[0], *(found[1] or [])} - {None}) or [0]
    lower = F.array(*(F.lit(b) for b in bounds))
    own = F.size(F.filter(lower, lambda b: b <= F.col("key"))) - 1
    # Bounds are doc_ids of the table, so the first document of a range has its bound.
    before = F.pmod(F.col("range") - 1, F.lit(len(bounds)))
    homes = F.array_compact(
        F.array(
            F.struct(F.col("range").alias("to"), F.lit(False).alias("visitor")),
            F.when(F.array_contains(lower, F.col("key")), F.struct(before.alias("to"), F.lit(True).alias("visitor"))),
        )
    )
    sent = rows.withColumn("range", own).select("doc_id", "text", "key", F.explode(homes).alias("home"))
    dealt = sent.select("doc_id", "text", "key", F.col("home.to").cast("int").alias("to"), "home.visitor")
    ordered = dealt.repartitionById(len(bounds), "to").sortWithinPartitions("visitor", "key", "text")
    return ordered.select("doc_id", "text", "visitor").mapInArrow(_stream, OUT)
