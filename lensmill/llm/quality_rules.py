"""Quality rules with risk-controlled thresholds.

A rule rejects a document whose ratio (symbols, exclamation marks, duplicate lines, repeated words) lies above a
cutoff. Cutoffs are not chosen by hand: labelled documents of good quality are a holdout that no rule was fitted
on, and a cutoff counts as safe for a stratum if the exact binomial test on its false rejections refutes "more
than alpha of the good documents are rejected". Per stratum and rule the cutoffs are tested from the most lenient
one on and testing stops at the first failure, which needs no correction; over strata and rules the error level is
divided (Bonferroni), and alpha is shared among a stratum's rules, so that all rules together reject at most alpha
of a stratum's good documents, in every stratum at once with confidence 1 - delta. Of the safe cutoffs the one that
separates good from bad labels best is taken, in the middle where several do; a stratum with too few labels to
prove anything gets no cutoff and keeps its documents.

What is gathered is a count per stratum, rule and cutoff. Labels meet their documents in one join of narrow rows.

Edge cases: a null text has no words and fails the base rules; a null stratum is a stratum of its own; several
labels of a doc_id count once each; an empty label table leaves only the base rules; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lensmill.llm.common import stored, whole_text

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks", "n_lines")
#: Cutoffs a rule may take, ascending.
CUTOFFS = [0.01 * 1.25**k for k in range(36)]
WINDOW = 5


def repeat_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words in windows of ``width`` words that occur twice or more, the first occurrence included."""
    windows = list(zip(*(words[k:] for k in range(width)), strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, until = 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + width - max(i, until)
            until = i + width
    return covered


def measure_text(text: str) -> tuple[int, ...]:
    """The measures of one text, in the order of MEASURES."""
    data = text.encode()
    words = data.split()  # bytes split at ASCII white space only, as words are defined
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        text.count("!"),
        len(lines),
    )


def measures(documents: DataFrame, stratum: str | None = "lang") -> DataFrame:
    """doc_id, stratum and the measures of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure_text(text) for text in batch.column("text").to_pylist()]
            columns = list(zip(*found, strict=True)) or [()] * len(MEASURES)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("stratum"), *(pa.array(c, pa.int64()) for c in columns)],
                names=["doc_id", "stratum", *MEASURES],
            )

    by = (F.col(stratum) if stratum else F.lit(None)).cast("string").alias("stratum")
    rows = documents.select(F.col("doc_id").cast("long"), by, whole_text(F.col("text")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, stratum string, " + ", ".join(f"{m} long" for m in MEASURES))


def _ratios() -> dict[str, Column]:
    per = lambda what, of: F.coalesce(F.try_divide(F.col(what), F.col(of)), F.lit(0.0))
    return {
        "symbols": per("n_symbols", "n_words"),
        "marks": per("n_marks", "n_words"),
        "dup_lines": per("n_dup_lines", "n_lines"),
        "repeats": per("n_repeat_words", "n_words"),
    }


def refutes(rejected: int, n: int, alpha: float, level: float) -> bool:
    """Exact binomial test: True if P(X <= rejected) <= level for X ~ Binomial(n, alpha)."""
    if not n:
        return False
    k = np.arange(rejected + 1)
    logs = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(alpha) + (n - i) * math.log1p(-alpha)
        for i in k.tolist()
    ]
    return bool(np.exp(np.logaddexp.reduce(logs)) <= level)


def choose(good: list[int], bad: list[int], alpha: float, level: float) -> float | None:
    """The cutoff of one rule in one stratum. good, bad: documents per bin; bin b holds values above b cutoffs."""
    n_good, n_bad = sum(good), sum(bad)
    if not n_bad:
        return None
    gains: dict[int, float] = {}
    for j in reversed(range(len(CUTOFFS))):
        false = sum(good[j + 1 :])
        if not refutes(false, n_good, alpha, level):
            break
        gains[j] = sum(bad[j + 1 :]) / n_bad - false / n_good
    best = max(gains.values(), default=0)
    if best <= 0:
        return None
    ties = sorted(j for j, gain in gains.items() if gain == best)
    return CUTOFFS[ties[len(ties) // 2]]


def thresholds(measured: DataFrame, labels: DataFrame, alpha: float = 0.05, delta: float = 0.05) -> DataFrame:
    """(stratum, rule, cutoff), for the rules of a stratum that have a safe cutoff."""
    ratios = _ratios()
    # Number of cutoffs below the value: the bin a document falls into.
    steps = F.array(*(F.lit(c) for c in CUTOFFS))
    value = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), v.alias("value")) for r, v in ratios.items())))
    binned = (
        measured.join(labels.select(F.col("doc_id").cast("long"), "quality"), "doc_id")
        .where("quality in (0, 1)")
        .select("stratum", "quality", value.alias("of"))
        .select("stratum", "quality", "of.rule", F.size(F.filter(steps, lambda c: c < F.col("of.value"))).alias("bin"))
    )
    counts = stored(binned.groupBy("stratum", "rule", "quality", "bin").count(), "rules-counts")
    n_strata = max(1, counts.select("stratum").distinct().count())
    level, share = delta / (n_strata * len(ratios)), alpha / len(ratios)

    def one(group: pd.DataFrame) -> pd.DataFrame:
        per_bin = np.zeros((2, len(CUTOFFS) + 1), int)
        np.add.at(per_bin, (group["quality"].to_numpy(int), group["bin"].to_numpy(int)), group["count"].to_numpy(int))
        cutoff = choose(per_bin[1].tolist(), per_bin[0].tolist(), share, level)
        found = [(group["stratum"].iloc[0], group["rule"].iloc[0], cutoff)] if cutoff is not None else []
        return pd.DataFrame(found, columns=["stratum", "rule", "cutoff"])

    # A group has at most two rows per cutoff.
    return counts.groupBy("stratum", "rule").applyInPandas(one, "stratum string, rule string, cutoff double")


def judge(
    documents: DataFrame,
    labels: DataFrame,
    stratum: str | None = "lang",
    min_words: int = 10,
    max_repeat_percent: int = 20,
    alpha: float = 0.05,
    delta: float = 0.05,
) -> DataFrame:
    """Per document: doc_id, the measures, base_failed, kept and the rules it broke."""
    measured = stored(measures(documents, stratum), "rules-measures")
    limits = (
        thresholds(measured, labels, alpha, delta)
        .groupBy("stratum")
        .agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("limits"))
        .withColumnRenamed("stratum", "its_stratum")
    )
    joined = measured.join(stored(limits, "rules-limits"), F.col("stratum").eqNullSafe(F.col("its_stratum")), "left")
    broken = F.array_compact(
        F.array(*(F.when(v > F.element_at("limits", F.lit(r)), F.lit(r)) for r, v in _ratios().items()))
    )
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return joined.withColumns({"base_failed": base, "broken": broken}).select(
        "doc_id",
        *MEASURES[:5],
        "base_failed",
        (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept"),
        F.concat_ws(",", "broken").alias("broken"),
    )
