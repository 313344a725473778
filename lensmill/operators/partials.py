"""Day partials: facts folded to (day, keys, entity) once, from which any report over any window is folded again.

A stored row holds the same columns a tally folds (masks and measures), for one day, one value of every key that some report
uses, and one entity. Both combine by ``bit_or`` and ``sum``, so a window is the fold of its days, a report's keys are the fold
of the finer keys, and a distinct count is exact, as entities are kept. Several reports share one scan and one fold of a
fact: their tests are bits of the same mask.

Windows end at 23:59:59 sharp. Rows of a day's last split second are kept apart (``_late``): they count for every day of a
window but its last one.

A source is a folder partitioned by day. Writing a range of days replaces each of them whole, also a day that has no rows
any more: every day has a row without bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from lensmill.functions.windows import DateRange
from lensmill.operators.tally import Fact, Metric, Plan, assign_bits, combined, fold, project


@dataclass(frozen=True)
class Source:
    """A fact as it is stored: ``fact`` has the keys and metrics of all reports; ``date`` is the SQL of a row's instant."""

    name: str
    fact: Fact
    date: str

    @property
    def plan(self) -> Plan:
        return assign_bits(self.fact.metrics)

    @property
    def folder(self) -> str:
        """Named by what is stored, so tables of other definitions are not read by mistake."""
        stated = repr((dict(self.fact.keys), list(self.fact.metrics), self.fact.entity, self.fact.once_per, self.date))
        return f"{self.name}-{hashlib.sha256(stated.encode()).hexdigest()[:16]}"


@dataclass(frozen=True)
class Part:
    """What a report takes of a source: its keys (report's name -> source's name), metrics and window."""

    source: Source
    keys: Mapping[str, str]
    metrics: Sequence[Metric]
    window: DateRange


def merged_metrics(*lists: Sequence[Metric]) -> list[Metric]:
    """The metrics of several reports over one fact; the same metric may be in more than one."""
    found: dict[str, Metric] = {}
    for metric in (m for metrics in lists for m in metrics):
        if found.setdefault(metric.name, metric) != metric:
            raise ValueError(f"two metrics are called {metric.name}")
    return list(found.values())


def write_days(spark: SparkSession, sources: Sequence[Source], days: DateRange, root: str) -> None:
    """Folds and stores the days of all sources; days that are there already are replaced."""
    for source in sources:
        at = f"({source.date})"
        midnight = f"cast(cast({at} as date) as timestamp_ntz)"
        own = {"_day": f"cast({at} as date)", "_late": f"{at} > {midnight} + make_dt_interval(0, 23, 59, 59)"}
        span = f"cast({at} as date) between date '{days.first}' and date '{days.last}'"
        dated = replace(source.fact, frame=source.fact.frame.filter(span), keys=own | dict(source.fact.keys))
        by = [*dated.keys, *(["_entity"] if dated.entity else [])]
        rows = fold(project(dated, source.plan), by)
        every = spark.sql(f"select explode(sequence(date '{days.first}', date '{days.last}')) as _day")
        rows = rows.unionByName(every, allowMissingColumns=True)
        rows.hint("rebalance", "_day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "_day"
        ).parquet(f"{root}/{source.folder}")


def read_days(spark: SparkSession, source: Source, window: DateRange, root: str) -> DataFrame:
    """The stored rows of a window."""
    rows = spark.read.parquet(f"{root}/{source.folder}")
    last = F.lit(window.last)
    return rows.filter(F.col("_day").between(F.lit(window.first), last) & F.expr(_any_bit(source))).filter(
        ~F.col("_late") | (F.col("_day") < last)
    )


def _any_bit(source: Source) -> str:
    return " or ".join(f"_mask{w} <> 0" for w in source.plan.words)


def tally_days(
    spark: SparkSession, parts: Sequence[Part], root: str, roster: DataFrame | None = None, drop_zero: bool = False
) -> DataFrame:
    """The same table ``tally`` gives for the parts' facts and windows, from the stored days alone."""
    plan = assign_bits([m for part in parts for m in part.metrics])
    facts = []
    for part in parts:
        entity = any(m.kind == "distinct" for m in part.metrics)
        columns = [f"{own} as {name}" for name, own in part.keys.items()]
        columns += ["_entity"] if entity else []
        columns += _moved_bits(part, plan)
        # Distinct counts have no stored measure; what else a metric adds up keeps its name.
        kinds = {m.name: m.kind for m in part.metrics}
        stored = read_days(spark, part.source, part.window, root)
        wanted = {f"_v_{n}{less}" for n, kind in kinds.items() if kind != "distinct" for less in ("", "__less")}
        columns += [c for c in stored.columns if c in wanted]
        facts.append((stored.selectExpr(*columns), entity))
    return combined(facts, list(parts[0].keys), plan, roster, drop_zero)


def _moved_bits(part: Part, plan: Plan) -> list[str]:
    """The report's masks, made of the source's."""
    stored = part.source.plan
    of: dict[int, list[str]] = {w: [] for w in plan.words}
    pairs = [(stored.bit[m.name], plan.bit[m.name]) for m in part.metrics]
    pairs += [(stored.less_bit[m.name], plan.less_bit[m.name]) for m in part.metrics if m.less]
    for (word, bit), (to, place) in pairs:
        of[to].append(f"if(_mask{word} & {bit}L <> 0, {place}L, 0L)")
    return [f"{' | '.join(bits) or '0L'} as _mask{w}" for w, bits in of.items()]
