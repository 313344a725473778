"""Many filtered counts, sums and distinct counts over several facts in one aggregation.

Each fact row is projected to (key, entity, mask, measures): bit i of ``mask`` says whether the row
matches predicate i. A mask is as many words of 63 bits as there are predicates for, and each word is folded alone. Facts with an entity are unioned and folded to one row per (key, entity); those rows
and the facts without one are then folded to one row per key. Masks are combined with ``bit_or``, so a distinct count is the number of entities with the bit set
and needs no row expansion. Both folds combine on the map side, so neither a hot key nor a hot entity
ends up in one task.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import count

from pyspark.sql import DataFrame, functions as F


#: Bits of a word of a mask. There is a test each for a metric, for what is taken off it, and for the roster.
WORD_BITS = 63
#: Distinct tests up to which a fact is filtered before it is folded.
FILTER_TESTS = 8


@dataclass(frozen=True)
class Metric:
    """One report column. ``where``, ``of`` and ``less`` are SQL expressions over the fact's columns.

    kind: ``count`` = COUNT(of), ``sum`` = SUM(of), ``distinct`` = COUNT(DISTINCT entity),
    ``once`` = COUNT(DISTINCT unit), where the unit is the fact's ``once_per`` column,
    ``sum_once`` = SUM(of) with each unit taken once.
    With ``less`` the rows matching it are subtracted, but only for keys that have rows matching
    ``where``: a key with returns and no sales stays empty. ``type`` is that of the finished column.
    """

    name: str
    kind: str
    where: str = "true"
    of: str | None = None
    less: str | None = None
    type: str = "bigint"


@dataclass(frozen=True)
class Fact:
    """A source of metrics: key columns and entity as SQL expressions over ``frame``.

    ``once_per`` names a column that determines the entity (an invoice has one patient).
    """

    frame: DataFrame
    keys: Mapping[str, str]
    metrics: Sequence[Metric]
    entity: str | None = None
    once_per: str | None = None


def tally(facts: Sequence[Fact], roster: DataFrame | None = None, drop_zero: bool = False) -> DataFrame:
    """One row per key with every metric. A key no row matched counts 0; SUM over nulls stays null.

    With ``roster`` (the key columns only) exactly its keys are returned; otherwise the keys for which at
    least one metric has a row. ``drop_zero`` leaves out keys with no metric other than 0, where a null
    metric counts as a value.
    """
    plan = assign_bits([m for f in facts for m in f.metrics])
    return combined([(project(fact, plan), bool(fact.entity)) for fact in facts], list(facts[0].keys), plan, roster, drop_zero)


@dataclass
class Plan:
    """Where each test's bit is: (word, bit)."""

    metrics: list[Metric]
    bit: dict[str, tuple[int, int]]
    less_bit: dict[str, tuple[int, int]]
    roster_bit: tuple[int, int]

    @property
    def words(self) -> list[int]:
        return list(range(self.roster_bit[0] + 1))

    def tests(self, metrics: Sequence[Metric]) -> list[tuple[str, tuple[int, int]]]:
        found = [(m.where, self.bit[m.name]) for m in metrics]
        return found + [(m.less, self.less_bit[m.name]) for m in metrics if m.less]


def assign_bits(metrics: Sequence[Metric]) -> Plan:
    places = ((k // WORD_BITS, 1 << k % WORD_BITS) for k in count())
    bit = {m.name: next(places) for m in metrics}
    less_bit = {m.name: next(places) for m in metrics if m.less}
    return Plan(list(metrics), bit, less_bit, next(places))


def combined(
    facts: Sequence[tuple[DataFrame, bool]], keys: list[str], plan: Plan, roster: DataFrame | None, drop_zero: bool
) -> DataFrame:
    """The finished table of projected facts. Each comes with whether it has an entity."""
    by_entity = [rows for rows, has_entity in facts if has_entity]
    parts = [rows for rows, has_entity in facts if not has_entity]
    wanted = list(plan.bit.values())
    if roster is not None:
        wanted = [plan.roster_bit]
        parts.append(roster.selectExpr(*keys, *_masks([("true", plan.roster_bit)], plan)))
    if by_entity:
        rows = fold(_union(by_entity), [*keys, "_entity"])
        flags = _flags([m for m in plan.metrics if m.kind == "distinct"], plan, "_entity")
        parts.append(rows.selectExpr(*(c for c in rows.columns if c != "_entity"), *flags))
    rows = fold(_union(parts), keys).filter(_has(*wanted))
    if drop_zero:
        rows = rows.filter(f"array_contains(array({', '.join(_nonzero(m, plan) for m in plan.metrics)}), true)")
    return rows.selectExpr(*keys, *(f"cast({_finish(m, plan)} as {m.type}) as `{m.name}`" for m in plan.metrics))


def _masks(tests: Sequence[tuple[str, tuple[int, int]]], plan: Plan) -> list[str]:
    """One column per word, from (test, place of its bit)."""
    of = {w: [f"if({test}, {bit}L, 0L)" for test, (word, bit) in tests if word == w] for w in plan.words}
    return [f"{' | '.join(bits) or '0L'} as _mask{w}" for w, bits in of.items()]


def _sale(m: Metric) -> str:
    return f"_v_{m.name}"


def _less(m: Metric) -> str:
    return f"_v_{m.name}__less"


def _has(*places: tuple[int, int]) -> str:
    """Whether one of the bits is set."""
    words: dict[int, int] = {}
    for word, bit in places:
        words[word] = words.get(word, 0) | bit
    return "(" + " or ".join(f"(_mask{word} & {bits}L) <> 0" for word, bits in words.items()) + ")"


def _flags(metrics: Sequence[Metric], plan: Plan, column: str) -> list[str]:
    """1 for each metric whose predicate some row of this entity or unit matched."""
    bits = [(_sale(m), plan.bit[m.name]) for m in metrics]
    bits += [(_less(m), plan.less_bit[m.name]) for m in metrics if m.less]
    return [f"if({column} is not null and {_has(bit)}, 1L, null) as {name}" for name, bit in bits]


def project(fact: Fact, plan: Plan) -> DataFrame:
    """Key, entity, masks and row-level measures of one fact; units are folded here already."""
    tests = plan.tests(fact.metrics)
    # Rows that no test matches add nothing. Spark takes the parts of this filter that one table answers to its scan. With
    # many tests it would keep nearly all rows and cost more than the folds save.
    wanted = sorted({test for test, _ in tests})
    narrow = "true" not in wanted and len(wanted) <= FILTER_TESTS
    frame = fact.frame.filter(" or ".join(f"({test})" for test in wanted)) if narrow else fact.frame
    columns = [f"{expression} as {name}" for name, expression in fact.keys.items()]
    if fact.entity:
        columns.append(f"{fact.entity} as _entity")
    columns += _masks(tests, plan)
    for m in fact.metrics:
        if m.kind == "count":
            columns.append(f"if(({m.where}) and ({m.of}) is not null, 1L, null) as {_sale(m)}")
        elif m.kind in ("sum", "sum_once"):
            less = f" when {m.less} then -({m.of})" if m.less else ""
            columns.append(f"case when {m.where} then {m.of}{less} end as {_sale(m)}")
    if not fact.once_per:
        return frame.selectExpr(*columns)

    rows = frame.selectExpr(*columns, f"{fact.once_per} as _unit")
    by = [*fact.keys, *(["_entity"] if fact.entity else []), "_unit"]
    once = {_sale(m) for m in fact.metrics if m.kind == "sum_once"}
    rows = fold(rows, by, once)
    flags = _flags([m for m in fact.metrics if m.kind == "once"], plan, "_unit")
    return rows.selectExpr(*(c for c in rows.columns if c != "_unit"), *flags)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def fold(rows: DataFrame, by: list[str], once: Collection[str] = ()) -> DataFrame:
    """One row per key: masks combined, measures added up (those in ``once`` taken a single time)."""
    masks = [F.expr(f"bit_or({c}) as {c}") for c in rows.columns if c.startswith("_mask")]
    measures = [c for c in rows.columns if c.startswith("_v_")]
    # The filter lets a row skip the sums it has no value for, which most rows have for most sums.
    adds = (F.expr(f"{'max' if c in once else 'sum'}({c}) filter (where {c} is not null) as {c}") for c in measures)
    return rows.groupBy(*by).agg(*masks, *adds)


def _finish(m: Metric, plan: Plan) -> str:
    value, here = _sale(m), _has(plan.bit[m.name])
    if m.kind in ("count", "distinct", "once"):
        if not m.less:
            return f"coalesce({value}, 0L)"
        return f"if({here}, coalesce({value}, 0L) - coalesce({_less(m)}, 0L), 0L)"
    return f"if({here}, {f'coalesce({value}, 0)' if m.less else value}, 0)"


def _nonzero(m: Metric, plan: Plan) -> str:
    """Whether the finished metric differs from 0, on the folded columns.

    Deliberately shares no sub-expression with ``_finish``: a filter over the very expressions a
    projection names makes Spark's constraint inference try every subset of them.
    """
    value, here = _sale(m), _has(plan.bit[m.name])
    if m.kind in ("count", "distinct", "once"):
        if not m.less:
            return f"{value} > 0"
        return f"{here} and nvl({value}, 0L) <> nvl({_less(m)}, 0L)"
    return f"{here} and nvl({value} <> 0, {'false' if m.less else 'true'})"
