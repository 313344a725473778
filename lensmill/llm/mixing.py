"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

A source's target is its weight's share of the total, but at most ``max_epochs`` times its size; what the
cap cuts off goes to the others by weight until none is above its cap. Every document of a source is then
repeated ``floor(target / size)`` times, and one further copy goes to the first documents in a seeded random
order until the rest of the target is filled, so a source misses its target by at most half a document.

The random order is by a digest of seed, doc_id and text. The place where a source's order is cut is found
from sums per digest prefix, never by sorting a source: two passes of 4096 groups a source, then the
documents of one prefix of six digits. A source that holds most rows costs no more than that.

Edge cases: a null text has size 0 and is taken 0 words; a null source is one source, ordered last; sources of
size 0 get target 0; rows alike in doc_id and text are cut together; an empty table gives an empty result.
Extra columns are ignored by ``mix_report`` and kept by ``mix``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from lensmill.llm.common import n_words, stored

#: Hexadecimal digits of the digest that one pass resolves.
DIGITS = 3
PASSES = 2


def cyclic_weights(rank: Column) -> Column:
    """Weights 1, 2, 3, repeating, from a rank that begins at 1."""
    return (rank - 1) % 3 + 1


def _key(seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id"), F.md5(F.col("text"))))


def targets(
    sizes: DataFrame, max_epochs: int = 3, weights: Callable[[Column], Column] = cyclic_weights, total: int | None = None
) -> DataFrame:
    """(source, source_size, target, whole, rest) from (source, source_size), one row per source.

    The windows run over one row per source. In the order of cap per weight, the level of the water is the
    first one that does not exceed its own source's cap.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("rank"))
    all_words = F.lit(total) if total is not None else F.sum("source_size").over(everything)
    ranked = sizes.select(
        "source", "source_size", F.row_number().over(by_name).alias("rank"), all_words.cast("long").alias("total")
    ).withColumn("weight", weights(F.col("rank")).cast("long"))
    before = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.col("total") - before) / left
    filled = (
        ranked.withColumn("cap", F.lit(max_epochs) * F.col("source_size"))
        .withColumn("level", level)
        .withColumn("fits", F.col("level") <= F.col("cap") / F.col("weight"))
        .withColumn("water", F.first(F.when(F.col("fits"), F.col("level")), ignorenulls=True).over(by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("weight") * F.col("water"), F.col("cap").cast("double")))
    whole = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(0).cast("long")
    return filled.select("source", "source_size", target.alias("target"), whole.alias("whole")).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size")
    )


def _cuts(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, cut): documents whose key is at most ``cut`` get one further copy. Sources with no rest are absent."""
    state = plan.where("rest > 0").select("source", "rest", F.lit("").alias("prefix"), F.lit(0).cast("long").alias("below"))
    for step in range(1, PASSES + 1):
        inside = _in_prefix(sized, state, DIGITS * (step - 1))
        sums = inside.groupBy("source", "rest", "below", F.substring("key", 1, DIGITS * step).alias("prefix")).agg(
            F.sum("size").alias("words")
        )
        earlier = Window.partitionBy("source").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
        state = stored(
            sums.withColumn("below", F.col("below") + F.coalesce(F.sum("words").over(earlier), F.lit(0)))
            .where("below < rest")
            .groupBy("source", "rest")
            .agg(F.max_by("below", "prefix").alias("below"), F.max("prefix").alias("prefix")),
            "mix-cut",
        )
    inside = _in_prefix(sized, state, DIGITS * PASSES)
    earlier = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("below") + F.coalesce(F.sum("size").over(earlier), F.lit(0))
    # A prefix sorts before the keys that begin with it: it is the cut where none of them is taken.
    return inside.withColumn("taken", start + F.col("size") / 2 < F.col("rest")).groupBy("source").agg(
        F.coalesce(F.max(F.when(F.col("taken"), F.col("key"))), F.max("prefix")).alias("cut")
    )


def _in_prefix(sized: DataFrame, state: DataFrame, digits: int) -> DataFrame:
    there = state.withColumnRenamed("source", "its_source")
    same = F.col("source").eqNullSafe(F.col("its_source")) & (F.substring("key", 1, digits) == F.col("prefix"))
    return sized.join(there, same).select("source", "size", "key", "rest", "below", "prefix")


def mixture_plan(sized: DataFrame, max_epochs: int = 3, weights: Callable[[Column], Column] = cyclic_weights) -> DataFrame:
    """One row per source: source, source_size, target, whole copies and the key up to which one more is taken."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = stored(targets(sizes, max_epochs, weights), "mix-targets")
    cuts = _cuts(sized, plan).withColumnRenamed("source", "its_source")
    return stored(
        plan.join(cuts, F.col("source").eqNullSafe(F.col("its_source")), "left").drop("its_source", "rest"), "mix-plan"
    )


def _sized(documents: DataFrame, seed: int) -> DataFrame:
    return documents.select("doc_id", "source", n_words(F.col("text")).alias("size"), _key(seed).alias("key"))


def _with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    there = plan.withColumnRenamed("source", "its_source")
    extra = F.when(F.col("key") <= F.col("cut"), 1).otherwise(0)
    return rows.join(there, F.col("source").eqNullSafe(F.col("its_source"))).withColumn("copies", F.col("whole") + extra)


def mix_report(
    documents: DataFrame, seed: int = 17, max_epochs: int = 3, weights: Callable[[Column], Column] = cyclic_weights
) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, copies and the words the mix takes."""
    sized = stored(_sized(documents, seed), "mix-sizes")
    return _with_copies(sized, mixture_plan(sized, max_epochs, weights)).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix(
    documents: DataFrame, seed: int = 17, max_epochs: int = 3, weights: Callable[[Column], Column] = cyclic_weights
) -> DataFrame:
    """The mixed documents themselves, all columns as they are, each row as often as the mix takes it."""
    sized = stored(_sized(documents, seed), "mix-sizes")
    plan = mixture_plan(sized, max_epochs, weights)
    whole = documents.select("source", _key(seed).alias("key"), F.struct("*").alias("row"))
    copied = _with_copies(whole, plan).where("copies > 0")
    # A repeated row is one array in a row until the explode: no shuffle.
    return copied.select(F.explode(F.array_repeat("row", F.col("copies").cast("int"))).alias("row")).select("row.*")


def mix_sql(seed: int = 17, documents: str = "documents") -> str:
    """The same result in DuckDB's SQL, by sorting each source."""
    return f"""
with sized as (
 select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size,
  md5(concat_ws(':', '{seed}', cast(doc_id as varchar), md5(text))) as key
 from {documents}
), ranked as (
 select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) as rank,
  cast(sum(sum(size)) over () as bigint) as total
 from sized group by source
), capped as (
 select *, (rank - 1) % 3 + 1 as weight, 3 * source_size as cap from ranked
), levels as (
 select *, (total - coalesce(sum(cap) over (order by cap / weight, rank rows between unbounded preceding and 1 preceding), 0))
  / sum(weight) over (order by cap / weight, rank rows between current row and unbounded following) as level
 from capped
), filled as (
 select l.*, least(cast(cap as double), coalesce(weight * water, cast(cap as double))) as target
 from levels l, (select arg_min(level, (cap / weight, rank)) as water from levels where level <= cap / weight)
), plan as (
 select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as whole from filled
), ordered as (
 select s.doc_id, s.source, s.size, s.key, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size as rest,
  coalesce(sum(s.size) over (partition by s.source order by s.key rows between unbounded preceding and 1 preceding), 0)
   + s.size / 2 as middle
 from sized s join plan p on s.source is not distinct from p.source
), cut as (
 select source, max(key) as cut from ordered where middle < rest group by source
)
select o.doc_id, o.source, o.size, o.source_size, o.target,
 o.whole + case when o.key <= c.cut then 1 else 0 end as copies,
 o.size * (o.whole + case when o.key <= c.cut then 1 else 0 end) as taken
from ordered o left join cut c on o.source is not distinct from c.source
"""
