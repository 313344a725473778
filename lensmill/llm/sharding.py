"""Sharding by a k-d tree over the documents' metadata.

A node of the tree is a set of documents. It is split at the weighted median (by bytes) of its widest dimension
(size, source, language or doc_id, each relative to the whole table's extent) until leaves reach the target
bytes; a node whose number of leaves is odd is split in that proportion. Medians are distributed: all nodes of a
level share two aggregations that narrow the cut down by 16 bits each, so nothing is sorted and the driver sees
no rows.

The points of the tree are groups of equal texts, so copies share a shard. A group of more than one percent of
a shard is first divided into parts of that size, which are points of their own: with a group of copies that holds
a third of all rows, shards still come out even. There are fewer such groups than a hundred per shard, so Spark can
send their list to every task. The law is ``bytes``: shards differ by little more than the largest point.

Edge cases: a null text has size 1 (its end) and the crc32 of an empty text; null metadata sorts first; copies are
separate rows with slots of their own; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lensmill.llm.common import stored, whole_text

DIMENSIONS = ("size", "source", "lang", "doc_id")
#: Largest share of a shard's bytes that a group of equal texts may have as one point.
WHOLE_GROUP = 0.01
#: Bits of a cut that one aggregation resolves; a cut has two of them: place along the dimension and tie-break.
BITS = 16
PLACES = 1 << 12


def _prefix_number(text: Column) -> Column:
    """The first six bytes of a text as a number that sorts as the text does; -1 for null."""
    six = F.rpad(F.substring(F.hex(F.encode(text, "utf-8")), 1, 12), 12, "0")
    return F.coalesce(F.conv(six, 16, 10).cast("double"), F.lit(-1.0))


def _items(documents: DataFrame) -> DataFrame:
    text = whole_text(F.col("text"))
    return documents.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.col("source").cast("string"),
        F.col("lang").cast("string"),
        F.monotonically_increasing_id().alias("item"),
    )


def _points(items: DataFrame, shard_bytes: float) -> tuple[DataFrame, DataFrame]:
    """Items with their part, and the points: groups of equal texts, or parts of large groups."""
    most = max(1.0, shard_bytes * WHOLE_GROUP)
    groups = items.groupBy("text_crc32", "size").agg(F.sum("size").alias("bytes"))
    large = stored(
        groups.where(F.col("bytes") > most).withColumn("parts", F.ceil(F.col("bytes") / most)).drop("bytes"), "shard-large"
    )
    part = F.coalesce(F.pmod(F.xxhash64("item"), F.col("parts")), F.lit(0)).alias("part")
    parted = items.join(large, ["text_crc32", "size"], "left").select(items["*"], part)
    point = F.xxhash64("text_crc32", "size", "part")
    points = parted.groupBy("text_crc32", "size", "part").agg(
        F.sum("size").cast("double").alias("bytes"),
        _prefix_number(F.min("source")).alias("d_source"),
        _prefix_number(F.min("lang")).alias("d_lang"),
        F.coalesce(F.min("doc_id").cast("double"), F.lit(-1.0)).alias("d_doc_id"),
    )
    return parted, points.withColumns({"d_size": F.col("size").cast("double"), "tie": F.pmod(point, F.lit(1 << 20))})


def _split(points: DataFrame, extent: dict[str, float]) -> DataFrame:
    """Splits every node that has more than one leaf; points keep (shard: first leaf of the node, leaves)."""
    divided = points.where("leaves > 1")
    nodes = divided.groupBy("shard", "leaves").agg(
        F.sum("bytes").alias("node_bytes"),
        *(f(f"d_{d}").alias(f"{name}_{d}") for d in DIMENSIONS for name, f in (("lo", F.min), ("hi", F.max))),
    )
    widths = {d: (F.col(f"hi_{d}") - F.col(f"lo_{d}")) / (extent[d] or 1.0) for d in DIMENSIONS}
    widest = F.greatest(*widths.values())
    pick = lambda of: F.coalesce(*(F.when(widths[d] == widest, of(d)) for d in DIMENSIONS))
    chosen = stored(
        nodes.select(
            "shard",
            "leaves",
            "node_bytes",
            pick(F.lit).alias("dimension"),
            pick(lambda d: F.col(f"lo_{d}")).alias("lo"),
            pick(lambda d: F.col(f"hi_{d}")).alias("hi"),
        ),
        "shard-nodes",
    )
    along = F.coalesce(*(F.when(F.col("dimension") == d, F.col(f"d_{d}")) for d in DIMENSIONS))
    place = F.least(F.floor((along - F.col("lo")) / F.greatest(F.col("hi") - F.col("lo"), F.lit(1e-9)) * PLACES), F.lit(PLACES - 1))
    celled = points.join(chosen.drop("leaves"), "shard", "left").withColumn("cell", place.cast("long") * (1 << 20) + F.col("tie"))
    half = F.floor(F.col("leaves") / 2)
    goal = F.col("node_bytes") * half / F.col("leaves")
    # First the upper bits of the cut, then the lower ones.
    state = chosen.select("shard", goal.alias("goal"), F.lit(0).cast("long").alias("cut"), F.lit(0.0).alias("below"))
    for shift in (BITS, 0):
        inside = celled.where("cell is not null").join(state, "shard")
        if not shift:
            inside = inside.where(F.shiftright("cell", BITS) == F.shiftright("cut", BITS))
        sums = inside.groupBy("shard", "goal", "below", F.shiftleft(F.shiftright("cell", shift), shift).alias("cut")).agg(
            F.sum("bytes").alias("here")
        )
        earlier = Window.partitionBy("shard").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
        begun = sums.withColumn("below", F.col("below") + F.coalesce(F.sum("here").over(earlier), F.lit(0.0)))
        fits = F.col("below") + (F.lit(0.0) if shift else F.col("here") / 2) <= F.col("goal")
        # Where not even the first cell fits, the cut lies before the cells that share the upper bits.
        before = F.shiftleft(F.shiftright(F.min("cut"), BITS), BITS) - 1
        state = stored(
            begun.groupBy("shard", "goal").agg(
                F.coalesce(F.max(F.when(fits, F.col("cut"))), before).alias("cut"),
                F.coalesce(F.max(F.when(fits, F.col("below"))), F.lit(0.0)).alias("below"),
            ),
            "shard-cut",
        )
    cuts = state.select("shard", "cut")
    left = F.col("cell").isNotNull() & (F.col("cell") <= F.coalesce(F.col("cut"), F.lit(-1)))
    split = celled.join(cuts, "shard", "left")
    return split.select(
        *(c for c in points.columns if c not in ("shard", "leaves")),
        F.when((F.col("leaves") == 1) | left, F.col("shard")).otherwise(F.col("shard") + half).alias("shard"),
        F.when(F.col("leaves") == 1, 1).when(left, half).otherwise(F.col("leaves") - half).cast("long").alias("leaves"),
    )


def shard(documents: DataFrame, n_shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (always null: the law is ``bytes``)."""
    items = stored(_items(documents), "shard-items")
    total = items.agg(F.sum("size")).first()[0] or 0
    leaves = n_shards or max(1, -(-total // (target_bytes or 1 << 27)))
    parted, points = _points(items, total / leaves)
    points = stored(points.withColumns({"shard": F.lit(0).cast("long"), "leaves": F.lit(leaves).cast("long")}), "shard-points")
    bounds = points.agg(*(F.max(f"d_{d}") - F.min(f"d_{d}") for d in DIMENSIONS)).first()
    extent = dict(zip(DIMENSIONS, (b or 0.0 for b in bounds), strict=True))
    for _ in range((leaves - 1).bit_length()):
        points = stored(_split(points, extent), "shard-points")
    placed = stored(
        parted.join(points.select("text_crc32", "size", "part", "shard"), ["text_crc32", "size", "part"]).select(
            "doc_id", "size", "text_crc32", F.col("shard").cast("int"), F.shiftright("item", 33).alias("block"), "item"
        ),
        "shard-placed",
    )
    # Slots: rows before the block, then the place in the block; a block is what one task has read.
    blocks = placed.groupBy("shard", "block").count()
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("shard", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "block").orderBy("item")
    return (
        placed.withColumn("place", F.row_number().over(inside) - 1)
        .join(starts, ["shard", "block"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("first") + F.col("place")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
