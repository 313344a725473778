"""Connected components of a graph given by its edges, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lensmill.llm.common import job, narrow, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of edges (a, b); the component is its smallest node.

    Large and small stars in turn: every node hangs its larger neighbours, then its smaller ones, to the smallest of
    its neighbourhood, until nothing changes. Only minima are gathered per node, so a node with very many neighbours
    costs no task more than others, and each round is written to the shared folder, which cuts the lineage.
    """
    ordered = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, before = stored(ordered.distinct(), "edges"), None
    while True:
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = state
        few = lambda frame, n=state[0]: narrow(frame, n)
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        with job(edges.sparkSession):
            # Large star: neighbours above a node go to the smallest one around it.
            least = stored(few(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))), "edges-least")
            large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
            large = stored(few(large), "edges")
            # Small star: a node and its neighbours below go to the smallest of them.
            least = stored(few(large.groupBy("a").agg(F.min("b").alias("m"))), "edges-least")
            small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
            now = stored(few(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct()), "edges", result=True)
