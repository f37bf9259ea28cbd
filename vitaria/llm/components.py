"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaria.operators.joins import HOT_ROWS, BroadcastBound, lookup_join
from vitaria.sinks.shared import keep_table


def _large_star(links: DataFrame, bound: BroadcastBound, hot_rows: int) -> DataFrame:
    """Each node passes its least neighbour to its greater ones."""
    both = links.union(links.select("low", "high")).toDF("node", "other")
    least = keep_table(both.groupBy("node").agg(F.min("other").alias("least")), "least")
    joined = lookup_join(both, least, ["node"], bound, hot_rows=hot_rows).where("other > node")
    return joined.select(F.col("other").alias("high"), F.least("least", "node").alias("low")).distinct()


def _small_star(links: DataFrame, bound: BroadcastBound, hot_rows: int) -> DataFrame:
    """Each node and its lesser neighbours move to the least of these."""
    least = keep_table(links.groupBy("high").agg(F.min("low").alias("least")), "least")
    joined = lookup_join(links, least, ["high"], bound, hot_rows=hot_rows)
    moved = joined.where("low > least").select(F.col("low").alias("high"), F.col("least").alias("low"))
    return moved.union(least.select("high", F.col("least").alias("low"))).distinct()


def components(links: DataFrame, bound: BroadcastBound = BroadcastBound(), hot_rows: int = HOT_ROWS) -> DataFrame:
    """``node, component`` for every node of a link, by alternating large and small stars.

    ``links`` has two columns of whole numbers, in any order; links to itself and
    nulls are left out. ``component`` is the least node that can be reached. Every
    round is written to the shared folder. The least neighbour of each node is found
    with a count in each task before the shuffle, and given to the links by a broadcast within the
    bound; beyond it by a shuffle in which nodes of more than ``hot_rows`` links are dealt to several tasks.
    """
    links = links.toDF("a", "b").where("a <> b")
    state = keep_table(links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(), "links")
    before = None
    while True:
        state = keep_table(_large_star(state, bound, hot_rows), "links")
        state = keep_table(_small_star(state, bound, hot_rows), "links")
        now = state.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if now == before:
            return state.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
                state.select("low", "low").distinct()
            )
        before = now
