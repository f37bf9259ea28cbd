"""Totals of all subtrees by parallel tree contraction.

Every round rakes and compresses at once. Rake: a node without children hands its total
to its parent and leaves. Compress: in a chain of nodes with one child each, some step out,
no two of them neighbours; the child of such a node moves up to its parent, and carries on
its edge what the node would have added. At the end the nodes that stepped out get their
totals back from the nodes they handed their place to. A chain of any length and a node of any
number of children are done in a number of rounds that grows with the logarithm of the nodes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaria.operators.joins import lookup_join
from vitaria.sinks.shared import keep_table


def _toss(depth: Column, node: Column, turn: int, bits: int) -> Column:
    """0 or 1 for a node: a bit of its depth in the first rounds, so that every other node of a chain
    steps out; later, where chains came about by raking, a hash."""
    if turn < bits:
        return F.shiftright(depth, turn) % 2
    return F.pmod(F.xxhash64(node, F.lit(turn)), F.lit(2))


def _contract(state: DataFrame, values: Sequence[str], turn: int, bits: int) -> DataFrame:
    """The nodes after one round; those that step out of a chain are marked as ``gone``."""
    leaf, rooted = F.col("kids") == 0, F.col("parent").isNull()
    child = F.struct("node", "depth", *[f"edge_{v}" for v in values])
    given = state.where(~rooted).groupBy(F.col("parent").alias("of")).agg(
        F.count_if(leaf).alias("raked"),
        F.min(F.when(~leaf, child)).alias("child"),
        *[F.sum(F.when(leaf, F.col(f"own_{v}") + F.col(f"edge_{v}"))).alias(f"given_{v}") for v in values],
    )
    raked = state.where(~leaf | rooted).join(given, F.col("node") == F.col("of"), "left").drop("of")
    raked = raked.withColumns(
        {"kids": F.col("kids") - F.coalesce("raked", F.lit(0))}
        | {f"own_{v}": F.col(f"own_{v}") + F.coalesce(f"given_{v}", F.lit(0)) for v in values}
    )
    steps_out = (_toss(F.col("depth"), F.col("node"), turn, bits) == 1) & (
        _toss(F.col("child.depth"), F.col("child.node"), turn, bits) == 0
    )
    gone = F.coalesce((F.col("kids") == 1) & F.col("parent").isNotNull() & steps_out, F.lit(False))
    raked = raked.withColumn("gone", gone)
    moved = raked.where("gone").select(
        F.col("child.node").alias("moved"), F.col("parent").alias("up"),
        *[(F.col(f"own_{v}") + F.col(f"edge_{v}")).alias(f"more_{v}") for v in values],
    )
    return raked.join(moved, F.col("node") == F.col("moved"), "left").select(
        "node", F.coalesce("up", "parent").alias("parent"), "depth", "kids", "gone",
        *[f"own_{v}" for v in values],
        *[(F.col(f"edge_{v}") + F.coalesce(f"more_{v}", F.lit(0))).alias(f"edge_{v}") for v in values],
        F.when(F.col("gone"), F.col("child.node")).alias("anchor"),
        *[F.when(F.col("gone"), F.col(f"own_{v}") + F.col(f"child.edge_{v}")).alias(f"ahead_{v}") for v in values],
    )


def _expand(gone: DataFrame, totals: DataFrame, values: Sequence[str], rounds: int) -> DataFrame:
    """Totals of the nodes that stepped out: those of the nodes they handed their place to, and what lies between."""
    ahead = [f"ahead_{v}" for v in values]
    far = 1
    while far < rounds:  # a node's anchor may have stepped out in a later round: pointers double
        next_ = gone.select(F.col("node").alias("anchor"), F.col("anchor").alias("next"), *[F.col(a).alias(f"next_{a}") for a in ahead])
        joined = lookup_join(gone, next_, ["anchor"])
        gone = keep_table(
            joined.select(
                "node", F.coalesce("next", "anchor").alias("anchor"),
                *[(F.col(a) + F.coalesce(f"next_{a}", F.lit(0))).alias(a) for a in ahead],
            ),
            "anchors",
        )
        far *= 2
    known = totals.select(F.col("node").alias("anchor"), *[F.col(v).alias(f"of_{v}") for v in values])
    return lookup_join(gone, known, ["anchor"]).select("node", *[(F.col(f"ahead_{v}") + F.col(f"of_{v}")).alias(v) for v in values])


def subtree_sums(nodes: DataFrame, values: Sequence[str]) -> DataFrame:
    """``node`` and the sum of each of ``values`` over its subtree, itself included.

    ``nodes`` has ``node`` (unique), ``parent`` (null for a root; there may be several roots), ``depth`` (greater than
    the parent's) and whole-number columns ``values``, null counting as 0. Every parent has to be a node. An empty table gives an empty one.
    """
    kids = nodes.where("parent is not null").groupBy(F.col("parent").alias("of")).agg(F.count("*").alias("n"))
    state = nodes.join(kids, F.col("node") == F.col("of"), "left").select(
        "node", "parent", F.col("depth").cast("long"), F.coalesce("n", F.lit(0)).alias("kids"), F.lit(False).alias("gone"),
        *[F.coalesce(F.col(v).cast("long"), F.lit(0)).alias(f"own_{v}") for v in values],
        *[F.lit(0).cast("long").alias(f"edge_{v}") for v in values],
    )
    state = keep_table(state, "contracted")
    count = lambda s: s.agg(F.count_if(F.col("parent").isNotNull()), F.max("depth")).first()
    (left, deepest), tables = count(state), [state]
    bits, live = (deepest or 0).bit_length(), state
    while left:
        state = keep_table(_contract(live, values, len(tables) - 1, bits), "contracted")
        tables.append(state)
        live = state.where("not gone")
        left, _ = count(live)
    named = [F.col(f"own_{v}").alias(v) for v in values]
    raked = [t.where("not gone and kids = 0 and parent is not null").select("node", *named) for t in tables]
    totals = reduce(DataFrame.union, [live.select("node", *named), *raked])
    if len(tables) == 1:
        return totals
    totals = keep_table(totals, "totals")
    gone = reduce(DataFrame.union, [t.where("gone").select("node", "anchor", *[f"ahead_{v}" for v in values]) for t in tables[1:]])
    return totals.union(_expand(keep_table(gone, "anchors"), totals, values, len(tables) - 1))
