"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

Every source gets a share of the asked size by its weight. A source whose share
is above ``max_epochs`` times its own size is clamped there and what it cannot
use is shared again by weight among the others, until none is above its clamp.
A target is then taken as whole repetitions of all documents of the source and
one more repetition of some, chosen in the order of a seeded hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitaria.llm.words import count_words
from vitaria.sinks.shared import keep_table

#: Hexadecimal digits of the hash by which documents of a source are dealt into parts.
PART_DIGITS = 3


def ranked(df: DataFrame, key: Column, name: str) -> DataFrame:
    """Kept copy of a frame with ``name``: 0 for the first row by ``key``, 1 for the second, ...

    Rows are ranked within range partitions; only the partitions' sizes meet on the driver.
    """
    part = f"{name}_part"
    rows = df.repartitionByRange(key).withColumn(part, F.spark_partition_id())
    kept = keep_table(rows, "ranked")
    before, offsets = 0, [F.lit(-1), F.lit(0)]
    for row in kept.groupBy(part).count().orderBy(part).collect():
        offsets += [F.lit(row[0]), F.lit(before)]
        before += row[1]
    within = F.row_number().over(Window.partitionBy(part).orderBy(key))
    return kept.withColumn(name, F.create_map(*offsets)[F.col(part)] + within - 1).drop(part)


def fill(sources: DataFrame, total: float, epochs: float) -> float | None:
    """Level at which ``min(weight * level, epochs * size)`` adds up to ``total``; None: all are clamped.

    ``sources`` has ``mix_weight`` and ``mix_source_size`` per source. Each round is one aggregate.
    """
    clamp, level = F.col("mix_source_size") * F.lit(epochs), 0.0
    while True:
        clamped = F.col("mix_weight") * F.lit(level) > clamp
        row = sources.agg(
            F.coalesce(F.sum(F.when(clamped, clamp)), F.lit(0.0)),
            F.sum(F.when(~clamped, F.col("mix_weight"))),
            F.sum(F.when(clamped, 1)),
        ).first()
        if not row[1]:
            return None
        found = (total - row[0]) / row[1]
        if found <= level:
            return found
        level = found


def mix_sources(
    docs: DataFrame,
    *,
    source: str = "source",
    doc_id: str = "doc_id",
    text: str = "text",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """Documents with ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_repeats``.

    ``weights`` go to the sources in order of code points, null last, and start
    again when they run out. ``share`` is the asked size as a part of all words.

    A null text has size 0. A null source is a source of its own. A null
    ``doc_id`` is hashed as empty; rows equal in id and text are
    interchangeable. Sources without words have target 0, and an empty table
    gives an empty one. Columns named ``mix_*`` are replaced, other columns stay.
    """
    spark = docs.sparkSession
    docs = docs.drop(*[c for c in docs.columns if c.startswith("mix_")])
    id_text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    key = F.md5(F.concat(F.lit(f"{seed}|"), id_text, F.lit("|"), F.md5(F.coalesce(F.col(text), F.lit("")))))
    sized = docs.withColumns({"mix_size": count_words(F.col(text)), "mix_key": key})
    sized = sized.withColumn("mix_part", F.substring("mix_key", 1, PART_DIGITS))

    parts = keep_table(
        sized.groupBy(F.col(source).alias("mix_source"), "mix_part").agg(F.sum("mix_size").alias("mix_part_size")), "mix-parts"
    )
    sizes = parts.groupBy("mix_source").agg(F.sum("mix_part_size").alias("mix_source_size"))
    sources = ranked(sizes, F.col("mix_source").asc_nulls_last(), "mix_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("mix_rank") % len(weights) + 1).cast("int"))
    sources = keep_table(sources.withColumn("mix_weight", weight), "mix-sources")
    whole = sources.agg(F.sum("mix_source_size")).first()[0] or 0
    level = fill(sources, share * whole, max_epochs)
    clamp = F.col("mix_source_size") * F.lit(max_epochs)
    target = clamp if level is None else F.least(clamp, F.col("mix_weight") * F.lit(level))
    sources = sources.select("mix_source", "mix_source_size", target.cast("double").alias("mix_target"))

    before = Window.partitionBy("mix_source").orderBy("mix_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("mix_before", F.coalesce(F.sum("mix_part_size").over(before), F.lit(0))).drop("mix_part_size")
    same = parts["mix_source"].eqNullSafe(sources["mix_source"])
    parts = keep_table(parts.join(sources, same).drop(sources["mix_source"]).withColumnRenamed("mix_part", "mix_in"), "mix-starts")

    inside = Window.partitionBy(source, "mix_part").orderBy("mix_key").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("mix_inside", F.coalesce(F.sum("mix_size").over(inside), F.lit(0)))
    joined = placed.join(parts, placed[source].eqNullSafe(parts["mix_source"]) & (placed["mix_part"] == parts["mix_in"]))
    epochs = F.floor(F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(0.0))
    extra = F.col("mix_target") - epochs * F.col("mix_source_size")
    more = 2 * (F.col("mix_before") + F.col("mix_inside")) + F.col("mix_size") <= 2 * extra
    repeats = epochs + F.when((extra > 0) & more & (F.col("mix_size") > 0), 1).otherwise(0)
    return joined.withColumn("mix_repeats", repeats.cast("int")).drop(
        "mix_key", "mix_part", "mix_in", "mix_source", "mix_before", "mix_inside"
    )


def repeat_rows(mixed: DataFrame) -> DataFrame:
    """Each document as often as the mix takes it, without the ``mix_*`` columns."""
    kept = [c for c in mixed.columns if not c.startswith("mix_")]
    copies = F.explode(F.when(F.col("mix_repeats") > 0, F.sequence(F.lit(1), F.col("mix_repeats"))))
    return mixed.withColumn("mix_copy", copies).select(*[F.col(f"`{c}`") for c in kept])
