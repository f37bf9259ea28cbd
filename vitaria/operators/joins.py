"""Left joins to a side that holds at most one row per key."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitaria.sinks.shared import keep_table


@dataclass(frozen=True)
class BroadcastBound:
    """Most rows and bytes a side may have to be broadcast."""

    rows: int = 500_000
    size: int = 64 * 1024 * 1024


# A key with more rows than this is hot: its rows are spread over several tasks.
HOT_ROWS = 1_000_000
# The list of hot keys holds at most so many for a join: with the number of rows
# the least number of rows of a hot key rises.
HOT_LIST = 100_000


def _row_bytes(frame: DataFrame):
    size = F.lit(8 * len(frame.columns))
    for field in frame.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
    return size.cast("long")


def fits(frame: DataFrame, bound: BroadcastBound = BroadcastBound()) -> bool:
    """Count the rows and bytes of a frame and tell if they are within the bound."""
    rows, size = frame.agg(F.count("*"), F.coalesce(F.sum(_row_bytes(frame)), F.lit(0))).first()
    return rows <= bound.rows and size <= bound.size


def lookup_join(
    rows: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    bound: BroadcastBound = BroadcastBound(),
    small: bool | None = None,
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Left join ``side``, whose ``keys`` are unique, onto ``rows``.

    The side is measured (unless ``small`` says what is known of it). Within
    the bound it is broadcast and ``rows`` are not shuffled. Beyond it both are
    shuffled on the keys; the rows of hot keys, null included, are counted
    first (unless ``hot`` holds them, see :func:`hot_keys`) and spread over
    tasks of about ``hot_rows`` rows, and only the side's row for such a key is
    copied.
    """
    keys = list(keys)
    if small if small is not None else fits(side, bound):
        return rows.join(F.broadcast(side), keys, "left")
    if hot is None:
        hot = hot_keys(rows, [keys], hot_rows)
    hot = hot.where(F.col("_of") == 0).drop("_of") if "_of" in hot.columns else hot
    if hot.isEmpty():
        return rows.join(side, keys, "left")
    columns = [c for c in rows.columns if c not in keys]
    spread = _dealt(_mark(rows, hot, keys), keys)
    copies = _mark(side, hot, keys).withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    )
    joined = spread.join(copies.drop("_parts"), [*keys, "_part"], "left")
    return joined.select(*keys, *columns, *[c for c in side.columns if c not in keys])


def _dealt(marked: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the part of their key that they go to, in turn within each task.

    Rows are numbered in the order of their key and content, so rows alike in all are dealt out
    as evenly as others, and a lost task that is run again gives the same rows the same parts.
    """
    held = [F.col(f"`{f.name}`") for f in marked.schema if not _has_map(f.dataType)]
    ordered = marked.sortWithinPartitions(*[F.col(f"`{k}`") for k in keys], F.xxhash64(*held))
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + F.pmod(F.xxhash64(F.spark_partition_id()), F.lit(1 << 20))
    return ordered.withColumn("_part", F.coalesce(F.pmod(number, F.col("_parts")).cast("int"), F.lit(0))).drop("_parts")


@dataclass(frozen=True)
class Lookup:
    """One column to be looked up: in which side, by its key, and whether the side is known to be small."""

    column: str
    side: DataFrame
    small: bool | None = None


def lookup_columns(
    rows: DataFrame,
    lookups: Sequence[Lookup],
    value: Callable[[Lookup, Column], Column],
    bound: BroadcastBound = BroadcastBound(),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``rows`` with several columns replaced by ``value(lookup, found)``; all sides are planned together.

    A side has the unique ``_key``, as text, and other columns, which come as the struct ``found``, null without a match. Sides are measured
    once each and small ones are joined first, without a shuffle. Hot keys of all large ones are counted in one
    pass over ``rows`` as they are, before any join.
    """
    measured: dict[int, bool] = {}
    for lookup in lookups:
        known = lookup.small if lookup.small is not None else measured.get(id(lookup.side))
        measured[id(lookup.side)] = fits(lookup.side, bound) if known is None else known
    ordered = sorted(lookups, key=lambda x: not measured[id(x.side)])
    large = [x for x in ordered if not measured[id(x.side)]]
    text = lambda x: F.col(f"`{x.column}`").cast("string")
    hot = None
    if large:
        codes = rows.select(*[text(x).alias(f"_key{i}") for i, x in enumerate(large)])
        hot = hot_keys(codes, [[f"_key{i}"] for i in range(len(large))], hot_rows)
    names = rows.columns
    for x in ordered:
        side = x.side.select("_key", F.struct(*[F.col(f"`{c}`") for c in x.side.columns if c != "_key"]).alias("_found"))
        own = hot.where(F.col("_of") == large.index(x)).drop("_of") if x in large else None
        joined = lookup_join(rows.withColumn("_key", text(x)), side, ["_key"], bound, measured[id(x.side)], hot_rows, own)
        replaced = value(x, F.col("_found"))
        rows = joined.select(*[replaced.alias(n) if n == x.column else F.col(f"`{n}`") for n in names])
    return rows


def _has_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString()


def hot_keys(rows: DataFrame, keys: Sequence[Sequence[str]], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``_of, _hot0, _hot1, …, _parts``: hot keys of several joins, counted in one pass.

    ``keys`` lists the key columns of each join, of one type at each place;
    ``_of`` is the number of the join. The list holds at most
    ``HOT_LIST`` keys for each join.
    """
    keys = [list(k) for k in keys]
    if len(keys) == 1:
        named = [F.col(f"`{k}`").alias(f"_hot{i}") for i, k in enumerate(keys[0])]
        stacked = rows.select(F.lit(0).alias("_of"), *named)
    else:
        entries = [
            F.struct(F.lit(n).alias("_of"), *[F.col(f"`{k}`").alias(f"_hot{i}") for i, k in enumerate(of)])
            for n, of in enumerate(keys)
        ]
        stacked = rows.select(F.explode(F.array(*entries)).alias("_k")).select("_k.*")
    names = [c for c in stacked.columns if c != "_of"]
    counted = keep_table(stacked.groupBy("_of", *names).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows), "hot-keys")
    total = counted.agg(F.sum("_n")).first()[0] or 0
    least = max(hot_rows, -(-total // HOT_LIST))
    parts = F.ceil(F.col("_n") / hot_rows).cast("int").alias("_parts")
    return counted.where(F.col("_n") > least).select("_of", *names, parts)


def _mark(frame: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_hot{i}")) for i, k in enumerate(keys)])
    return frame.join(F.broadcast(hot), same, "left").drop(*[f"_hot{i}" for i in range(len(keys))])
