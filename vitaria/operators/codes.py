"""Codes to descriptions: exact entry first, then the first prefix in file order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaria.operators.columns import named
from vitaria.operators.joins import BroadcastBound, Lookup, fits, hot_keys, lookup_columns, lookup_join
from vitaria.sinks.shared import keep_table
from vitaria.sources.dictionary import CodeDictionary

# one hash probe per code length; real dictionaries have two to five lengths
MAX_LENGTHS = 16


def resolve_codes(
    df: DataFrame,
    columns: Sequence[str],
    dictionary: CodeDictionary,
    bound: BroadcastBound = BroadcastBound(),
) -> DataFrame:
    """Replace codes by descriptions in the given columns, where present.

    A code listed in the dictionary gets its description. Failing that, or when
    the description only repeats the code, the listed code that begins it and
    stands first in the file decides, not the longest one. Unknown codes and
    null stay as they are.

    A small dictionary is broadcast, one equality join per code length, and no
    row of ``df`` is shuffled or read twice. A larger one is joined to the
    distinct codes only and the outcome is joined back.
    """
    present = [c for c in columns if c in df.columns]
    if not present or not dictionary.lengths:
        return df.withColumns({c: named(c).cast("string") for c in present})
    if dictionary.small and len(dictionary.lengths) <= MAX_LENGTHS:
        for c in present:
            df = _probe_lengths(df, c, dictionary)
        return df
    resolved = keep_table(resolve_distinct(df, present, dictionary, bound), "resolved")
    small = fits(resolved, bound)
    hot = None
    if not small:  # hot codes of all columns at once, before any join
        codes = df.select(*[named(c).cast("string").alias(f"_code{i}") for i, c in enumerate(present)])
        hot = hot_keys(codes, [[f"_code{i}"] for i in range(len(present))])
    for i, c in enumerate(present):
        own = None if hot is None else hot.where(F.col("_of") == i).drop("_of")
        df = _join_back(df, c, resolved, small, own)
    return df


def exact_lookup(df: DataFrame, columns: Sequence[str], dictionary: CodeDictionary) -> DataFrame:
    """Only the exact step: description of a listed code, else the code itself."""
    side = dictionary.frame.select(F.col("code").alias("_key"), "description")
    lookups = [Lookup(c, side, dictionary.small) for c in columns if c in df.columns]
    described = lambda x, found: F.when(found.isNotNull(), found["description"]).otherwise(named(x.column).cast("string"))
    return lookup_columns(df, lookups, described)


def _choose(code: Column, exact: Column, first: Column) -> Column:
    text = exact["description"]
    return (
        F.when(exact.isNotNull() & ~text.eqNullSafe(code), text)
        .when(first.isNotNull(), first["description"])
        .otherwise(code)
    )


def _probe_lengths(df: DataFrame, column: str, dictionary: CodeDictionary) -> DataFrame:
    order = df.columns
    joined = df.withColumn("_code", named(column).cast("string"))
    code, value = F.col("_code"), None
    for n in sorted(dictionary.lengths, reverse=True):
        side = dictionary.probes[n].select(
            F.col("code").alias(f"_key{n}"), F.col("exact").alias(f"_exact{n}"), F.col("best").alias(f"_best{n}")
        )
        # a code shorter than this gives a shorter text, which matches no entry
        joined = joined.join(F.broadcast(side), F.substring(code, 1, n) == F.col(f"_key{n}"), "left")
        found = F.col(f"_key{n}").isNotNull()
        text = F.when(F.length(code) == n, F.col(f"_exact{n}")).otherwise(F.col(f"_best{n}"))
        value = F.when(found, text) if value is None else value.when(found, text)
    value = value.otherwise(code)
    return joined.select(*[value.alias(c) if c == column else named(c) for c in order])


def distinct_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Different non-null codes of some columns, as one column ``code``."""
    stacked = F.explode(F.array(*[named(c).cast("string") for c in columns]))
    return df.select(stacked.alias("code")).where(F.col("code").isNotNull()).distinct()


def resolve_distinct(
    df: DataFrame, columns: Sequence[str], dictionary: CodeDictionary, bound: BroadcastBound = BroadcastBound()
) -> DataFrame:
    """``(code, description)`` of the different codes that the dictionary changes."""
    codes = distinct_codes(df, columns)
    lengths = F.array(*[F.lit(n) for n in dictionary.lengths])
    usable = F.filter(lengths, lambda n: n <= F.length("code"))
    prefixes = codes.select("code", F.explode(usable).alias("n")).select(
        "code", F.substr("code", F.lit(1), F.col("n")).alias("_prefix")
    )
    side = dictionary.frame.select(
        F.col("code").alias("_prefix"), F.struct("ord", "description").alias("_hit")
    )
    hits = lookup_join(prefixes, side, ["_prefix"], bound, small=dictionary.small).where(
        F.col("_hit").isNotNull()
    )
    best = hits.groupBy("code").agg(
        F.min("_hit").alias("_first"),
        F.min(F.when(F.col("_prefix") == F.col("code"), F.col("_hit"))).alias("_exact"),
    )
    return best.select(
        "code", _choose(F.col("code"), F.col("_exact"), F.col("_first")).alias("description")
    )


def _join_back(df: DataFrame, column: str, resolved: DataFrame, small: bool, hot: DataFrame | None) -> DataFrame:
    order = df.columns
    side = resolved.select(F.col("code").alias("_code"), F.struct("description").alias("_hit"))
    joined = lookup_join(df.withColumn("_code", named(column).cast("string")), side, ["_code"], small=small, hot=hot)
    value = F.when(F.col("_hit").isNotNull(), F.col("_hit.description")).otherwise(F.col("_code"))
    return joined.select(*[value.alias(c) if c == column else named(c) for c in order])
