"""Drop, rename, select, keep and recode columns.

Absent columns are ignored and names are compared exactly. What is present is
decided once, on the schema, while the plan is built.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitaria.functions import age, dates, labels
from vitaria.operators.joins import BroadcastBound, Lookup, lookup_columns, lookup_join


class RenameCollision(ValueError):
    """Two columns would end up with one name."""


def named(column: str) -> Column:
    """A column by its plain name, whatever characters it holds."""
    return F.col("`" + column.replace("`", "``") + "`")


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the listed columns that are there."""
    gone = set(names)
    return df.select(*[named(c) for c in df.columns if c not in gone])


def select_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the given columns, in the given order."""
    return df.select(*[named(c) for c in names])


def column_list(df: DataFrame) -> str:
    """Column names as one text."""
    return ", ".join(df.columns)


def rename_columns(df: DataFrame, names: Mapping[str, str], on_collision: str = "error") -> DataFrame:
    """Rename by map, all at once.

    When two columns would get one name: ``"error"`` refuses before the plan is
    built, ``"suffix"`` numbers the later ones (``name_2``), ``"keep"`` leaves
    all columns of the table as they were.
    """
    if on_collision not in ("error", "suffix", "keep"):
        raise ValueError(f"on_collision must be 'error', 'suffix' or 'keep', not {on_collision!r}")
    new = [names.get(c, c) for c in df.columns]
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"

    def fold(name: str) -> str:
        return name if sensitive else name.lower()

    clashes = {name for name, times in Counter(map(fold, new)).items() if times > 1}
    if clashes and on_collision == "error":
        sources = {n: [c for c, m in zip(df.columns, new) if fold(m) == n] for n in sorted(clashes)}
        raise RenameCollision(f"columns would share a name: {sources}")
    if clashes and on_collision == "keep":
        return df
    taken: set[str] = set()
    free: list[str] = []
    reserved = set(map(fold, new))
    for name in new:
        candidate, number = name, 1
        while fold(candidate) in taken or (number > 1 and fold(candidate) in reserved):
            number += 1
            candidate = f"{name}_{number}"
        taken.add(fold(candidate))
        free.append(candidate)
    return df.toDF(*free)


def keep_raw(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Copy each code column to ``<column>_keep`` before it is described."""
    return df.withColumns({f"{c}_keep": named(c) for c in columns if c in df.columns})


def text_columns(df: DataFrame) -> set[str]:
    """Names of the columns held as text."""
    return {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}


def recode_columns(
    df: DataFrame,
    table: Mapping[str, Mapping[str, str | None]],
    blank_null_labels: bool = False,
) -> DataFrame:
    """Codes to labels, column by column; other values pass through.

    Codes are text, so columns of any other type stay unchanged. A rule with
    many labels becomes a join to those labels, which the driver holds anyway.
    """
    text = text_columns(df)
    build = labels.recode_all if blank_null_labels else labels.recode
    due = {c: mapping for c, mapping in table.items() if c in text}
    long = {c: mapping for c, mapping in due.items() if len(mapping) > labels.MAX_CASE_LABELS}
    df = df.withColumns({c: build(named(c), mapping) for c, mapping in due.items() if c not in long})
    lookups = []
    for c, mapping in long.items():
        pairs = [(k, v) for k, v in mapping.items() if v is not None or blank_null_labels]
        side = df.sparkSession.createDataFrame(pairs, "_key string, label string")
        lookups.append(Lookup(c, side, len(pairs) <= BroadcastBound().rows))
    return lookup_columns(df, lookups, lambda x, found: F.when(found.isNotNull(), found["label"]).otherwise(named(x.column)))


def recode_by_table(
    df: DataFrame,
    column: str,
    side: DataFrame,
    bound: BroadcastBound = BroadcastBound(),
    small: bool | None = None,
) -> DataFrame:
    """Recode by a table ``(code, label)`` of any size with unique codes.

    With a third column ``known`` a null label blanks the value.
    """
    columns = df.columns
    pairs = side.select(
        F.col("code").alias("_code"),
        F.col("label").alias("_label"),
        (F.col("known") if "known" in side.columns else F.col("label").isNotNull()).alias("_known"),
    )
    joined = lookup_join(df.withColumn("_code", named(column)), pairs, ["_code"], bound, small)
    value = F.when(F.col("_known"), F.col("_label")).otherwise(named(column))
    return joined.select(*[value.alias(c) if c == column else named(c) for c in columns])


def decode_ages(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Age codes to text in the given columns, where present and held as text."""
    text = text_columns(df)
    due = [c for c in columns if c in text]
    # the quantity is a column of its own so that it is parsed once per row
    parsed = df.withColumns({f"_quantity_{c}": age.age_quantity(named(c)) for c in due})
    decoded = parsed.withColumns({c: age.age_text(named(c), named(f"_quantity_{c}")) for c in due})
    return decoded.select(*[named(c) for c in df.columns])


def enforce_dates(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """Date type for the given columns; text that does not fit gives null.

    Columns that already are dates or timestamps are only cast.
    """
    types = {f.name: f.dataType for f in df.schema}
    ready = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.withColumns(
        {
            c: named(c).cast("date") if isinstance(types[c], ready) else dates.parse_date(named(c), pattern)
            for c, pattern in patterns.items()
            if c in types
        }
    )
