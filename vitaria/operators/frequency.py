"""Frequencies of values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaria.functions.dates import year_text
from vitaria.operators.columns import named


def stack_columns(df: DataFrame, *columns: str | Column, name: str = "valor") -> DataFrame:
    """Several columns under each other in one, duplicates kept, one scan."""
    values = [named(c) if isinstance(c, str) else c for c in columns]
    return df.select(F.explode(F.array(*values)).alias(name))


def value_counts(df: DataFrame, column: str, sort: bool = True) -> DataFrame:
    """How often each non-null value occurs, most frequent first."""
    counts = df.where(named(column).isNotNull()).groupBy(named(column)).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), named(column)) if sort else counts


def year_frequency(df: DataFrame, *columns: str, name: str = "ano") -> DataFrame:
    """How often each year occurs in several date columns taken together."""
    years = [year_text(named(c), df.schema[c].dataType) for c in columns]
    return value_counts(stack_columns(df, *years, name=name), name)
