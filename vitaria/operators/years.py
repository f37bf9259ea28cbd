"""Filters on the year of a date column, in forms a Parquet scan can use."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitaria import fixed_values as fv
from vitaria.functions.dates import year_text
from vitaria.operators.columns import named

_LARGEST = {T.IntegerType: 2**31 - 1, T.LongType: 2**63 - 1}


def _runs(years: Iterable[int]) -> list[tuple[int, int]]:
    """Consecutive years as inclusive ranges."""
    runs: list[tuple[int, int]] = []
    for year in sorted(set(years)):
        if runs and runs[-1][1] == year - 1:
            runs[-1] = (runs[-1][0], year)
        else:
            runs.append((year, year))
    return runs


def year_predicate(df: DataFrame, column: str, years: Sequence[int | str]) -> Column:
    """True where the first four characters of the value are one of the years.

    The test is on the bare column, as prefixes for text and as ranges for
    dates and whole numbers, so that it reaches the scan. ``year(col)`` or a
    substring would not.
    """
    wanted = [int(year) for year in years]
    if not wanted or any(not 1000 <= year <= 9999 for year in wanted):
        raise ValueError(f"four-digit years expected, got {list(years)}")
    kind = df.schema[column].dataType
    value = named(column)
    if isinstance(kind, T.StringType):
        tests = [value.startswith(str(year)) for year in sorted(set(wanted))]
    elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        tests = [
            (value >= F.lit(f"{first}-01-01").cast(kind)) & _before(value, last, kind)
            for first, last in _runs(wanted)
        ]
    elif type(kind) in _LARGEST:
        largest = _LARGEST[type(kind)]
        tests = [
            value.between(F.lit(first * 10**zeros), F.lit(min((last + 1) * 10**zeros - 1, largest)))
            for first, last in _runs(wanted)
            for zeros in range(0, 16)
            if first * 10**zeros <= largest
        ]
    else:
        return year_text(value, kind).isin([str(year) for year in wanted])
    return reduce(lambda a, b: a | b, tests)


def _before(value: Column, last: int, kind: T.DataType) -> Column:
    if last == 9999:
        return value.isNotNull()
    return value < F.lit(f"{last + 1}-01-01").cast(kind)


def add_year(df: DataFrame, column: str, name: str = fv.YEAR_COLUMN) -> DataFrame:
    """Add the year of a date column as text."""
    return df.withColumn(name, year_text(named(column), df.schema[column].dataType))


def filter_years(
    df: DataFrame, column: str, years: Sequence[int | str], name: str | None = fv.YEAR_COLUMN
) -> DataFrame:
    """Rows of the given years; the year stays as column ``name``."""
    kept = df.where(year_predicate(df, column, years))
    return kept if name is None else add_year(kept, column, name)
