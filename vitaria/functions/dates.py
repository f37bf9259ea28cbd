"""Years and dates held as text, numbers or date types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def year_text(column: Column, data_type: T.DataType | None = None) -> Column:
    """First four characters of the value written as text; null stays null."""
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        # keep large numbers such as 20200131.0 out of exponent notation
        column = column.try_cast("decimal(38,10)")
    return F.substring(column.cast("string"), 1, 4)


def parse_date(column: Column, pattern: str) -> Column:
    """Date read by ``pattern``; null where the text does not fit."""
    return F.try_to_timestamp(column.cast("string"), F.lit(pattern)).cast("date")


def date_is_bad(column: Column, pattern: str) -> Column:
    """True for text that is present but is no date of this pattern."""
    return column.isNotNull() & parse_date(column, pattern).isNull()
