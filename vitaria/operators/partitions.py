"""Coordinates that should be there but are not; states to regions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from vitaria import fixed_values as fv
from vitaria.functions import region_of
from vitaria.operators.columns import named


def missing_partitions(expected: DataFrame, observed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected coordinates for which no dataset was observed.

    ``observed`` may be a dataset listing or any table with the key columns.
    """
    seen = observed.select(*keys).distinct()
    return expected.join(seen, list(keys), "left_anti")


def add_region(df: DataFrame, uf: str = "uf", name: str = "regiao") -> DataFrame:
    """Region of each row's state; null for an unknown one.

    The 27 states are a fixed list, so this is an expression and no join; on a
    constant state it folds to a constant.
    """
    return df.withColumn(name, region_of(named(uf)))


def in_regions(df: DataFrame, regions: Sequence[str], uf: str = "uf") -> DataFrame:
    """Rows of the states of some regions, as a plain list test on the state.

    On a partition column this prunes directories.
    """
    return df.where(named(uf).isin([state for region in regions for state in fv.REGIONS[region]]))
