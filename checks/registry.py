"""Registration of queries beside their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register a query; without SQL only its rows are checked."""

    def register(query: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_case(column: str, labels: dict[str, str], name: str | None = None) -> str:
    """CASE text for a recode rule."""
    arms = " ".join(f"when '{code}' then '{label}'" for code, label in labels.items())
    return f'case {column} {arms} else {column} end as "{name or column}"'
