"""Writing silver tables, Delta or Parquet tables, audits and JSON rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitaria.operators.partitions import add_region
from vitaria.sources.bronze import dataset_files
from vitaria.sources.contract import as_contracted, keep_contract
from vitaria.sources.tables import SILVER_KEYS, delta_available, read_mixed, silver_path


def write_silver(
    df: DataFrame,
    base: str,
    system: str,
    table: str,
    partition_by: Sequence[str] = SILVER_KEYS,
    rebalance: bool = False,
) -> T.StructType:
    """Overwrite exactly the partitions of a silver table that ``df`` holds.

    The region of the state is added; columns of ``partition_by`` that the
    table lacks are left out. Rows that come straight from bronze datasets
    already lie together by partition, so nothing is shuffled and each task
    writes its own part. ``rebalance=True`` is for frames that do not: one
    shuffle on the partition columns in which large partitions are split and
    small ones joined. Columns get the types of the table's contract, which is widened
    where needed (see :mod:`vitaria.sources.contract`). Returns the schema as written.
    """
    if "regiao" in partition_by and "regiao" not in df.columns and "uf" in df.columns:
        df = add_region(df)
    keys = [c for c in partition_by if c in df.columns]
    if rebalance:
        df = df.hint("rebalance", *[F.col(c) for c in keys])
    path = silver_path(base, system, table)
    stored = df.drop("tabela")
    stored = as_contracted(stored, keep_contract(df.sparkSession, path, stored.schema))
    (
        stored.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )
    return stored.schema


def write_table(
    df: DataFrame, path: str, table_format: str | None = None, partition_by: Sequence[str] = ()
) -> str:
    """Overwrite one table; Delta where the session has it, else Parquet.

    Returns the format written.
    """
    kind = table_format or ("delta" if delta_available(df.sparkSession) else "parquet")
    writer = df.write.format(kind).mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
    return kind


def convert_datasets(
    spark: SparkSession, source: str, target: str, table_format: str | None = None
) -> DataFrame:
    """All datasets under ``source`` as one table at ``target``, by dataset.

    Returns the datasets written with their places: ``dataset destino``.
    """
    found = dataset_files(spark, source)
    rows = read_mixed(spark, [place for place, _, _ in found], "dataset")
    write_table(rows, target, table_format, ["dataset"])
    return spark.createDataFrame(
        [(name, f"{target}/dataset={name}") for _, name, _ in found], "dataset string, destino string"
    )


def listed_as_text(report: DataFrame) -> DataFrame:
    """A report with its arrays of names as texts, joined by a comma and a space."""
    arrays = [f.name for f in report.schema if isinstance(f.dataType, T.ArrayType)]
    return report.withColumns({c: F.array_join(F.col(f"`{c}`"), ", ") for c in arrays})


def write_report_csv(report: DataFrame, path: str) -> None:
    """A small report as one CSV file with a header; arrays of names are joined by a comma and a space."""
    listed_as_text(report).repartition(1).write.mode("overwrite").option("header", True).csv(path)


def write_json_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ("uf",)) -> None:
    """Rows as JSON lines, one directory per state; null fields are kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).partitionBy(*partition_by).json(path)


def json_rows(df: DataFrame, name: str = "json") -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name))
