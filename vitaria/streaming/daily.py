"""The scheduled run: only datasets whose files changed go through the chain again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitaria.functions.names import parse_dataset
from vitaria.plans.chain import Outcome, empty_partitions, run_datasets
from vitaria.plans.specs import TableSpec
from vitaria.sinks.shared import keep_table
from vitaria.sources.dictionary import CodeDictionary
from vitaria.sources.tables import path_exists


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, length, modificationTime`` of the Parquet files under a folder; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return files.load(folder).select("path", "length", "modificationTime")


def changed_datasets(spark: SparkSession, spec: TableSpec, bronze: str, checkpoint: str) -> tuple[DataFrame, DataFrame]:
    """``(place, dataset, there)`` of the table's datasets that changed since the last run, and the listing now.

    A file counts as new when its path, length and time are not in the last
    listing, however old it is; a dataset also changed when a file of it has gone.
    ``there`` tells whether it still has files. Datasets of other tables in
    the same folder are left alone.
    """
    now = keep_table(list_files(spark, f"{bronze.rstrip('/')}/{spec.layout.folder}"), "listing")
    keys = now.columns
    if path_exists(spark, f"{checkpoint}/listing"):
        seen = spark.read.parquet(f"{checkpoint}/listing")
        last = seen.agg(F.max("run")).first()[0]
        seen = seen.where(F.col("run") == last).select(*keys)
    else:
        seen = spark.createDataFrame([], now.schema)
    there = F.lit(True).alias("there")
    files = now.join(seen, keys, "left_anti").select("path").union(seen.join(now, keys, "left_anti").select("path"))
    place = _place(F.col("path"), spec.layout.extension)
    standing = now.select(place.alias("place"), there).distinct()
    changed = files.select(place.alias("place")).distinct().join(standing, "place", "left")
    parsed = parse_dataset(F.col("place"))
    named = changed.select(
        "place", F.coalesce("there", F.lit(False)).alias("there"), parsed["tabela"].alias("tabela"),
        _dataset(F.col("place")).alias("dataset"),
    )
    return named.where(F.col("tabela") == spec.layout.table).select("place", "dataset", "there"), now


def _place(path: Column, extension: str) -> Column:
    return F.concat(F.substring_index(path, f".{extension}", 1), F.lit(f".{extension}"))


def _dataset(place: Column) -> Column:
    return F.substring_index(F.substring_index(F.substring_index(place, "/", -1), "=", -1), ".", 1)


def refresh_new_datasets(
    spark: SparkSession,
    spec: TableSpec,
    bronze: str,
    silver: str,
    checkpoint: str,
    schema: T.StructType | None = None,
    dictionary: CodeDictionary | None = None,
    **options,
) -> Outcome | None:
    """Process what changed since the last run; None if nothing did.

    Changed datasets are read whole and their silver partitions overwritten;
    the partitions of datasets that have gone, or hold no row any more, are
    emptied. The listing of files is stored under ``checkpoint`` when all is
    done, so a run that fails is done again as a whole and gives the same tables.
    Files that could not be read are in the outcome's failures, and their datasets are tried again next time, also
    where nothing else changed.
    """
    changed, now = changed_datasets(spark, spec, bronze, checkpoint)
    datasets = changed.collect()
    places = [row.place for row in datasets if row.there]
    if gone := [row.dataset for row in datasets if not row.there]:
        empty_partitions(spark, spec, silver, gone)
    outcome = run_datasets(spark, spec, places, silver, dictionary, schema=schema, **options) if places else None
    failed = [] if outcome is None else sorted({row.dataset for row in outcome.failures.collect()})
    known = path_exists(spark, f"{checkpoint}/listing")
    if datasets or not known:
        last = spark.read.parquet(f"{checkpoint}/listing").agg(F.max("run")).first()[0] if known else 0
        done = now.where(~_dataset(_place(F.col("path"), spec.layout.extension)).isin(failed))
        done.withColumn("run", F.lit((last or 0) + 1)).write.mode("append").partitionBy("run").parquet(f"{checkpoint}/listing")
    return outcome
