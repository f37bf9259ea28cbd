"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_kept: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Where it is unset a local session gets a temporary folder; a cluster is
    refused one, since its machines would not see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="vitaria-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder in the shared place that nobody else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def keep_table(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as a table in the shared place and read it from there.

    It is computed once however often it is used, and a lost executor does not
    bring its computation back. :func:`drop_kept` removes it when a run is over.
    """
    path = new_folder(df.sparkSession, name)
    _kept.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def files_in(spark: SparkSession, folder: str) -> frozenset[str]:
    """Names of the data files in a folder of any store that Spark reads; none if there is no such folder."""
    store, place = _file_system(spark, folder)
    if not store.exists(place):
        return frozenset()
    names = (status.getPath().getName() for status in store.listStatus(place))
    return frozenset(name for name in names if not name.startswith(("_", ".")))


def remove_folders(spark: SparkSession, folders: Sequence[str]) -> None:
    """Remove folders that are there, without a Spark job."""
    for folder in folders:
        store, place = _file_system(spark, folder)
        if store.exists(place):
            store.delete(place, True)


def drop_kept(spark: SparkSession) -> None:
    """Remove the tables that :func:`keep_table` made in this session; frames read from them end with it."""
    remove_folders(spark, _kept.pop(spark.sparkContext.applicationId, []))
