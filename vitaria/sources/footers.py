"""Schemas of many Parquet files, without a Spark job for each."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import types as T

_SPARK_SCHEMA = "org.apache.spark.sql.parquet.row.metadata"


@dataclass(frozen=True)
class Footer:
    """What the end of a Parquet file says: its schema as text, equal for equal schemas, and its rows."""

    kind: str
    rows: int


def unquoted(uri: str) -> str:
    """Path of a file that Spark lists as a URI."""
    return unquote(uri)


def as_uri(spark: SparkSession, path: str) -> str:
    """A plain path as the URI that Spark would list."""
    return spark._jvm.org.apache.hadoop.fs.Path(path).toUri().toString()


def reason(error: BaseException) -> str:
    """First line of what went wrong at the root of an error."""
    java = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    text = str(error)
    while java is not None:
        text, java = java.getMessage() or text, java.getCause()
    return (text.strip() or repr(error)).splitlines()[0][:300]


def read_footers(spark: SparkSession, files: Sequence[str], threads: int = 32) -> tuple[dict[str, Footer], dict[str, str]]:
    """Footers of the files that can be opened, and why the others cannot.

    ``files`` are URIs as Spark lists them. Only the last bytes of each file are read,
    by threads of the driver's JVM and through any store that Spark reads; no job runs.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    parquet = jvm.org.apache.parquet.hadoop

    def one(file: str) -> Footer | str:
        try:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
            reader = parquet.ParquetFileReader.open(parquet.util.HadoopInputFile.fromPath(path, conf))
            try:
                meta = reader.getFileMetaData()
                own = meta.getKeyValueMetaData().get(_SPARK_SCHEMA) or ""
                return Footer(f"{meta.getSchema().toString()}\n{own}", reader.getRecordCount())
            finally:
                reader.close()
        except Exception as error:  # whatever is wrong with one file, the others go on
            return reason(error)

    with ThreadPoolExecutor(threads) as pool:
        found = dict(zip(files, pool.map(one, files), strict=True))
    bad = {file: text for file, text in found.items() if isinstance(text, str)}
    return {file: footer for file, footer in found.items() if file not in bad}, bad


def file_facts(spark: SparkSession, files: Sequence[str]) -> tuple[dict[str, tuple[T.StructType, int]], dict[str, str]]:
    """Spark's schema and the rows of each file that can be opened, and why the others cannot: one Spark read for each different schema."""
    footers, bad = read_footers(spark, files)
    first: dict[str, str] = {}
    for file, footer in footers.items():
        first.setdefault(footer.kind, file)
    known: dict[str, T.StructType | str] = {}
    for kind, file in first.items():
        try:
            known[kind] = spark.read.parquet(unquoted(file)).schema
        except Exception as error:  # types that Spark does not know
            known[kind] = reason(error)
    bad |= {file: known[footer.kind] for file, footer in footers.items() if isinstance(known[footer.kind], str)}
    return {file: (known[footer.kind], footer.rows) for file, footer in footers.items() if file not in bad}, bad


def file_schemas(spark: SparkSession, files: Sequence[str]) -> tuple[dict[str, T.StructType], dict[str, str]]:
    """As :func:`file_facts`, without the rows."""
    found, bad = file_facts(spark, files)
    return {file: schema for file, (schema, _) in found.items()}, bad
