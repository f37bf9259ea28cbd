"""Reading record tables: Parquet directories, silver tables, Delta."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitaria.functions.names import dataset_name
from vitaria.sources.footers import file_schemas, unquoted

SILVER_KEYS = ("regiao", "uf", "ano", "mes", "segmento")


def read_records(
    spark: SparkSession,
    *paths: str,
    schema: T.StructType | None = None,
    merge_schema: bool = True,
) -> DataFrame:
    """One DataFrame over files or dataset directories, walked recursively.

    Only ``*.parquet`` files count. Columns that some files lack come back as
    null. Giving ``schema`` spares Spark the reading of every footer, which is
    worth it on very many files.
    """
    reader = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("mergeSchema", str(merge_schema and schema is None).lower())
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*paths)


def dataset_schemas(spark: SparkSession, paths: Iterable[str]) -> dict[str, T.StructType]:
    """Schema of each dataset, from the footers of its files; no rows are read.

    Columns that only some files of a dataset have come after the others; one of different types in them is an error.
    """
    paths = list(paths)
    files = files_of(spark, paths)
    known, bad = file_schemas(spark, [file for own in files.values() for file in own])
    if bad:
        raise ValueError(f"{len(bad)} files cannot be read: {sorted(bad.items())[0]}")
    found = {}
    for path in paths:
        types: dict[str, T.StructField] = {}
        for field in (f for file in files[path] for f in known[file]):
            if types.setdefault(field.name, field).dataType != field.dataType:
                raise ValueError(f"{path}: column {field.name} is {types[field.name].dataType.simpleString()} and {field.dataType.simpleString()}")
        found[path] = T.StructType(list(types.values()))
    return found


def files_of(spark: SparkSession, paths: Iterable[str]) -> dict[str, list[str]]:
    """Files under each path, in one listing."""
    paths = list(paths)
    anything = T.StructType([T.StructField("_", T.StringType())])
    plain = {path: path.split(":", 1)[-1].lstrip("/") for path in paths}
    found: dict[str, list[str]] = {path: [] for path in paths}
    by_plain = {name: path for path, name in plain.items()}
    for file in read_records(spark, *paths, schema=anything).inputFiles():
        name = unquoted(file).split(":", 1)[-1].lstrip("/")
        while name and name not in by_plain:
            name = name.rpartition("/")[0]
        if name:
            found[by_plain[name]].append(file)
    return found


def read_mixed(spark: SparkSession, paths: Iterable[str], name: str | None = None) -> DataFrame:
    """Union of datasets whose columns or column types drifted apart, between datasets or between files of one.

    Files of equal schema are read together, so the number of branches is
    the number of different schemas. A column whose type differs between them
    becomes text; absent columns are null. ``name`` adds a column of that name
    with the dataset a row comes from.
    """
    files = [file for own in files_of(spark, paths).values() for file in own]
    schemas, bad = file_schemas(spark, files)
    if bad:
        raise ValueError(f"{len(bad)} files cannot be read: {sorted(bad.items())[0]}")
    groups: dict[tuple, list[str]] = {}
    known: dict[tuple, T.StructType] = {}
    types: dict[str, set[str]] = {}
    for file, schema in schemas.items():
        signature = tuple((f.name, f.dataType.simpleString()) for f in schema)
        groups.setdefault(signature, []).append(unquoted(file))
        known.setdefault(signature, schema)
        for column, kind in signature:
            types.setdefault(column, set()).add(kind)
    mixed = {column for column, kinds in types.items() if len(kinds) > 1}
    result: DataFrame | None = None
    for signature, members in groups.items():
        part = read_records(spark, *members, schema=known[signature])  # no footer is read again
        changes = {c: F.col(f"`{c}`").cast("string") for c, _ in signature if c in mixed}
        if name is not None:
            changes[name] = dataset_name(F.col("_metadata.file_path"))
        part = part.withColumns(changes)
        result = part if result is None else result.unionByName(part, allowMissingColumns=True)
    if result is None:
        raise ValueError("no dataset to read")
    return result


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in any store that Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def silver_path(base: str, system: str, table: str) -> str:
    """Place of one silver table."""
    return f"{base.rstrip('/')}/{system}/{table}"


def contract_place(path: str) -> str:
    """Where the contract of a silver table lies; Spark takes no folder of such a name for data."""
    return f"{path}/_contract"


def read_contract(spark: SparkSession, path: str) -> tuple[T.StructType, bool] | None:
    """Columns and types of the silver table at ``path``, and whether all its files have them; None if it has no contract."""
    if not path_exists(spark, contract_place(path)):
        return None
    held = json.loads(spark.read.text(contract_place(path), wholetext=True).first()[0])
    return T.StructType.fromJson(held["schema"]), held["ready"]


def read_silver(
    spark: SparkSession, base: str, system: str, table: str, schema: T.StructType | None = None
) -> DataFrame:
    """A silver table with its partition columns as text, so ``mes`` stays ``01``.

    Without ``schema`` the table's contract says its columns and types, and no footer is read.
    Tables without a contract have the columns of all their files merged.
    """
    path = silver_path(base, system, table)
    contract = None if schema is not None else read_contract(spark, path)
    if schema is not None:
        found = schema
    elif contract is not None:
        found = contract[0]
    else:
        found = spark.read.option("mergeSchema", "true").parquet(path).schema
    fields = [
        T.StructField(f.name, T.StringType() if f.name in SILVER_KEYS else f.dataType, True)
        for f in found
    ]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def delta_available(spark: SparkSession) -> bool:
    """Whether this session can read and write Delta tables."""
    try:
        spark.read.format("delta").load("/nonexistent-delta-table").schema
    except AnalysisException as error:
        return "DATA_SOURCE_NOT_FOUND" not in (error.getCondition() or str(error))
    except Exception as error:
        return "DATA_SOURCE_NOT_FOUND" not in str(error)
    return True


def require_delta(spark: SparkSession, path: str) -> None:
    """Refuse to go on without a Delta library."""
    if not delta_available(spark):
        raise RuntimeError(
            f"cannot read {path}: the session has no Delta library; "
            "add it, or pass raw_files=True to read all Parquet files of the directory"
        )


def read_delta(spark: SparkSession, path: str, raw_files: bool = False) -> DataFrame:
    """Current snapshot of a Delta table.

    ``raw_files=True`` reads every Parquet file of the directory instead,
    removed ones included, and needs no Delta library.
    """
    if raw_files:
        return read_records(spark, path)
    require_delta(spark, path)
    return spark.read.format("delta").load(path)
