"""The contract of a silver table: one type for each column, over all runs.

It lies beside the partitions, as the schema's JSON text. A run whose column is of another type widens the
contract: whole numbers to longer ones, a float to a double, anything else to text. Only
partitions that hold the narrower type are rewritten.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitaria.sinks.shared import keep_table
from vitaria.sources.footers import file_schemas, unquoted
from vitaria.sources.tables import SILVER_KEYS, contract_place, path_exists, read_contract, read_records

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrower type that holds the values of both, text if there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    if {type(a), type(b)} == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    return T.StringType()


def common_schema(a: T.StructType, b: T.StructType) -> T.StructType:
    """All columns of both, each of the type that holds both."""
    types = {f.name: f.dataType for f in a}
    for f in b:
        types[f.name] = common_type(types[f.name], f.dataType) if f.name in types else f.dataType
    return T.StructType([T.StructField(name, kind, True) for name, kind in types.items()])


def as_contracted(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The frame's columns, of the contract's types."""
    types = {f.name: f.dataType for f in contract}
    return df.withColumns({f.name: F.col(f"`{f.name}`").cast(types[f.name]) for f in df.schema if types.get(f.name, f.dataType) != f.dataType})


def _store(spark: SparkSession, path: str, schema: T.StructType, ready: bool) -> None:
    text = json.dumps({"ready": ready, "schema": json.loads(schema.json())})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(contract_place(path))


def _files(spark: SparkSession, path: str) -> list[str]:
    anything = T.StructType([T.StructField("_", T.StringType())])
    return read_records(spark, path, schema=anything).inputFiles() if path_exists(spark, path) else []


def _widen_partitions(spark: SparkSession, path: str, contract: T.StructType) -> None:
    """Rewrite the partitions that hold a file whose types are not the contract's."""
    wanted = {f.name: f.dataType for f in contract}
    found, _ = file_schemas(spark, files := _files(spark, path))
    folder = lambda file: file.rsplit("/", 1)[0]
    narrow = {folder(file) for file, schema in found.items() if any(wanted.get(f.name, f.dataType) != f.dataType for f in schema)}
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for file in files:
        if folder(file) in narrow and file in found:
            groups.setdefault(found[file].json(), (found[file], []))[1].append(file)
    if not groups:
        return
    keys = [part.split("=", 1)[0] for part in next(iter(narrow)).split("/") if "=" in part and part.split("=", 1)[0] in SILVER_KEYS]
    rows = None
    for schema, own in groups.values():
        typed = T.StructType([*schema, *[T.StructField(key, T.StringType()) for key in keys]])
        part = spark.read.schema(typed).option("basePath", path).parquet(*map(unquoted, own))
        part = as_contracted(part, contract)
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    kept = keep_table(rows, "widened")  # read from the very folders that are overwritten
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def keep_contract(spark: SparkSession, path: str, schema: T.StructType) -> T.StructType:
    """The contract of the table at ``path`` after rows of ``schema`` come to it; stored, and older partitions brought to it.

    A table without a contract gets that of its files. A run that fails while partitions are rewritten leaves the
    contract marked, and the next one rewrites what is left.
    """
    held = read_contract(spark, path)
    if held is None:
        old = T.StructType([])
        for found in {s.json(): s for s in file_schemas(spark, _files(spark, path))[0].values()}.values():
            old = common_schema(old, found)
    else:
        old = held[0]
    contract = common_schema(old, schema)
    types = {f.name: f.dataType for f in contract}
    changed = any(types[f.name] != f.dataType for f in old)
    if changed or (held is not None and not held[1]) or (held is None and len(old)):
        _store(spark, path, contract, ready=False)
        _widen_partitions(spark, path, contract)
        _store(spark, path, contract, ready=True)
    elif held is None or contract != old:
        _store(spark, path, contract, ready=True)
    return contract
