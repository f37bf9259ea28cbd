"""Bronze datasets addressed by table, state, year and month."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitaria import fixed_values as fv
from vitaria.functions.names import coordinates, dataset_name, parse_dataset
from vitaria.sources.footers import unquoted
from vitaria.sources.tables import read_records, require_delta

# Measured: a branch costs the driver about 0.1 s of planning, cutting the
# coordinates from the path costs about 1 microsecond per row.
MAX_BRANCHES = 32
# Each Delta table is a branch of its own in the plan.
MAX_DELTA_TABLES = 1_000
MONTHS = tuple(f"{month:02d}" for month in range(1, 13))


@dataclass(frozen=True)
class BronzeLayout:
    """Where the datasets of one table lie under the bronze base path.

    ``segments`` is a glob for the letter some tables put after the month;
    datasets without a letter match as well.
    """

    table: str
    folder: str
    monthly: bool = True
    segments: str = ""
    extension: str = "parquet"


def _any_of(values: Iterable[str]) -> str:
    return "{" + ",".join(values) + "}"


def dataset_glob(
    base: str,
    layout: BronzeLayout,
    ufs: Sequence[str],
    years: Sequence[int | str],
    months: Sequence[int | str] = MONTHS,
) -> str:
    """One glob for a whole state x year x month grid.

    A coordinate without a dataset simply matches nothing. Directories that
    Spark wrote by ``partitionBy("dataset")`` match too.
    """
    parts = [layout.table, _any_of(ufs)]
    if layout.monthly:
        parts.append(_any_of(str(year)[-2:] for year in years))
        parts.append(_any_of(f"{int(month):02d}" for month in months))
    else:
        parts.append(_any_of(str(year) for year in years))
    if layout.segments:
        parts.append(_any_of(["", layout.segments]))
    name = "".join(parts) + "." + layout.extension
    return f"{base.rstrip('/')}/{layout.folder.strip('/')}/{_any_of(['', 'dataset='])}{name}"


def scan_bronze(
    spark: SparkSession,
    base: str,
    layout: BronzeLayout,
    ufs: Sequence[str],
    years: Sequence[int | str],
    months: Sequence[int | str] = MONTHS,
    *,
    schema: T.StructType | None = None,
    merge_schema: bool = True,
    raw_delta_files: bool = False,
    max_branches: int = MAX_BRANCHES,
) -> DataFrame:
    """Rows of the requested datasets with ``tabela uf ano [mes] dataset`` added.

    Only directories of the grid are listed and read. Up to ``max_branches``
    datasets are read one by one and united, so that the coordinates are
    constants: they cost nothing per row, and a filter on them leaves whole
    datasets unread. Beyond that all are read together and the coordinates are
    cut from the file path of each row.
    """
    glob = dataset_glob(base, layout, ufs, years, months)
    return scan_datasets(
        spark, [glob], layout, schema=schema, merge_schema=merge_schema,
        raw_delta_files=raw_delta_files, max_branches=max_branches,
    )


def scan_datasets(
    spark: SparkSession,
    places: Sequence[str],
    layout: BronzeLayout,
    *,
    schema: T.StructType | None = None,
    merge_schema: bool = True,
    raw_delta_files: bool = False,
    max_branches: int = MAX_BRANCHES,
) -> DataFrame:
    """As :func:`scan_bronze`, for given dataset paths or globs of one table."""
    if layout.extension == "delta" and not raw_delta_files:
        found = dataset_files(spark, *places, extension="delta")
        if not found:
            raise ValueError(f"no dataset matches {list(places)}")
        if len(found) > MAX_DELTA_TABLES:
            raise ValueError(f"{len(found)} Delta tables at once; convert them to one partitioned table and filter that")
        require_delta(spark, found[0][0])
        parts = [_with_coordinates(spark.read.format("delta").load(place), layout, F.lit(name)) for place, name, _ in found]
        return _balanced_union(parts, by_name=True)
    rows = _or_none(lambda: read_records(spark, *places, schema=schema, merge_schema=merge_schema))
    if rows is None:
        raise ValueError(f"no dataset matches {list(places)}")
    found = _datasets(rows.inputFiles(), layout.extension)
    if len(found) > max_branches:
        return _with_coordinates(rows, layout, dataset_name(F.col("_metadata.file_path"), layout.extension))
    schema = rows.schema

    def branch(item: tuple[str, str, int]) -> DataFrame:
        place, name, _ = item
        return _with_coordinates(read_records(spark, place, schema=schema), layout, F.lit(name))

    with ThreadPoolExecutor(16) as pool:
        return _balanced_union(list(pool.map(branch, found)))


def dataset_parts(spark: SparkSession, *paths: str, extension: str = "parquet") -> list[tuple[str, str]]:
    """``(file, dataset)`` of all files under some paths, as Spark lists them; a Delta table counts as one file."""
    anything = T.StructType([T.StructField("_", T.StringType())])
    listed = _or_none(lambda: read_records(spark, *paths, schema=anything))
    files = [] if listed is None else [f for f in listed.inputFiles() if f".{extension}" in f]
    if extension == "delta":
        return [(place, name) for place, name, _ in _datasets(files, extension)]
    return sorted((file, _datasets([file], extension)[0][1]) for file in files)


def scan_files(
    spark: SparkSession,
    parts: Sequence[tuple[str, str]],
    layout: BronzeLayout,
    schema: T.StructType,
    max_branches: int = MAX_BRANCHES,
) -> DataFrame:
    """As :func:`scan_datasets`, for given files ``(file, dataset)`` of one schema."""
    by_name: dict[str, list[str]] = {}
    for file, name in parts:
        by_name.setdefault(name, []).append(unquoted(file))
    if len(by_name) > max_branches:
        rows = read_records(spark, *[file for own in by_name.values() for file in own], schema=schema)
        return _with_coordinates(rows, layout, dataset_name(F.col("_metadata.file_path"), layout.extension))
    with ThreadPoolExecutor(16) as pool:
        read = lambda item: _with_coordinates(read_records(spark, *item[1], schema=schema), layout, F.lit(item[0]))
        return _balanced_union(list(pool.map(read, sorted(by_name.items()))))


def _balanced_union(parts: list[DataFrame], by_name: bool = False) -> DataFrame:
    def both(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.unionByName(b, allowMissingColumns=True) if by_name else a.unionAll(b)

    # pairwise, so that the plan stays shallow
    while len(parts) > 1:
        parts = [reduce(both, parts[i : i + 2]) for i in range(0, len(parts), 2)]
    return parts[0]


def unite_drifted(parts: list[DataFrame]) -> DataFrame:
    """Union by name; a column whose type differs between the parts becomes text, absent ones are null."""
    kinds: dict[str, set[str]] = {}
    for part in parts:
        for field in part.schema:
            kinds.setdefault(field.name, set()).add(field.dataType.simpleString())
    mixed = {c for c, found in kinds.items() if len(found) > 1}
    text = [p.withColumns({c: F.col(f"`{c}`").cast("string") for c in p.columns if c in mixed}) for p in parts]
    return _balanced_union(text, by_name=True)


def _with_coordinates(rows: DataFrame, layout: BronzeLayout, name: Column) -> DataFrame:
    added = {"tabela": F.lit(layout.table), **coordinates(name, layout.monthly, bool(layout.segments)), "dataset": name}
    taken = [c for c in rows.columns if c.lower() in added]
    if taken:
        raise ValueError(f"columns {taken} of table {layout.table} hide its coordinates; rename them first")
    return rows.withColumns(added)


def _or_none(read: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return read()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            return None
        raise


def _datasets(files: Iterable[str], extension: str) -> list[tuple[str, str, int]]:
    ending = f".{extension}"
    local = re.compile("^file:/+")
    places = Counter(local.sub("file:/", unquote(path)).split(ending, 1)[0] for path in files if ending in path)
    return [(place + ending, place.rsplit("/", 1)[-1].rsplit("=", 1)[-1], n) for place, n in sorted(places.items())]


def dataset_files(spark: SparkSession, *paths: str, extension: str = "parquet") -> list[tuple[str, str, int]]:
    """``(place, dataset, number of files)`` of all datasets under some paths.

    Taken from Spark's file listing; no file is opened and no job runs over
    the data. A file in no ``X.parquet`` directory is a dataset of its own.
    """
    anything = T.StructType([T.StructField("_", T.StringType())])
    listed = _or_none(lambda: read_records(spark, *paths, schema=anything))
    return [] if listed is None else _datasets(listed.inputFiles(), extension)


def list_datasets(spark: SparkSession, root: str, extension: str = "parquet") -> DataFrame:
    """Datasets under a directory: path, name, number of files, coordinates."""
    found = dataset_files(spark, root, extension=extension)
    listed = spark.createDataFrame(found, "caminho string, dataset string, arquivos long")
    return listed.withColumns(parse_dataset(F.col("caminho")))


def partition_grid(
    spark: SparkSession,
    ufs: Sequence[str],
    years: Sequence[int | str],
    months: Sequence[int | str] | None = MONTHS,
) -> DataFrame:
    """Every requested coordinate: ``uf ano [mes]``, month padded to two digits."""

    def values(items: Iterable) -> Column:
        return F.explode(F.array(*[F.lit(str(item)) for item in items]))

    grid = spark.range(1).select(values(ufs).alias("uf")).select("uf", values(years).alias("ano"))
    if months is None:
        return grid
    return grid.select("uf", "ano", values(months).alias("mes")).withColumn("mes", F.lpad("mes", 2, "0"))


def region_states(spark: SparkSession, regions: Sequence[str] | None = None) -> DataFrame:
    """``regiao uf``, 27 rows at most."""
    rows = [(region, uf) for region in (regions or fv.REGIONS) for uf in fv.REGIONS[region]]
    return spark.createDataFrame(rows, "regiao string, uf string")
