"""Row-count and column audits, quarantine of bad values, missing columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaria import fixed_values as fv
from vitaria.operators.columns import named
from vitaria.sources.bronze import dataset_files
from vitaria.sources.tables import dataset_schemas


def _count_by_place(rows: DataFrame) -> DataFrame:
    """``(_place, n)``, rows per dataset path of a frame read from files.

    Counted by the raw file path first: names are cut once per file, not once
    per row, and only row counts are read.
    """
    per_file = rows.groupBy(F.col("_metadata.file_path").alias("_path")).agg(F.count("*").alias("n"))
    # file_path is percent-encoded, listed places are not
    decoded = F.url_decode(F.replace("_path", F.lit("+"), F.lit("%2B")))
    place = F.concat(F.substring_index(decoded, ".parquet", 1), F.lit(".parquet"))
    return per_file.groupBy(place.alias("_place")).agg(F.sum("n").alias("n"))


def _last_name(place: str) -> Column:
    return F.substring_index(F.substring_index(place, "/", -1), "=", -1)


def audit(
    df: DataFrame,
    dataset: Column | None = None,
    columns: Sequence[str] | None = None,
    stage: str | None = None,
) -> DataFrame:
    """Rows and column list per dataset of one DataFrame.

    ``Arquivo``, ``Número de Registros``, ``Colunas`` (an array) and, when
    given, the stage as ``etapa``. Without ``dataset`` the frame must come straight from
    files, and their places name the datasets.
    """
    if dataset is None:
        counts = _count_by_place(df).select(_last_name("_place").alias(fv.AUDIT_FILE), F.col("n").alias(fv.AUDIT_ROWS))
    else:
        counts = df.groupBy(dataset.alias(fv.AUDIT_FILE)).agg(F.count("*").alias(fv.AUDIT_ROWS))
    listed = F.array(*[F.lit(c) for c in (df.columns if columns is None else columns)]).cast("array<string>")
    report = counts.withColumn(fv.AUDIT_COLUMNS, listed)
    return report if stage is None else report.withColumn("etapa", F.lit(stage))


def audit_datasets(spark: SparkSession, root: str, stage: str | None = None) -> DataFrame:
    """Audit of every dataset under a directory, each with its own columns.

    Row counts and column names both come from Parquet footers. What passes
    through the driver is one schema per dataset.
    """
    paths = [place for place, _, _ in dataset_files(spark, root)]
    if not paths:
        raise ValueError(f"no dataset under {root}")
    schemas = dataset_schemas(spark, paths)
    listed = spark.createDataFrame(
        [(path, schema.names) for path, schema in schemas.items()],
        f"_place string, `{fv.AUDIT_COLUMNS}` array<string>",
    )
    rows = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .schema(schemas[paths[0]])
        .parquet(*paths)
    )
    report = listed.join(_count_by_place(rows), "_place", "left").select(
        _last_name("_place").alias(fv.AUDIT_FILE),
        F.coalesce("n", F.lit(0)).cast("long").alias(fv.AUDIT_ROWS),
        named(fv.AUDIT_COLUMNS),
    )
    return report if stage is None else report.withColumn("etapa", F.lit(stage))


def audit_listed(
    listed: Sequence[tuple[str, Sequence[str]]], rows: DataFrame, dataset: Column, stage: str | None = None
) -> DataFrame:
    """Audit of named datasets, each with its own columns, 0 rows where ``rows`` has none of it."""
    names = rows.sparkSession.createDataFrame(
        [(name, list(columns)) for name, columns in listed], f"`{fv.AUDIT_FILE}` string, `{fv.AUDIT_COLUMNS}` array<string>"
    )
    counts = rows.groupBy(dataset.alias(fv.AUDIT_FILE)).agg(F.count("*").alias("n"))
    report = names.join(counts, fv.AUDIT_FILE, "left").select(
        named(fv.AUDIT_FILE), F.coalesce("n", F.lit(0)).cast("long").alias(fv.AUDIT_ROWS), named(fv.AUDIT_COLUMNS)
    )
    return report if stage is None else report.withColumn("etapa", F.lit(stage))


def audit_known(
    spark: SparkSession, listed: Sequence[tuple[str, Sequence[str]]], rows: Mapping[str, int], stage: str | None = None
) -> DataFrame:
    """As :func:`audit_listed`, with row counts that are known already, 0 where ``rows`` lacks a dataset."""
    report = spark.createDataFrame(
        [(name, rows.get(name, 0), list(columns)) for name, columns in listed],
        f"`{fv.AUDIT_FILE}` string, `{fv.AUDIT_ROWS}` long, `{fv.AUDIT_COLUMNS}` array<string>",
    )
    return report if stage is None else report.withColumn("etapa", F.lit(stage))


def audit_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """What changed between two audits: rows lost, columns removed and added (arrays)."""

    def side(report: DataFrame, end: str) -> DataFrame:
        return report.select(
            named(fv.AUDIT_FILE),
            named(fv.AUDIT_ROWS).alias(f"registros_{end}"),
            named(fv.AUDIT_COLUMNS).alias(f"_{end}"),
        )

    def difference(a: str, b: str) -> Column:
        empty = F.array().cast("array<string>")
        return F.array_except(F.coalesce(a, empty), F.coalesce(b, empty))

    both = side(before, "antes").join(side(after, "depois"), fv.AUDIT_FILE, "full")
    lost = F.coalesce("registros_antes", F.lit(0)) - F.coalesce("registros_depois", F.lit(0))
    return both.select(
        named(fv.AUDIT_FILE),
        "registros_antes",
        "registros_depois",
        lost.alias("registros_perdidos"),
        difference("_antes", "_depois").alias("colunas_removidas"),
        difference("_depois", "_antes").alias("colunas_adicionadas"),
    )


def quarantine(df: DataFrame, checks: Mapping[str, Column], dataset: Column) -> DataFrame:
    """Bad values with their number of rows: ``dataset coluna valor ocorrencias``.

    ``checks`` says per column when its value is bad. All columns are checked
    in one scan, and rows without a bad value go no further.
    """
    present = {c: bad for c, bad in checks.items() if c in df.columns}
    if not present:
        raise ValueError(f"none of {list(checks)} is a column of the table")
    findings = F.array(
        *[
            F.when(bad, F.struct(F.lit(c).alias("coluna"), named(c).cast("string").alias("valor")))
            for c, bad in present.items()
        ]
    )
    return (
        df.where(reduce(lambda a, b: a | b, present.values()))
        .select(dataset.alias("dataset"), F.explode(findings).alias("f"))
        .where(F.col("f").isNotNull())
        .groupBy("dataset", "f.coluna", "f.valor")
        .agg(F.count("*").alias("ocorrencias"))
    )


def missing_columns(audits: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Expected columns that a dataset lacks: ``Arquivo coluna``."""
    wanted = F.array(*[F.lit(c) for c in expected]).cast("array<string>")
    absent = F.array_except(wanted, named(fv.AUDIT_COLUMNS))
    return audits.select(named(fv.AUDIT_FILE), F.explode(absent).alias("coluna"))
