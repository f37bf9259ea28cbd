"""Bronze to silver for one record table, as one lazy plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitaria import fixed_values as fv
from vitaria.functions import age_is_bad, coordinates, date_is_bad
from vitaria.operators import columns as ops
from vitaria.operators.codes import resolve_codes
from vitaria.operators.lineage import process_records
from vitaria.operators.partitions import add_region, missing_partitions
from vitaria.operators.quality import audit_diff, audit_known, audit_listed, missing_columns, quarantine
from vitaria.operators.years import filter_years
from vitaria.plans.faults import failing_parts
from vitaria.plans.specs import TableSpec
from vitaria.sinks.shared import files_in, remove_folders
from vitaria.sinks.tables import write_silver
from vitaria.sources.bronze import MONTHS, dataset_glob, dataset_parts, partition_grid, scan_datasets, scan_files, unite_drifted
from vitaria.sources.dictionary import CodeDictionary
from vitaria.sources.footers import as_uri, file_facts, read_footers, reason
from vitaria.sources.tables import SILVER_KEYS, silver_path


def apply_step(
    df: DataFrame, step: str, spec: TableSpec, dictionary: CodeDictionary | None = None
) -> DataFrame:
    """One named step of a table's chain."""
    rules = spec.rules
    match step:
        case "drop":
            return ops.drop_columns(df, rules.drop)
        case "recode":
            return ops.recode_columns(df, rules.recode)
        case "age":
            return ops.decode_ages(df, rules.age_columns)
        case "keep":
            return ops.keep_raw(df, rules.keep)
        case "icd":
            if dictionary is None:
                raise ValueError(f"{spec.system}.{spec.table} needs a code dictionary")
            return resolve_codes(df, rules.icd_columns, dictionary)
        case "dates":
            return ops.enforce_dates(df, rules.dates)
        case "years":
            if rules.year_column not in df.columns:
                raise ValueError(f"{spec.system}.{spec.table} has no column {rules.year_column} to filter on")
            return filter_years(df, rules.year_column, rules.years)
        case "rename":
            return ops.rename_columns(df, rules.rename, spec.on_collision)
    raise ValueError(f"unknown step {step!r}")


def apply_chain(df: DataFrame, spec: TableSpec, dictionary: CodeDictionary | None = None) -> DataFrame:
    """All steps of a table in their order; nothing runs until it is written."""
    for step in spec.steps:
        df = apply_step(df, step, spec, dictionary)
    return df


def chain_columns(
    df: DataFrame, spec: TableSpec, dictionary: CodeDictionary | None = None
) -> list[tuple[str, list[str], list[str]]]:
    """``(step, columns before, columns after)`` for every step of the chain."""
    history = []
    for step in spec.steps:
        after = apply_step(df, step, spec, dictionary)
        history.append((step, df.columns, after.columns))
        df = after
    return history


def chain_lineage(
    df: DataFrame,
    spec: TableSpec,
    owner: str,
    dictionary: CodeDictionary | None = None,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Process records of all steps for the datasets of a bronze frame (``names``, if they are known)."""
    if names is None:
        datasets = df.select("dataset").distinct()
    else:
        datasets = df.sparkSession.createDataFrame([(name,) for name in names], "dataset string")
    records: DataFrame | None = None
    for step, before, after in chain_columns(df, spec, dictionary):
        part = process_records(datasets, step, before, after, owner)
        records = part if records is None else records.unionAll(part)
    if records is None:
        raise ValueError(f"{spec.system}.{spec.table} has no steps")
    return records


def chain_quarantine(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Values of a bronze frame that its age and date steps cannot read."""
    return quarantine(df, _checks(df, spec), F.col("dataset"))


def _checks(df: DataFrame, spec: TableSpec) -> dict[str, Column]:
    checks = {c: age_is_bad(ops.named(c)) for c in spec.rules.age_columns if "age" in spec.steps}
    if "dates" in spec.steps:
        checks |= {c: date_is_bad(ops.named(c), pattern) for c, pattern in spec.rules.dates.items()}
    text = ops.text_columns(df)
    return {c: bad for c, bad in checks.items() if c in text}


def with_options(spec: TableSpec, keep: bool = False, dates: bool = False, icd: bool = False) -> TableSpec:
    """The same table with the steps that are only declared for it switched on."""
    steps = list(spec.steps)
    place = next((steps.index(step) for step in ("icd", "rename") if step in steps), len(steps))
    wanted = [("keep", keep), ("icd", icd and "icd" not in steps), ("dates", dates)]
    steps[place:place] = [step for step, on in wanted if on]
    return replace(spec, steps=tuple(steps))


COORDINATES = ("tabela", "uf", "ano", "mes", "segmento", "dataset")


@dataclass(frozen=True)
class Outcome:
    """Reports on a run, each computed when it is used.

    Audits before and after with every dataset's own columns, what changed
    between them, rule columns that datasets lack, values that could not be
    read (None where no step of the table reads values), files that could
    not be processed, with their dataset and why, requested coordinates without a dataset (None
    where datasets were named), and the lineage of every step.
    """

    before: DataFrame
    after: DataFrame
    changes: DataFrame
    missing: DataFrame
    quarantine: DataFrame | None
    failures: DataFrame
    absent: DataFrame | None = None
    lineage: DataFrame | None = None

    def store(self, folder: str) -> None:
        """Write each report as a table of its own in a folder."""
        for name, report in vars(self).items():
            if report is not None:
                report.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")


def run_table(
    spark: SparkSession,
    spec: TableSpec,
    bronze: str,
    silver: str,
    ufs: Sequence[str],
    years: Sequence[int | str],
    months: Sequence[int | str] = MONTHS,
    dictionary: CodeDictionary | None = None,
    **options,
) -> Outcome:
    """Run the chain over the requested datasets and overwrite their silver partitions."""
    glob = dataset_glob(bronze, spec.layout, ufs, years, months)
    outcome = run_datasets(spark, spec, [glob], silver, dictionary, **options)
    monthly = spec.layout.monthly
    grid = partition_grid(spark, ufs, years, months if monthly else None)
    keys = ["uf", "ano", "mes"] if monthly else ["uf", "ano"]
    names = outcome.before.select(F.col(f"`{fv.AUDIT_FILE}`").alias("name"))
    names = names.union(outcome.failures.select(F.col("dataset").alias("name"))).distinct()
    there = coordinates(F.substring_index("name", ".", 1), monthly, bool(spec.layout.segments))
    return replace(outcome, absent=missing_partitions(grid, names.select(*[there[k].alias(k) for k in keys]), keys))


@dataclass(frozen=True)
class _Group:
    """Files of equal columns and types, read and run together."""

    parts: tuple[tuple[str, str], ...]
    rows: DataFrame
    result: DataFrame
    unreadable: Observation | None

    @property
    def names(self) -> list[str]:
        """Datasets that have files here."""
        return sorted({name for _, name in self.parts})


def run_datasets(
    spark: SparkSession,
    spec: TableSpec,
    places: Sequence[str],
    silver: str,
    dictionary: CodeDictionary | None = None,
    rebalance: bool = False,
    owner: str = "",
    schema: T.StructType | None = None,
    **scan_options,
) -> Outcome:
    """As :func:`run_table`, for given dataset paths or globs.

    Files are grouped by their columns and types, each group goes through
    the chain by itself and the groups are united afterwards, so a code column
    that holds numbers in one file is recoded nowhere else than where it is
    text. A file that cannot be read is reported and the others go on, those of its dataset too; a
    dataset of which no file can be read keeps its silver partition. Silver partitions of datasets that kept no row are emptied. With
    ``schema`` no footer is read and all datasets are taken to have it.
    """
    found = dataset_parts(spark, *places, extension=spec.layout.extension)
    if not found:
        raise ValueError(f"no dataset matches {list(places)}")
    groups, failed, counts = _groups(spark, spec, found, dictionary, schema, scan_options)
    folders = _partition_folders(spark, spec, silver, sorted({name for group in groups for name in group.names}))
    before_files = {folder: files_in(spark, folder) for folder in folders.values()}
    groups, broken = _write(spark, spec, groups, silver, rebalance, dictionary, scan_options)
    failed |= broken
    done = sorted({name for group in groups for name in group.names})
    # what holds the files it held before got no row from this run
    stale = {folders[n] for n in done if before_files[folders[n]] and files_in(spark, folders[n]) == before_files[folders[n]]}
    remove_folders(spark, sorted(stale))
    failures = spark.createDataFrame([(*part, text) for part, text in sorted(failed.items())], "arquivo string, dataset string, erro string")
    if not groups:
        return _nothing_done(spark, failures)

    listed, ended = (_columns_of(groups, spec, which) for which in ("rows", "result"))
    if counts is None:  # no footer was read
        name = F.concat(F.col("dataset"), F.lit(f".{spec.layout.extension}"))
        before = audit_listed(listed, unite_drifted([g.rows for g in groups]), name)
    else:
        stayed: dict[str, int] = {}
        for file, dataset in (part for group in groups for part in group.parts):
            stayed[dataset] = stayed.get(dataset, 0) + counts[file]
        before = audit_known(spark, listed, {f"{n}.{spec.layout.extension}": rows for n, rows in stayed.items()})
    after = audit_known(spark, ended, {f"{n}.{spec.layout.extension}": rows for n, rows in _stored_rows(spark, folders, done).items()})
    used = [*spec.rules.age_columns, *spec.rules.icd_columns] if "icd" in spec.steps else []
    checked = [chain_quarantine(g.rows if _has_unreadable(g) else g.rows.limit(0), spec) for g in groups if _checks(g.rows, spec)]
    traced = [chain_lineage(g.rows, spec, owner, dictionary, g.names) for g in groups if spec.steps]
    summed = unite_drifted(checked).groupBy("dataset", "coluna", "valor").agg(F.sum("ocorrencias").alias("ocorrencias")) if checked else None
    return Outcome(
        before,
        after,
        audit_diff(before, after),
        missing_columns(before, used),
        summed,
        failures,
        lineage=unite_drifted(traced).distinct() if traced else None,
    )


def _nothing_done(spark: SparkSession, failures: DataFrame) -> Outcome:
    """Outcome of a run in which no file could be read."""
    none = spark.createDataFrame([], f"`{fv.AUDIT_FILE}` string, `{fv.AUDIT_ROWS}` long, `{fv.AUDIT_COLUMNS}` array<string>")
    return Outcome(none, none, audit_diff(none, none), missing_columns(none, []), None, failures)


def _has_unreadable(group: _Group) -> bool:
    """Whether the write met a value that a step cannot read; if it counted none, bronze need not be read for them again."""
    return group.unreadable is None or group.unreadable.get["rows"] > 0


def _stored_rows(spark: SparkSession, folders: dict[str, str], names: Sequence[str]) -> dict[str, int]:
    """Rows of datasets in their silver partitions, by the footers of the files there."""
    files = {f"{folders[name]}/{file}": name for name in names for file in files_in(spark, folders[name])}
    uris = {as_uri(spark, path): name for path, name in files.items()}
    footers, bad = read_footers(spark, list(uris))
    if bad:
        raise RuntimeError(f"{len(bad)} files just written cannot be read: {sorted(bad.items())[0]}")
    rows: dict[str, int] = {}
    for uri, footer in footers.items():
        rows[uris[uri]] = rows.get(uris[uri], 0) + footer.rows
    return rows


def _columns_of(groups: Sequence[_Group], spec: TableSpec, which: str) -> list[tuple[str, list[str]]]:
    """Columns of every dataset, those of all its files, without its coordinates."""
    found: dict[str, dict[str, None]] = {}
    for group in groups:
        own = [c for c in getattr(group, which).columns if c not in COORDINATES]
        for name in group.names:
            found.setdefault(name, {}).update(dict.fromkeys(own))
    return [(f"{name}.{spec.layout.extension}", list(own)) for name, own in sorted(found.items())]


def _groups(
    spark: SparkSession,
    spec: TableSpec,
    found: Sequence[tuple[str, str]],
    dictionary: CodeDictionary | None,
    schema: T.StructType | None,
    scan_options: dict,
) -> tuple[list[_Group], dict[tuple[str, str], str], dict[str, int] | None]:
    """Files by their columns and types, those that cannot be read or go through the chain with the reason, and the rows
    of each file, None where footers were not read."""
    counts = None
    if schema is not None or spec.layout.extension == "delta":
        schemas, failed = {file: schema for file, _ in found}, {}
    else:
        facts, bad = file_facts(spark, [file for file, _ in found])
        schemas = {file: own for file, (own, _) in facts.items()}
        counts = {file: rows for file, (_, rows) in facts.items()}
        failed = {(file, name): bad[file] for file, name in found if file in bad}
    members: dict[tuple, list[tuple[str, str]]] = {}
    for file, name in found:
        if file in schemas:
            kinds = schemas[file] and tuple((f.name, f.dataType.simpleString()) for f in schemas[file])
            members.setdefault(kinds, []).append((file, name))
    groups = []
    for own in members.values():
        try:
            groups.append(_group(spark, spec, own, schemas[own[0][0]], dictionary, scan_options))
        except (ValueError, AnalysisException) as error:
            failed |= dict.fromkeys(own, reason(error))
    return groups, failed, counts


def _group(
    spark: SparkSession,
    spec: TableSpec,
    parts: Sequence[tuple[str, str]],
    schema: T.StructType | None,
    dictionary: CodeDictionary | None,
    scan_options: dict,
) -> _Group:
    if schema is None or spec.layout.extension == "delta":
        rows = scan_datasets(spark, [place for place, _ in parts], spec.layout, **scan_options)
    else:
        branches = {k: v for k, v in scan_options.items() if k == "max_branches"}
        rows = scan_files(spark, parts, spec.layout, schema, **branches)
    steps, checked, unreadable = spec.steps, rows, None
    if steps[:1] == ("drop",):  # so that dropped columns are not read
        steps, checked = steps[1:], apply_step(rows, "drop", spec)
    checks = _checks(checked, spec)
    if checks and "years" not in steps:  # a year filter has to reach the files
        unreadable = Observation()
        checked = checked.observe(unreadable, F.count_if(reduce(or_, checks.values())).alias("rows"))
    return _Group(tuple(parts), rows, apply_chain(checked, replace(spec, steps=steps), dictionary), unreadable)


def _write(
    spark: SparkSession,
    spec: TableSpec,
    groups: list[_Group],
    silver: str,
    rebalance: bool,
    dictionary: CodeDictionary | None,
    scan_options: dict,
) -> tuple[list[_Group], dict[tuple[str, str], str]]:
    """Write all groups at once. If that fails, the files that cannot be read are found by testing
    groups of files and the others are written; an error that is not a file's is raised.

    Gives the groups written, and the files left out with the reason.
    """

    def without(bad: set, among: Sequence[tuple[str, str]] | None = None) -> list[_Group]:
        kept = []
        for group in groups:
            own = [p for p in group.parts if p not in bad and (among is None or p in among)]
            if own:
                shape = T.StructType([f for f in group.rows.schema if f.name not in COORDINATES])
                kept.append(_group(spark, spec, own, shape, dictionary, scan_options))
        return kept

    def test(parts: Sequence[tuple[str, str]]) -> Exception | None:
        try:
            unite_drifted([g.result for g in without(set(), set(parts))]).write.format("noop").mode("overwrite").save()
        except Exception as error:  # broken data pages show only when they are read
            return error
        return None

    def store(chosen: list[_Group]) -> None:
        write_silver(unite_drifted([g.result for g in chosen]), silver, spec.system, spec.table, rebalance=rebalance)

    if not groups:
        return [], {}
    try:
        store(groups)
        return groups, {}
    except Exception as error:
        bad = failing_parts([p for g in groups for p in g.parts], test)
        if not bad:
            raise error
    if left := without(set(bad)):
        store(left)
    return left, {part: reason(error) for part, error in bad.items()}


def _places(spark: SparkSession, spec: TableSpec, names: Sequence[str]) -> DataFrame:
    listed = spark.createDataFrame([(name,) for name in names], "dataset string")
    keys = coordinates(F.col("dataset"), spec.layout.monthly, bool(spec.layout.segments))
    return add_region(listed.select("dataset", *[value.alias(key) for key, value in keys.items()])).distinct()


def _partition_folders(spark: SparkSession, spec: TableSpec, silver: str, names: Sequence[str]) -> dict[str, str]:
    """Silver folder of each dataset's partition."""
    keys = [key for key in SILVER_KEYS if key in {"regiao", "uf", "ano", *(["mes"] if spec.layout.monthly else []), *(["segmento"] if spec.layout.segments else [])}]
    base = silver_path(silver, spec.system, spec.table)
    return {
        row.dataset: "/".join([base, *[f"{key}={row[key] or '__HIVE_DEFAULT_PARTITION__'}" for key in keys]])
        for row in _places(spark, spec, names).collect()
    }


def empty_partitions(spark: SparkSession, spec: TableSpec, silver: str, names: Sequence[str]) -> None:
    """Remove the silver partitions of datasets that are no more."""
    remove_folders(spark, sorted(set(_partition_folders(spark, spec, silver, names).values())))
