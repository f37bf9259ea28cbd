"""Catalog tables: file metadata, process records and lineage edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaria import fixed_values as fv
from vitaria.operators.columns import named


def file_metadata(
    datasets: DataFrame,
    filename: str = "filename",
    name_suffix: str = "",
    owner: str = "",
    description: str = "",
    namespace: str = "bronze",
) -> DataFrame:
    """One catalog record per dataset file name."""
    files = datasets.select(named(filename).alias("filename")).distinct()
    base = F.substring_index("filename", ".", 1)
    return files.select(
        F.concat(base, F.lit(f"@{namespace}")).alias("qualifiedName"),
        F.concat(base, F.lit(name_suffix)).alias("name"),
        F.lit(description).alias("description"),
        F.lit(owner).alias("owner"),
        "filename",
    )


def process_records(
    datasets: DataFrame,
    step: str,
    columns_before: Sequence[str],
    columns_after: Sequence[str],
    owner: str,
    dataset: str = "dataset",
    inputs: Column | None = None,
    outputs: Column | None = None,
    system: str = "vitaria",
) -> DataFrame:
    """One record per dataset for one step, with the columns it added and deleted.

    ``system`` names the processing system in the record's identifier.
    """
    base = named(dataset)

    def filled(pattern: str) -> Column:
        before, after = pattern.format(step=step, dataset="\0").split("\0")
        return F.concat(F.lit(before), base, F.lit(after))

    def listed(names: Sequence[str]) -> Column:
        return F.array(*[F.lit(n) for n in names]).cast("array<string>")

    added = [c for c in columns_after if c not in set(columns_before)]
    deleted = [c for c in columns_before if c not in set(columns_after)]
    return datasets.select(base).distinct().select(
        F.concat(F.lit(f"process.{step}.{system}@"), base).alias("qualifiedName"),
        filled(fv.PROCESS_NAME).alias("name"),
        F.lit(owner).alias("owner"),
        F.lit(fv.PROCESS_DESCRIPTION.format(step=step)).alias("description"),
        listed(added).alias("added_columns"),
        listed(deleted).alias("deleted_columns"),
        F.array(base if inputs is None else inputs).alias("inputs"),
        F.array(base if outputs is None else outputs).alias("outputs"),
    )


def lineage_edges(pairs: DataFrame, kind: str, origin: str = "origem", target: str = "destino") -> DataFrame:
    """Edges ``typeName end1 end2`` from pairs of catalog identifiers."""
    return pairs.select(
        F.lit(kind).alias("typeName"), named(origin).alias("end1"), named(target).alias("end2")
    ).distinct()
