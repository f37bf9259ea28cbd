"""Rule files in their several shapes, brought to one canonical form."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Rules:
    """What one record system does to its columns.

    ``dates`` maps a column to its date pattern, ``keep`` lists the code columns
    whose raw value stays beside the description as ``<column>_keep``.
    """

    drop: Sequence[str] = ()
    recode: Mapping[str, Mapping[str, str | None]] = field(default_factory=dict)
    rename: Mapping[str, str] = field(default_factory=dict)
    dates: Mapping[str, str] = field(default_factory=dict)
    keep: Sequence[str] = ()
    icd_columns: Sequence[str] = ()
    age_columns: Sequence[str] = ()
    year_column: str | None = None
    years: Sequence[str] = ()


def read_json(spark: SparkSession, path: str):
    """Content of one rule file, from any file system Spark can read."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def drop_list(data, entries: str = "all") -> list[str]:
    """Columns to drop from a flat list or from ``[{"id", "to_drop"}]``.

    ``entries="first"`` takes only the first entry; ``"all"`` takes every id,
    the last one winning when an id repeats.
    """
    if entries not in ("all", "first"):
        raise ValueError(f"entries must be 'all' or 'first', not {entries!r}")
    if all(isinstance(item, str) for item in data):
        return list(dict.fromkeys(data))
    if entries == "first":
        return list(dict.fromkeys(data[0]["to_drop"]))
    by_id = {item["id"]: item["to_drop"] for item in data}
    return list(dict.fromkeys(name for names in by_id.values() for name in names))


def recode_table(data, strict: bool = False) -> dict[str, dict[str, str | None]]:
    """Recode rules from ``{col: {code: label}}`` or from the list form.

    The list form pairs ``to_replace`` with ``value``; unequal lengths are cut
    to the shorter list, or refused when ``strict``. Several rules for one
    column take effect one after the other.
    """
    if isinstance(data, Mapping):
        return {column: dict(labels) for column, labels in data.items()}
    table: dict[str, dict[str, str | None]] = {}
    for rule in data:
        codes, labels = rule["to_replace"], rule["value"]
        if strict and len(codes) != len(labels):
            raise ValueError(
                f"rule for {rule['column_name']!r}: {len(codes)} codes but {len(labels)} labels"
            )
        step = dict(zip(codes, labels))
        earlier = table.get(rule["column_name"], {})
        merged = {code: step.get(label, label) for code, label in earlier.items()}
        merged.update({code: label for code, label in step.items() if code not in earlier})
        table[rule["column_name"]] = merged
    return table


def dictionary_entries(items: Iterable[Mapping]) -> list[tuple[int, str, str | None]]:
    """``(ord, code, description)`` of a code dictionary in file order.

    A repeated code keeps the place of its first entry and the description of
    its last one.
    """
    merged: dict[str, str | None] = {}
    for item in items:
        merged[item["code"]] = item["description"]
    return [(position, code, text) for position, (code, text) in enumerate(merged.items())]


def load_rules(
    spark: SparkSession,
    start: Rules = Rules(),
    *,
    drop: str | None = None,
    drop_entries: str = "first",
    recode: str | None = None,
    strict_recode: bool = False,
    rename: str | None = None,
    dates: str | None = None,
    date_pattern: str = "yyyyMMdd",
) -> Rules:
    """``start`` with the parts for which a rule file is given replaced by it."""
    found = {}
    if drop is not None:
        found["drop"] = drop_list(read_json(spark, drop), drop_entries)
    if recode is not None:
        found["recode"] = recode_table(read_json(spark, recode), strict_recode)
    if rename is not None:
        names = read_json(spark, rename)
        if not isinstance(names, dict) or not all(isinstance(new, str) for new in names.values()):
            raise ValueError(f"{rename}: a map of old to new column names expected")
        found["rename"] = names
    if dates is not None:
        found["dates"] = {column: date_pattern for column in drop_list(read_json(spark, dates))}
    return replace(start, **found)
