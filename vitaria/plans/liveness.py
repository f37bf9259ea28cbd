"""Rules that can never apply, because an earlier step takes their column away or changes its type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaria.operators.columns import named
from vitaria.plans.specs import TableSpec


def step_columns(spec: TableSpec) -> dict[str, list[str]]:
    """Columns that the rules of each step name."""
    rules = spec.rules
    return {
        "drop": list(rules.drop),
        "recode": list(rules.recode),
        "age": list(rules.age_columns),
        "keep": list(rules.keep),
        "icd": list(rules.icd_columns),
        "dates": list(rules.dates),
        "years": [rules.year_column] if rules.year_column else [],
        "rename": list(rules.rename),
    }


def dead_rules(spec: TableSpec) -> list[tuple[str, str, str]]:
    """``(step, column, reason)`` of the rules that no input can bring to apply.

    The steps are followed in order. A column is gone after it is dropped, and after it is renamed unless
    another takes its name; what a step makes anew (``<column>_keep``, new names) is there again. Codes are recoded and
    ages decoded only in text, so not in what has become a date. Rules of a step that the table does not run are told as that.
    """
    gone: dict[str, str] = {}
    dates: set[str] = set()
    found = []
    columns_of = step_columns(spec)
    for step in spec.steps:
        for column in columns_of[step]:
            if column in gone:
                found.append((step, column, f"{gone[column]} removes it first"))
            elif step in ("recode", "age") and column in dates:
                found.append((step, column, "dates makes it a date first"))
        live = [c for c in columns_of[step] if c not in gone]
        if step == "drop":
            gone |= dict.fromkeys(live, "drop")
        elif step == "keep":
            for column in live:
                gone.pop(f"{column}_keep", None)
        elif step == "dates":
            dates |= set(live)
        elif step == "rename":
            made = {spec.rules.rename[c] for c in live}
            gone |= {c: "rename" for c in live if c not in made}
            for name in made:
                gone.pop(name, None)
    for step, columns in columns_of.items():
        if step not in spec.steps:
            found += [(step, column, "the table does not run this step") for column in columns]
    return found


def dead_rules_report(spark: SparkSession, tables: Sequence[tuple[TableSpec, DataFrame]]) -> DataFrame:
    """``sistema tabela etapa coluna motivo valores`` of all rules that can never apply.

    ``tables`` has bronze rows of each record table; ``valores`` counts the values that such a rule
    leaves untouched, 0 where the column is not there. Each frame is read once, only its columns that dead rules name; tables
    that share a frame share the pass.
    """
    rules = [(spec, id(frame), dead_rules(spec)) for spec, frame in tables]
    counted: dict[int, dict[str, int]] = {}
    for key, frame in {id(frame): frame for _, frame in tables}.items():
        due = sorted({c for _, of, own in rules if of == key for _, c, _ in own} & set(frame.columns))
        if due:
            counts = frame.agg(*[F.count(named(c)).alias(f"n{i}") for i, c in enumerate(due)]).first()
            counted[key] = dict(zip(due, counts, strict=True))
    found = [
        (spec.system, spec.table, step, column, why, counted.get(of, {}).get(column, 0))
        for spec, of, own in rules for step, column, why in own
    ]
    return spark.createDataFrame(found, "sistema string, tabela string, etapa string, coluna string, motivo string, valores long")
