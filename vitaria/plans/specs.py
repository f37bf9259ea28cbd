"""The record tables: where each lies, which steps it goes through."""

from __future__ import annotations

from dataclasses import dataclass

from vitaria import fixed_values as fv
from vitaria.rules import Rules
from vitaria.sources.bronze import BronzeLayout


@dataclass(frozen=True)
class TableSpec:
    """One record table.

    ``steps`` run in this order. ``on_collision`` is what to do when renaming
    would give two columns one name.
    """

    system: str
    layout: BronzeLayout
    rules: Rules
    steps: tuple[str, ...]
    on_collision: str = "error"

    @property
    def table(self) -> str:
        return self.layout.table


SIM_RULES = Rules(
    drop=fv.SIM_DROP,
    recode=fv.SIM_RECODE,
    rename=fv.SIM_RENAME,
    keep=fv.SIM_KEEP,
    icd_columns=fv.SIM_ICD_COLUMNS,
    age_columns=[fv.SIM_AGE_COLUMN],
)
SIA_RULES = Rules(
    drop=fv.SIA_DROP,
    recode=fv.SIA_RECODE,
    rename=fv.SIA_RENAME,
    dates={c: "yyyyMM" if c in ("AP_CMP", "AP_MVM") else "yyyyMMdd" for c in fv.SIA_DATES},
)


def _admission_rules(year_column: str) -> Rules:
    return Rules(
        drop=fv.SIH_DROP,
        recode=fv.SIH_RECODE,
        rename=fv.SIH_RENAME,
        dates={c: "yyyyMMdd" for c in fv.SIH_DATES},
        keep=fv.SIH_KEEP,
        icd_columns=fv.SIH_KEEP,
        year_column=year_column,
        years=fv.SIH_YEARS,
    )


SIM_STEPS = ("drop", "recode", "age", "icd", "rename")
SIA_STEPS = ("drop", "recode", "rename")
SIH_STEPS = ("drop", "years", "rename")


def _outpatient(table: str, segments: str = "") -> TableSpec:
    return TableSpec("SIA", BronzeLayout(table, f"sia-parquet/{table}", segments=segments), SIA_RULES, SIA_STEPS)


def _outpatient_delta(table: str) -> TableSpec:
    layout = BronzeLayout(table, "sia-delta", extension="delta")
    return TableSpec("SIA", layout, SIA_RULES, ("drop", "recode"))


def _admissions(table: str, year_column: str) -> TableSpec:
    # two source columns share one target name, so the later one gets a number
    return TableSpec(
        "SIH", BronzeLayout(table, f"sih-parquet/{table}"), _admission_rules(year_column), SIH_STEPS, "suffix"
    )


def _scan_only(table: str) -> TableSpec:
    return TableSpec("SIH", BronzeLayout(table, f"sih-parquet/{table}"), Rules(), ())


SPECS: dict[str, TableSpec] = {
    f"{spec.system}.{spec.table}": spec
    for spec in [
        TableSpec("SIM", BronzeLayout("DO", "sim-parquet", monthly=False), SIM_RULES, SIM_STEPS),
        *[_outpatient(table) for table in ("ACF", "AM", "AQ", "AR", "ATD", "BI", "PS")],
        _outpatient("PA", segments="[a-z]"),
        *[_outpatient_delta(table) for table in ("AN", "AP", "IMPBO", "PAM", "PAR", "PAS", "SAD")],
        _admissions("RD", "DT_INTER"),
        _admissions("SP", "SP_DTINTER"),
        *[_scan_only(table) for table in ("CH", "CM", "ER", "RJ")],
    ]
}
