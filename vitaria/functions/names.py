"""What the name of a dataset says: table, state, year, month.

``AMSP2201.parquet`` is table AM, state SP, year 22, month 01;
``PASP2101a.parquet`` carries a segment letter; ``DOPE2020.parquet`` is yearly
with a four-digit year. The state is always the last two letters before the
digits, because table codes differ in length and some equal a state.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitaria import fixed_values as fv

_MONTHLY = r"(?:^|[/=])([A-Z]+)([A-Z]{2})(\d{2})(\d{2})([a-z]?)(?:\.(?:parquet|delta))?(?:/|$)"
_YEARLY = r"(?:^|[/=])(DO)([A-Z]{2})(\d{4})(?:\.(?:parquet|delta))?(?:/|$)"
# two-digit years from here on belong to the 1900s
_CENTURY_TURN = "70"


def full_year(two_digits: Column) -> Column:
    """Four-digit year of a two-digit one."""
    return F.concat(
        F.when(two_digits >= _CENTURY_TURN, F.lit("19")).otherwise(F.lit("20")), two_digits
    )


def dataset_name(path: Column, extension: str = "parquet") -> Column:
    """Dataset of a file path: the first ``X.parquet`` in it, file or directory."""
    before = F.substring_index(path, f".{extension}", 1)
    return F.substring_index(F.substring_index(before, "/", -1), "=", -1)


def coordinates(name: Column, monthly: bool, segments: bool = False) -> dict[str, Column]:
    """State, year and month of a dataset name whose table is already known.

    Fixed positions from the end of the name: cheaper than a pattern match
    where it runs for every row. Tables with segments also get ``segmento``,
    ``0`` for a dataset without a letter.
    """
    core = name
    found = {}
    if segments:
        last = F.right(name, F.lit(1))
        has_letter = last.between("a", "z")
        core = F.when(has_letter, F.substr(name, F.lit(1), F.length(name) - 1)).otherwise(name)
        found = {"segmento": F.when(has_letter, last).otherwise("0")}
    uf = F.substring(core, -6, 2)
    if not monthly:
        return {"uf": uf, "ano": F.substring(core, -4, 4)} | found
    return {"uf": uf, "ano": full_year(F.substring(core, -4, 2)), "mes": F.substring(core, -2, 2)} | found


def region_of(uf: Column) -> Column:
    """Region of a state, null for an unknown one."""
    regions = iter(fv.REGIONS.items())
    region, states = next(regions)
    chain = F.when(uf.isin(states), region)
    for region, states in regions:
        chain = chain.when(uf.isin(states), region)
    return chain


def parse_dataset(path: Column) -> dict[str, Column]:
    """``tabela uf ano mes segmento`` of a dataset name or of a path holding one.

    Fields are null when the name does not follow the scheme; ``mes`` is null
    and ``segmento`` empty for yearly datasets.
    """
    yearly = F.regexp_like(path, F.lit(_YEARLY))

    def part(year_group: int | None, month_group: int) -> Column:
        monthly = F.regexp_extract(path, _MONTHLY, month_group)
        if year_group is None:
            return F.when(~yearly, monthly)
        return F.when(yearly, F.regexp_extract(path, _YEARLY, year_group)).otherwise(monthly)

    known = yearly | F.regexp_like(path, F.lit(_MONTHLY))
    year = F.when(yearly, F.regexp_extract(path, _YEARLY, 3)).otherwise(
        full_year(F.regexp_extract(path, _MONTHLY, 3))
    )
    return {
        "tabela": F.when(known, part(1, 1)),
        "uf": F.when(known, part(2, 2)),
        "ano": F.when(known, year),
        "mes": F.when(known, part(None, 4)),
        "segmento": F.when(known, F.when(yearly, F.lit("")).otherwise(F.regexp_extract(path, _MONTHLY, 5))),
    }
