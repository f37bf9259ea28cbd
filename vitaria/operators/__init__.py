from vitaria.operators.columns import (
    RenameCollision, column_list, decode_ages, drop_columns, enforce_dates, keep_raw, named,
    recode_by_table, recode_columns, rename_columns, select_columns,
)
from vitaria.operators.joins import BroadcastBound, fits, lookup_join
from vitaria.operators.years import add_year, filter_years, year_predicate

__all__ = [
    "BroadcastBound", "RenameCollision", "add_year", "column_list", "decode_ages", "drop_columns",
    "enforce_dates", "filter_years", "fits", "keep_raw", "lookup_join", "named", "recode_by_table",
    "recode_columns", "rename_columns", "select_columns", "year_predicate",
]
