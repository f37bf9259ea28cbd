from vitaria.functions.age import age_is_bad, decode_age
from vitaria.functions.dates import date_is_bad, parse_date, year_text
from vitaria.functions.names import coordinates, dataset_name, parse_dataset, region_of
from vitaria.functions.labels import lookup_or, recode, recode_all

__all__ = [
    "age_is_bad", "coordinates", "dataset_name", "date_is_bad", "decode_age",
    "lookup_or", "parse_dataset", "parse_date", "recode", "recode_all", "region_of", "year_text",
]
