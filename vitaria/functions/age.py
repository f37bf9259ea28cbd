"""Age code: one digit for the unit, the rest for the quantity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitaria import fixed_values as fv


def age_quantity(code: Column) -> Column:
    """Number after the unit digit; null where the code has no number or no unit."""
    return F.when(F.substring(code, 1, 1).between("0", "9"), F.substr(code, F.lit(2)).try_cast("bigint"))


def age_text(code: Column, quantity: Column) -> Column:
    """Readable age from a code and its quantity."""
    unit = F.substring(code, 1, 1)
    text = F.when(quantity.isNull(), F.lit(None).cast("string"))
    text = text.when((quantity == 0) & (unit == "0"), fv.AGE_UNKNOWN)
    text = text.when((quantity == 0) & (unit == "4"), fv.AGE_UNDER_ONE)
    for digit, name in enumerate(fv.AGE_UNITS):
        number = F.try_add(quantity, F.lit(100)) if digit == 5 else quantity
        text = text.when(unit == str(digit), F.concat(number.cast("string"), F.lit(f" {name}")))
    return text.otherwise(fv.AGE_INVALID)


def decode_age(code: Column) -> Column:
    """Readable age, e.g. ``402`` -> ``2 anos``; null where the code has no number.

    A code that does not parse gives null for its own row only; list such
    values with :func:`vitaria.operators.quality.quarantine` and
    :func:`age_is_bad`.
    """
    return age_text(code, age_quantity(code))


def age_is_bad(code: Column) -> Column:
    """True for a code that is present but cannot be decoded."""
    return code.isNotNull() & age_quantity(code).isNull()
