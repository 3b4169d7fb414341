"""Age and age-group expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Age groups in display order with their exclusive upper bounds.
AGE_GROUPS = (("<18", 18), ("18-24", 25), ("25-34", 35), ("35-44", 45), ("45-54", 55), ("55+", None))


def age_years(date_of_birth: Column, as_of: Column) -> Column:
    """Whole 365-day years between birth and ``as_of``, cut towards zero."""
    return (F.date_diff(as_of, date_of_birth) / F.lit(365.0)).cast("int")


def age_group(age: Column) -> Column:
    label = F
    for name, upper in AGE_GROUPS:
        label = label.when(age < upper, name) if upper is not None else label.otherwise(name)
    return label
