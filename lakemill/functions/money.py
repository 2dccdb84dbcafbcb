"""Money stays decimal inside a job and turns into a double once, in the last projection."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"


def money(value: Column) -> Column:
    """Any numeric or numeric-text column as exact money."""
    return value.cast(MONEY)


def as_double(value: Column) -> Column:
    return value.cast("double")


def percent_text(part: Column, whole: Column) -> Column:
    """``12.3%`` with one decimal; ``0.0%`` when there is nothing to divide by."""
    rate = F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
    return F.format_string("%.1f%%", rate * 100)
