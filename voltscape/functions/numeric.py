"""Arithmetic with the warehouse's NULL and rounding rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """NULL instead of an error when the denominator is 0 or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def round_half_up(value: Column, digits: int = 2) -> Column:
    """Round half away from zero.

    The decimal cast drops the noise that summing doubles in a different task order
    leaves in the last bits, so the result does not depend on the partitioning.
    """
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def round_half_even(value: Column, digits: int = 2) -> Column:
    return F.bround(value.cast("decimal(38,10)"), digits).cast("double")


def row_sum(columns: list[Column]) -> Column:
    """Horizontal sum that skips NULLs; 0 for no columns or all NULL."""
    return reduce(lambda a, b: a + b, (F.coalesce(c, F.lit(0)) for c in columns), F.lit(0))


def flag(condition: Column) -> Column:
    """1 where the condition is true, 0 where it is false or NULL."""
    return F.when(condition, 1).otherwise(0)
