"""Numeric column builders that stay safe when ANSI mode is on."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_number(value: Column | str) -> Column:
    """Double; unreadable text, NaN and infinities become null."""
    number = as_column(value).try_cast("double")
    # NaN sorts above infinity, so one comparison covers all three.
    return F.when(F.abs(number) < F.lit(math.inf), number)


def round_half_up(value: Column | str, digits: int) -> Column:
    """Round through a decimal, so the result does not depend on summation noise.

    A double from 2^53 on is a whole number and passes unchanged, as do NaN and
    infinities; every smaller one fits the decimal.
    """
    number = as_column(value)
    rounded = F.round(number.cast("decimal(30,10)"), digits).cast("double")
    return F.when(F.abs(number) < F.lit(2.0**53), rounded).otherwise(number)


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient, null where the denominator is zero."""
    return as_column(numerator) / F.nullif(as_column(denominator), F.lit(0.0))


def within(value: Column | str, low: float, high: float) -> Column:
    """The value if low <= value <= high, else null (not clipped)."""
    value = as_column(value)
    return F.when(value.between(low, high), value)


def not_negative(value: Column | str) -> Column:
    value = as_column(value)
    return F.when(value >= 0, value)


def positive(value: Column | str) -> Column:
    value = as_column(value)
    return F.when(value > 0, value)


def exact_sum(value: Column | str) -> Column:
    """Sum of a rounded measure that is the same for every order of the rows.

    A sum of doubles changes in its last digit with the order in which partial
    sums arrive; a decimal sum does not, so a retried task cannot change it.
    """
    return F.sum(as_column(value).cast("decimal(28,6)")).cast("double")


def exact_mean(value: Column | str) -> Column:
    return exact_sum(value) / F.nullif(F.count(as_column(value)), F.lit(0))


def correlation(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation over pairs; null (not an error) when a side is constant."""
    x, y = as_column(x), as_column(y)
    paired = x.isNotNull() & y.isNotNull()
    x, y = F.when(paired, x), F.when(paired, y)
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))


def sum_where(condition: Column, value: Column | str) -> Column:
    """Sum over matching rows; null when no row matches."""
    return F.sum(F.when(condition, as_column(value)))
