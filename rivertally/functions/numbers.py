"""Numeric column expressions with the survey's rounding and missing-value rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_to(value: Column | str, digits: int) -> Column:
    """Half-up rounding on the decimal text of a double, so 1.005 gives 1.01."""
    return F.round(col(value).cast("double"), digits)


def total(value: Column | str, na_rm: bool = True) -> Column:
    """Sum of a group. A missing value is skipped, or makes the sum missing if not ``na_rm``.

    With ``na_rm`` a group without any value sums to 0.
    """
    value = col(value)
    summed = F.coalesce(F.sum(value), F.lit(0))
    if na_rm:
        return summed
    return F.when(F.count_if(value.isNull()) == 0, summed)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as a double; missing where the denominator is 0."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def hours(seconds: Column | str) -> Column:
    return col(seconds).cast("double") / F.lit(3600.0)


def area(length: str, width: str) -> Column:
    return F.col(length) * F.col(width)
