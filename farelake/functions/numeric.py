"""Rounding, exact money sums and guarded division.

Money is summed as whole millionths, so a sum is the same in whatever order the rows arrive. A millionth count is split
in two parts that are summed as 64-bit integers, which costs a task no decimal arithmetic and cannot overflow below 1e11
rows; only the few results are widened to decimals. Amounts of a billion and more, NaN and infinities are no fares: they
are summed as doubles beside the others and added to the result, so that they neither fail a job nor get lost.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

#: From here on an amount is large, and is added as a double.
LARGE_AMOUNT = 1e9

_SPLIT_BITS = 24
_WHOLE = "decimal(31,0)"
_EXACT = "decimal(38,6)"


def round_to(value: Column, digits: int) -> Column:
    """Round half away from zero, by way of a decimal with twelve places.

    That is far more than any result shows, so a value is rounded once, and still absorbs the last-bit noise that a
    distributed float sum carries. What such a decimal cannot hold (NaN, infinities, 1e26 and above, where a double
    has no fraction any more) is returned as it is.
    """
    exact = F.round(value.try_cast("decimal(38,12)"), digits).cast("double")
    return F.coalesce(exact, value.cast("double"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives null for a zero divisor."""
    return F.try_divide(numerator, denominator)


def rows() -> Column:
    """The number of rows in a group."""
    return F.count(F.lit(1))


def _small(value: Column) -> Column:
    return F.abs(value) < LARGE_AMOUNT


def millionths(column: str) -> Column:
    """Aggregate: the sum of the amounts that are not large, in whole millionths (none: null)."""
    value = F.col(column)
    whole = F.floor(F.when(_small(value), value) * 1e6 + 0.5)
    upper = F.sum(F.shiftright(whole, _SPLIT_BITS)).cast(_WHOLE)
    lower = F.sum(whole.bitwiseAND(F.lit((1 << _SPLIT_BITS) - 1)))
    return (upper * F.lit(1 << _SPLIT_BITS) + lower).cast(_WHOLE)


def large_amounts(column: str) -> Column:
    """Aggregate: the sum of the large amounts, as a double (none: null)."""
    value = F.col(column)
    return F.sum(F.when(~_small(value), value.cast("double")))


def exact_amount(whole: Column, large: Column) -> Column:
    """A sum of money as a decimal, from its two parts; null for no amounts, and where it does not fit."""
    exact = (whole.cast(_WHOLE) * F.lit(Decimal("0.000001"))).cast(_EXACT)
    with_large = F.try_add(F.coalesce(exact, F.lit(0).cast(_EXACT)), large.try_cast(_EXACT)).cast(_EXACT)
    return F.when(large.isNull(), exact).otherwise(with_large)


def amount(whole: Column, large: Column) -> Column:
    """A sum of money as a double, unrounded; null for no amounts."""
    parts = F.coalesce(whole.cast("double"), F.lit(0.0)) / 1e6 + large
    return F.coalesce(exact_amount(whole, large).cast("double"), parts)


def rounded_amount(whole: Column, large: Column, digits: int = 2) -> Column:
    """A sum of money, rounded once; null for no amounts."""
    return F.coalesce(F.round(exact_amount(whole, large), digits).cast("double"), amount(whole, large))


def mean(column: str, digits: int) -> Column:
    return round_to(F.avg(column), digits)


def money_mean(column: str, digits: int = 2) -> Column:
    return round_to(ratio(amount(millionths(column), large_amounts(column)), F.count(column)), digits)


def total(column: str, digits: int = 2) -> Column:
    return rounded_amount(millionths(column), large_amounts(column), digits)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return round_to(ratio(part, whole) * 100.0, digits)
