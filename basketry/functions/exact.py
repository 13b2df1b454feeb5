"""Ratios of exact integers, rounded half up, so that results do not depend on row order."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _div(left: Column, right: Column) -> Column:
    return F.call_function("div", left, right)


def half_up(numerator: Column, denominator: Column, scale: int) -> Column:
    """``numerator / denominator`` as a whole number of 10^-scale units; NULL over zero.

    Both sides are non-negative whole numbers, which is all the warehouse divides.
    """
    factor = F.lit(2 * 10**scale).cast("bigint")
    return F.when(denominator > 0, _div(numerator * factor + denominator, denominator * 2))


def ratio(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """Rounded quotient as a double."""
    return half_up(numerator, denominator, scale).cast("double") / F.lit(float(10**scale))


def percent(numerator: Column, denominator: Column) -> Column:
    """Rounded share in percent with two digits."""
    return ratio(numerator * 100, denominator, 2)


def decimal_ratio(numerator: Column, denominator: Column, precision: int, scale: int) -> Column:
    """Rounded quotient as a stored decimal."""
    units = half_up(numerator, denominator, scale).cast("decimal(18,0)")
    return (units / F.lit(10**scale).cast("decimal(9,0)")).cast(f"decimal({precision},{scale})")


def units(column: Column, scale: int) -> Column:
    """A stored decimal as its whole number of 10^-scale units."""
    return (column * F.lit(10**scale)).cast("bigint")


def share(part: Column, whole: Column) -> Column:
    """Unrounded percentage of two whole numbers; NULL over zero."""
    return F.when(whole > 0, F.lit(100.0) * part / whole)


def mean(total: Column, count: Column) -> Column:
    """Unrounded quotient of two whole numbers; NULL over zero."""
    return F.when(count > 0, total.cast("double") / count)
