"""Exact rates and averages.

Sums and counts stay 64-bit integers while rows are read; only the aggregated
row is divided, as decimals, and rounded half away from zero. So a result does
not depend on the order in which partitions were added up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column, digits: int, factor: int = 1) -> Column:
    """``num * factor / den`` to ``digits`` places; NULL where ``den`` is 0 or NULL."""
    top = num.cast("decimal(20,0)") * F.lit(factor)
    bottom = F.nullif(den.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(top / bottom, digits).cast(f"decimal(18,{digits})")


def percent(num: Column, den: Column, digits: int = 2) -> Column:
    return ratio(num, den, digits, factor=100)


def quotient(num: Column, den: Column) -> Column:
    """Unrounded ``num / den``, for ranking on an average before it is rounded."""
    bottom = F.nullif(den.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return num.cast("decimal(20,0)") / bottom


def in_units(value: Column, scale: int) -> Column:
    """A number as a whole number of units of ``scale`` places, rounded to the nearest."""
    return F.round(value * F.lit(10**scale)).cast("bigint")


def mean(value: Column, digits: int, scale: int = 0, where: Column | None = None) -> Column:
    """Aggregate: average of a whole number, or of a number with ``scale`` places.

    A value with more places stops the job where ``scale`` is 0, rather than lose them. ``where`` restricts the rows averaged without dropping them from the group.
    """
    if scale:
        units = in_units(value, scale)
    else:
        fraction = F.raise_error(F.lit("an average of fractions needs a scale"))
        units = F.when(value.isNull() | (value == F.floor(value)), value.cast("bigint")).otherwise(fraction)
    if where is not None:
        units = F.when(where, units)
    return ratio(F.sum(units), F.count(units) * F.lit(10**scale), digits)


