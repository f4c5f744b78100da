"""Aggregate columns for reports.

All of them combine on the map side, so a group holding most of the rows costs
no more to shuffle than any other.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def row_count() -> Column:
    return F.count(F.lit(1))


def distinct_count(value: str | Column) -> Column:
    return F.count_distinct(_col(value))


# Sums are kept in two halves, split at this many bits, for values of at most so many units.
_LOW_BITS = 20
_MOST_UNITS = 1 << 40
# Beyond this a value is added as a double.
_MOST_DECIMAL = 1e24


def exact_sum(value: str | Column, scale: int) -> Column:
    """Sum of money-like doubles that does not depend on the order of addition.

    Values are counted in whole units of 10**-scale (2: cents), to the nearest one.  Up to 2**40
    units a value is added in two integer sums, which stay in generated code and hold for 2**43
    rows.  Larger ones, up to 1e24, are added as decimals, which hold for 1e12 rows.  Infinite and
    still larger values, and values that are not a number, are added as doubles: the sum is then
    what such an addition gives.  NULLs do not count; the sum of none is NULL.
    """
    plain = _col(value).cast("double")
    units = F.rint(plain * 10**scale)
    small = F.abs(units) <= _MOST_UNITS  # NaN is larger than any number
    wide = ~small & (F.abs(plain) <= _MOST_DECIMAL)
    whole = F.when(small, units).cast("bigint")
    high = F.sum(F.shiftright(whole, _LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(whole.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).cast("decimal(20,0)")
    counted = high * F.lit(1 << _LOW_BITS).cast("decimal(7,0)") + low
    unit = F.lit(f"1e-{scale}").cast(f"decimal({scale + 1},{scale})")
    in_units = (counted * unit).cast(f"decimal(38,{scale})")
    in_decimals = F.sum(F.when(wide, plain).cast(f"decimal(38,{scale})"))
    none = F.lit(0).cast(f"decimal(38,{scale})")
    exact = F.when(
        in_units.isNotNull() | in_decimals.isNotNull(),
        F.coalesce(in_units, none) + F.coalesce(in_decimals, none),
    ).cast("double")
    rest = F.sum(F.when(~small & ~wide, plain))
    return F.when(rest.isNull(), exact).otherwise(rest + F.coalesce(exact, F.lit(0.0)))


def exact_avg(value: str | Column, scale: int) -> Column:
    """Mean as exact sum over the number of values that are not NULL; NULL of none."""
    n = F.count(_col(value))
    return F.when(n > 0, exact_sum(value, scale) / n)
