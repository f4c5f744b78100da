"""Series without holes, with running and trailing measures.

A series is cut into blocks of consecutive places, so one long series is worked on by several tasks:
a running sum is the sum within the block and the sums of the blocks before it, of which there are few;
a trailing measure takes along the places before its block that it reaches back to.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratawell.functions.storage import unused_name
from stratawell.operators.reporting import time_bucket, time_series

#: The step from one bucket of a grain to the next.
STEPS = {
    "day": "INTERVAL 1 DAY",
    "week": "INTERVAL 7 DAY",
    "month": "INTERVAL 1 MONTH",
    "quarter": "INTERVAL 3 MONTH",
    "year": "INTERVAL 1 YEAR",
}
#: Places of a block.
BLOCK = 4096


def _named(columns: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in columns]


def _equal(left: Sequence[str], right: Sequence[str]) -> Column:
    pairs = [F.col(f"`{a}`").eqNullSafe(F.col(f"`{b}`")) for a, b in zip(left, right)]
    return reduce(lambda a, b: a & b, pairs, F.lit(True))


def filled_series(
    df: DataFrame,
    time_col: str,
    grain: str,
    aggs: Mapping[str, Column],
    dims: Sequence[str] = (),
    start: Any = None,
    end: Any = None,
    fill: Mapping[str, Any] | None = None,
) -> DataFrame:
    """A time series with a row for every day, week, month, quarter or year, and its place in ``nr``.

    For each combination of ``dims`` that occurs there are the buckets from ``start`` to ``end``, by
    default the first and the last of all; buckets without rows have the values of ``fill``, or NULL.
    ``nr`` counts buckets from 0.  Rows without a time have no place and are left out, as are those
    outside ``start`` and ``end``.  No rows give no rows.  ``df`` is read twice where a bound is missing.
    """
    dims = list(dims)
    if clash := {grain, "nr"} & {*dims, *aggs}:
        raise ValueError(f"{sorted(clash)} name the buckets of a series")
    bucket = time_bucket(time_col, grain)
    bounds = [F.lit(x).cast("date") if x is not None else None for x in (start, end)]
    if any(b is None for b in bounds):
        first, last = df.agg(F.min(bucket), F.max(bucket)).first()
        bounds = [b if b is not None else F.lit(x).cast("date") for b, x in zip(bounds, (first, last))]
    bounds = [time_bucket(b, grain) for b in bounds]
    inside = df.filter(bucket.between(*bounds))
    series = time_series(inside, time_col, grain, aggs, dims)
    places = F.posexplode(F.sequence(*bounds, F.expr(STEPS[grain]))).alias("nr", grain)
    if dims:
        theirs = {dim: unused_name([*series.columns, "nr"], f"_{dim}") for dim in dims}
        every = series.select(*_named(dims)).distinct().select("*", places)
        found = series.select(*[F.col(f"`{c}`").alias(theirs.get(c, c)) for c in series.columns])
    else:
        theirs = {}
        every = series.limit(1).select(places)
        found = series
    at = unused_name([*found.columns, "nr"], "_at")
    found = found.withColumnRenamed(grain, at)
    same = (F.col(grain) == F.col(at)) & _equal(dims, list(theirs.values()))
    joined = every.join(found, same, "left")
    values = [
        F.when(F.col(at).isNull(), F.lit((fill or {}).get(name))).otherwise(F.col(f"`{name}`")).alias(name)
        for name in aggs
    ]
    return joined.select("nr", grain, *_named(dims), *values)


def running(
    series: DataFrame,
    sums: Mapping[str, str],
    dims: Sequence[str] = (),
    place: str = "nr",
    block: int = BLOCK,
) -> DataFrame:
    """The series with running sums: ``sums`` maps new names to columns.

    Each is the sum of its column over all places up to a row's own; NULLs do not count.  Whole numbers
    and decimals are exact.  The rows of a series meet by blocks of places, and what is ordered over
    the whole of it has a row for each block.  The series is read twice, so pass a stored one.
    """
    dims = list(dims)
    taken = [*series.columns, *sums]
    nr = unused_name(taken, "_block")
    before = {name: unused_name(taken, f"_before_{name}") for name in sums}
    theirs = [unused_name(taken, f"_{c}") for c in [*dims, nr]]
    cut = series.withColumn(nr, F.floor(F.col(f"`{place}`") / block))
    inside = Window.partitionBy(*_named(dims), nr).orderBy(F.col(f"`{place}`"))
    inside = inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    own = {name: F.sum(F.col(f"`{column}`")).over(inside) for name, column in sums.items()}
    totals = cut.groupBy(*_named(dims), nr).agg(
        *[F.sum(F.col(f"`{column}`")).alias(before[name]) for name, column in sums.items()]
    )
    earlier = Window.partitionBy(*_named(dims)).orderBy(nr).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *[F.col(f"`{c}`").alias(t) for c, t in zip([*dims, nr], theirs)],
        *[F.sum(name).over(earlier).alias(name) for name in before.values()],
    )
    met = cut.withColumns(own).join(totals, _equal([*dims, nr], theirs), "left")

    def added(name: str) -> Column:
        mine, earlier_sum = F.col(f"`{name}`"), F.col(before[name])
        both = F.coalesce(mine, F.lit(0)) + F.coalesce(earlier_sum, F.lit(0))
        return F.when(mine.isNotNull() | earlier_sum.isNotNull(), both).alias(name)

    return met.select(*_named(series.columns), *[added(name) for name in sums])


def trailing(
    series: DataFrame,
    n: int,
    aggs: Mapping[str, Column],
    dims: Sequence[str] = (),
    place: str = "nr",
    block: int = BLOCK,
) -> DataFrame:
    """The series with aggregates over the last ``n`` places up to a row's own.

    Any aggregate will do.  A place that is missing has no part, so fill the series first.  A row goes to
    its own block and, as one that is only looked at, to those that reach back to it: of every
    ``block`` rows ``n`` - 1 are sent twice.
    """
    dims = list(dims)
    nr, seen = (unused_name([*series.columns, *aggs], name) for name in ("_block", "_seen"))
    at = F.col(f"`{place}`")
    mine, last = F.floor(at / block), F.floor((at + (n - 1)) / block)
    dealt = series.withColumn(nr, F.explode(F.sequence(mine, last))).withColumn(seen, F.col(nr) > mine)
    reach = Window.partitionBy(*_named(dims), nr).orderBy(at).rangeBetween(-(n - 1), Window.currentRow)
    figures = {name: column.over(reach) for name, column in aggs.items()}
    return dealt.withColumns(figures).filter(~F.col(seen)).drop(nr, seen)
