"""Aggregates a report reads.

``aggs`` maps result names to aggregate columns (``functions.measures`` has the
usual ones).  Every function is one partial and one final aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Grains that a calendar date can be cut to.
DATE_GRAINS = ("day", "week", "month", "quarter", "year")


def _named(aggs: Mapping[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in aggs.items()]


def measures(df: DataFrame, dims: Sequence[str | Column], aggs: Mapping[str, Column]) -> DataFrame:
    """Measures by dimensions."""
    return df.groupBy(*dims).agg(*_named(aggs))


def time_bucket(time_col: str | Column, grain: str) -> Column:
    """The date a time falls in, cut to ``grain``.

    Goes through the date, so times without zone are never read in the zone of
    the session.
    """
    if grain not in DATE_GRAINS:
        raise ValueError(f"grain must be one of {DATE_GRAINS}, not {grain!r}")
    time = F.col(time_col) if isinstance(time_col, str) else time_col
    date = time.cast("date")
    return date if grain == "day" else F.trunc(date, grain)


def time_series(
    df: DataFrame,
    time_col: str,
    grain: str,
    aggs: Mapping[str, Column],
    dims: Sequence[str | Column] = (),
) -> DataFrame:
    """Measures per day, week, month, quarter or year, in a column named after the grain."""
    return measures(df, [time_bucket(time_col, grain).alias(grain), *dims], aggs)


def headline(df: DataFrame, aggs: Mapping[str, Column]) -> DataFrame:
    """One row of totals."""
    return df.agg(*_named(aggs))


def top_n(
    df: DataFrame, dims: Sequence[str], measure: Mapping[str, Column], n: int
) -> DataFrame:
    """The ``n`` groups that are largest by the first measure, ties by ``dims``.

    Each partition keeps its own ``n`` best, so the full ranking is never sorted
    or gathered.
    """
    ranked_by = next(iter(measure))
    return (
        measures(df, dims, measure).orderBy(F.col(ranked_by).desc_nulls_last(), *dims).limit(n)
    )
