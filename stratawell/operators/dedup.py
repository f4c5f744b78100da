"""One row per key, batch form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratawell.functions.hashing import has_map
from stratawell.functions.storage import unused_name


def tie_order(df: DataFrame, ties: Sequence[str]) -> list[Column]:
    """Columns to sort by; maps, which have no order, and what holds them sort by their JSON text."""
    return [
        F.to_json(F.struct(F.col(f"`{c}`"))) if has_map(df.schema[c].dataType) else F.col(f"`{c}`")
        for c in ties
    ]


def dedup(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the first row of each key under ``order``.

    Rows equal under ``order`` are told apart by ``ties``, by default all other
    columns, so that the kept row does not depend on how the input is
    partitioned.  NULL keys form one group.

    Spark keeps one row per key and input partition before the shuffle, so a key
    with very many rows sends only one row per partition to its reducer.
    """
    if ties is None:
        ties = [c for c in df.columns if c not in keys]
    rank = unused_name(df.columns, "_rank")
    ranked = Window.partitionBy(*keys).orderBy(*order, *tie_order(df, ties))
    first = df.withColumn(rank, F.row_number().over(ranked)).filter(F.col(rank) == 1)
    return first.drop(rank)
