"""Layers whose files hold rows that are near in several columns, with what each file holds noted.

Rows are sorted along a space-filling curve: the ranks of the columns' values, their bits in turns.  A
table of the smallest and the largest values in each file tells which files a filter needs, before
any is opened.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratawell.functions import versions
from stratawell.functions.storage import unused_name
from stratawell.operators.incremental import mark_literal

#: Ranks that a column is cut into: two to this power.
_RANK_BITS = 8


def _bounds(df: DataFrame, by: Sequence[str]) -> list[list[Any]]:
    """Values that cut each column into parts of about the same number of rows, as text or number."""
    shares = [i / (1 << _RANK_BITS) for i in range(1, 1 << _RANK_BITS)]
    figures = []
    for name in by:
        column = F.col(f"`{name}`")
        if df.schema[name].dataType.typeName() == "string":
            # Of texts the first eight bytes, as a number that has their order.
            column = _text_rank(column)
        figures.append(F.percentile_approx(column, shares, 2000))
    return [cuts or [] for cuts in df.agg(*[f.alias(f"c{i}") for i, f in enumerate(figures)]).first()]


def _text_rank(text: Column) -> Column:
    padded = F.rpad(F.hex(F.substring(F.encode(text, "UTF-8"), 1, 6)), 12, "0")
    return F.conv(padded, 16, 10).cast("bigint")


def curve_place(df: DataFrame, by: Sequence[str]) -> Column:
    """The place of a row on the curve: the ranks of its values, one bit of each in turns.

    NULLs have the lowest rank.  ``df`` is read once for the cuts of the columns.
    """
    places = []
    for name, cuts in zip(by, _bounds(df, by)):
        column = F.col(f"`{name}`")
        if df.schema[name].dataType.typeName() == "string":
            column = _text_rank(column)
        known = F.array(*[F.lit(cut) for cut in sorted(set(cuts))]) if cuts else None
        rank = F.size(F.filter(known, lambda cut: cut <= column)) if cuts else F.lit(0)
        places.append(F.coalesce(rank, F.lit(0)).cast("bigint"))
    bits = []
    for bit in range(_RANK_BITS):
        for i, rank in enumerate(places):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1))
            bits.append(F.shiftleft(one, bit * len(places) + i))
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def write_clustered(df: DataFrame, path: str, by: Sequence[str], files: int) -> None:
    """Write a layer in about ``files`` files of rows that are near in the columns of ``by``.

    At most seven columns.  A layer that is there is replaced, seen whole or not at all.  Rows with the
    same values may be dealt to several files, so a value that many rows have does no harm.  ``df`` is
    read three times, so pass a stored table.  Read the layer by :func:`read_clustered`.
    """
    spark, by = df.sparkSession, list(by)
    if not 1 <= len(by) <= 7:
        raise ValueError("a curve goes through one to seven columns")
    at = versions.version(spark, path)
    place, deal = unused_name(df.columns, "_place"), unused_name(df.columns, "_deal")
    keys = [F.col(place), F.col(deal)]
    placed = df.withColumn(place, curve_place(df, by)).withColumn(deal, F.monotonically_increasing_id())
    run = versions.new_run()
    sorted_rows = placed.repartitionByRange(files, *keys).sortWithinPartitions(*keys).drop(place, deal)
    sorted_rows.write.parquet(f"{path}/{run}")
    stored = spark.read.schema(df.schema).parquet(f"{path}/{run}")
    named = [F.col(f"`{c}`") for c in by]
    figures = [
        figure(c).alias(f"{side}{i}")
        for i, c in enumerate(named)
        for side, figure in (("least", F.min), ("most", F.max))
    ]
    held = stored.select(F.col("_metadata.file_path").alias("file"), *named).groupBy("file")
    held = held.agg(F.count(F.lit(1)).alias("rows"), *figures)
    held.coalesce(1).write.parquet(f"{path}/held/{run}")
    state = {"by": by, "run": run, "schema": df.schema.json()}
    versions.commit(spark, path, at, state)
    versions.sweep(spark, path, [path, f"{path}/held"])


def read_clustered(
    spark: SparkSession, path: str, between: Mapping[str, tuple[Any, Any]] | None = None
) -> DataFrame:
    """The rows whose columns are between two values, ends included; None leaves an end open.

    Only files that may hold such rows are read, told by the table of what each holds.  Columns that
    the layer is not clustered by only filter.  To the driver go the names of the files to be read.
    """
    from pyspark.sql.types import _parse_datatype_json_string

    state = versions.version(spark, path).state
    if not state:
        raise ValueError(f"there is no clustered layer in {path}")
    schema = _parse_datatype_json_string(state["schema"])
    between = dict(between or {})
    held = spark.read.parquet(f"{path}/held/{state['run']}")
    empty = spark.createDataFrame([], schema)
    for name, (low, high) in between.items():
        if name in state["by"]:
            i = state["by"].index(name)
            if low is not None:
                held = held.filter(F.col(f"most{i}") >= mark_literal(empty, name, low))
            if high is not None:
                held = held.filter(F.col(f"least{i}") <= mark_literal(empty, name, high))
    files = sorted(row["file"] for row in held.select("file").collect())
    rows = spark.read.schema(schema).parquet(*files) if files else empty
    for name, (low, high) in between.items():
        if low is not None:
            rows = rows.filter(F.col(f"`{name}`") >= mark_literal(empty, name, low))
        if high is not None:
            rows = rows.filter(F.col(f"`{name}`") <= mark_literal(empty, name, high))
    return rows
