"""Whether events came whole: ranges of offsets, kept from run to run, with gaps and replays."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratawell.functions import versions
from stratawell.functions.storage import unused_name
from stratawell.operators.dedup import dedup

#: Offsets that are worked on together.
BLOCK = 1 << 20


def _islands(ranges: DataFrame, by: list[Column]) -> DataFrame:
    """Ranges that touch or overlap as one; ``ranges`` has ``first`` and ``last``."""
    order = Window.partitionBy(*by).orderBy("first", "last")
    until = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = ranges.withColumn("opens", F.coalesce(F.col("first") > until + 1, F.lit(True)).cast("int"))
    number = F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        starts.withColumn("island", number)
        .groupBy(*by, "island")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .drop("island")
    )


def offset_ranges(
    events: DataFrame, by: Sequence[str] = ("topic", "partition"), offset: str = "offset", block: int = BLOCK
) -> DataFrame:
    """(by, first, last): the longest ranges of offsets without a gap, in each partition.

    Offsets are first put together within blocks of ``block`` of them, so a partition with most
    events is worked on by several tasks; what then meets has a few ranges for each block.  NULL
    offsets have no place.  Repeated offsets count once.
    """
    named = [F.col(f"`{c}`") for c in by]
    at = F.col(f"`{offset}`").cast("bigint")
    once = events.select(*named, at.alias("first")).filter("first IS NOT NULL").distinct()
    cut = once.withColumn("last", F.col("first")).withColumn("block", F.floor(F.col("first") / block))
    inside = _islands(cut, [*named, F.col("block")]).drop("block")
    return _islands(inside, named)


class Offsets(NamedTuple):
    """Events not taken before, each once; what was found about ranges; and what is to be committed."""

    events: DataFrame
    report: DataFrame
    path: str
    run: str


def _compared(new: DataFrame, before: DataFrame, by: list[Column]) -> DataFrame:
    """(by, first, last, kind): ``new``, ``replay`` and ``gap`` ranges, by a sweep over all bounds."""
    bounds = reduce(
        DataFrame.unionByName,
        [
            ranges.select(*by, at.alias("first"), F.lit(x * step).alias("new"), F.lit(y * step).alias("old"))
            for ranges, x, y in ((new, 1, 0), (before, 0, 1))
            for at, step in ((F.col("first"), 1), (F.col("last") + 1, -1))
        ],
    )
    bounds = bounds.groupBy(*by, "first").agg(F.sum("new").alias("new"), F.sum("old").alias("old"))
    order = Window.partitionBy(*by).orderBy("first")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    open_ = bounds.select(
        *by,
        "first",
        (F.lead("first").over(order) - 1).alias("last"),
        (F.sum("new").over(so_far) > 0).alias("new"),
        (F.sum("old").over(so_far) > 0).alias("old"),
    ).filter("last IS NOT NULL")
    kind = (
        F.when(F.col("new") & F.col("old"), "replay")
        .when(F.col("new"), "new")
        .when(~F.col("old"), "gap")
    )
    return open_.select(*by, "first", "last", kind.alias("kind")).filter("kind IS NOT NULL")


def take_offsets(
    events: DataFrame,
    path: str,
    by: Sequence[str] = ("topic", "partition"),
    offset: str = "offset",
    block: int = BLOCK,
) -> Offsets:
    """Compare the offsets of a run with those of all runs before, which are kept in ``path``.

    The report has (by, first, last, kind): ``new`` ranges, those that came before (``replay``), and
    those missing between the first and the last offset known by then (``gap``), of earlier runs
    included.  The events returned are those with new offsets, one for each: of several with one
    offset the first by all other columns.  Events without an offset are all returned.

    Write the events, then call :func:`commit_offsets`: a run that dies before is repeated as if it had
    not been.  What is kept are ranges, a few for each partition, not offsets, and the reports.
    ``events`` is read more than once, so pass a stored table.  One writer at a time.
    """
    spark, by = events.sparkSession, list(by)
    if clash := {"first", "last", "kind"} & set(by):
        raise ValueError(f"{sorted(clash)} name what a report has")
    named = [F.col(f"`{c}`") for c in by]
    work = versions.new_run()
    ranges = offset_ranges(events, by, offset, block)
    ranges.write.parquet(f"{path}/{work}/new")
    new = spark.read.schema(ranges.schema).parquet(f"{path}/{work}/new")
    kept = versions.version(spark, path).state.get("run")
    before = spark.createDataFrame([], ranges.schema)
    if kept:
        before = spark.read.schema(ranges.schema).parquet(f"{path}/{kept}/all")
    _islands(before.unionByName(new), named).write.parquet(f"{path}/{work}/all")

    taken = [*events.columns, *by]
    theirs = [unused_name(taken, f"_{c}") for c in by]
    first, last, cut = (unused_name([*taken, *theirs], name) for name in ("_first", "_last", "_block"))
    # Offsets and ranges meet by block, so no event is compared with all ranges.
    blocks = F.sequence(F.floor(F.col("first") / block), F.floor(F.col("last") / block))
    known = before.select(
        *[F.col(f"`{c}`").alias(t) for c, t in zip(by, theirs)],
        F.col("first").alias(first),
        F.col("last").alias(last),
        F.explode(blocks).alias(cut),
    )
    at = F.col(f"`{offset}`").cast("bigint")
    same = [F.col(f"`{c}`").eqNullSafe(F.col(t)) for c, t in zip(by, theirs)]
    again = reduce(lambda a, b: a & b, [F.floor(at / block) == F.col(cut), *same])
    fresh = events.join(known, again & at.between(F.col(first), F.col(last)), "left_anti")
    distinct = new.agg(F.sum(F.col("last") - F.col("first") + 1)).first()[0] or 0
    if events.filter(at.isNotNull()).count() > distinct:  # some offsets came twice in this run
        fresh = dedup(fresh.filter(at.isNotNull()), [*by, offset], []).unionByName(
            fresh.filter(at.isNull())
        )
    found = _compared(new, before, named)
    report = f"{path}/reports/{work.partition('=')[2]}"
    found.write.parquet(report)
    return Offsets(fresh, spark.read.schema(found.schema).parquet(report), path, work)


def commit_offsets(spark: SparkSession, taken: Offsets) -> None:
    """Keep the offsets of a run whose events were written."""
    at = versions.version(spark, taken.path)
    versions.commit(spark, taken.path, at, {"run": taken.run})
    versions.sweep(spark, taken.path, [taken.path])
