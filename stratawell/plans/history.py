"""What each key was when: intervals of validity, from changes that arrive in any order."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratawell.functions import versions
from stratawell.functions.hashing import key_hash
from stratawell.functions.storage import unused_name
from stratawell.operators.dedup import dedup
from stratawell.operators.incremental import (
    BUCKET,
    buckets_of,
    fixed_buckets,
    hot_hashes,
    in_buckets,
    mark_literal,
    split_by_keys,
)

UNTIL = "valid_to"
#: There are never more hot keys than this, so what is broadcast of them is bounded.
_MOST_HOT = 10_000


def _time_blocks(
    points: DataFrame, keys: list[str], at: str, hot_rows: int, blocks: int, names: tuple[str, str]
) -> DataFrame | None:
    """Hashes of keys with very many changes, each with times that cut them into blocks; None of none."""
    hashed, bounds = names
    least = max(hot_rows, -(-points.count() // _MOST_HOT))
    hot = hot_hashes(points, key_hash(keys), hashed, least)
    found = [row[0] for row in hot.collect()]  # _MOST_HOT at most
    if not found:
        return None
    shares = [i / blocks for i in range(1, blocks)]
    mine = points.select(key_hash(keys).alias(hashed), F.col(f"`{at}`").alias(bounds))
    mine = mine.sample(min(1.0, 1000 * blocks / least), seed=0)
    return (
        mine.filter(F.col(hashed).isin(found))
        .groupBy(hashed)
        .agg(F.array_distinct(F.percentile_approx(bounds, shares, 10_000)).alias(bounds))
    )


def change_points(
    changes: DataFrame,
    keys: Sequence[str],
    at: str,
    order: Sequence[str | Column] = (),
    hot_rows: int = 1_000_000,
    blocks: int = 64,
) -> DataFrame:
    """One row for each key and time, with ``valid_to``: the time of the key's next one, or NULL.

    Of several changes of a key at one time the first under ``order`` counts, and then the first by
    all other columns, so the rows do not depend on the order in which changes arrived.  NULL keys are
    one key.  A change without a time has no place, and fails the query.

    The changes of one key meet in one task, but for keys with about ``hot_rows`` changes or more,
    looked for on a sample: these are cut by time into ``blocks``, and the last change of a block takes
    the first time of the next.  What is found has no influence on the rows.  ``changes`` is read more
    than once, so pass a stored table.
    """
    keys = list(keys)
    if UNTIL in {c.lower() for c in changes.columns}:
        raise ValueError(f"{UNTIL} is the name of the end of an interval")
    time = F.col(f"`{at}`")
    missing = F.raise_error(F.lit(f"a change without a time in {at}"))
    changes = changes.withColumn(at, F.coalesce(time, missing.cast(changes.schema[at].dataType)))
    once = dedup(changes, [*keys, at], order)
    names = [unused_name(changes.columns, name) for name in ("_hash", "_bounds", "_block", "_next")]
    hashed, bounds, block, following = names
    cut = _time_blocks(changes, keys, at, hot_rows, blocks, (hashed, bounds))
    named = [F.col(f"`{k}`") for k in keys]
    if cut is None:
        return once.withColumn(UNTIL, F.lead(time).over(Window.partitionBy(*named).orderBy(time)))
    mine = key_hash(keys) == F.col(hashed)
    once = once.join(F.broadcast(cut), mine, "left").withColumn(
        block,
        F.when(
            F.col(bounds).isNotNull(), F.size(F.filter(bounds, lambda bound: bound <= time))
        ).otherwise(-1),
    )
    columns = [F.col(f"`{c}`") for c in changes.columns]
    within = Window.partitionBy(*named, block).orderBy(time)
    inside = once.withColumn(UNTIL, F.lead(time).over(within))
    # Of a hot key there is one row for each block here.
    starts = once.filter(F.col(block) >= 0).groupBy(*named, block).agg(F.min(time).alias(following))
    starts = starts.withColumn(
        following, F.lead(following).over(Window.partitionBy(*named).orderBy(block))
    )
    theirs = [unused_name([*inside.columns, following], f"_{k}") for k in keys]
    starts = starts.select(
        *[F.col(f"`{k}`").alias(t) for k, t in zip(keys, theirs)],
        F.col(block).alias(f"{block}_"),
        following,
    )
    same = F.col(block) == F.col(f"{block}_")
    for k, t in zip(keys, theirs):
        same &= F.col(f"`{k}`").eqNullSafe(F.col(t))
    return inside.join(starts, same, "left").select(
        *columns, F.coalesce(F.col(UNTIL), F.col(following)).alias(UNTIL)
    )


def update_history(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    keys: Sequence[str],
    at: str,
    deleted: str | None = None,
    order: Sequence[str | Column] = (),
    buckets: int = 256,
    hot_rows: int = 1_000_000,
) -> int:
    """Take changes into a stored history of each key; returns the number of partitions written.

    A change says what a key was from the time in ``at`` on, until its next one.  Where ``deleted``,
    a boolean column, is true the key was not there from then on; this is remembered, so a change that
    arrives later but is older does not bring it back.  A late change splits the interval that it falls
    in.  Whatever the order in which changes arrive, in one load or many, some of them twice, the
    history is the same: see :func:`change_points`.

    Only partitions with changed keys are written, and in them only changed keys are made anew.  A call
    that dies changes nothing and may be repeated (``functions.versions``).  One writer at a time.
    """
    keys = list(keys)
    at_version = versions.version(spark, path)
    state = at_version.state
    fixed_buckets(path, state, buckets)
    how = {"keys": keys, "at": at, "deleted": deleted}
    if state and {name: state[name] for name in how} != how:
        raise ValueError(f"{path} has another history: {state}")
    touched = buckets_of(in_buckets(changes, keys, buckets))
    if not touched:
        return 0
    parts = state.get("parts", {})
    schema = T.StructType([*changes.schema, T.StructField(UNTIL, changes.schema[at].dataType)])
    stored = versions.read_parts(spark, path, BUCKET, parts, schema, touched)
    others, mine = split_by_keys(stored, changes, keys)
    points = change_points(mine.drop(UNTIL).unionByName(changes), keys, at, order, hot_rows)
    merged = in_buckets(others.unionByName(points), keys, buckets)
    parts = versions.store_parts(path, merged, BUCKET, touched, parts)
    versions.commit(
        spark, path, at_version, {**how, "column": BUCKET, "buckets": buckets, "parts": parts}
    )
    versions.sweep(spark, path, [path])
    return len(touched)


def read_history(spark: SparkSession, path: str, as_of: Any = None) -> DataFrame:
    """The intervals in which keys were there, or those of them that hold at a time.

    An interval is from ``at``, inclusive, to ``valid_to``, exclusive; the last one of a key has no
    end.  A time is cast to the type of ``at``.
    """
    state = versions.version(spark, path).state
    if not state:
        raise ValueError(f"there is no history in {path}")
    rows = versions.read_parts(spark, path, BUCKET, state["parts"])
    if state["deleted"] is not None:
        gone = F.coalesce(F.col(state["deleted"]), F.lit(False))
        rows = rows.filter(~gone).drop(state["deleted"])
    if as_of is None:
        return rows
    time = mark_literal(rows, state["at"], as_of)
    return rows.filter(
        (F.col(state["at"]) <= time) & (F.col(UNTIL).isNull() | (F.col(UNTIL) > time))
    )
