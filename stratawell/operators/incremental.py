"""Batch patterns for taking in only what is new."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratawell.functions import versions
from stratawell.functions.hashing import key_hash
from stratawell.functions.storage import unused_name
from stratawell.operators.dedup import dedup


def high_water_mark(df: DataFrame, col: str) -> Any:
    """The largest value of a column, or None for an empty table."""
    return df.agg(F.max(col)).first()[0]


def mark_literal(df: DataFrame, col: str, mark: Any) -> Column:
    """A value as one of a column's type, whatever the zone of the session."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        # As text: a datetime literal would pass through the zone of the session.
        mark = str(mark)
    return F.lit(mark).cast(dtype)


def read_since(df: DataFrame, col: str, mark: Any, until: Any = None) -> DataFrame:
    """Rows beyond the mark, up to and with ``until``; from the first row if there is no mark yet.

    Marks are cast to the column's type and the column is left bare, so the
    comparison reaches the scan.  Take ``until`` from :func:`high_water_mark`
    first and keep it as the next mark: rows that arrive meanwhile then belong
    to the next run, and none is missed.  Rows that arrive later with exactly
    the mark's value, or an older one, are not seen: use a column that only
    grows.  Rows with NULL in the column have no place in this order and are
    never returned where a mark or ``until`` is given.
    """
    if mark is not None:
        df = df.filter(F.col(col) > mark_literal(df, col, mark))
    if until is not None:
        df = df.filter(F.col(col) <= mark_literal(df, col, until))
    return df


def hot_hashes(df: DataFrame, hashed: Column, name: str, min_rows: int) -> DataFrame:
    """Hashes of keys that hold about ``min_rows`` rows or more, rows / min_rows of them at most.

    Counted on a sample in which such a key is expected about a thousand times.
    """
    fraction = min(1.0, 1000 / min_rows)
    sampled = df.select(hashed.alias(name))
    if fraction < 1:
        sampled = sampled.sample(fraction, seed=0)
    return sampled.groupBy(name).count().filter(F.col("count") >= min_rows * fraction).select(name)


def new_keys(
    incoming: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    hot_rows: int | None = 1_000_000,
    salts: int = 64,
) -> DataFrame:
    """Incoming rows whose key is not in the target yet.

    Repeats within ``incoming`` are all kept, and so are rows with a NULL in the
    key, which never equals a key of the target.  Only key columns of the target
    are read, and reduced to distinct keys before the shuffle.

    The rows of one key would all meet in one reducer, so hashes of keys that
    hold ``hot_rows`` incoming rows or more (choose what one reducer should
    take) are looked for first, on a sample of the key columns.  Their rows are
    dealt over ``salts`` reducers, and the target's keys with such a hash are
    sent to each.  There are no more of these hashes than rows / ``hot_rows``,
    of 8 bytes each, and they are broadcast.  Which are found has no influence
    on the result.  ``hot_rows=None`` leaves the search out.

    Both tables are read more than once, so pass stored ones.
    """
    keys = list(keys)
    known = target.select(*keys).na.drop().distinct()
    if hot_rows is None:
        return incoming.join(known, keys, "left_anti").select(*incoming.columns)
    taken = [*incoming.columns, *keys]
    salt, place = unused_name(taken, "_salt"), unused_name(taken, "_place")
    mine, theirs = unused_name(taken, "_hash"), unused_name(taken, "_hot")
    hashed = F.xxhash64(*keys)
    hot = F.broadcast(hot_hashes(incoming, hashed, theirs, hot_rows))
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    # The place of a row in its input partition deals equal rows out evenly, and
    # alike if a task runs again.  Rows without a whole key meet none: spread them.
    dealt = F.pmod(F.col(place), F.lit(salts)).cast("int")
    probe = (
        incoming.withColumn(place, F.monotonically_increasing_id())
        .withColumn(mine, hashed)
        .join(hot, F.col(mine) == F.col(theirs), "left")
        .withColumn(salt, F.when(F.col(theirs).isNotNull() | ~has_key, dealt).otherwise(F.lit(0)))
    )
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    lookup = (
        known.withColumn(mine, hashed)
        .join(hot, F.col(mine) == F.col(theirs), "left")
        .withColumn(
            salt, F.explode(F.when(F.col(theirs).isNotNull(), every).otherwise(F.array(F.lit(0))))
        )
        .select(*keys, salt)
    )
    return probe.join(lookup, [*keys, salt], "left_anti").select(*incoming.columns)


def _key_bytes(keys: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a + b,
        [F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys],
    )


def _fits_broadcast(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    rows, size = df.agg(F.count(F.lit(1)), F.sum(_key_bytes(df.columns))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def _newest(
    old: DataFrame,
    changes: DataFrame,
    keys: list[str],
    order: Sequence[str | Column],
    ties,
    deleted: str | None,
) -> DataFrame:
    taken = [*old.columns, *changes.columns]
    change, gone = unused_name(taken, "_change"), unused_name(taken, "_gone")
    is_gone = F.lit(False) if deleted is None else F.coalesce(F.col(deleted), F.lit(False))
    changed = changes.select(*[F.col(f"`{c}`") for c in old.columns], is_gone.alias(gone))
    old = old.withColumn(gone, F.lit(False))
    both = old.withColumn(change, F.lit(0)).unionByName(changed.withColumn(change, F.lit(1)))
    if ties is None:
        ties = [c for c in both.columns if c not in (*keys, change, gone)]
    # Of changes that are equal under the order, one that deletes comes first.
    later = [F.col(change).desc(), F.col(gone).desc()]
    first = dedup(both, keys, [*order, *later], ties)
    return (first if deleted is None else first.filter(~F.col(gone))).drop(change, gone)


def split_by_keys(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    broadcast_rows: int = 1_000_000,
    broadcast_bytes: int = 64 << 20,
) -> tuple[DataFrame, DataFrame]:
    """Rows of keys that the changes have not, and rows of keys that they have.  NULL keys are one key.

    The changed keys are broadcast if they are measured to be within both limits.
    """
    names = {k: unused_name([*target.columns, *changes.columns], f"_changed_{k}") for k in keys}
    changed = changes.select(*[F.col(k).alias(names[k]) for k in keys]).distinct()
    if _fits_broadcast(changed, broadcast_rows, broadcast_bytes):
        changed = F.broadcast(changed)
    else:
        changed = changed.hint("merge")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(names[k])) for k in keys])
    return target.join(changed, same, "left_anti"), target.join(changed, same, "left_semi")


def upsert(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    ties: Sequence[str] | None = None,
    broadcast_rows: int = 1_000_000,
    broadcast_bytes: int = 64 << 20,
    deleted: str | None = None,
) -> DataFrame:
    """Target plus changes: of each changed key the first row under ``order``.

    Target rows of other keys stay as they are, repeated keys included.  A
    change wins over a target row that is equal under ``order``; what is then
    still equal is told apart by ``ties``, by default all other columns.  NULL
    keys are one key.  Write the result to a new path, never to the one being
    read, or use :func:`upsert_partitions`.

    ``deleted`` names a boolean column of the changes that the target has not.  A
    change in which it is true removes its key if it is the first under ``order``.
    It is not remembered: an older change that arrives later brings the key back,
    which it does not in :func:`~stratawell.plans.history.update_history`.

    The changed keys are counted and measured first.  Up to the two limits they
    are broadcast, and target rows of other keys pass without a shuffle; beyond
    them the target meets the changed keys in a shuffle.  The rows are the same
    either way.  Both tables are read more than once, so pass stored ones.
    """
    keys, order = list(keys), list(order)
    untouched, touched = split_by_keys(target, changes, keys, broadcast_rows, broadcast_bytes)
    return untouched.unionByName(_newest(touched, changes, keys, order, ties, deleted))


BUCKET = "bucket__part"


def bucket_of(hashed: str | Column, buckets: int) -> Column:
    """The number of the bucket for the hash of a key."""
    return F.pmod(F.col(hashed) if isinstance(hashed, str) else hashed, F.lit(buckets)).cast("int")


def in_buckets(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """The rows with the number of the bucket that their key falls in."""
    if BUCKET in {c.lower() for c in df.columns}:
        raise ValueError(f"{BUCKET} is the name of the partitions")
    return df.withColumn(BUCKET, bucket_of(key_hash(keys), buckets))


def buckets_of(df: DataFrame) -> list[str]:
    """The numbers of the buckets that rows fall in, as text; there are no more than buckets."""
    return [str(row[0]) for row in df.select(BUCKET).distinct().collect()]


def fixed_buckets(path: str, state: dict[str, Any], buckets: int) -> None:
    if state.get("buckets", buckets) != buckets:
        raise ValueError(f"{path} has {state['buckets']} buckets, not {buckets}")


def upsert_partitions(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    buckets: int = 256,
    deleted: str | None = None,
) -> int:
    """Upsert into a stored table, writing only the partitions that hold changed keys.

    The table is partitioned by a hash of the keys; ``buckets`` is fixed by the
    first call, until :func:`redeal_partitions` changes it.  Returns the number of partitions written.  ``deleted`` is as in
    :func:`upsert`, and not stored.

    New files are written beside the old ones, large partitions by several tasks,
    and one small file then switches to them (see ``functions.versions``).  A call
    that dies at any point leaves the table as it was, and running it again gives
    the same table as if it had not.  Read the table by
    :func:`~stratawell.sources.files.read_layer`; what read it before stays valid
    until the second call after that.  One writer at a time: of two, one is refused.
    """
    keys = list(keys)
    at = versions.version(spark, path)
    fixed_buckets(path, at.state, buckets)
    dealt = in_buckets(changes, keys, buckets)
    touched = buckets_of(dealt)
    if not touched:
        return 0
    parts = at.state.get("parts", {})
    schema = changes.drop(deleted).schema if deleted else changes.schema
    stored = versions.read_parts(spark, path, BUCKET, parts, schema, touched)
    merged = upsert(stored, changes, keys, order, deleted=deleted)
    parts = versions.store_parts(path, in_buckets(merged, keys, buckets), BUCKET, touched, parts)
    versions.commit(spark, path, at, {"column": BUCKET, "buckets": buckets, "parts": parts})
    versions.sweep(spark, path, [path])
    return len(touched)


def redeal_partitions(spark: SparkSession, path: str, keys: Sequence[str], buckets: int) -> None:
    """Deal a stored table, or a history, to another number of partitions, as it has grown or shrunk.

    The whole table is read and written once; it is seen with the old partitions or with the new ones.
    Later calls that write to it take the new number.
    """
    at = versions.version(spark, path)
    if not at.state:
        raise ValueError(f"there is no table in {path}")
    rows = versions.read_parts(spark, path, BUCKET, at.state["parts"])
    parts = versions.store_parts(path, in_buckets(rows, keys, buckets), BUCKET, [], {})
    versions.commit(spark, path, at, at.state | {"buckets": buckets, "parts": parts})
    versions.sweep(spark, path, [path])
