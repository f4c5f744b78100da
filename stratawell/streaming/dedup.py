"""One row per key, streaming form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratawell.functions.storage import unused_name


def dedup_stream(
    stream: DataFrame,
    keys: Sequence[str],
    time_col: str,
    delay: str,
    salts: int = 8,
) -> DataFrame:
    """Drop repeats of a key that arrive within ``delay`` of it, across micro-batches.

    State is bounded by ``delay``.  Rows that arrive more than ``delay`` behind
    the newest row seen are dropped as late, so choose it from how late the
    source can be; ``ingest_incremental`` returns how many were.  A key seen
    again after ``delay`` may be passed on again.  A row without a time can be
    held against nothing and does not pass: take those with ``rows_without_time``
    to a sink of their own.

    A key may hold a large part of the rows, so repeats are first dropped per key
    and input partition, over ``salts`` groups; the key's reducer then sees at
    most one row of each.  ``salts=1`` leaves that step out where keys are known
    to be spread.  The plan depends on ``salts`` and on no setting, so a restart
    may change settings, but going from 1 to more or back needs a new checkpoint.

    ``time_col`` may be a time without zone: a zoned copy, which the watermark
    requires, is used on the way and the column itself is passed on untouched.
    """
    keys = list(keys)
    time = unused_name(stream.columns, "_event_time")
    salt = unused_name(stream.columns, "_salt")
    marked = (
        stream.filter(F.col(time_col).isNotNull())
        .withColumn(time, F.col(time_col).cast("timestamp"))
        .withWatermark(time, delay)
    )
    if salts > 1:
        marked = (
            marked.withColumn(salt, F.pmod(F.spark_partition_id(), F.lit(salts)))
            .dropDuplicatesWithinWatermark([*keys, salt])
            .drop(salt)
        )
    return marked.dropDuplicatesWithinWatermark(keys).drop(time)


def rows_without_time(stream: DataFrame, time_col: str) -> DataFrame:
    """What :func:`dedup_stream` leaves out for lack of a time."""
    return stream.filter(F.col(time_col).isNull())
