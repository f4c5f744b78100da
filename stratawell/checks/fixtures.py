"""Inputs derived from the given tables, so that SQL can state the same rows.

Staging writes whole tables through Spark into a shared workspace.  The time it
takes is kept apart, so that the bench can report operators without it.
"""

from __future__ import annotations

import time
from collections.abc import Iterable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Times keep their microseconds in text formats.
TIME_FORMAT = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

# What makes a derived row dirty, by its id.
BAD_VALUE_EVERY = 97
BAD_TIME_EVERY = 89
SHOUTED_TYPE_EVERY = 5
CUT_PAYLOAD_EVERY = 101
CUT_PAYLOAD_CHARS = 10
BAD_PRICE_EVERY = 113
REVISED_EVERY = 10
ZONED_TIME_EVERY = 83
TRAILING_OBJECT_EVERY = 103
NO_PAYLOAD_EVERY = 107
INVALID_BYTES_EVERY = 109
MORE_FIELDS_EVERY = 127
SECOND_PAYLOAD_EVERY = 131
REPEATED_SHARE = 10
REPEAT_WAVES = 4

_staging_seconds = 0.0


def staging_seconds() -> float:
    """Seconds spent staging since the process started."""
    return _staging_seconds


def _staged(stage):
    @wraps(stage)
    def timed(*args, **kwargs):
        global _staging_seconds
        start = time.perf_counter()
        try:
            return stage(*args, **kwargs)
        finally:
            _staging_seconds += time.perf_counter() - start

    return timed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(col: str, n: int) -> Column:
    return F.col(col) % n == 0


def _later(col: str) -> Column:
    return F.col(col) + F.expr("INTERVAL 5 MINUTES")


@_staged
def land_events(events: DataFrame, landing: str, parts: Iterable[int] = range(4)) -> None:
    """JSON files of the events whose id modulo 4 is among ``parts``."""
    chosen = events.filter((F.col("event_id") % 4).isin(list(parts)))
    chosen.write.mode("append").options(**TIME_FORMAT).json(landing)


def revised_events(events: DataFrame) -> DataFrame:
    """Newer versions of every tenth event: five minutes later, value one higher."""
    return (
        events.filter(_every("event_id", REVISED_EVERY))
        .withColumn("ts", _later("ts"))
        .withColumn("value", F.col("value") + 1)
    )


def dirty_events(events: DataFrame) -> DataFrame:
    """The events as text, with bad values, empty and zoned times and unclean types."""
    shouted = F.concat(F.lit("  "), F.upper("event_type"), F.lit(" "))
    text = {c: F.col(c).cast("string") for c in events.columns}
    text["value"] = F.when(_every("event_id", BAD_VALUE_EVERY), "n/a").otherwise(text["value"])
    abroad = F.concat((F.col("ts") + F.expr("INTERVAL 5 HOURS")).cast("string"), F.lit("+05:00"))
    text["ts"] = (
        F.when(_every("event_id", BAD_TIME_EVERY), "")
        .when(_every("event_id", ZONED_TIME_EVERY), abroad)
        .otherwise(text["ts"])
    )
    text["event_type"] = F.when(_every("event_id", SHOUTED_TYPE_EVERY), shouted).otherwise(
        F.col("event_type")
    )
    return events.select(*[text[c].alias(c) for c in events.columns])


@_staged
def stage_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("append").parquet(path)
    return path


@_staged
def stage_csv(df: DataFrame, path: str) -> str:
    df.write.option("header", True).options(**TIME_FORMAT).csv(path)
    return path


def event_envelopes(events: DataFrame) -> DataFrame:
    """The events as keyed binary payloads, some cut short, missing, not UTF-8 or with more behind.

    What is behind may be another object, or fields as if the payload were part of one.
    """
    payload = F.to_json(F.struct(*events.columns), TIME_FORMAT)
    cut = F.when(
        _every("event_id", CUT_PAYLOAD_EVERY), F.substring(payload, 1, CUT_PAYLOAD_CHARS)
    ).otherwise(payload)
    trailing = F.concat(cut, F.lit('{"event_id":1}'))
    invalid = F.concat(cut.cast("binary"), F.unhex(F.lit("FF")))
    value = (
        F.when(_every("event_id", NO_PAYLOAD_EVERY), F.lit(None).cast("binary"))
        .when(_every("event_id", TRAILING_OBJECT_EVERY), trailing.cast("binary"))
        .when(_every("event_id", INVALID_BYTES_EVERY), invalid)
        .when(_every("event_id", MORE_FIELDS_EVERY), F.concat(cut, F.lit(',"x":2')).cast("binary"))
        .when(
            _every("event_id", SECOND_PAYLOAD_EVERY),
            F.concat(cut, F.lit(',"payload":'), cut).cast("binary"),
        )
        .otherwise(cut.cast("binary"))
    )
    return events.select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        value.alias("value"),
        F.lit("events").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


@_staged
def land_drifting_events(events: DataFrame, landing: str) -> None:
    """JSON files of the events in three folders; those of the later ones have more fields.

    ``zz`` is a whole number in the second folder and, but for every fifth event, a text in the third,
    where ``more`` is an object.
    """
    event_id = F.col("event_id")
    nested = F.struct(event_id.alias("p"), F.array(F.lit(1), F.lit(2)).alias("q"))
    extra = {
        0: [],
        1: [event_id.alias("zz")],
        2: [F.when(event_id % 5 != 0, F.concat(F.lit("z"), event_id)).alias("zz"), nested.alias("more")],
    }
    for turn, columns in extra.items():
        some = events.filter(event_id % 3 == turn).select("*", *columns)
        some.write.options(**TIME_FORMAT).json(f"{landing}/wave={turn}")


def offset_runs(events: DataFrame) -> list[DataFrame]:
    """Envelopes of the events in three runs: the second replays some, the third comes after a gap."""
    event_id = F.col("event_id")
    envelopes = event_envelopes(events).select(
        "*", (F.col("offset") % 4).cast("int").alias("p"), F.floor(F.col("offset") / 4).alias("o")
    )
    envelopes = envelopes.withColumns({"partition": F.col("p"), "offset": F.col("o")}).drop("p", "o")
    share = events.agg((F.max(event_id) + 1).alias("n")).first()["n"] // 10
    of = F.col("key").cast("string").cast("bigint")
    bounds = [(0, 4 * share), (3 * share, 6 * share), (7 * share, 11 * share)]
    runs = [envelopes.filter((of >= low) & (of < high)) for low, high in bounds]
    return [runs[0], runs[1].unionByName(runs[1].filter(of % 100 < 4)), runs[2]]


@_staged
def repeat_waves(events: DataFrame) -> list[DataFrame]:
    """The events in time order, in four waves that repeat the last tenth of the one before."""
    first, last = events.agg(F.min("event_id"), F.max("event_id")).first()
    size = -(-(last - first + 1) // REPEAT_WAVES)
    event_id = F.col("event_id")
    waves = []
    for start in range(first, last + 1, size):
        wave = events.filter((event_id >= start) & (event_id < start + size))
        if start > first:
            again = events.filter((event_id >= start - size // REPEATED_SHARE) & (event_id < start))
            wave = wave.unionByName(again.withColumn("ts", _later("ts")))
        waves.append(wave)
    return waves


def dirty_orders(orders: DataFrame) -> DataFrame:
    """Whole orders, some prices unreadable."""
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    bad = F.when(_every("o_orderkey", BAD_PRICE_EVERY), "bad").otherwise(price)
    return orders.withColumn("o_totalprice", bad)
