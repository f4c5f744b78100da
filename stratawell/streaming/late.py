"""One row per key from a stream, with late rows kept instead of dropped."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratawell.functions import storage
from stratawell.streaming.dedup import dedup_stream
from stratawell.streaming.sink import Taken, ingest_incremental

OUTCOME = "outcome"


def stored_watermark(spark: SparkSession, checkpoint: str) -> int | None:
    """The watermark, in milliseconds, that the next batch of a stopped stream will have; None of a new one."""
    done = [int(name) for name in storage.entries(spark, f"{checkpoint}/commits") if name.isdigit()]
    if not done:
        return None
    text = storage.read_text(spark, f"{checkpoint}/commits/{max(done)}") or ""
    return json.loads(text.strip().split("\n")[-1]).get("nextBatchWatermarkMs")


def ingest_deduplicated(
    stream: DataFrame,
    keys: Sequence[str],
    time_col: str,
    delay: str,
    out: str,
    checkpoint: str,
    salts: int = 8,
) -> Taken:
    """Take the input not taken before into a layer; nothing is lost but repeats.

    The layer has all columns and ``outcome``: ``passed`` rows are those that :func:`dedup_stream` passes
    on, ``late`` ones those it would drop for being older than the watermark, ``untimed`` ones those without
    a time.  So passed, late and untimed rows and the repeats are the input.

    The watermark of a run is read from the checkpoint when it starts, and the input is split by it
    before anything is held in state.  For this a run takes all there is as one batch: limits on the
    files or bytes of a batch do not apply, so run it often enough for one to be of a good size.
    """
    spark = stream.sparkSession
    if OUTCOME in {c.lower() for c in stream.columns}:
        raise ValueError(f"{OUTCOME} says what became of a row")
    since = stored_watermark(spark, checkpoint)
    time = F.col(f"`{time_col}`")
    late = F.lit(False)
    if since is not None:
        late = F.coalesce(time.cast("timestamp") <= F.timestamp_millis(F.lit(since)), F.lit(False))
    passed = dedup_stream(stream.filter(~late), keys, time_col, delay, salts)
    tagged = [
        rows.withColumn(OUTCOME, F.lit(name))
        for name, rows in (
            ("passed", passed),
            ("late", stream.filter(late)),
            ("untimed", stream.filter(time.isNull())),
        )
    ]
    everything = tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
    taken = ingest_incremental(everything, out, checkpoint, [OUTCOME], one_batch=True)
    if taken.late:
        raise RuntimeError(f"{taken.late} rows came in more than one batch and were dropped as late")
    return taken
