"""Streams into layers, once per record."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratawell.functions import storage
from stratawell.operators.bronze import with_parts

_OWNER = "layer_sink"
_KEPT = "spark.sql.streaming.numRecentProgressUpdates"
# Batches whose progress is kept, and how often it is looked at: no run has so many in between.
_KEPT_BATCHES = 1000
_LOOK_SECONDS = 2
_CLAIM = "_layer_owner"


@dataclass(frozen=True)
class Taken:
    """What a run took: batches, rows written, and rows dropped as late."""

    batches: int
    rows: int
    late: int


def bind_checkpoint(spark: SparkSession, out: str, checkpoint: str) -> None:
    """Tie a checkpoint and an output to each other for good, or refuse.

    The sink skips batches whose number its own log already holds.  A fresh
    checkpoint over an old output restarts the numbers, so its first batches
    would be dropped without an error; an old checkpoint over a fresh output
    would never read its input again; and rows that a batch job wrote would be
    hidden by the sink's log.  Each side names the other.  The output's side is
    created, never replaced, so of several checkpoints at once one gets it and
    the others are refused now and whenever they try again.
    """
    out, own = storage.qualify(spark, out), storage.qualify(spark, checkpoint)
    owner_path, sink_log = f"{own}/{_OWNER}", f"{out}/_spark_metadata"
    owner = storage.read_text(spark, owner_path)
    if owner and owner != out:
        raise ValueError(f"checkpoint {checkpoint} belongs to {owner}, not to {out}")
    if owner:
        if storage.has_entries(spark, f"{own}/commits") and not storage.has_entries(spark, sink_log):
            raise ValueError(f"{out} has lost the rows that checkpoint {checkpoint} has taken")
    elif storage.exists(spark, f"{own}/metadata"):
        raise ValueError(f"checkpoint {checkpoint} was made by another query")
    elif set(storage.entries(spark, out)) - {_CLAIM, f".{_CLAIM}.crc"}:
        raise ValueError(f"{out} already holds data that checkpoint {checkpoint} does not know")
    holder = storage.claim(spark, f"{out}/{_CLAIM}", own)
    if holder != own:
        raise ValueError(f"{out} already belongs to checkpoint {holder}, not to {checkpoint}")
    if not owner:
        storage.write_text(spark, owner_path, out)


def stream_sink(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    trigger: Mapping[str, Any] | None = None,
) -> StreamingQuery:
    """Start writing a stream to a layer; each record is written once across restarts.

    ``trigger`` takes the arguments of ``DataStreamWriter.trigger`` and defaults
    to taking what is there and stopping.  Both paths must be on storage that
    outlives the cluster.  The number of shuffle partitions of a stateful stream
    is fixed by its first run.
    """
    bind_checkpoint(stream.sparkSession, out, checkpoint)
    stream, copies = with_parts(stream, partition_by)
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    if copies:
        writer = writer.partitionBy(*copies)
    return writer.start()


def ingest_incremental(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    one_batch: bool = False,
) -> Taken:
    """Take the input not taken before, then stop.  Raises if the run failed.

    With ``one_batch`` all there is makes one batch, whatever limits the source has.  Returns what the run took.  Spark keeps the progress of the last batches only, so it is gathered
    while the run goes on, more often than batches could fall out.
    """
    spark = stream.sparkSession
    counted = stream.observe("taken", F.count(F.lit(1)).alias("rows"))
    seen: dict[tuple[int, str], tuple[int | None, int]] = {}

    def gather() -> None:
        for p in query.recentProgress:
            progress = json.loads(p.json) if hasattr(p, "json") else p
            taken = progress.get("observedMetrics", {}).get("taken")
            late = sum(op.get("numRowsDroppedByWatermark", 0) for op in progress["stateOperators"])
            place = progress["batchId"], progress["timestamp"]
            seen[place] = taken["rows"] if taken else None, late

    before = spark.conf.get(_KEPT)
    spark.conf.set(_KEPT, str(max(int(before), _KEPT_BATCHES)))  # read anew after each batch
    try:
        trigger = {"once": True} if one_batch else None
        query = stream_sink(counted, out, checkpoint, partition_by, trigger)
        try:
            while not query.awaitTermination(_LOOK_SECONDS):
                gather()
            gather()
        finally:
            query.stop()
    finally:
        spark.conf.set(_KEPT, before)
    rows = [n for n, _ in seen.values() if n is not None]
    return Taken(batches=len(rows), rows=sum(rows), late=sum(late for _, late in seen.values()))
