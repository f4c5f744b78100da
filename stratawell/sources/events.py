"""Event sources: keyed binary payloads with partition and offset."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stratawell.sources.files import file_stream

# The columns Spark's Kafka source delivers.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)


def event_options(options: Mapping[str, str], parallelism: int) -> dict[str, str]:
    """Reader options with a busy partition's offset range cut into several tasks."""
    return {"minPartitions": str(parallelism), **options}


def event_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Read an event service that speaks the Kafka protocol.

    Needs Spark's Kafka connector on the class path.  Give
    ``maxOffsetsPerTrigger`` to bound one micro-batch of a large backlog.
    """
    chosen = event_options(options, spark.sparkContext.defaultParallelism)
    return spark.readStream.format("kafka").options(**chosen).load()


def event_replay(spark: SparkSession, directory: str, **bounds) -> DataFrame:
    """Read archived event envelopes (Parquet) as a stream of the same shape.

    ``bounds`` are those of :func:`file_stream`.
    """
    return file_stream(spark, directory, "parquet", ENVELOPE, **bounds)
