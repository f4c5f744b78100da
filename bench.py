"""Time every query at one scale and print one JSON line.

Each query runs once to warm up and then BENCH_RUNS times; the figure is the
median.  Results go to the noop sink in full.  Staging of inputs is timed apart
and not part of the figure.
"""

from __future__ import annotations

import json
import os
import statistics
import time

import pyspark
from pyspark.sql import SparkSession

from stratawell.checks import fixtures
from stratawell.checks.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
MEMORY = os.environ.get("BENCH_MEMORY", "8g")
ONLY = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name]

# For local disks only: the default manager starts a process per state file where
# Hadoop's native library is missing, which would be most of what is measured.
LOCAL_CHECKPOINTS = (
    "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"
)

# Queries that run a stream over the whole of `events`, once or in several runs.
STREAMS = (
    "file_stream_source incremental_ingest event_source stream_sink payload_decode dedup_stream "
    "lineage events_per_day"
).split()


def timed(spark: SparkSession, name: str) -> tuple[float, float]:
    """Seconds of operator and of staging."""
    staged = fixtures.staging_seconds()
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    total = time.perf_counter() - start
    staged = fixtures.staging_seconds() - staged
    return total - staged, staged


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("stratawell-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", MEMORY)
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.streaming.checkpointFileManagerClass", LOCAL_CHECKPOINTS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    events = fixtures.table(spark, SF_DIR, "events").count()
    medians, ranges, staging, rates = {}, {}, {}, {}
    for name in ONLY or QUERIES:
        timed(spark, name)
        runs = [timed(spark, name) for _ in range(RUNS)]
        seconds = [run[0] for run in runs]
        medians[name] = round(statistics.median(seconds), 3)
        ranges[name] = [round(min(seconds), 3), round(max(seconds), 3)]
        staging[name] = round(statistics.median(run[1] for run in runs), 3)
        if name in STREAMS:
            rates[name] = round(events / medians[name])
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "range": ranges,
                "staging": staging,
                "stream_rows_per_sec": rates,
                "runs": RUNS,
                "cpus": CPUS,
                "memory": MEMORY,
                "spark": pyspark.__version__,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
