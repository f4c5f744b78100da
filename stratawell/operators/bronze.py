"""The raw layer: source records unchanged, with where and when they came from."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratawell.functions import storage


def with_lineage(df: DataFrame) -> DataFrame:
    """Add source file, file time and ingest time.

    Apply it to a file source before any join or aggregation: the file's
    metadata exists only on the scan.  Works on streams as well.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("source_time"),
        F.current_timestamp().alias("ingested_at"),
    )


# Directory columns are copies under names of their own: a value read back from a path has lost
# its type, and its zeros, so the column itself stays in the files.
PART = "__part"


def with_parts(df: DataFrame, partition_by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The rows with a copy of each partition column, and the names of the copies."""
    known = {c.lower() for c in df.columns}
    copies = [f"{c}{PART}" for c in partition_by]
    if clash := [c for c in copies if c.lower() in known]:
        raise ValueError(f"columns {clash} have the names of partitions")
    return df.withColumns({copy: F.col(c) for copy, c in zip(copies, partition_by)}), copies


_DIRECTORIES = "_directories"


def _directories(spark: SparkSession, out: str) -> list[str] | None:
    """The directory columns of a layer, as its folders show them; None if it holds nothing."""
    names = [n for n in storage.entries(spark, out) if not n.startswith(("_", "."))]
    if not names:
        return None
    below = [n for n in names if f"{PART}=" in n]
    if not below:
        return []
    deeper = [_directories(spark, f"{out}/{name}") for name in below]
    return [below[0].partition("=")[0], *next((d for d in deeper if d), [])]


def _same_directories(spark: SparkSession, out: str, columns: list[str]) -> None:
    """Refuse a call whose directories are not those of the layer, and fix those of a new one."""
    path = f"{out.rstrip('/')}/{_DIRECTORIES}"
    fixed = storage.read_text(spark, path)
    if not fixed:
        there = _directories(spark, out)
        fixed = storage.claim(spark, path, json.dumps(columns if there is None else there))
    if json.loads(fixed) != columns:
        raise ValueError(f"{out} has the directories {fixed}, not {json.dumps(columns)}")


def bronze_append(
    df: DataFrame,
    out: str,
    load: int | str | None = None,
    load_col: str = "load_no",
    partition_by: Sequence[str] = (),
) -> None:
    """Append records to the raw layer.

    With ``load``, kept in ``load_col``, the records go to that load's own
    directory, and writing the same load again replaces all of it, also by fewer
    partitions or by no rows.  So a load that died half-way may simply be
    repeated.  Without ``load`` every call adds rows.

    A layer keeps the directories of its first call: one that is written with and
    without ``load``, under another ``load_col`` or by other partitions, would be
    read in part only, so such a call is refused before it writes.

    With ``partition_by`` rows are first gathered by those columns to keep the
    number of files low; the rebalance splits a value that holds many rows.
    """
    spark = df.sparkSession
    if storage.exists(spark, f"{out}/_spark_metadata"):
        raise ValueError(
            f"{out} is written by a stream; readers would not see rows appended by a batch"
        )
    if load is not None:
        if load_col.lower() in {c.lower() for c in df.columns}:
            raise ValueError(f"the records have a column {load_col} of their own")
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", str(load)):
            raise ValueError(f"a load is named by letters, digits, '_', '.' and '-', not {load!r}")
        df = df.withColumn(load_col, F.lit(load))
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df, copies = with_parts(df, partition_by)
    _same_directories(spark, out, [*([f"{load_col}{PART}"] if load is not None else []), *copies])
    if load is not None:
        out = f"{out.rstrip('/')}/{load_col}{PART}={load}"
    mode = "append" if load is None else "overwrite"
    df.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(*copies).parquet(out)
