"""Stored tables whose state is one small file, so that a write is seen whole or not at all.

Data goes to new folders beside the old ones.  The state says which folder holds which partition;
a new state is written aside and renamed to its number last.  A run that dies before that leaves the
table as it was, with folders that nobody reads and the next run removes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stratawell.functions import storage

FOLDER = "_versions"
_RUN = "run="


@dataclass(frozen=True)
class Version:
    """A state of a table; number 0 is that of one that does not exist yet."""

    number: int
    state: dict[str, Any]


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The versions kept, oldest first."""
    return sorted(int(name) for name in storage.entries(spark, f"{path}/{FOLDER}") if name.isdigit())


def version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """A version, by default the newest."""
    kept = numbers(spark, path)
    if number is None:
        number = kept[-1] if kept else 0
    if not number:
        return Version(0, {})
    text = storage.read_text(spark, f"{path}/{FOLDER}/{number}")
    if text is None:
        raise ValueError(f"{path} has no version {number}, only {kept}")
    return Version(number, json.loads(text))


def commit(spark: SparkSession, path: str, after: Version, state: dict[str, Any]) -> Version:
    """Make a state the next version; refuses if another writer was faster."""
    new = Version(after.number + 1, state)
    aside = f"{path}/{FOLDER}/_{uuid.uuid4().hex}"
    storage.write_text(spark, aside, json.dumps(state, sort_keys=True))
    storage.rename_new(spark, aside, f"{path}/{FOLDER}/{new.number}")
    return new


def new_run() -> str:
    """The name of a folder that no run before has used."""
    return f"{_RUN}{uuid.uuid4().hex}"


def store_parts(
    path: str, rows: DataFrame, column: str, touched: Iterable[str], parts: dict[str, str]
) -> dict[str, str]:
    """Write the whole content of the touched partitions; returns what ``parts`` becomes by it.

    The rebalance writes a partition that is large as several files, by several tasks.
    """
    spark, run = rows.sparkSession, new_run()
    rows.hint("rebalance", column).write.partitionBy(column).parquet(f"{path}/{run}")
    found = [name for name in storage.entries(spark, f"{path}/{run}") if name.startswith(f"{column}=")]
    gone = set(touched)
    kept = {part: folder for part, folder in parts.items() if part not in gone}
    return kept | {name.partition("=")[2]: run for name in found}


def read_parts(
    spark: SparkSession,
    path: str,
    column: str,
    parts: Mapping[str, str | list[str]],
    schema: T.StructType | None = None,
    only: Iterable[str] | None = None,
) -> DataFrame:
    """The rows of all partitions, or of some of them; no others are listed.

    A partition is in one folder, or in several.
    """
    chosen = parts if only is None else {part: parts[part] for part in only if part in parts}
    folders = [
        f"{path}/{run}/{column}={part}"
        for part, runs in sorted(chosen.items())
        for run in ([runs] if isinstance(runs, str) else runs)
    ]
    if schema is None:
        return spark.read.parquet(*folders)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def sweep(spark: SparkSession, path: str, folders: Iterable[str], keep: int = 2) -> None:
    """Remove the folders of data that none of the newest ``keep`` versions needs, and older versions.

    What read an older version fails from then on, instead of reading half of it.
    """
    kept = numbers(spark, path)
    text = "".join(storage.read_text(spark, f"{path}/{FOLDER}/{n}") or "" for n in kept[-keep:])
    for folder in folders:
        for name in storage.entries(spark, folder):
            if name.startswith(_RUN) and name not in text:
                storage.delete(spark, f"{folder}/{name}")
    for number in kept[:-keep]:
        storage.delete(spark, f"{path}/{FOLDER}/{number}")
