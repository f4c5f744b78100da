"""The refined layer: as one build, and kept up to date load by load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial
from typing import Any, NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratawell.functions import storage, versions
from stratawell.functions.cleaning import Field
from stratawell.functions.hashing import key_hash, row_hash
from stratawell.functions.storage import unused_name
from stratawell.operators.conform import broken_rules, names_where
from stratawell.operators.dedup import dedup
from stratawell.operators.incremental import (
    BUCKET,
    bucket_of,
    buckets_of,
    fixed_buckets,
    in_buckets,
    upsert,
)


@dataclass(frozen=True)
class SilverRules:
    """How raw records become refined ones.

    ``valid`` sees the refined columns, and the raw record as ``raw``.
    """

    mapping: Sequence[Field]
    valid: Mapping[str, Column]
    keys: Sequence[str]
    order: Sequence[str | Column]


class Silver(NamedTuple):
    accepted: DataFrame
    quarantined: DataFrame


OUTCOME = "outcome__part"
LOAD = "load__part"
#: Times keep their microseconds in the JSON text of a record.
_JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _tagged(bronze: DataFrame, rules: SilverRules, keep: Sequence[Column] = ()) -> DataFrame:
    """Refined columns, reasons, and the raw record as JSON text where there are reasons."""
    names = {f.name.lower() for f in rules.mapping}
    if clash := names & {"raw", "reasons", OUTCOME, LOAD}:
        raise ValueError(f"{sorted(clash)} name what a quarantined record carries")
    raw_types = bronze.select(*[f.raw() for f in rules.mapping]).schema
    typed = [f.typed(raw_types[f.name].dataType) for f in rules.mapping]
    there = [f.there(raw_types[f.name].dataType) for f in rules.mapping]
    record = F.struct(*[F.col(f"`{c}`") for c in bronze.columns])
    theres = unused_name([*names, LOAD], "there")
    read = bronze.select(
        *typed,
        record.alias("raw"),
        F.struct(*[flag.alias(f"_{i}") for i, flag in enumerate(there)]).alias(theres),
        *keep,
    )
    # Told by what was typed above: a field's text is parsed once.
    unfit = [
        (f"unfit:{f.name}", F.col(theres)[f"_{i}"] & F.col(f"`{f.name}`").isNull())
        for i, f in enumerate(rules.mapping)
    ]
    reasons = F.concat(names_where(unfit), broken_rules(rules.valid))
    columns = [F.col(f"`{f.name}`") for f in rules.mapping]
    kept = [F.col(f"`{c}`") for c in read.columns[len(columns) + 2 :]]  # those of ``keep``
    tagged = read.select(*columns, "raw", reasons.alias("reasons"), *kept)
    bad = F.size("reasons") > 0
    return tagged.select(
        *columns,
        "reasons",
        F.when(bad, F.to_json("raw", _JSON)).alias("raw"),
        F.when(bad, "quarantined").otherwise("accepted").alias(OUTCOME),
        *kept,
    )


def _sides(written: DataFrame) -> Silver:
    accepted = written.filter(F.col(OUTCOME) == "accepted").drop(OUTCOME, "reasons", "raw")
    quarantined = written.filter(F.col(OUTCOME) == "quarantined").drop(OUTCOME)
    return Silver(accepted, quarantined)


def silver_build(bronze: DataFrame, rules: SilverRules, out: str) -> Silver:
    """Conform, set invalid rows apart, keep one row per key.

    Records are read, typed and judged once and written to ``out``, accepted
    ones apart from quarantined ones.  A record is quarantined if a rule is
    broken (NULL counts as broken) or if a value that is not blank does not fit
    its type; it then carries the ``reasons``, all that apply, and the whole
    ``raw`` record as JSON text.  Accepted rows are deduplicated as they are
    read, in one shuffle; quarantined ones are all kept.
    """
    tagged = _tagged(bronze, rules)
    tagged.write.mode("overwrite").partitionBy(OUTCOME).parquet(out)
    judged = _sides(bronze.sparkSession.read.schema(tagged.schema).parquet(out))
    return Silver(dedup(judged.accepted, rules.keys, rules.order), judged.quarantined)


@dataclass(frozen=True)
class _Load:
    """A load of the raw layer: its value, and a fingerprint of its rows."""

    value: Any
    mark: str


def _loads(bronze: DataFrame, load_col: str) -> dict[str, _Load]:
    """The loads in the raw layer by name, each with a fingerprint.

    It sums up the rows by the file they are in, its size and its time, so only the load's column
    is read, and the order of rows has no influence.  Records that come from no files are summed up
    themselves.
    """
    load = F.col(f"`{load_col}`").alias("load")
    try:
        file = [F.col(f"_metadata.{x}") for x in ("file_path", "file_size", "file_modification_time")]
        rows = bronze.select(load, F.xxhash64(*file).alias("hash"))
    except AnalysisException:
        rows = bronze.select(load, row_hash(bronze, bronze.columns).alias("hash"))
    sums = rows.groupBy("load").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("hash").cast("decimal(20,0)")).alias("sum")
    )
    found = sums.select("*", F.col("load").cast("string").alias("name")).collect()  # a row per load
    if not all(row["name"] for row in found):
        raise ValueError(f"there are records without a load in {load_col}")
    return {row["name"]: _Load(row["load"], f"{row['n']}:{row['sum']}") for row in found}


_RUN = "run"


def _of_loads(
    spark: SparkSession, path: str, below: str, runs: Mapping[str, str], schema: T.StructType
) -> DataFrame:
    """The rows that given runs stored of given loads."""
    text = [T.StructField(name, T.StringType()) for name in (_RUN, LOAD)]
    schema = T.StructType([*[f for f in schema if f.name not in (_RUN, LOAD)], *text])
    if not runs:
        return spark.createDataFrame([], schema)
    folders = sorted({f"{path}/{run}{below}" for run in runs.values()})
    rows = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    place = F.concat_ws("/", F.lit("run"), _RUN, LOAD)
    wanted = [f"run/{run.partition('=')[2]}/{name}" for name, run in runs.items()]
    return rows.filter(place.isin(wanted))  # a filter of folders


_KEYS = T.StructType([T.StructField("key_hash", T.LongType())])
_QUARANTINE = f"/{OUTCOME}=quarantined"


def silver_update(
    bronze: DataFrame,
    rules: SilverRules,
    out: str,
    mark_col: str,
    buckets: int = 256,
) -> int:
    """Bring a stored refined layer up to the raw layer, load by load.

    Loads are told by ``mark_col``, numbers or text.  Each has a fingerprint, made from the files that
    its rows are in; it tells loads that are new, that were replaced, and that are gone.  Of the others
    only that column is read, and if there are none nothing is written.

    New loads are judged as in :func:`silver_build`: accepted rows are upserted into ``out/accepted``,
    where only partitions with changed keys are written, and quarantined rows are kept by load under
    ``out/judged``.  For each load the hashes of the keys it has accepted rows of are kept under
    ``out/keys``.  Where a load was replaced or is gone, these tell which keys it touched and which
    other loads have any of them; those loads are read again, and the keys are made anew from them.
    A key that no load has any more is removed.

    One small file switches to the new state last (``functions.versions``), so a run that died at any
    point changes nothing and may be repeated.  One writer at a time: of two, one is refused.
    Returns the number of partitions of accepted rows that were written.
    """
    spark = bronze.sparkSession
    at = versions.version(spark, out)
    fixed_buckets(out, at.state, buckets)
    taken: dict[str, list[str]] = at.state.get("loads", {})  # name -> fingerprint, run
    loads = _loads(bronze, mark_col)
    changed = [name for name, load in loads.items() if taken.get(name, [None])[0] != load.mark]
    stale = {
        name: run for name, (mark, run) in taken.items() if name not in loads or loads[name].mark != mark
    }
    if not changed and not stale:
        return 0
    kept = {name: run for name, (_, run) in taken.items() if name not in stale}
    keys, run = list(rules.keys), versions.new_run()

    def judged(names: Sequence[str]) -> DataFrame:
        some = bronze.filter(F.col(f"`{mark_col}`").isin([loads[name].value for name in names]))
        return _tagged(some, rules, [F.col(f"`{mark_col}`").cast("string").alias(LOAD)])

    tagged = judged(changed)
    tagged.write.partitionBy(OUTCOME, LOAD).parquet(f"{out}/judged/{run}")
    stored = spark.read.schema(tagged.schema).parquet(f"{out}/judged/{run}")
    sound = stored.filter(F.col(OUTCOME) == "accepted")
    index = sound.select(key_hash(keys).alias("key_hash"), LOAD).distinct().hint("rebalance", LOAD)
    index.write.partitionBy(LOAD).parquet(f"{out}/keys/{run}")
    accepted = _sides(stored).accepted.drop(LOAD)

    parts = at.state.get("parts", {})
    read_old = partial(
        versions.read_parts, spark, f"{out}/accepted", BUCKET, parts, accepted.schema
    )
    if not stale:
        touched = buckets_of(in_buckets(accepted, keys, buckets))
        merged = upsert(read_old(touched), accepted, keys, rules.order)
    else:
        before = _of_loads(spark, f"{out}/keys", "", stale, _KEYS).select("key_hash")
        after = _of_loads(spark, f"{out}/keys", "", dict.fromkeys(changed, run), _KEYS).select("key_hash")
        before.unionByName(after).distinct().write.parquet(f"{out}/touched/{run}")
        touching = spark.read.schema(_KEYS).parquet(f"{out}/touched/{run}")
        of_others = _of_loads(spark, f"{out}/keys", "", kept, _KEYS)
        others = of_others.join(touching, "key_hash", "left_semi").select(LOAD).distinct().collect()
        again = sound
        if others:  # no more than loads
            # Stored before it is read on: Spark would move a filter of the outcome below what makes it,
            # and judge a row several times.
            more = judged([row[0] for row in others]).drop("raw", "reasons")
            more.write.partitionBy(OUTCOME, LOAD).parquet(f"{out}/again/{run}")
            more = spark.read.schema(more.schema).parquet(f"{out}/again/{run}")
            more = more.filter(F.col(OUTCOME) == "accepted")
            again = again.drop("raw", "reasons").unionByName(more)
        names = accepted.columns
        hashed = unused_name(names, "_hash")
        touching = touching.withColumnRenamed("key_hash", hashed)
        mine = key_hash(keys) == F.col(hashed)
        again = _sides(again).accepted.select(*[F.col(f"`{c}`") for c in names])
        winners = dedup(again.join(touching, mine, "left_semi"), keys, rules.order)
        touched = buckets_of(touching.select(bucket_of(hashed, buckets).alias(BUCKET)))
        merged = read_old(touched).join(touching, mine, "left_anti").unionByName(winners)
    if touched:
        merged = in_buckets(merged, keys, buckets)
        parts = versions.store_parts(f"{out}/accepted", merged, BUCKET, touched, parts)
    marks = {name: taken[name] for name in kept} | {name: [loads[name].mark, run] for name in changed}
    versions.commit(spark, out, at, {"buckets": buckets, "parts": parts, "loads": marks})
    # What was judged sound is in the accepted rows, or was not the first of its key.
    storage.delete(spark, f"{out}/judged/{run}/{OUTCOME}=accepted")
    for name in ("touched", "again"):
        storage.delete(spark, f"{out}/{name}/{run}")
    folders = ("accepted", "judged", "keys", "touched", "again")
    versions.sweep(spark, out, [f"{out}/{name}" for name in folders])
    return len(touched)


def read_silver(bronze: DataFrame, rules: SilverRules, out: str) -> Silver:
    """The layer that :func:`silver_update` keeps; ``bronze`` is read for its columns only.

    Before the first load both sides are empty.
    """
    spark = bronze.sparkSession
    schema = _tagged(bronze, rules).schema
    sides = _sides(spark.createDataFrame([], schema))
    state = versions.version(spark, out).state
    accepted = versions.read_parts(
        spark, f"{out}/accepted", BUCKET, state.get("parts", {}), sides.accepted.schema
    )
    runs = {name: run for name, (_, run) in state.get("loads", {}).items()}
    runs = {
        name: run
        for name, run in runs.items()
        if storage.exists(spark, f"{out}/judged/{run}{_QUARANTINE}")
    }
    bad = sides.quarantined.schema
    quarantined = _of_loads(spark, f"{out}/judged", _QUARANTINE, runs, bad)
    return Silver(accepted, quarantined.select(*[F.col(f"`{c}`") for c in bad.names]))
