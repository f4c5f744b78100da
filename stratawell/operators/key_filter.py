"""Append rows with new keys to a stored table, asking a stored filter before the table itself."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratawell.functions import storage, versions
from stratawell.functions.hashing import key_hash
from stratawell.functions.storage import unused_name
from stratawell.operators.incremental import BUCKET, buckets_of, fixed_buckets, in_buckets

#: Bits of a block, as Spark's bitmaps have them, and how many of them a key sets.
_BITS = 1 << 15
_SET = 4
#: Bits for each expected key; about 1.5 per cent of new keys then look known.
_BITS_OF_KEY = 10
#: Increments of the filter that are kept before they are merged.
_INCREMENTS = 8
_MAYBE = "maybe__part"
_FILTER = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("bits", T.BinaryType())])


def _block(keys: Sequence[str], blocks: int) -> Column:
    return F.pmod(key_hash(keys, 1), F.lit(blocks)).cast("int")


def _positions(keys: Sequence[str]) -> list[Column]:
    """The places of a key's bits in its block: fifteen bits each of one hash."""
    hashed = key_hash(keys, 2)
    return [
        F.call_function("shiftrightunsigned", hashed, F.lit(15 * i)).bitwiseAND(F.lit(_BITS - 1))
        for i in range(_SET)
    ]


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.call_function("getbit", value, (position % 8).cast("int")) == 1


def _bits_of(rows: DataFrame, keys: Sequence[str], blocks: int) -> DataFrame:
    """(block, bits) of the keys of some rows, put together in each task before the shuffle."""
    each = rows.select(_block(keys, blocks).alias("block"), F.explode(F.array(*_positions(keys))).alias("at"))
    return each.distinct().groupBy("block").agg(F.bitmap_construct_agg("at").alias("bits"))


def _stored_filter(spark: SparkSession, path: str, runs: list[str]) -> DataFrame:
    if not runs:
        return spark.createDataFrame([], _FILTER)
    stored = spark.read.schema(_FILTER).parquet(*[f"{path}/filter/{run}" for run in runs])
    return stored.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def append_new(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    expected_keys: int = 10_000_000,
    buckets: int = 256,
) -> int:
    """Append the rows whose key a stored table has not; returns the number of rows appended.

    The rows are those of :func:`~stratawell.operators.incremental.new_keys`: repeats within
    ``incoming`` are all kept, and so are rows with a NULL in the key.  Beside the table a blocked Bloom
    filter of its keys is kept, 10 bits for each of ``expected_keys``; more keys only make it less
    sharp.  Rows that the filter does not know are new; only keys of buckets for which it knows some
    are read and compared.  So the less of a load is known already, the less is read.

    ``keys``, ``expected_keys`` and ``buckets`` are fixed by the first call.  A call that dies changes
    nothing and may be repeated (``functions.versions``).  One writer at a time.  Read the table by
    :func:`~stratawell.sources.files.read_layer`.
    """
    keys = list(keys)
    at = versions.version(spark, path)
    state = at.state
    fixed_buckets(path, state, buckets)
    blocks = max(1, -(-expected_keys * _BITS_OF_KEY // _BITS))
    how = {"keys": keys, "blocks": blocks}
    if state and {name: state[name] for name in how} != how:
        raise ValueError(f"{path} is kept by the keys {state['keys']} in {state['blocks']} blocks")
    run = versions.new_run()
    taken = [*incoming.columns, BUCKET]
    block, bits, own = (unused_name(taken, name) for name in ("_block", "_bits", "_own"))
    whole = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
    known = _stored_filter(spark, path, state.get("filter", [])).select(
        F.col("block").alias(block), F.col("bits").alias(bits)
    )
    dealt = in_buckets(incoming, keys, buckets).withColumn(own, _block(keys, blocks))
    every = reduce(lambda a, b: a & b, [_is_set(F.col(bits), at_) for at_ in _positions(keys)])
    maybe = F.coalesce(whole & every, F.lit(False)).cast("int").alias(_MAYBE)
    columns = [F.col(f"`{c}`") for c in incoming.columns]
    marked = dealt.join(known, F.col(own) == F.col(block), "left").select(*columns, BUCKET, maybe)
    marked.write.partitionBy(_MAYBE).parquet(f"{path}/work/{run}")
    marked = spark.read.schema(marked.schema).parquet(f"{path}/work/{run}")

    maybes = marked.filter(F.col(_MAYBE) == 1).drop(_MAYBE)
    parts: dict[str, list[str]] = state.get("parts", {})
    stored = versions.read_parts(spark, path, BUCKET, parts, incoming.schema, buckets_of(maybes))
    stored = stored.select(*[F.col(f"`{k}`") for k in keys]).distinct()
    new = marked.filter(F.col(_MAYBE) == 0).drop(_MAYBE).unionByName(maybes.join(stored, keys, "left_anti"))
    new.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/{run}")
    found = [n.partition("=")[2] for n in storage.entries(spark, f"{path}/{run}") if n.startswith(f"{BUCKET}=")]
    if not found:
        storage.delete(spark, f"{path}/work/{run}")
        return 0
    added = versions.read_parts(spark, path, BUCKET, dict.fromkeys(found, run), incoming.schema)
    increment = versions.new_run()
    _bits_of(added.filter(whole), keys, blocks).write.parquet(f"{path}/filter/{increment}")
    filters = [*state.get("filter", []), increment]
    if len(filters) > _INCREMENTS:
        merged = versions.new_run()
        _stored_filter(spark, path, filters).write.parquet(f"{path}/filter/{merged}")
        filters = [merged]
    parts = parts | {part: [*parts.get(part, []), run] for part in found}
    rows = added.count()
    new_state = {**how, "column": BUCKET, "buckets": buckets, "parts": parts, "filter": filters}
    versions.commit(spark, path, at, new_state)
    versions.sweep(spark, path, [path, f"{path}/filter", f"{path}/work"])
    storage.delete(spark, f"{path}/work/{run}")
    return rows
