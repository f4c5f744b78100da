"""What changed between full copies of a table, found by sums of hashes.

Rows are dealt to buckets by their key.  A bucket has the sum of its rows' hashes, which does not
depend on their order, and a node has the sums of its buckets.  Two copies are compared from the nodes
down: only buckets whose sums differ are read, and only they are stored anew.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratawell.functions import storage, versions
from stratawell.functions.hashing import row_hash
from stratawell.functions.storage import unused_name
from stratawell.operators.incremental import BUCKET, in_buckets

NODE = "node__part"
#: Buckets below a node.
_FAN = 64
_LEAF = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("digest", T.StringType()),
        T.StructField("run", T.StringType()),
    ]
)


def _digest() -> Column:
    """A text of the number of rows and two sums of hashes; those of buckets add up to a node's."""
    return F.concat_ws(":", "n", "a", "b")


def _sums(rows: DataFrame, by: str) -> DataFrame:
    return rows.groupBy(by).agg(*[F.sum(name).alias(name) for name in ("n", "a", "b")])


def _leaves(spark: SparkSession, path: str, state: dict[str, Any], nodes: Sequence[str]) -> DataFrame:
    return versions.read_parts(spark, f"{path}/leaves", NODE, state.get("leaves", {}), _LEAF, nodes)


def _differing(tops: dict[str, str], others: dict[str, str]) -> list[str]:
    return sorted(node for node in {*tops, *others} if tops.get(node) != others.get(node))


def store_snapshot(df: DataFrame, keys: Sequence[str], path: str, buckets: int = 1024) -> int:
    """Keep a full copy of a table as the next version; returns its number, from 1.

    Buckets whose rows are those of the version before are not written again: the new version names
    the old files.  ``buckets`` is fixed by the first call; choose it so that one holds some ten
    megabytes.  ``df`` is read twice, so pass a stored table.  Any rows will do: NULL and repeated
    keys and repeated rows are kept.

    To the driver go the sums of each node, one for every 64 buckets.  A call that dies changes nothing
    and may be repeated (``functions.versions``).  One writer at a time.
    """
    spark, keys = df.sparkSession, list(keys)
    at = versions.version(spark, path)
    state = at.state
    how = {"keys": keys, "buckets": buckets, "schema": df.schema.json()}
    if state and {name: state[name] for name in how} != how:
        raise ValueError(f"{path} has copies of another table: {state['keys']}, {state['buckets']} buckets")
    dealt = in_buckets(df, keys, buckets)
    hashes = dealt.select(
        F.col(BUCKET).alias("bucket"),
        F.lit(1).alias("n"),
        *[row_hash(df, df.columns, seed).cast("decimal(20,0)").alias(c) for seed, c in ((1, "a"), (2, "b"))],
    )
    run = versions.new_run()
    work = f"{path}/work/{run}"
    node = F.floor(F.col("bucket") / _FAN).cast("string")
    _sums(hashes, "bucket").withColumn("node", node).write.parquet(f"{work}/sums")
    sums = spark.read.parquet(f"{work}/sums")
    tops = {row["node"]: row["digest"] for row in _sums(sums, "node").select("node", _digest().alias("digest")).collect()}
    nodes = _differing(tops, state.get("tops", {}))

    found = sums.filter(F.col("node").isin(nodes)).select("bucket", "node", _digest().alias("digest"))
    known = _leaves(spark, path, state, nodes).select(
        "bucket", F.col("digest").alias("old_digest"), F.col("run").alias("old_run")
    )
    same = F.col("digest") == F.col("old_digest")
    leaves = found.join(known, "bucket", "left").select(
        "bucket",
        "digest",
        F.when(same, F.col("old_run")).otherwise(run).alias("run"),
        F.col("node").alias(NODE),
    )
    leaves.write.parquet(f"{work}/leaves")
    leaves = spark.read.schema(leaves.schema).parquet(f"{work}/leaves")
    changed = leaves.filter(F.col("run") == run).select(F.col("bucket").alias(BUCKET))
    # There are no more of these than buckets.
    fresh = dealt.join(F.broadcast(changed), BUCKET, "left_semi")
    fresh.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/data/{run}")
    stored = versions.store_parts(f"{path}/leaves", leaves, NODE, nodes, state.get("leaves", {}))
    new = versions.commit(spark, path, at, {**how, "tops": tops, "leaves": stored})
    storage.delete(spark, work)
    return new.number


def _data(spark: SparkSession, path: str, places: Sequence[tuple[str, int]], schema: T.StructType) -> DataFrame:
    if not places:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/data/{run}/{BUCKET}={bucket}" for run, bucket in places]
    return spark.read.schema(schema).parquet(*folders)


def _schema(state: dict[str, Any]) -> T.StructType:
    return T._parse_datatype_json_string(state["schema"])


def read_snapshot(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """All rows of a version, by default the newest."""
    state = versions.version(spark, path, number).state
    if not state:
        raise ValueError(f"there is no copy in {path}")
    leaves = _leaves(spark, path, state, list(state["leaves"])).select("run", "bucket")
    return _data(spark, path, [tuple(row) for row in leaves.collect()], _schema(state))


def snapshot_changes(spark: SparkSession, path: str, old: int, new: int) -> DataFrame:
    """The rows that went and came from one version to another, with ``change``.

    A row that came under a key that lost none is an ``insert``, a row that went from a key that got
    none a ``delete``; otherwise they are ``update_from`` and ``update_to``.  Rows are counted: of a
    row that is there twice and then once, one went.  Rows are the same if two 64-bit hashes are.

    Nodes are compared by the sums in the two versions, then the buckets of nodes that differ; only
    the files of buckets that differ are read, and their rows meet in one shuffle by key.
    """
    before, after = (versions.version(spark, path, n).state for n in (old, new))
    schema, keys = _schema(after), after["keys"]
    nodes = _differing(before["tops"], after["tops"])
    sides = [
        _leaves(spark, path, state, nodes).select(
            "bucket", F.col("digest").alias(f"{side}_digest"), F.col("run").alias(f"{side}_run")
        )
        for side, state in (("old", before), ("new", after))
    ]
    differ = ~F.col("old_digest").eqNullSafe(F.col("new_digest"))
    buckets = sides[0].join(sides[1], "bucket", "full").filter(differ).collect()  # those that differ
    names = [unused_name(schema.names, name) for name in ("_net", "_a", "_b", "_row", "_both")]
    net, a, b, row, both = names
    parts = []
    for side, sign in (("old", -1), ("new", 1)):
        places = [(one[f"{side}_run"], one["bucket"]) for one in buckets if one[f"{side}_run"]]
        parts.append(_data(spark, path, sorted(places), schema).withColumn(net, F.lit(sign)))
    rows = parts[0].unionByName(parts[1])
    named = [F.col(f"`{k}`") for k in keys]
    hashes = [row_hash(rows, schema.names, seed).alias(name) for seed, name in ((1, a), (2, b))]
    whole = F.struct(*[F.col(f"`{c}`") for c in schema.names]).alias(row)
    counted = rows.select(*named, *hashes, whole, net).groupBy(*named, a, b)
    counted = counted.agg(F.sum(net).alias(net), F.first(row).alias(row))
    moved = counted.filter(F.col(net) != 0).select(*named, net, row)
    signs = moved.groupBy(*named).agg(F.min(net).alias(a), F.max(net).alias(b))
    theirs = [unused_name([*moved.columns, a, b, both], f"_{k}") for k in keys]
    updated = signs.filter((F.col(a) < 0) & (F.col(b) > 0)).select(
        *[F.col(f"`{k}`").alias(t) for k, t in zip(keys, theirs)], F.lit(True).alias(both)
    )
    same = reduce(
        lambda x, y: x & y, [F.col(f"`{k}`").eqNullSafe(F.col(t)) for k, t in zip(keys, theirs)]
    )
    each = moved.join(updated, same, "left")
    came = F.col(net) > 0
    kind = (
        F.when(came & F.col(both), "update_to")
        .when(came, "insert")
        .when(F.col(both), "update_from")
        .otherwise("delete")
    )
    copies = F.explode(F.sequence(F.lit(1), F.abs(F.col(net)).cast("int"))).alias(a)
    out = each.select(kind.alias("change"), F.col(row), copies)
    return out.select("change", *[F.col(row)[c].alias(c) for c in schema.names])
