"""Exact search for the vectors with the largest inner products, by a KD-tree for each shard.

Vectors are dealt to shards of a bounded size.  Each shard builds a tree by median splits along
the widest side, with the tight box of what lies in each node.  A query takes the nodes in the
order of the largest product that their boxes allow, and stops where that falls below its k-th
best product so far.  The first shard is searched first; its k-th products go along with the
queries to all others, so these start with a bound.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratawell.llm.common import Steps

#: Vectors of a shard, queries that meet it at a time, and vectors of a leaf, on average or at most.
SHARD = 8192
QUERIES = 4096
LEAF = 128
SCALE = 1024


def whole_numbers(vector: Column) -> Column:
    """floor(1024 * x) of each component; NULL if the vector or a component is NULL or not finite."""
    x = vector.cast("array<double>")
    finite = F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )
    return F.when(finite, F.transform(x, lambda v: F.floor(v * SCALE).cast("bigint")))


class Node:
    """A box of the tree, with the smallest id in it; a leaf has rows, others have children."""

    __slots__ = ("low", "high", "least_id", "rows", "children")

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, leaf: int):
        inside = vectors[rows]
        self.low, self.high = inside.min(axis=0), inside.max(axis=0)
        self.least_id = int(ids[rows].min())
        self.rows, self.children = rows, ()
        if len(rows) > leaf:
            side = int((self.high - self.low).argmax())
            if self.high[side] > self.low[side]:
                half = len(rows) // 2
                order = np.argpartition(inside[:, side], half)
                halves = rows[order[:half]], rows[order[half:]]
                self.children = tuple(Node(vectors, ids, part, leaf) for part in halves)
                self.rows = None

    def bound(self, query: np.ndarray) -> int:
        """No vector in the box has a larger product."""
        return int(np.maximum(query * self.low, query * self.high).sum())


class Tree:
    """The KD-tree of a shard.  ids decide ties: of equal products the smaller ids count."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, keys: np.ndarray, leaf: int = LEAF):
        self.vectors, self.ids, self.keys = vectors, ids, keys
        self.root = Node(vectors, ids, np.arange(len(ids)), leaf)

    def search(self, query: np.ndarray, own: int, k: int, floor: int | None) -> list[tuple]:
        """The best k of (product, id, key), without the row ``own``, none below ``floor``."""
        best: list[tuple[int, int, int]] = []  # as (-product, id, key), sorted
        waiting = [(-self.root.bound(query), 0, self.root)]
        pushed = 0
        while waiting:
            turned, _, node = heapq.heappop(waiting)
            if floor is not None and -turned < floor:
                break
            if len(best) == k and (turned, node.least_id) > best[-1][:2]:
                if turned > best[-1][0]:
                    break
                continue  # equal products at most, with larger ids only
            for child in node.children:
                pushed += 1
                heapq.heappush(waiting, (-child.bound(query), pushed, child))
            if node.rows is not None:
                products = self.vectors[node.rows] @ query
                least = -best[-1][0] if len(best) == k else floor
                good = node.rows if least is None else node.rows[products >= least]
                if least is not None:
                    products = products[products >= least]
                if len(good):
                    found = zip((-products).tolist(), self.ids[good].tolist(), self.keys[good].tolist())
                    best = heapq.nsmallest(k, [*best, *(x for x in found if x[2] != own)])
        return [(-turned, one, key) for turned, one, key in best]


def _flat(column: pa.ChunkedArray, n: int) -> np.ndarray:
    values = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.int64).reshape(n, -1)


def _exact_type(vectors: np.ndarray, queries: np.ndarray) -> type:
    """Doubles where no sum can leave the whole numbers they hold, as they multiply faster.

    Where sums may not fit 64 bits, Python's own numbers.
    """
    most = [float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (vectors, queries)]
    largest = most[0] * most[1] * vectors.shape[1]
    return np.float64 if largest < 2**53 else np.int64 if largest < 2**62 else object


_FOUND = "query_key bigint, query_id bigint, vec_id bigint, vec_key bigint, score bigint"


def _search(k: int, leaf: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if left.num_rows and right.num_rows:
            vectors = _flat(left.column("vector"), left.num_rows)
            queries = _flat(right.column("vector"), right.num_rows)
            kind = _exact_type(vectors, queries)
            ids = left.column("id").to_numpy()
            tree = Tree(vectors.astype(kind), ids, left.column("key").to_numpy(), leaf)
            asked = zip(
                queries.astype(kind),
                right.column("key").to_pylist(),
                right.column("id").to_pylist(),
                right.column("floor").to_pylist(),
            )
            for query, key, one, floor in asked:
                for score, vec, vec_key in tree.search(query, key, k, floor):
                    rows.append((key, one, vec, vec_key, int(score)))
        if any(abs(row[4]) >= 1 << 63 for row in rows):
            raise ValueError("a product that is among the largest does not fit a bigint")
        columns = list(zip(*rows)) if rows else [()] * 5
        names = ["query_key", "query_id", "vec_id", "vec_key", "score"]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    return search


def _meet(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    on = ["size", "shard", "block"]
    return vectors.groupBy(*on).cogroup(queries.groupBy(*on)).applyInArrow(_search(k, LEAF), _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_key").orderBy(F.desc("score"), "vec_id", "vec_key")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def largest_products(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest products of each query row, ties by id.

    Components count as floor(1024 * x).  Candidates of a query are all rows but its own whose
    vectors are as long.  Rows whose vector is NULL, or holds NULL or non-finite components, and
    rows with a NULL id take no part.  Repeated rows are rows of their own: each is a candidate,
    and each query among them gets its own results.  Fewer candidates than k give fewer rows.
    Products are exact; one that is among the largest and does not fit a bigint fails the query, as do
    components beyond one.  Other columns are ignored.
    """
    steps = Steps(vectors.sparkSession)
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"),
        whole_numbers(F.col(vector_col)).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).filter("id IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0")
    rows = steps.save(
        rows.withColumn("key", F.monotonically_increasing_id()).withColumn("size", F.size("vector"))
    )
    beyond = F.exists("vector", lambda v: (v >= F.lit((1 << 63) - 1)) | (v <= F.lit(-(1 << 63))))
    counts = rows.agg(F.count(F.lit(1)), F.count_if("asks"), F.count_if(beyond)).first()
    if counts[2]:
        raise ValueError(f"{counts[2]} vectors have components that do not fit a bigint")
    shards = max(1, -(-counts[0] // SHARD))
    blocks = max(1, -(-counts[1] // QUERIES))
    sharded = rows.select(
        "size",
        F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        "id",
        "key",
        "vector",
    )
    asking = steps.save(
        rows.filter("asks").select(
            "size",
            F.pmod(F.xxhash64("key", F.lit(1)), F.lit(blocks)).cast("int").alias("block"),
            "id",
            "key",
            "vector",
        )
    )
    no_floor = F.lit(None).cast("bigint")
    first = asking.withColumn("shard", F.lit(0)).withColumn("floor", no_floor)
    pilot = steps.save(_best(_meet(sharded.filter("shard = 0"), first, k), k).drop("rank"))
    floors = pilot.groupBy("query_key").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor")
    )
    others = (
        asking.join(floors, F.col("key") == F.col("query_key"), "left")
        .drop("query_key")
        .withColumn("shard", F.explode(F.sequence(F.lit(1), F.lit(max(1, shards - 1)))))
    )
    rest = _meet(sharded.filter("shard > 0"), others, k)
    found = steps.save(_best(pilot.unionByName(rest), k))
    return found.select("query_id", "rank", "vec_id", "score")
