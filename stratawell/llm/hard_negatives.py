"""Hard negatives of anchors, by lists of coordinates in buckets of vectors of like length.

Vectors are dealt to buckets from the longest to the shortest.  A bucket has its vectors scaled to
length one and, for each coordinate, the order of their values.  An anchor that seeks products from
some number on can pass by a bucket whose longest vector is too short for it.  Otherwise that number
bounds the angle to what it seeks, and so the values that its largest coordinates, the focus, may have
there: of the stretches of the sorted lists with such values the shortest is taken, and what lies
outside any other is struck out.  The rest is compared in whole numbers.

Buckets are met in rounds, each of several times as many as the last; what is found in one raises the
numbers from which products are sought in the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratawell.llm.common import Steps

#: Vectors of a bucket, on average or fewer.
BUCKET = 4096
#: Coordinates whose lists are looked up.
FOCUS = 4
#: How many times as many buckets each round has.
GROWTH = 8
#: Added to angles, against rounding.
SLACK = 1e-6

LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component; NULL if the vector or a component is NULL or not finite."""
    x = vector.cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.when(finite, F.transform(x, lambda v: F.floor(v * scale).cast("bigint")))


_INDEX = (
    "bucket int, size int, longest double, ids binary, keys binary, labels binary, "
    "vectors binary, lists binary"
)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bucket of a partition, as a row for each size of its vectors."""
    parts: dict[int, list[list[np.ndarray]]] = {}
    for batch in batches:
        sizes = batch.column("size").to_numpy()
        table = pa.Table.from_batches([batch])
        for size in np.unique(sizes).tolist():
            some = table.filter(pa.array(sizes == size)).combine_chunks()
            vectors = some.column("vector").combine_chunks().flatten().to_numpy()
            columns = [some.column(name).to_numpy() for name in ("id", "key", "label")]
            parts.setdefault(size, []).append([*columns, vectors.reshape(len(some), size)])
    rows = []
    for size, some in parts.items():
        ids, keys, labels, vectors = (np.concatenate(x) for x in zip(*some))
        lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        lists = np.argsort(_units(vectors, lengths), axis=0, kind="stable").T.astype(np.int32)
        cells = [ids, keys, labels, vectors, np.ascontiguousarray(lists)]
        rows.append((size, float(lengths.max()), *(cell.tobytes() for cell in cells)))
    if rows:
        bucket = TaskContext.get().partitionId()
        kinds = [pa.int32(), pa.float64(), *[pa.binary()] * 5]
        columns = [pa.array([bucket] * len(rows), pa.int32())]
        columns += [pa.array(cells, kind) for cells, kind in zip(zip(*rows), kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _INDEX.split(", ")])


def _units(vectors: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return vectors / np.where(lengths > 0, lengths, 1)[:, None]


class Bucket:
    """Vectors of one size and of like length, with their coordinate lists."""

    def __init__(self, row: dict):
        self.place = row["bucket"], row["size"]
        self.longest = row["longest"]
        self.ids, self.keys, self.labels, vectors = (
            np.frombuffer(row[name], dtype=np.int64) for name in ("ids", "keys", "labels", "vectors")
        )
        n, size = len(self.ids), row["size"]
        self.vectors = vectors.reshape(n, size)
        self.lists = np.frombuffer(row["lists"], dtype=np.int32).reshape(size, n)
        self.most = float(np.abs(self.vectors).max(initial=0))
        self.doubles = self.vectors.astype(np.float64)
        self.units = _units(self.vectors, np.sqrt((self.doubles**2).sum(axis=1)))
        self.sorted = np.take_along_axis(self.units.T, self.lists, axis=1)

    def candidates(self, query: np.ndarray, floor: int) -> np.ndarray | None:
        """Rows that may have a product of ``floor`` or more; None for all."""
        if floor <= 0:
            return None
        length = float(np.sqrt((query.astype(np.float64) ** 2).sum()))
        if length * self.longest * (1 + SLACK) < floor:
            return np.empty(0, dtype=np.int32)
        turn = np.arccos(min(1.0, floor / (length * self.longest))) + SLACK
        unit = query / length
        focus = np.argsort(-np.abs(unit))[:FOCUS]
        angles = np.arccos(np.clip(unit[focus], -1, 1))
        least = np.cos(np.minimum(angles + turn, np.pi)) - SLACK
        most = np.cos(np.maximum(angles - turn, 0)) + SLACK
        ranges = [
            (int(np.searchsorted(self.sorted[f], a)), int(np.searchsorted(self.sorted[f], b, "right")))
            for f, a, b in zip(focus, least, most)
        ]
        shortest = min(range(len(ranges)), key=lambda i: ranges[i][1] - ranges[i][0])
        first, past = ranges[shortest]
        if 2 * (past - first) > len(self.ids):
            return None  # comparing all is less work
        rows = self.lists[focus[shortest]][first:past]
        for f, a, b in zip(focus, least, most):
            values = self.units[rows, f]
            rows = rows[(values >= a) & (values <= b)]
        return rows

    def search(self, query: np.ndarray, key: int, label: int, same: bool, bands: list, k: int) -> list:
        """(mark, product, id, key) of the first k rows in each band (mark, low, high).

        Rows have the label if ``same``, otherwise another; the row ``key`` is none of them.
        """
        rows = self.candidates(query, min(low for _, low, _ in bands))
        if rows is None:
            fits = (self.labels == label) == same
            rows = np.flatnonzero(fits & (self.keys != key))
        else:
            rows = rows[((self.labels[rows] == label) == same) & (self.keys[rows] != key)]
        if not len(rows):
            return []
        # Doubles where no sum can leave the whole numbers they hold, as they multiply faster.
        small = self.most * float(np.abs(query).max(initial=0)) * len(query) < 2**53
        products = (self.doubles if small else self.vectors)[rows] @ (
            query.astype(np.float64) if small else query
        )
        products = products.astype(np.int64)
        found = []
        for mark, low, high in bands:
            inside = np.flatnonzero((products >= low) & (products <= high))
            if len(inside) > 8 * k:
                least = np.partition(products[inside], len(inside) - k)[len(inside) - k]
                inside = inside[products[inside] >= least]
            some = rows[inside]
            order = np.lexsort((self.keys[some], self.ids[some], -products[inside]))[:k]
            chosen = some[order]
            found += zip(
                [mark] * len(chosen),
                products[inside][order].tolist(),
                self.ids[chosen].tolist(),
                self.keys[chosen].tolist(),
            )
        return found


_FOUND = "key bigint, mark bigint, score bigint, vec_id bigint, vec_key bigint"


def _meet(same: bool, k: int):
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = None
        for batch in batches:
            of_bucket = [c for c in batch.schema.names if c not in ("key", "label", "vector", "bands")]
            vectors = batch.column("vector")
            kinds = batch.column("asks").to_pylist()
            places = list(zip(batch.column("bucket").to_pylist(), batch.column("size").to_pylist()))
            keys, labels = batch.column("key").to_pylist(), batch.column("label").to_pylist()
            rows: list[tuple] = []
            for i, asks in enumerate(kinds):
                if not asks:
                    bucket = Bucket({c: batch.column(c)[i].as_py() for c in of_bucket})
                elif bucket is not None and bucket.place == places[i]:
                    query = vectors[i].values.to_numpy()
                    bands = [tuple(b.values()) for b in batch.column("bands")[i].as_py()]
                    found = bucket.search(query, keys[i], labels[i], same, bands, k)
                    rows += [(keys[i], *one) for one in found]
            columns = list(zip(*rows)) if rows else [()] * 5
            names = [c.split()[0] for c in _FOUND.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return meet


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("key", "mark").orderBy(F.desc("score"), "vec_id", "vec_key")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _raised(band: Column) -> Column:
    """A band from the last product on that still counts in it."""
    floor = F.try_element_at("floors", band["mark"])
    return F.struct(
        band["mark"].alias("mark"), F.greatest(band["low"], floor).alias("low"), band["high"].alias("high")
    )


def _search(steps: Steps, index: DataFrame, asking: DataFrame, same: bool, k: int) -> DataFrame:
    """The first k rows in each band of each asking row: (key, mark, rank, score, vec_id, vec_key)."""
    buckets = (index.agg(F.max("bucket")).first()[0] or 0) + 1
    best, first, wide = None, 0, 1
    while first < buckets:
        past = min(buckets, first + wide)
        asks = asking
        if best is not None:
            floors = best.groupBy("key", "mark").agg(
                F.count(F.lit(1)).alias("n"), F.min("score").alias("floor")
            )
            floors = floors.filter(F.col("n") >= k).groupBy("key")
            floors = floors.agg(
                F.map_from_entries(F.collect_list(F.struct("mark", "floor"))).alias("floors")
            )
            raised = F.transform("bands", _raised)
            asks = asking.join(floors, "key", "left").withColumn("bands", raised).drop("floors")
        place = F.sequence(F.lit(first), F.lit(past - 1))
        asks = asks.select("*", F.explode(place).alias("bucket"), F.lit(True).alias("asks"))
        here = index.filter(F.col("bucket").between(first, past - 1))
        both = here.withColumn("asks", F.lit(False)).unionByName(asks, allowMissingColumns=True)
        # A bucket comes first, and then what asks there.
        met = (
            both.repartition("bucket", "size")
            .sortWithinPartitions("bucket", "size", "asks")
            .mapInArrow(_meet(same, k), _FOUND)
        )
        if best is not None:
            met = met.unionByName(best.drop("rank"))
        best = steps.save(_first(met, k))
        first, wide = past, wide * GROWTH
    return best


def _floor_of(number: Column, by: int) -> Column:
    """number / by, rounded down, by way of decimals that hold any such number."""
    number = number.cast("decimal(38,0)")
    return ((number - F.pmod(number, F.lit(by))) / F.lit(by)).cast("bigint")


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    most: int = 100,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components count as floor(scale * x), and the score of two rows is their inner product.  The
    positives of an anchor are the first other rows with its label, its negatives for a positive the
    first rows of other labels with a score of ``least`` to ``most`` per cent of the positive's,
    ends included.  Higher scores come first, then smaller ids; ``rank`` counts the negatives of a
    positive from 1.  A positive with a score below 0 has none, unless both per cents are the same.

    Rows with a NULL id or label, a NULL vector, or NULL or non-finite components take no part.
    Vectors are compared with those as long.  Vectors of zeros or without components have the score
    0 with all.  Repeated rows are rows of their own: each may be a positive or a negative, and an
    anchor comes as often.  Labels are whole numbers.  Scores are exact; vectors so large that one
    might not fit a bigint are refused.  Other columns are ignored, no rows give no rows.
    """
    steps = Steps(vectors.sparkSession)
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"),
        label.cast("bigint").alias("label"),
        whole_numbers(F.col(vector_col), scale).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    ).filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    rows = steps.save(
        rows.withColumn("key", F.monotonically_increasing_id()).withColumn("size", F.size("vector"))
    )
    highest = F.greatest(F.array_max("vector").cast("double"), -F.array_min("vector").cast("double"))
    n, size, high = rows.agg(F.count(F.lit(1)), F.max("size"), F.max(highest)).first()
    if float(high or 0) ** 2 * max(size or 0, 1) >= 2**63:
        raise ValueError(f"products of components up to {high} may not fit a bigint")

    length = F.aggregate(
        "vector", F.lit(0.0), lambda total, v: total + v.cast("double") * v.cast("double")
    )
    dealt = rows.repartitionByRange(max(1, -(-n // BUCKET)), F.desc(length), F.xxhash64("key"))
    index = steps.save(
        dealt.select("id", "key", "label", "size", "vector").mapInArrow(_index, _INDEX)
    )

    anchors = rows.filter("anchor").select("key", "size", "label", "vector")
    everything = F.struct(
        F.lit(0).cast("bigint").alias("mark"),
        F.lit(LOWEST).cast("bigint").alias("low"),
        F.lit(HIGHEST).cast("bigint").alias("high"),
    )
    asking = steps.save(anchors.withColumn("bands", F.array(everything)))
    own = _search(steps, index, asking, True, positives).select(
        "key", F.col("score").alias("mark"), F.col("vec_id").alias("positive_id"), "vec_key"
    )

    mark = F.col("mark").cast("decimal(20,0)")
    band = F.struct(
        "mark",
        (-_floor_of(-mark * least, 100)).alias("low"),
        _floor_of(mark * most, 100).alias("high"),
    )
    bands = (
        own.select("key", band.alias("band"))
        .filter("band.low <= band.high")
        .groupBy("key")
        .agg(F.sort_array(F.collect_set("band")).alias("bands"))
    )
    asking = steps.save(anchors.join(bands, "key"))
    others = _search(steps, index, asking, False, negatives).select(
        "key",
        "mark",
        "rank",
        F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    ids = rows.filter("anchor").select("key", F.col("id").alias("anchor_id"))
    return (
        own.join(others, ["key", "mark"])
        .join(ids, "key")
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            "negative_id",
            F.col("mark").alias("positive_score"),
            "negative_score",
        )
    )
