"""Near copies among vectors by iterative quantisation and multi-index Hamming tables.

A rotation is learned that makes the signs of the rotated vectors good binary codes.  A code is
cut into short strings, and vectors of one label meet in a table for each string they share.  Of
those that meet, pairs whose codes are close are ranked by the cosine of the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratawell.llm.common import Steps, lowest_hashes
from stratawell.llm.components import components

#: Vectors that the rotation is learned on: those with the smallest hashes.
SAMPLE = 4096
BITS = 64
TABLE_BITS = 8
#: Codes may differ in this share of their bits, or more of few bits, for their vectors to be compared.
NEAR_SHARE = 0.375
LEARNING_ROUNDS = 50
#: Vectors of one table entry compared in one piece; fuller entries are cut into such blocks.
BLOCK = 512


class Rotation:
    """Codes of vectors: signs after centring, principal components and a learned rotation."""

    def __init__(self, sample: np.ndarray, bits: int):
        self.mean = sample.mean(axis=0)
        centred = sample - self.mean
        _, axes = np.linalg.eigh(centred.T @ centred)
        axes = axes[:, ::-1][:, :bits]
        seen = centred @ axes
        turn, _ = np.linalg.qr(np.random.default_rng(0).standard_normal((axes.shape[1],) * 2))
        for _ in range(LEARNING_ROUNDS):
            left, _, right = np.linalg.svd(np.where(seen @ turn >= 0, 1.0, -1.0).T @ seen)
            turn = (left @ right).T
        self.axes = axes @ turn
        self.bits = self.axes.shape[1]

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Each code in one unsigned 64-bit number."""
        signs = (vectors - self.mean) @ self.axes >= 0
        padded = np.zeros((len(vectors), 64), dtype=bool)
        padded[:, : self.bits] = signs
        return np.packbits(padded, axis=1, bitorder="little").view("<u8")[:, 0]


def unit(vectors: np.ndarray) -> np.ndarray:
    # scaled first, so that neither tiny nor huge components leave the range of doubles
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def usable(vector: Column) -> Column:
    """Not NULL, not zero, and with finite components only."""
    x = vector.cast("array<double>")
    finite = F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(x, lambda v: v != 0), F.lit(False))


def _learn(classes: DataFrame, size: int, count: int) -> Rotation:
    place = F.xxhash64("vector")
    rows = (
        classes.filter(F.size("vector") == size)
        .filter(lowest_hashes(place, count, SAMPLE))
        .orderBy(place)
        .select("vector")
        .limit(SAMPLE)
        .collect()
    )
    return Rotation(unit(np.array([row["vector"] for row in rows], dtype=np.float64)), BITS)


def _entries(classes: DataFrame, rotations: dict[int, Rotation]) -> DataFrame:
    """Each class in each of its tables: (label, size, slot, string, class, n, code, vector)."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            sizes = np.array([len(v) for v in batch.column("vector")])
            codes = np.zeros(len(sizes), dtype=np.uint64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                vectors = unit(_matrix(batch.column("vector").take(pa.array(at))))
                codes[at] = rotations[size].codes(vectors)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(codes.view(np.int64))], names=[*batch.schema.names, "code"]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in classes.schema)
    coded = classes.mapInArrow(batches, f"{schema}, code bigint")
    slots = F.sequence(F.lit(0), F.lit(BITS // TABLE_BITS - 1))
    strings = F.transform(
        slots,
        lambda slot: F.struct(
            slot.alias("slot"),
            F.call_function("shiftrightunsigned", F.col("code"), slot * TABLE_BITS)
            .bitwiseAND(F.lit((1 << TABLE_BITS) - 1))
            .alias("string"),
        ),
    )
    return coded.select("*", F.size("vector").alias("size"), F.inline(strings))


def _blocks(steps: Steps, entries: DataFrame) -> DataFrame:
    """Entries of fuller tables cut into blocks, which meet two by two."""
    key = ["label", "size", "slot", "string"]
    full = steps.save(
        entries.groupBy(*key)
        .count()
        .filter(F.col("count") > BLOCK)
        .select(*key, F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    )
    one = F.coalesce("blocks", F.lit(1))
    mine = F.pmod(F.xxhash64("class"), one).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), one - 1),
        lambda other: F.struct(
            F.least(mine, other).alias("a"), F.greatest(mine, other).alias("b")
        ),
    )
    return (
        entries.join(full, key, "left")
        .select(*key, "class", "n", "code", "vector", mine.alias("block"), F.explode(pairs).alias("pair"))
        .groupBy(*key, "pair")
        .agg(F.collect_list(F.struct("class", "n", "code", "vector", "block")).alias("members"))
        .filter(F.size("members") > 1)
        .select("slot", "pair", "members")
    )


def _first_shared(differ: np.ndarray, slot: int) -> np.ndarray:
    """Whether the table is the first in which the codes meet."""
    first = np.ones(len(differ), dtype=bool)
    for earlier in range(slot):
        mask = np.uint64(((1 << TABLE_BITS) - 1) << (earlier * TABLE_BITS))
        first &= (differ & mask) != 0
    return first


def _radius(bits: int, least: float) -> int:
    """In how many bits codes may differ; few bits are wrong by chance more often than many.

    A bit differs with the angle's share of a half turn; three deviations are added to what is expected
    of the largest angle that links.
    """
    chance = np.arccos(min(1.0, max(-1.0, least))) / np.pi
    likely = chance * bits + 3 * np.sqrt(chance * (1 - chance) * bits) + 1
    return min(bits, max(int(NEAR_SHARE * bits), int(likely)))


def _near_pairs(codes, units, blocks, pair, slot, bits, least):
    """Pairs of one piece whose cosine is at least ``least``, each only where it meets first."""
    left = np.flatnonzero(blocks == pair["a"])
    right = left if pair["a"] == pair["b"] else np.flatnonzero(blocks == pair["b"])
    differ = codes[left][:, None] ^ codes[right][None, :]
    close = np.bitwise_count(differ) <= bits
    if left is right:
        close &= np.tri(len(left), k=-1, dtype=bool).T
    i, j = np.nonzero(close)
    first = _first_shared(differ[i, j], slot)
    i, j = left[i[first]], right[j[first]]
    keep = np.zeros(len(i), dtype=bool)
    for at in range(0, len(i), 1 << 16):
        part = slice(at, at + (1 << 16))
        keep[part] = np.einsum("ij,ij->i", units[i[part]], units[j[part]]) >= least
    return i[keep], j[keep]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest member of each member's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _links(pieces: DataFrame, least: float) -> DataFrame:
    """(class, links, root): links found in a piece, and a member of the same component there."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out = [[], [], []]
            for slot, pair, members in zip(
                batch.column("slot").to_pylist(),
                batch.column("pair").to_pylist(),
                batch.column("members"),
            ):
                member = members.values
                classes = member.field("class").to_numpy()
                order = np.argsort(classes)  # the smallest member then has the smallest class
                member, classes = member.take(pa.array(order)), classes[order]
                vectors = _matrix(member.field("vector"))
                codes = member.field("code").to_numpy().view(np.uint64)
                blocks, n = member.field("block").to_numpy(), member.field("n").to_numpy()
                bits = _radius(min(BITS, vectors.shape[1]), least)
                i, j = _near_pairs(codes, unit(vectors), blocks, pair, slot, bits, least)
                if len(i):
                    size = len(classes)
                    links = np.bincount(i, n[j], size) + np.bincount(j, n[i], size)
                    root = _roots(size, i, j)
                    linked = np.flatnonzero(links)
                    out[0].append(classes[linked])
                    out[1].append(links[linked].astype(np.int64))
                    out[2].append(classes[root[linked]])
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in out], names=["class", "links", "root"]
                )

    return pieces.mapInArrow(batches, "class bigint, links bigint, root bigint")


def vector_groups(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    least: float = 0.93,
) -> DataFrame:
    """(id_col, n_links, component_id, kept) of each row.

    Rows link if their labels are equal and not NULL, their vectors are equally long and the
    cosine, in double precision, is ``least`` or more.  Equal vectors of a label are one class and
    always link.  ``n_links`` counts other rows linked directly, ``component_id`` is the smallest
    id reachable, the row's own included, and ``kept`` says whether that is its own.  A vector that
    is NULL, empty or zero, or holds NULL or non-finite components, links with nothing.  A row with
    a NULL id links too; its id is never the smallest, and it is kept only if it is alone.
    Repeated rows are rows of their own.  Other columns are ignored; no rows give no rows.
    """
    steps = Steps(vectors.sparkSession)
    rows = steps.save(
        vectors.select(
            F.col(id_col).alias("id"),
            F.col(label_col).alias("label"),
            F.when(usable(F.col(vector_col)), F.col(vector_col)).alias("vector"),
        )
    )
    one = rows.filter("label IS NOT NULL AND vector IS NOT NULL").groupBy("label", "vector")
    classes = steps.save(
        one.agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least")).withColumn(
            "class", F.monotonically_increasing_id()
        )
    )
    # one row, and one rotation, for each length that vectors have
    sizes = classes.groupBy(F.size("vector").alias("size")).count().collect()
    rotations = {row["size"]: _learn(classes, row["size"], row["count"]) for row in sizes}
    entries = steps.save(_entries(classes.drop("least"), rotations))
    found = steps.save(_links(_blocks(steps, entries), least))
    steps.drop(entries)
    edges = found.select(
        F.least("class", "root").alias("lo"), F.greatest("class", "root").alias("hi")
    )
    node = components(steps, edges)
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    member = steps.save(
        classes.join(node, F.col("class") == F.col("node"), "left")
        .join(links, "class", "left")
        .select(
            "label",
            "vector",
            "least",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "class").alias("component"),
        )
    )
    smallest = member.groupBy("component").agg(F.min("least").alias("component_id"))
    named = steps.save(member.join(smallest, "component").drop("component", "least"))
    own = F.coalesce("component_id", F.when(F.col("n_links").isNull(), F.col("id")))
    alone = F.coalesce("n_links", F.lit(0)) == 0
    return rows.join(named, ["label", "vector"], "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        own.alias("component_id"),
        F.coalesce(F.col("id") == own, alone).alias("kept"),
    )
