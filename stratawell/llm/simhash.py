"""Near copies by SimHash fingerprints, found through a pigeonring of segments.

Two fingerprints within ``distance`` bits, cut into a ring of ``SEGMENTS`` segments, have a segment
from which every chain of consecutive segments stays within its share of the distance: the first
``l`` of them differ in at most ``l * distance / SEGMENTS`` bits in total.  With five segments and
four bits, the chain starts with an equal segment, and the second segment differs in one bit at
most, so one of its halves is equal too.  That segment and half are the key under which
fingerprints meet; the longer chains are checked before the full distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratawell.llm.common import Steps, unused
from stratawell.llm.components import components

SEGMENTS = 5
#: Fingerprints of one key compared in one piece; fuller keys are cut into blocks of this size.
BLOCK = 4096
#: First bit of each segment, and the end.
BOUNDS = [round(i * 64 / SEGMENTS) for i in range(SEGMENTS + 1)]
MAX_BITS = SEGMENTS - 1


def fingerprint(text: str | None, shingle_words: int) -> int:
    """The 64 bits that over half of the hashes of the text's shingles have set; 0 without words."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    tails = [words[i:] for i in range(1, shingle_words)]
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(words, *tails))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(x, 42) for x in shingles), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    """(id_col, fp) of each row, fp being the 64 bits as a signed long."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            texts = batch.column(1)
            found = np.array(
                [fingerprint(t.as_py(), shingle_words) for t in texts], dtype=np.uint64
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], names=[id_col, "fp"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(batches, f"`{id_col}` {kind}, fp bigint")


def _masks() -> list[list[int]]:
    """For each first segment, the bits of the chains of 1, 2, ... segments from there."""
    one = [((1 << BOUNDS[i + 1]) - 1) ^ ((1 << BOUNDS[i]) - 1) for i in range(SEGMENTS)]
    chains = []
    for first in range(SEGMENTS):
        bits, chain = 0, []
        for length in range(SEGMENTS):
            bits |= one[(first + length) % SEGMENTS]
            chain.append(bits)
        chains.append(chain)
    return chains


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _keyed(fps: DataFrame) -> DataFrame:
    """(first, half, bits, fp): each fingerprint under each segment with each half of the next."""
    keys = []
    for first, chain in enumerate(_masks()):
        second = chain[1] & ~chain[0]
        low = second & -second
        middle = low << (second.bit_count() // 2)
        for half, bits in enumerate((second & (middle - 1), second & ~(middle - 1))):
            mask = F.lit(_signed(chain[0] | bits))
            keys.append(
                F.struct(
                    F.lit(2 * first + half).alias("slot"),
                    F.col("fp").bitwiseAND(mask).alias("bits"),
                )
            )
    return fps.select("fp", F.inline(F.array(*keys)))


def _forest(values: np.ndarray, masks: list[int], distance: int) -> list[tuple[int, int]]:
    """Links that join what can be joined among the values, each found by growing a group.

    A group grows from one member at a time over the values not yet in any group, so a dense
    group costs little more than one comparison for each member.
    """
    links, rest = [], values
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            here = queue.pop()
            differ = rest ^ np.uint64(here)
            near = np.ones(len(rest), dtype=bool)
            for length, mask in enumerate(masks, start=1):
                budget = length * distance // SEGMENTS
                near &= np.bitwise_count(differ & np.uint64(mask)) <= budget
            near_values = rest[near].tolist()
            links += [(here, other) for other in near_values]
            queue += near_values
            rest = rest[~near]
    return links


def links(steps: Steps, fps: DataFrame, distance: int) -> DataFrame:
    """(lo, hi) of fingerprints, as signed longs, that connect whatever is within the distance.

    Not all pairs: within a group that meets under one key, a spanning forest of its links.
    """
    masks = _masks()
    keyed = _keyed(fps)
    # Keys of more than a block are cut into blocks, which then meet two by two.
    full = steps.save(
        keyed.groupBy("slot", "bits")
        .count()
        .filter(F.col("count") > BLOCK)
        .select("slot", "bits", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    )
    one = F.coalesce("blocks", F.lit(1))
    mine = F.pmod(F.xxhash64("fp"), one).cast("int")
    dealt = keyed.join(full, ["slot", "bits"], "left").select(
        "slot",
        "bits",
        "fp",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), (one - 1).cast("int")),
                lambda other: F.struct(F.least(mine, other).alias("a"), F.greatest(mine, other).alias("b")),
            )
        ).alias("pair"),
    )
    groups = (
        dealt.groupBy("slot", "bits", "pair")
        .agg(F.collect_list("fp").alias("members"))
        .filter(F.size("members") > 1)
        .select("slot", "members")
    )

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            lo, hi = [], []
            for slot, members in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = members.values.to_numpy(zero_copy_only=False).view(np.uint64)
                found = _forest(np.unique(values), masks[slot // 2], distance)
                if found:
                    ends = np.array(found, dtype=np.uint64).view(np.int64)
                    lo.append(ends.min(axis=1))
                    hi.append(ends.max(axis=1))
            if lo:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(lo)), pa.array(np.concatenate(hi))], names=["lo", "hi"]
                )

    return groups.mapInArrow(batches, "lo bigint, hi bigint")


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 4,
    distance: int = 4,
) -> DataFrame:
    """(id_col, fingerprint, component_id): documents whose fingerprints are linked share a component.

    One row for each input row, repeated rows included.  ``component_id`` is the smallest id
    reachable; a NULL id is never the smallest, and a component of NULL ids only has a NULL one.
    A NULL or blank text has fingerprint zero and is linked like any other.  ``distance`` may be 0
    to 4.  Other columns are ignored; an empty table gives an empty one.
    """
    if not 0 <= distance <= MAX_BITS:
        raise ValueError(f"distance must be from 0 to {MAX_BITS}")
    steps = Steps(docs.sparkSession)
    ids = unused(docs.select(text_col), id_col)
    plain = docs.select(F.col(id_col).alias(ids), F.col(text_col).alias(unused(docs, "text")))
    each = steps.save(fingerprints(plain, plain.columns[0], plain.columns[1], shingle_words))
    distinct = steps.save(each.groupBy("fp").agg(F.min(plain.columns[0]).alias("least")))
    found = steps.save(links(steps, distinct.select("fp"), distance))
    node = components(steps, found)
    member = steps.save(
        distinct.join(node, F.col("fp") == F.col("node"), "left").select(
            "fp", "least", F.coalesce("component", "fp").alias("component")
        )
    )
    smallest = member.groupBy("component").agg(F.min("least").alias("component_id"))
    named = steps.save(member.join(smallest, "component").select("fp", "component_id"))
    return each.join(named, "fp").select(
        F.col(plain.columns[0]).alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_copies(docs: DataFrame, shingle_words: int = 4, distance: int = 4) -> DataFrame:
    """One row of each component: that with the smallest doc_id.

    Of repeated rows of that id one stays, whichever; rows with a NULL doc_id come after all others,
    so one of these stays where a component has no id.
    """
    steps = Steps(docs.sparkSession)
    key, place = unused(docs, "key"), unused(docs, "place")
    keyed = steps.save(docs.withColumn(key, F.monotonically_increasing_id()))
    order = F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(key).alias("row")
    )
    groups = simhash_groups(
        keyed.select(order.alias(place), "text"), place, "text", shingle_words, distance
    )
    first = groups.filter(F.col(place)["row"] == F.col("component_id")["row"])
    kept = steps.save(first.select(F.col(place)["row"].alias(key)))
    return keyed.join(kept, key, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
