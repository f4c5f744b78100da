"""Packing token sequences into as few sequences of a fixed capacity as it can.

The lengths are grouped linearly: pieces above a share of the capacity, in order of length, fall
into groups of equal size and count as long as the longest of their group.  For these few sizes a
linear program over the ways to fill a sequence says how often each way is used.  Then the pieces
themselves take the places of their group, longest first, and all others, the rounded-off rest and
the small ones, go where they fit best.

All of this works on counts by length, of which there are no more than the capacity, so the plan
is made on the driver whatever the number of documents.  Pieces find their place by their rank
among those of equal length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratawell.llm.common import Steps
from stratawell.llm.word_tokens import WordTokens

#: A piece is large above the capacity divided by this, and large pieces fall into so many groups.
#: Each of these schemes is tried; the plan with the fewest sequences counts.
SCHEMES = ((2, 48), (3, 48), (4, 48), (8, 48))
#: Steps of the linear program.  Its solution is usable, if not the best, after any of them.
PROGRAM_STEPS = 600

Runs = list[tuple[int, int]]


@dataclass(frozen=True)
class Content:
    """What a sequence holds, last addition first."""

    length: int
    copies: int
    before: Content | None


@dataclass
class Bins:
    """Sequences with equal content."""

    content: Content | None
    count: int


def _groups(runs: Runs, n_groups: int) -> list[Runs]:
    """Lengths, longest first, in so many groups of equally many pieces."""
    total = sum(count for _, count in runs)
    size = -(-total // n_groups)
    groups: list[Runs] = [[]]
    room = size
    for length, count in runs:
        while count:
            if not room:
                groups.append([])
                room = size
            taken = min(count, room)
            groups[-1].append((length, taken))
            count -= taken
            room -= taken
    return [group for group in groups if group]


def _best_filling(sizes: list[int], worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The filling of a sequence that is worth most."""
    most = capacity // min(sizes)
    best = np.zeros(capacity + 1)
    chosen = []
    for _ in range(most):
        better, choice = best.copy(), np.full(capacity + 1, -1)
        for i, size in enumerate(sizes):
            if worth[i] > 0:
                with_one = best[: capacity + 1 - size] + worth[i]
                gain = with_one > better[size:] + 1e-12
                better[size:][gain] = with_one[gain]
                choice[size:][gain] = i
        chosen.append(choice)
        best = better
    filling, room = np.zeros(len(sizes)), capacity
    for choice in reversed(chosen):
        if choice[room] >= 0:
            filling[choice[room]] += 1
            room -= sizes[choice[room]]
    return float(worth @ filling), filling


def _fillings(sizes: list[int], needed: list[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """Ways to fill a sequence and how often to use each, together within what is needed.

    Column generation: the ways in use start with one size each, and the way worth most at the
    present prices of the sizes replaces another until none is worth more than a sequence.
    """
    ways = np.diag([float(capacity // size) for size in sizes])
    need = np.array(needed, dtype=float)
    for _ in range(PROGRAM_STEPS):
        price = np.linalg.solve(ways.T, np.ones(len(sizes)))
        value, filling = _best_filling(sizes, price, capacity)
        if value <= 1 + 1e-9:
            break
        used, change = np.linalg.solve(ways, need), np.linalg.solve(ways, filling)
        ratio = np.full(len(sizes), np.inf)
        rising = change > 1e-9
        ratio[rising] = np.maximum(used[rising], 0) / change[rising]
        ways[:, int(ratio.argmin())] = filling
    used = np.floor(np.linalg.solve(ways, need) + 1e-9).astype(int)
    result, left = [], np.array(needed)
    for j in np.argsort(-used, kind="stable"):
        filling = ways[:, j].astype(int)
        if filling.any():
            times = min(int(used[j]), int((left[filling > 0] // filling[filling > 0]).min()))
            if times > 0:
                left -= filling * times
                result.append((filling, times))
    return result


def _take(runs: Runs, count: int) -> Runs:
    """Remove so many pieces from the front."""
    taken: Runs = []
    while count:
        length, there = runs[0]
        some = min(there, count)
        taken.append((length, some))
        count -= some
        if some == there:
            runs.pop(0)
        else:
            runs[0] = (length, there - some)
    return taken


def _substitute(places: list[Runs], times: int) -> list[tuple[list[int], int]]:
    """Sequences with a piece from each run in each: their lengths, and how many are alike."""
    queues = [list(runs) for runs in places]
    alike = []
    while times:
        some = min(runs[0][1] for runs in queues)
        alike.append(([_take(runs, some)[0][0] for runs in queues], some))
        times -= some
    return alike


def _plan(counts: dict[int, int], capacity: int, share: int, n_groups: int) -> list[Bins]:
    large = sorted(((n, c) for n, c in counts.items() if n * share > capacity), reverse=True)
    rest = {n: c for n, c in counts.items() if n * share <= capacity}
    gaps: dict[int, list[Bins]] = {}
    order: list[int] = []

    def put(gap: int, bins: Bins) -> None:
        if gap not in gaps:
            gaps[gap] = []
            insort(order, gap)
        gaps[gap].append(bins)

    if large:
        groups = _groups(large, n_groups)
        sizes = [group[0][0] for group in groups]
        merged: dict[int, Runs] = {}
        for size, group in zip(sizes, groups):
            merged.setdefault(size, []).extend(group)
        sizes = list(merged)
        needed = [sum(count for _, count in merged[size]) for size in sizes]
        for filling, times in _fillings(sizes, needed, capacity):
            places = [
                _take(merged[size], times)
                for size, copies in zip(sizes, filling)
                for _ in range(copies)
            ]
            for lengths, alike in _substitute(places, times):
                content = None
                for length in lengths:
                    content = Content(length, 1, content)
                put(capacity - sum(lengths), Bins(content, alike))
        for runs in merged.values():
            for length, count in runs:
                rest[length] = rest.get(length, 0) + count

    # best fit, longest first: the smallest gap that is wide enough, until it is not
    for length in sorted(rest, reverse=True):
        left = rest[length]
        while left:
            at = bisect_left(order, length)
            if at == len(order):
                put(capacity, Bins(None, -(-left // (capacity // length))))
                continue
            gap = order[at]
            bins = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], order[at]
            each = gap // length
            full = min(bins.count, left // each)
            if full:
                put(gap - each * length, Bins(Content(length, each, bins.content), full))
                left -= full * each
            untouched = bins.count - full
            if untouched and left:
                put(gap - left * length, Bins(Content(length, left, bins.content), 1))
                untouched -= 1
                left = 0
            if untouched:
                put(gap, Bins(bins.content, untouched))
    return [bins for same in gaps.values() for bins in same if bins.content]


@dataclass
class Place:
    """Where the pieces of one length with ranks from ``first`` to before ``end`` go."""

    length: int
    first: int
    end: int
    sequence: int
    copies: int
    offset: int


def plan_places(counts: dict[int, int], capacity: int) -> list[Place]:
    """A place for each piece of each length, by its rank among them."""
    if not counts:
        return []
    plans = [_plan(counts, capacity, share, n_groups) for share, n_groups in SCHEMES]
    plan = min(plans, key=lambda bins: sum(b.count for b in bins))
    places, ranks, sequence = [], dict.fromkeys(counts, 0), 0
    for bins in plan:
        content, parts = bins.content, []
        while content:
            parts.append(content)
            content = content.before
        offset = 0
        for part in reversed(parts):
            first = ranks[part.length]
            ranks[part.length] = end = first + part.copies * bins.count
            places.append(Place(part.length, first, end, sequence, part.copies, offset))
            offset += part.copies * part.length
        sequence += bins.count
    return places


@lru_cache(maxsize=2)
def _words(path: str, added_tokens: bool) -> WordTokens:
    return WordTokens(path, added_tokens)  # kept by a worker for its next tasks


def tokenize(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    path: str,
    capacity: int,
    end_id: int,
    added_tokens: bool = False,
) -> DataFrame:
    """(id_col, piece, start, length, ids, part, rank_in_part) of the pieces of each document.

    ``ids`` are little-endian unsigned 32-bit numbers.  ``rank_in_part`` counts the pieces of equal
    length in the task numbered ``part``.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        words = _words(path, added_tokens)
        for batch in rows:
            source, piece, start, length, ids, rank = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                all_ids = words.encode(text.as_py() or "") + end
                for at in range(0, len(all_ids), 4 * capacity):
                    some = all_ids[at : at + 4 * capacity]
                    source.append(row)
                    piece.append(at // (4 * capacity))
                    start.append(at // 4)
                    length.append(len(some) // 4)
                    ids.append(some)
                    rank.append(seen[len(some) // 4])
                    seen[len(some) // 4] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(source, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array([part] * len(source), pa.int32()),
                    pa.array(rank, pa.int64()),
                ],
                names=["id", "piece", "start", "length", "ids", "part", "rank_in_part"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = "piece int, start bigint, length bigint, ids binary, part int, rank_in_part bigint"
    return docs.select(id_col, text_col).mapInArrow(batches, f"id {kind}, {schema}")


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    added_tokens: bool = False,
) -> DataFrame:
    """(id_col, piece, start, length, ids, sequence_id, offset) of all pieces of all rows.

    A document is its tokens and the end id; a NULL or empty text is the end id alone.  Only what
    is longer than the capacity is cut.  Sequences are filled without gaps from offset 0.  Each row
    counts, with a NULL or repeated id too.  Other columns are ignored; no rows give no pieces.
    With ``added_tokens``, names of the tokenizer's added tokens in a text have their own ids, as
    by its default; without, they are text.
    """
    spark = docs.sparkSession
    steps = Steps(spark)
    pieces = steps.save(tokenize(docs, id_col, text_col, tokenizer, capacity, end_id, added_tokens))
    by_part = steps.save(pieces.groupBy("part", "length").count())
    by_length = by_part.groupBy("length").agg(F.sum("count").alias("count"))
    counts = {row["length"]: row["count"] for row in by_length.collect()}  # at most the capacity
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = steps.save(
        by_part.select(
            "part", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before")
        )
    )
    places = spark.createDataFrame(
        [(p.length, p.first, p.end, p.sequence, p.copies, p.offset) for p in plan_places(counts, capacity)],
        "length bigint, first bigint, end bigint, sequence bigint, copies bigint, at bigint",
    )
    # Merged, as the ranks grow with the number of tasks.
    ranked = pieces.join(before.hint("merge"), ["part", "length"]).withColumn(
        "rank", F.col("before") + F.col("rank_in_part")
    )
    # The places depend on the capacity alone: lengths are whole numbers up to it.
    placed = ranked.join(F.broadcast(places), "length").filter("rank >= first AND rank < end")
    nth = F.col("rank") - F.col("first")
    return placed.select(
        F.col("id").alias(id_col),
        "piece",
        "start",
        "length",
        "ids",
        (F.col("sequence") + F.floor(nth / F.col("copies"))).alias("sequence_id"),
        (F.col("at") + nth % F.col("copies") * F.col("length")).alias("offset"),
    )
