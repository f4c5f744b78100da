"""Removal of passages that occur more than once, by doubling the length of what is repeated.

A window of words is repeated only if shorter windows in it are.  So short windows are tried
first, and only where one is repeated is a window of twice its length tried, up to the length
asked for, until no candidates survive.  At the shorter lengths one window stands for many: of
those inside each full window, the one with the smallest hash.  Equal full windows choose the same
one, so nothing is missed, and a few hundredths of all positions are shuffled at the first length.

A task resolves by itself what it holds twice, and sends one row for it.  So a passage that is in
a third of all documents makes no more rows under one key than there are tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratawell.llm.common import Steps, unused

#: Windows shorter than this are not tried: too many are repeated by chance.
SHORTEST = 8
#: Windows that a task compares at a time.
BUFFER = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

Segment = tuple[int, np.ndarray]  # first word, hashes of the words
Found = tuple[np.ndarray, np.ndarray, np.ndarray]  # hashes, first and last start


def lengths(window: int) -> list[int]:
    """The lengths tried: each twice the one before at most, the last the window."""
    found = [window]
    while -(-found[0] // 2) >= SHORTEST:
        found.insert(0, -(-found[0] // 2))
    return found


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    factors = np.full(n, base, dtype=np.uint64)
    factors[:1] = 1
    return np.multiply.accumulate(factors)


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of each window of so many words."""
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * _powers(_BASE, len(words)), out=sums[1:])
    mixed = (sums[length:] - sums[:-length]) * _powers(_INVERSE, len(words) - length + 1)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(29))


def anchors(segment: Segment, length: int, window: int) -> Found:
    """The windows of ``length`` that stand for full ones, and the starts of these."""
    first, words = segment
    short = window_hashes(words, length)
    width = window - length + 1
    if width == 1:
        starts = np.arange(len(short)) + first
        return short, starts, starts
    chosen = np.lib.stride_tricks.sliding_window_view(short, width).argmin(axis=1)
    chosen += np.arange(len(chosen))
    change = np.flatnonzero(np.diff(chosen)) + 1
    begin = np.concatenate(([0], change))
    end = np.concatenate((change, [len(chosen)])) - 1
    return short[chosen[begin]], begin + first, end + first


def cut(segments: list[Segment], spans: Iterable[tuple[int, int]], window: int) -> list[Segment]:
    """The parts of the segments that hold the full windows starting in the spans."""
    joined: list[list[int]] = []
    for lo, hi in sorted(spans):
        if joined and lo <= joined[-1][1] + 1:
            joined[-1][1] = max(joined[-1][1], hi)
        else:
            joined.append([lo, hi])
    parts, at = [], 0
    for lo, hi in joined:
        while segments[at][0] + len(segments[at][1]) < hi + window:
            at += 1
        first, words = segments[at]
        parts.append((lo, words[lo - first : hi - first + window]))
    return parts


def _resolved(buffer: list[tuple[int, Found]]) -> pa.RecordBatch:
    """Rows of ``_PENDING`` for what a task holds."""
    hashes = np.concatenate([found[0] for _, found in buffer])
    key = np.repeat([key for key, _ in buffer], [len(found[0]) for _, found in buffer])
    lo = np.concatenate([found[1] for _, found in buffer])
    hi = np.concatenate([found[2] for _, found in buffer])
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    last = np.concatenate((new[1:], [True]))
    # Back in the order of the texts, in which keys and starts take little room.
    known, sent = np.empty(len(order), dtype=bool), np.empty(len(order), dtype=bool)
    known[order] = ~(new & last)  # held more than once
    sent[order] = new
    return pa.RecordBatch.from_arrays(
        [
            pa.array(hashes.view(np.int64)),
            pa.array(key.astype(np.int64)),
            pa.array(lo.astype(np.int32)),
            pa.array(hi.astype(np.int32)),
            pa.array(known),
            pa.array(sent),
        ],
        names=["hash", "key", "lo", "hi", "known", "sent"],
    )


_PENDING = "hash bigint, key bigint, lo int, hi int, known boolean, sent boolean"


def _pending(rows: Iterable[tuple[int, list[Segment]]], length: int, window: int, most: int):
    buffer: list[tuple[int, Found]] = []
    size = 0
    for key, segments in rows:
        for segment in segments:
            if len(segment[1]) >= window:
                found = anchors(segment, length, window)
                buffer.append((key, found))
                size += len(found[0])
        if size >= most:
            yield _resolved(buffer)
            buffer, size = [], 0
    if buffer:
        yield _resolved(buffer)


def _split(text) -> list[bytes]:
    value = text.as_py()
    return value.encode().split() if value else []


def _spans(column: pa.Array, row: int) -> list[tuple[int, int]]:
    return [(span["lo"], span["hi"]) for span in column[row].as_py()]


def _segments(batch: pa.RecordBatch, row: int) -> list[Segment]:
    words = np.frombuffer(batch.column("hashes")[row].as_py(), dtype=np.uint64)
    parts, at = [], 0
    for first, size in zip(batch.column("firsts")[row].as_py(), batch.column("sizes")[row].as_py()):
        parts.append((first, words[at : at + size]))
        at += size
    return parts


def _repeated(pending: DataFrame) -> DataFrame:
    """(key, spans): starts of full windows whose anchors are repeated anywhere."""
    sent = pending.filter("sent").withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("hash")))
    found = pending.filter("known").select("key", "lo", "hi").unionAll(
        sent.filter("n > 1 AND NOT known").select("key", "lo", "hi")
    )
    return found.groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def repeated_windows(
    steps: Steps, texts: DataFrame, window: int, buffer: int = BUFFER
) -> DataFrame:
    """(key, spans) of the words at which a window starts that also starts elsewhere.

    texts: (key, text), a step table with a key for each row.  ``buffer`` is how many windows a task
    compares at a time; it has no influence on the result.
    """
    first, *longer = lengths(window)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (key, [(0, word_hashes(_split(text)))])
            for batch in batches
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text"))
        )
        yield from _pending(rows, first, window, buffer)

    pending = steps.save(texts.mapInArrow(whole, _PENDING))
    spans = steps.save(_repeated(pending))
    steps.drop(pending)
    if not longer:
        return spans

    def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            firsts, sizes, hashes = [], [], []
            for row, text in enumerate(batch.column("text")):
                words = [(0, word_hashes(_split(text)))]
                parts = cut(words, _spans(batch.column("spans"), row), window)
                firsts.append([start for start, _ in parts])
                sizes.append([len(part) for _, part in parts])
                hashes.append(b"".join(part.tobytes() for _, part in parts))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(firsts, pa.list_(pa.int32())),
                    pa.array(sizes, pa.list_(pa.int32())),
                    pa.array(hashes, pa.binary()),
                ],
                names=["key", "firsts", "sizes", "hashes"],
            )

    regions = steps.save(
        texts.join(spans, "key").mapInArrow(
            survivors, "key bigint, firsts array<int>, sizes array<int>, hashes binary"
        )
    )
    steps.drop(spans)
    spans = None
    for length in longer:

        def narrowed(batches: Iterator[pa.RecordBatch], length=length) -> Iterator[pa.RecordBatch]:
            def rows():
                for batch in batches:
                    again = "spans" in batch.schema.names
                    for row, key in enumerate(batch.column("key").to_pylist()):
                        parts = _segments(batch, row)
                        if again:
                            parts = cut(parts, _spans(batch.column("spans"), row), window)
                        yield key, parts

            yield from _pending(rows(), length, window, buffer)

        candidates = regions if spans is None else regions.join(spans, "key")
        pending = steps.save(candidates.mapInArrow(narrowed, _PENDING))
        if spans is not None:
            steps.drop(spans)
        spans = steps.save(_repeated(pending))
        steps.drop(pending)
        if spans.isEmpty():
            break
    steps.drop(regions)
    return spans


def drop_repeated(
    docs: DataFrame, text_col: str = "text", window: int = 35, out: str = "removal"
) -> DataFrame:
    """All rows and columns, with ``out``: (n_words, n_removed, kept) of the text added.

    Words are what stands between ASCII white space.  A word goes if a window of ``window`` words
    over it also starts anywhere else, in the same text or another; ``kept`` joins the others by
    one space.  Repeated rows are texts of their own.  A NULL or empty text has no words and keeps
    the empty text; no rows give no rows.  The new name gets a leading underscore where it is taken.
    """
    steps = Steps(docs.sparkSession)
    key, spans_col, new = (unused(docs, name) for name in ("key", "spans", out))
    keyed = steps.save(docs.withColumn(key, F.monotonically_increasing_id()))
    texts = keyed.select(F.col(key).alias("key"), F.col(text_col).alias("text"))
    spans = repeated_windows(steps, texts, window)
    spans = spans.select(F.col("key").alias(key), F.col("spans").alias(spans_col))

    @F.pandas_udf("n_words bigint, n_removed bigint, kept string")
    def removed(texts, all_spans):
        import pandas as pd

        rows = []
        for text, starts in zip(texts, all_spans):
            words = text.encode().split() if text else []
            covered = np.zeros(len(words) + 1, dtype=np.int32)
            for span in starts if starts is not None else ():
                covered[span["lo"]] += 1
                covered[span["hi"] + window] -= 1
            gone = np.cumsum(covered[:-1]) > 0
            kept = b" ".join([w for w, g in zip(words, gone) if not g]) if gone.any() else b" ".join(words)
            rows.append((len(words), int(gone.sum()), kept.decode()))
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])

    joined = keyed.join(spans, key, "left").withColumn(
        new, removed(F.col(f"`{text_col}`"), F.col(spans_col))
    )
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], new)


def drop_repeated_passages(docs: DataFrame, window: int = 35) -> DataFrame:
    """The documents without repeated passages.

    A text that loses nothing stays as it is, white space included; one that does is its other
    words joined by one space, and ``n_chars`` is renewed.  Texts that lose all words stay, empty.
    """
    out = unused(docs, "removal")
    found = drop_repeated(docs, "text", window, out)
    changed = F.col(out)["n_removed"] > 0
    new = found.withColumn("text", F.when(changed, F.col(out)["kept"]).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new = new.withColumn(
            "n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        )
    return new.select(*[F.col(f"`{c}`") for c in docs.columns])
