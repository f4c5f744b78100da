"""Interpolated modified Kneser-Ney language model of words, of any order from 2.

Counts are made in Spark and written as sorted arrays below the shared folder: the hashes of all
words, whose place is the word's number, and for every length from 2 to the order the contexts and
n-grams, dealt over shards.  Workers map these files into memory and look n-grams up by binary
search, so what a worker holds does not grow with the model.

The longest n-grams have their counts, shorter ones the number of different words in front of them.
A task counts what it holds before anything is shuffled, and what is shuffled are packed columns of
n-grams, a row for each shard.  N-grams go to the shard of their context, so its statistics are
whole there; a context whose words are frequent is dealt over several shards, the more the more
frequent its rarest word is, and its statistics are the sum of theirs.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratawell.llm.common import Steps, partitions

#: Tokens that a task counts at a time.
BUFFER = 1 << 21
#: Words and n-grams of a shard, about.
WORDS_OF_SHARD = 1 << 19
TOKENS_OF_SHARD = 1 << 21
#: Words of the longest n-grams.
ORDER = 3
MOST_ORDER = 8
_END = np.uint64(xxhash.xxh64_intdigest(b""))  # no word is empty
#: Columns of a shard's file, the widest first, so that all are aligned: contexts with a single n-gram
#: that occurs once; other contexts; the n-grams of these, as place of the context and last word, those
#: that occur once and the others.  The last word after the first contexts.  Places of the contexts that
#: occur too often for a byte, with their statistics, and of such n-grams, with their counts.  In a byte
#: each, the statistics of all contexts but the first, and the counts of n-grams that occur more than once.
_SHARD = ("<u8",) * 4 + ("<u4",) * 8 + ("u1",) * 5
_WORDS = ("<u8", "<i8")
#: What a byte says where the figure is kept apart.
_WIDE = 255
#: Tokens that a task scores at a time, or one text.
SCORED = 1 << 20
_32 = np.uint64(32)


def local_path(folder: str) -> str:
    """The folder as a path that can be mapped into memory."""
    scheme, colon, rest = folder.partition(":")
    if not colon:
        return folder
    if scheme != "file":
        raise ValueError(f"model files are mapped into memory, so {scheme}: has to be mounted")
    return "/" + rest.lstrip("/")


def _write(path: str, *columns: np.ndarray) -> None:
    """Their lengths, then one after another; the file appears whole, and the same if a task runs again."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as out:
        for column in (np.array([len(column) for column in columns], dtype="<u8"), *columns):
            out.write(np.ascontiguousarray(column).tobytes())
    os.replace(part, path)


@lru_cache(maxsize=700)
def _mapped(path: str, *kinds: np.dtype | str) -> tuple[np.ndarray, ...]:
    """Columns of these types in a file, mapped into memory."""
    if not os.path.exists(path):
        raise FileNotFoundError(f"{path} of the model is not there, or its folder is not mounted here")
    whole = np.memmap(path, dtype=np.uint8, mode="r").view(np.ndarray)
    at, columns = 8 * len(kinds), []
    for kind, n in zip(map(np.dtype, kinds), whole[:at].view("<u8").tolist()):
        columns.append(whole[at : at + n * kind.itemsize].view(kind))
        at += n * kind.itemsize
    return tuple(columns)


def _found(known: np.ndarray, values: np.ndarray, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place (-1: none) among known sorted keys, and the value there or 0, of sorted keys."""
    if not len(known):
        return np.full(len(sought), -1), np.zeros(len(sought), dtype=np.int64)
    at = np.minimum(np.searchsorted(known, sought), len(known) - 1)
    hit = known[at] == sought
    return np.where(hit, at, -1), np.where(hit, values[at], 0)


def token_hashes(text: str | None) -> np.ndarray:
    """The hash of each word, A-Z lower-cased, and of the end."""
    words = text.encode().lower().split() if text else []
    found = np.empty(len(words) + 1, dtype=np.uint64)
    found[:-1] = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    found[-1] = _END
    return found


def _buffers(batches: Iterable[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Tokens of the texts in the first column, some texts at a time."""
    buffer, size = [], 0
    for batch in batches:
        for text in batch.column(0):
            buffer.append(token_hashes(text.as_py()))
            size += len(buffer[-1])
            if size >= BUFFER:
                yield buffer
                buffer, size = [], 0
    if buffer:
        yield buffer


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(31))


def _word_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards in the order of the hashes."""
    return ((hashes >> np.uint64(40)) * np.uint64(shards) >> np.uint64(24)).astype(np.int64)


@dataclass(frozen=True)
class Words:
    """The words of the training texts: sorted hashes in shards, with the count of each."""

    folder: str
    shards: int
    starts: tuple[int, ...]  # number of the first word of each shard, and of all

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (-1: unknown) and count of each of some sorted hashes."""
        numbers, counts = np.full(len(hashes), -1), np.zeros(len(hashes), dtype=np.int64)
        shard = _word_shard(hashes, self.shards)
        for one in np.unique(shard):
            if self.starts[one] == self.starts[one + 1]:
                continue  # no word fell in this shard, so it has no file
            part = slice(*np.searchsorted(shard, [one, one + 1]))
            known, n = _mapped(f"{self.folder}/{one}", *_WORDS)
            at, counts[part] = _found(known, n, hashes[part])
            numbers[part] = np.where(at >= 0, at + self.starts[one], -1)
        return numbers, counts

    def counts(self, numbers: np.ndarray) -> np.ndarray:
        """Counts of some sorted numbers of words."""
        counts = np.zeros(len(numbers), dtype=np.int64)
        shard = np.searchsorted(self.starts, numbers, side="right") - 1
        for one in np.unique(shard):
            part = slice(*np.searchsorted(shard, [one, one + 1]))
            counts[part] = _mapped(f"{self.folder}/{one}", *_WORDS)[1][numbers[part] - self.starts[one]]
        return counts


def _count_words(steps: Steps, texts: DataFrame, folder: str) -> tuple[Words, int]:
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for buffer in _buffers(batches):
            hashes, counts = np.unique(np.concatenate(buffer), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(counts)], names=["hash", "n"]
            )

    counts = steps.save(
        texts.mapInArrow(local, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n"))
    )
    distinct, tokens = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    shards = max(partitions(texts.sparkSession), -(-distinct // WORDS_OF_SHARD))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = [(b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy()) for b in batches]
        if whole:
            hashes = np.concatenate([x[0] for x in whole])
            n = np.concatenate([x[1] for x in whole])
            order = np.argsort(hashes)
            hashes, n = hashes[order], n[order]
            shard = _word_shard(hashes, shards)
            sizes = []
            for one in np.unique(shard):
                part = slice(*np.searchsorted(shard, [one, one + 1]))
                _write(f"{folder}/{one}", hashes[part], n[part].astype("<i8"))
                sizes.append((int(one), part.stop - part.start))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(x) for x in column], pa.int64()) for column in zip(*sizes)],
                names=["shard", "n"],
            )

    shard = (F.call_function("shiftrightunsigned", F.col("hash"), F.lit(40)) * shards) / (1 << 24)
    dealt = counts.repartition(shards, F.floor(shard))
    # saved, so that the shuffle files are gone before the next step; one row for each shard
    sizes = steps.save(dealt.mapInArrow(write, "shard bigint, n bigint"))
    of = {row["shard"]: row["n"] for row in sizes.collect()}
    starts = np.concatenate(([0], np.cumsum([of.get(i, 0) for i in range(shards)])))
    steps.drop(counts, sizes)
    return Words(folder, shards, tuple(int(x) for x in starts)), int(tokens)


@dataclass(frozen=True)
class Discounts:
    """What is taken from counts of one, two, and three or more."""

    one: float
    two: float
    more: float

    @classmethod
    def of(cls, n1: int, n2: int, n3: int, n4: int) -> Discounts:
        """From how many counts are 1, 2, 3 and 4; the usual guesses where one of these is 0."""
        if not (n1 and n2 and n3 and n4):
            return cls(0.5, 0.75, 0.9) if n1 else cls(0.0, 0.0, 0.0)
        y = n1 / (n1 + 2 * n2)
        found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        return cls(*(min(max(d, 0.0), most) for d, most in zip(found, (0.999, 1.999, 2.999))))

    def taken(self, counts: np.ndarray) -> np.ndarray:
        return np.choose(np.minimum(counts, 3), [0.0, self.one, self.two, self.more])

    def freed(self, n1, n2, n3):
        return self.one * n1 + self.two * n2 + self.more * n3


def _keys(context: list[np.ndarray]) -> np.ndarray:
    """Contexts as 64 bits: themselves up to two words, a hash beyond."""
    keys = context[0].astype(np.uint64)
    for at, column in enumerate(context[1:], 1):
        keys = (keys << _32 if at == 1 else _mixed(keys + np.uint64(at)) * np.uint64(0x9E3779B97F4A7C15)) ^ (
            column.astype(np.uint64)
        )
    return keys


@dataclass(frozen=True)
class Deal:
    """Which shard an n-gram goes to, told by its words and how often the rarest of its context occurs."""

    shards: int
    limit: int

    def parts(self, rarest: np.ndarray) -> np.ndarray:
        """Over how many shards a context is dealt."""
        return np.minimum(rarest // self.limit + 1, self.shards)

    def shard(self, keys: np.ndarray, part: np.ndarray) -> np.ndarray:
        return ((_mixed(keys + np.uint64(1)) >> _32).astype(np.int64) + part) % self.shards

    def spread(self, last: np.ndarray) -> np.ndarray:
        return (_mixed(last.astype(np.uint64) + np.uint64(1)) >> _32).astype(np.int64)

    def of(self, keys: np.ndarray, last: np.ndarray, rarest: np.ndarray) -> np.ndarray:
        return self.shard(keys, self.spread(last) % self.parts(rarest))


def _ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different value, in their order, and which of them each value is."""
    order = np.argsort(values)  # not stable, which np.unique would make it to give first places
    ordered = values[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    del ordered
    number = np.cumsum(new)
    number -= 1
    rank = np.empty(len(values), dtype=np.int64)
    rank[order] = number
    return order[new], rank


def _distinct(columns: list[np.ndarray], weights: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
    """Different rows of some columns of 32-bit numbers, and the sum of the weights of each."""
    place = columns[-1].astype(np.uint64)
    for column in columns[-2::-1]:
        # in place, and let go before the next: a task holds few arrays of this length at a time
        rows = column.astype(np.uint64)
        rows <<= _32
        rows |= place.view(np.uint64)
        del place
        at, place = _ranked(rows)
        del rows
    sums = np.bincount(place, weights).astype(np.int64)
    return [column[at] for column in columns], sums


#: Rows between tasks: packed n-grams for a shard, or, without a block, a figure: how often a word
#: number is a second word, and under _sizes and _file those of a length and what files there are.
_ROWS = "shard int, mark bigint, n bigint, block binary"


def _sizes(length: int, count: int) -> int:
    """The mark of how many n-grams of this length have a count of 1 to 4."""
    return -16 * length - count


def _file(length: int, shard: int) -> int:
    return -1000 - (shard * 16 + length)


def _rows(shard, mark, n, block) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
    columns = [pa.array(x, kind) for x, kind in zip((shard, mark, n, block), kinds)]
    return pa.RecordBatch.from_arrays(columns, names=["shard", "mark", "n", "block"])


def _figures(marks: Iterable[int], n: Iterable[int]) -> pa.RecordBatch:
    marks = np.asarray(marks, dtype=np.int64)
    return _rows((marks & 0x7FFFFFFF).astype(np.int32), marks, np.asarray(n, dtype=np.int64), [None] * len(marks))


def _pack(columns: list[np.ndarray]) -> bytes:
    """Columns of 32-bit numbers, the first in order, byte by byte of their steps, in which they compress."""
    rows = np.stack(columns)
    rows[0, 1:] -= rows[0, :-1].copy()
    planes = rows.view(np.uint8).reshape(*rows.shape, 4).transpose(0, 2, 1)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(block: bytes, columns: int, n: int) -> np.ndarray:
    raw = pa.decompress(block, n * 4 * columns, codec="zstd")
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(columns, 4, n)
    rows = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u4").reshape(columns, n)
    rows[0] = np.cumsum(rows[0], dtype=np.uint32)
    return rows


def _packed(columns: list[np.ndarray], n: np.ndarray, shard: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each shard: its n-grams, column by column, and their counts."""
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    columns = [x[order].astype("<u4") for x in (*columns, n)]
    at = _runs(shard)
    for begin in range(0, len(at), 256):
        some, end = at[begin : begin + 256], np.append(at[begin + 1 :], len(shard))
        blocks = [_pack([x[i:j] for x in columns]) for i, j in zip(some, end)]
        yield _rows(shard[some].astype(np.int32), np.zeros(len(some), np.int64), end[: len(some)] - some, blocks)


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))


def _narrow(*rows: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Rows of figures, the largest first, in a byte each; and places and figures of those kept apart."""
    wide = np.flatnonzero(rows[0] >= _WIDE)
    return [np.minimum(x, _WIDE).astype("u1") for x in rows], [x.astype("<u4") for x in (wide, *(x[wide] for x in rows))]


def _write_shard(path: str, grams: list[np.ndarray], n: np.ndarray) -> None:
    """The file of one shard, from its different n-grams and their counts."""
    if n.max() >= 1 << 32:
        raise ValueError("an n-gram that occurs more often than 32 bits count")
    contexts, place = np.unique(_keys(grams[:-1]), return_inverse=True)
    total, single = np.bincount(place, n), np.bincount(place, n == 1)
    if total.max() >= 1 << 32:
        raise ValueError("a context that occurs more often than 32 bits count")
    once = total == 1
    lone = once[place]
    last = np.zeros(len(contexts), dtype="<u4")
    last[place[lone]] = grams[-1][lone]
    stats = [total, single, np.bincount(place, n == 2), np.bincount(place, n > 2)]
    stats, wide = _narrow(*[x[~once] for x in stats])
    number = np.cumsum(~once) - 1
    keys = (number[place[~lone]].astype(np.uint64) << _32) | grams[-1][~lone].astype(np.uint64)
    order = np.argsort(keys)
    keys, n = keys[order], n[~lone][order]
    more, most = _narrow(n[n > 1])
    sorted_keys = (contexts[once], contexts[~once], keys[n == 1], keys[n > 1])
    _write(path, *sorted_keys, last[once], *wide, *most, *stats, *more)


def _count_grams(
    steps: Steps, texts: DataFrame, words: Words, tokens: int, folder: str, deal: Deal, order: int
) -> DataFrame:
    """Writes the n-grams of all texts; gives figures."""
    start = words.starts[-1]  # the number of what is before the first word

    def counted(numbers: np.ndarray) -> np.ndarray:
        known, place = np.unique(numbers, return_inverse=True)
        real = known < start
        return np.concatenate((words.counts(known[real]), np.full(np.count_nonzero(~real), tokens)))[place]

    def dealt(grams: list[np.ndarray], n: np.ndarray) -> Iterator[pa.RecordBatch]:
        rarest = np.minimum.reduce([counted(column) for column in grams[:-1]])
        return _packed(grams, n, deal.of(_keys(grams[:-1]), grams[-1], rarest))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for buffer in _buffers(batches):
            yield from dealt(*_distinct(_grams(words, buffer, order), None))

    def write(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, list[tuple[int, bytes]]] = {}
            for batch in batches:
                blocks = batch.column(3)
                figures = blocks.is_null()
                if figures.true_count:
                    yield batch.filter(figures)
                for row in batch.filter(pc.invert(figures)).to_pylist():
                    held.setdefault(row["shard"], []).append((row["n"], row["block"]))
            for shard in list(held):
                parts = [_unpack(block, length + 1, n) for n, block in held.pop(shard)]
                *columns, n = np.concatenate(parts, axis=1)
                del parts
                grams, n = _distinct(columns, n)
                _write_shard(f"{folder}/{length}/{shard}", grams, n)
                kinds = np.bincount(np.minimum(n, 5), minlength=6)[1:5]
                yield _figures([_sizes(length, i) for i in (1, 2, 3, 4)] + [_file(length, shard)], [*kinds, 1])
                if length > 2:
                    yield from dealt(*_distinct(grams[1:], None))
                else:
                    yield _figures(*np.unique(grams[1].astype(np.int64), return_counts=True))

        return shards

    rows, saved = texts.mapInArrow(local, _ROWS), []
    for length in range(order, 1, -1):
        # saved, so that the shuffle files of a length are gone before the next
        rows = steps.save(rows.repartition(deal.shards, "shard").mapInArrow(write(length), _ROWS))
        steps.drop(*saved)
        saved = [rows]
    return rows


def _columns(numbers: np.ndarray, texts: list[np.ndarray], start: int, order: int) -> list[np.ndarray]:
    """The n-gram that ends at each token, of all texts in a row: word by word."""
    sizes = np.array([len(text) for text in texts])
    at = np.arange(len(numbers))
    at -= np.repeat(np.cumsum(sizes) - sizes, sizes)
    columns = [numbers]
    for back in range(1, order):
        before = np.full(len(numbers), start, dtype=numbers.dtype)
        before[back:] = numbers[:-back]
        before[at < back] = start
        columns.append(before)
    return columns[::-1]


def _grams(words: Words, buffer: list[np.ndarray], order: int) -> list[np.ndarray]:
    """The n-grams of some training texts as columns of 32-bit numbers."""
    hashes, place = np.unique(np.concatenate(buffer), return_inverse=True)
    numbers = words.numbers(hashes)[0].astype("<u4")[place]
    del hashes, place
    return _columns(numbers, buffer, words.starts[-1], order)


@dataclass(frozen=True)
class Model:
    """Files and totals of a fitted model."""

    folder: str
    words: Words
    tokens: int
    order: int
    deal: Deal
    chunk: int
    #: By length, from 2.
    discounts: dict[int, Discounts]
    before: Discounts
    pair_kinds: int
    freed_before: float
    #: Lengths and shards that have files; in the others there is nothing.
    files: frozenset[tuple[int, int]]

    @property
    def distinct(self) -> int:
        return self.words.starts[-1]

    def words_before(self, numbers: np.ndarray) -> np.ndarray:
        """How many different words are in front of words by number; 0 for -1 and what is before the first."""
        found = np.zeros(len(numbers), dtype=np.int64)
        real = (numbers >= 0) & (numbers < self.distinct)
        chunk = np.where(real, numbers // self.chunk, -1)
        if not self.pair_kinds:
            return found  # of no texts there are no files
        for one in np.unique(chunk[chunk >= 0]):
            at = np.flatnonzero(chunk == one)
            (known,) = _mapped(f"{self.folder}/before/{one}", "<u4")
            found[at] = known[numbers[at] - one * self.chunk]
        return found

    def look_up(
        self, length: int, context: list[np.ndarray], rarest: np.ndarray, of: np.ndarray, last: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Statistics of contexts, and counts of n-grams made of one of these (``of``) and a last word.

        Statistics are rows of the total and of n-grams with counts of 1, 2 and more.  Below the
        order, counts are those of different words in front.
        """
        parts, keys = self.deal.parts(rarest), _keys(context)
        # an entry for each context and shard that it is dealt to, in the order of shards and keys
        begin = np.cumsum(parts) - parts
        own = np.repeat(np.arange(len(rarest)), parts)
        keys = keys[own]
        shard = self.deal.shard(keys, np.arange(len(own)) - begin[own])
        order = np.argsort(keys)
        small = np.min_scalar_type(self.deal.shards)  # 16 bits are put in order without comparisons
        order = order[np.argsort(shard[order].astype(small), kind="stable")]
        keys, shard = keys[order], shard[order]
        number = np.empty(len(own), dtype=np.int64)
        number[order] = np.arange(len(own))
        del own, order
        # n-grams in the order of entries and last words, which is that of their keys in a file
        entry = number[begin[of] + self.deal.spread(last) % parts[of]]
        del parts
        grams = (entry.astype(np.uint64) << _32) | last.astype(np.uint64)
        by = np.argsort(grams)
        entry, last = entry[by], grams[by] & np.uint64(0xFFFFFFFF)
        del grams
        place, lone = np.full(len(keys), -1), np.full(len(keys), -1)
        stats, found = np.zeros((4, len(keys)), dtype=np.int64), np.zeros(len(of), dtype=np.int64)
        starts = _runs(shard) if len(shard) else []
        ends = np.append(starts[1:], len(shard))
        gram_starts, gram_ends = np.searchsorted(entry, starts), np.searchsorted(entry, ends)
        for begins, end, first, after in zip(starts, ends, gram_starts, gram_ends):
            one = int(shard[begins])
            if (length, one) not in self.files:
                continue
            columns = _mapped(f"{self.folder}/{length}/{one}", *_SHARD)
            once, contexts, single, more = columns[:4]
            words, wide, most, narrow, few = columns[4], columns[5:10], columns[10:12], columns[12:16], columns[16]
            at = _found(contexts, contexts, keys[begins:end])[0]
            place[begins:end] = at
            known, unknown = begins + np.flatnonzero(at >= 0), begins + np.flatnonzero(at < 0)
            at = place[known]
            for row, values in zip(stats, narrow):
                row[known] = values[at]
            known = known[stats[0, known] == _WIDE]
            apart = np.searchsorted(wide[0], place[known])
            for row, values in zip(stats, wide[1:]):
                row[known] = values[apart]
            hit, word = _found(once, words, keys[unknown])
            known, word = unknown[hit >= 0], word[hit >= 0]
            lone[known], stats[0, known], stats[1, known] = word, 1, 1
            own, ending, counts = entry[first:after], last[first:after], found[first:after]
            counts[:] = lone[own] == ending.view(np.int64)
            own = place[own]
            at = np.flatnonzero(own >= 0)
            sought = (own[at].astype(np.uint64) << _32) | ending[at]
            hit = _found(single, single, sought)[0] >= 0
            counts[at[hit]] = 1
            at, sought = at[~hit], sought[~hit]
            hit, counts[at] = _found(more, few, sought)
            apart = counts[at] == _WIDE
            counts[at[apart]] = most[1][np.searchsorted(most[0], hit[apart])]
        counts = np.empty_like(found)
        counts[by] = found
        return np.array([np.add.reduceat(row[number], begin) for row in stats]) if len(begin) else stats, counts

    def delete(self, steps: Steps) -> None:
        """Remove the files."""
        jvm = steps.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(f"file://{self.folder}")
        conf = steps.spark.sparkContext._jsc.hadoopConfiguration()
        at.getFileSystem(conf).delete(at, True)


def fit(
    texts: DataFrame, text_col: str = "text", order: int = ORDER, frequent: int | None = None
) -> Model:
    """A model of the given texts; a NULL text is an empty one, which is an end alone.

    ``order`` is the number of words of the longest n-grams, from 2 to 8.  What is before the first
    word of a text is one word, as often as the order needs.  Contexts of three and more words are
    known by a 64-bit hash.  There may be 2**32 - 2 different words and 2**32 - 1 of an n-gram; more
    are refused.  ``frequent`` is how often the rarest word of a context may occur for it to go to one
    shard, by default an eighth of a shard; it has no influence on the scores.  Bytes that are not
    UTF-8 become replacement characters.
    """
    if not 2 <= order <= MOST_ORDER:
        raise ValueError(f"an order from 2 to {MOST_ORDER}")
    spark = texts.sparkSession
    steps = Steps(spark)
    folder = local_path(steps.folder)
    texts = texts.select(F.make_valid_utf8(F.col(text_col)).alias("text"))
    words, tokens = _count_words(steps, texts, f"{folder}/words")
    distinct = words.starts[-1]
    if distinct + 1 >= 1 << 32:
        raise ValueError("more different words than 32-bit numbers")
    shards = max(partitions(spark), -(-tokens // TOKENS_OF_SHARD))
    deal = Deal(shards, max(1, tokens // shards // 8 if frequent is None else frequent))
    partial = _count_grams(steps, texts, words, tokens, folder, deal, order)
    stats = steps.save(partial.groupBy("mark").agg(F.sum("n").alias("n")))
    steps.drop(partial)
    # One row for each file, and four for each length.
    figures = {r["mark"]: r["n"] for r in stats.filter("mark < 0").collect()}
    files = frozenset(((-1000 - mark) % 16, (-1000 - mark) // 16) for mark in figures if mark <= -1000)
    real = stats.filter("mark >= 0")
    m = real.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("all"),
        *[F.count_if(F.col("n") == i).alias(f"m{i}") for i in (1, 2, 3, 4)],
        F.count_if(F.col("n") > 2).alias("more"),
    ).first()
    chunks = max(partitions(spark), -(-distinct // WORDS_OF_SHARD))
    chunk = -(-(distinct + 1) // chunks)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if whole is not None:
            number, n = whole.column("mark").to_numpy(), whole.column("n").to_numpy()
            for one in np.unique(number // chunk):
                at = np.flatnonzero(number // chunk == one)
                values = np.zeros(chunk, dtype="<u4")  # at most as many as there are words, and the start
                values[number[at] - one * chunk] = n[at]
                _write(f"{folder}/before/{one}", values)
            yield pa.RecordBatch.from_arrays([pa.array([len(number)])], names=["n"])

    dealt = real.repartition(chunks, F.floor(F.col("mark") / chunk))
    steps.drop(steps.save(dealt.mapInArrow(write, "n bigint")), stats)
    before = Discounts.of(m["m1"], m["m2"], m["m3"], m["m4"])
    return Model(
        folder,
        words,
        tokens,
        order,
        deal,
        chunk,
        {n: Discounts.of(*(figures.get(_sizes(n, i), 0) for i in (1, 2, 3, 4))) for n in range(2, order + 1)},
        before,
        int(m["all"]),
        float(before.freed(m["m1"], m["m2"], m["more"])),
        files,
    )


def _scores(model: Model, texts: list[np.ndarray]) -> list[np.ndarray]:
    """Tokens, known tokens, base and model log10 of each text."""
    sizes = np.array([len(t) for t in texts])
    begin = np.cumsum(sizes) - sizes
    hashes, place = np.unique(np.concatenate(texts), return_inverse=True)
    numbers, counts = model.words.numbers(hashes)
    # one more word, last: what is before the first
    start = len(hashes)
    del hashes
    numbers, often = np.append(numbers, model.distinct), np.append(counts, model.tokens)
    new = 1.0 / (model.distinct + 1)
    if model.pair_kinds:
        before = model.words_before(numbers)
        shared = model.freed_before / model.pair_kinds * new
        probable = np.maximum(before - model.before.taken(before), 0) / model.pair_kinds + shared
    else:
        probable = np.full(len(numbers), new)
    # by token, the number of the n-gram that ends there; by number, its words, and last those of
    # what is before the first, which are the contexts of n-grams that are longer by a word
    gram, held = place, [np.arange(start + 1)]
    for length in range(2, model.order + 1):
        context = np.empty_like(gram)
        context[1:] = gram[:-1]
        context[begin] = len(held[0]) - 1
        at, wider = _ranked(context << 32 | place)
        of, last = context[at], numbers[place[at]]
        del context
        # contexts of known words, and their n-grams with a known word
        real = np.minimum.reduce([numbers[x] for x in held]) >= 0
        known = np.flatnonzero(real[of] & (last >= 0))
        found = model.look_up(
            length,
            [numbers[x[real]] for x in held],
            np.minimum.reduce([often[x[real]] for x in held]),
            (np.cumsum(real) - 1)[of[known]],
            last[known],
        )
        stats, seen = np.zeros((4, len(real)), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        stats[:, real], seen[known] = found
        del found, last, known
        total, discounts = np.maximum(stats[0], 1), model.discounts[length]
        left_over = np.where(stats[0] > 0, discounts.freed(*stats[1:]) / total, 1.0)
        probable = np.maximum(seen - discounts.taken(seen), 0) / total[of] + left_over[of] * probable[gram[at]]
        held = [np.append(x, start) for x in (*(x[of] for x in held), place[at])]
        gram = wider
    base = np.log10((counts + 1) / (model.tokens + model.distinct + 1))[place]
    score = np.log10(probable)[gram]
    sums = [np.add.reduceat(x, begin) for x in ((counts[place] > 0).astype(np.int64), base, score)]
    return [sizes, *sums]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, n_known, train_tokens, base_score, score, perplexity) of each row.

    ``base_score`` is by add-one counts, ``score`` by the model, both log10 of the whole text.  A
    NULL or empty text is the end alone, and bytes that are not UTF-8 become replacement characters.
    A row with a NULL or repeated id is like any other.
    """

    names = ["id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]

    def scored(held: list[tuple[pa.Array, list[np.ndarray]]]) -> pa.RecordBatch:
        n, known, base, own = _scores(model, [text for _, texts in held for text in texts])
        columns = [
            pa.concat_arrays([ids for ids, _ in held]),
            pa.array(n.astype(np.int64)),
            pa.array(known.astype(np.int64)),
            pa.array(np.full(len(n), model.tokens, dtype=np.int64)),
            pa.array(base),
            pa.array(own),
            pa.array(10 ** (-own / n)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in rows:
            if batch.num_rows:
                held.append((batch.column(0), [token_hashes(t.as_py()) for t in batch.column(1)]))
                size += sum(map(len, held[-1][1]))
                if size >= SCORED:
                    yield scored(held)
                    held, size = [], 0
        if held:
            yield scored(held)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    found = docs.select(id_col, F.make_valid_utf8(F.col(text_col))).mapInArrow(
        batches, f"id {kind}, {schema}, perplexity double"
    )
    return found.withColumnRenamed("id", id_col)
