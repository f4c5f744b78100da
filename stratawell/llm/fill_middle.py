"""Texts rearranged so that a model learns to fill in their middle.

A text is cut twice, each time behind a number of its units.  A Fenwick tree over fixed blocks of the
text has the units and code points that end in each block; a descent by halving steps finds the block
of a cut and what lies before it, and only that block is looked through for the place itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratawell.llm.common import unused

#: Bytes of a block.
BLOCK = 4096
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARKS = tuple(mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE))


class BlockTree:
    """A Fenwick tree over the blocks of a text in UTF-8: units and code points that end in each.

    Units are code points, or the matches of a pattern, left to right; what lies between matches
    belongs to no unit.
    """

    def __init__(self, text: bytes, unit: re.Pattern | None = None, block: int = BLOCK):
        self.block, self.size = block, len(text)
        data = np.frombuffer(text, dtype=np.uint8)
        begins = (data & 0xC0) != 0x80
        #: Per byte, whether a code point or a unit ends with it.
        self.char_ends = np.append(begins[1:], True) if len(data) else begins
        if unit is None:
            self.unit_ends = self.char_ends
        else:
            self.unit_ends = np.zeros(len(data), dtype=bool)
            last = np.flatnonzero(self.char_ends)
            ends = [m.end() - 1 for m in unit.finditer(text.decode()) if m.end() > m.start()]
            self.unit_ends[last[ends]] = True
        self.units, self.units_all = self._tree(self.unit_ends)
        self.chars, _ = self._tree(self.char_ends)

    def _tree(self, ends: np.ndarray) -> tuple[list[int], int]:
        starts = np.arange(0, len(ends), self.block)
        counts = np.add.reduceat(ends, starts, dtype=np.int64) if len(ends) else starts
        sums = np.concatenate(([0], np.cumsum(counts)))
        nodes = np.arange(1, len(sums))
        return [0, *(sums[nodes] - sums[nodes - (nodes & -nodes)]).tolist()], int(sums[-1])

    def cut(self, units: int) -> tuple[int, int]:
        """The bytes and the code points up to the end of so many units."""
        if units <= 0:
            return 0, 0
        at, left, chars = 0, units, 0
        step = 1 << (len(self.units) - 1).bit_length()
        while step:
            if at + step < len(self.units) and self.units[at + step] < left:
                at += step
                left -= self.units[at]
                chars += self.chars[at]
            step >>= 1
        first = at * self.block
        place = int(np.flatnonzero(self.unit_ends[first : first + self.block])[left - 1]) + 1
        return first + place, chars + int(np.count_nonzero(self.char_ends[first : first + place]))


def _draws(seed: str, id_col: str) -> list[Column]:
    """Four whole numbers below 2**32, which depend on the id alone."""
    place = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), place), 256)
    return [
        F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"h{i + 1}")
        for i in range(4)
    ]


def rearrange(
    docs: DataFrame,
    seed: str = "1",
    plain_from: int = 90,
    spm_below: int = 20,
    unit: str | None = None,
    block: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id_col, n, form, prefix_chars, middle_chars, output): each text with its middle last.

    ``n`` is the number of units: code points, or matches of ``unit``, a regular expression.  The
    text is cut behind two numbers of units from 0 to n, drawn from the seed and the id.  Form
    ``psm`` gives ``<P>prefix<S>suffix<M>middle`` and ``spm`` ``<S>suffix<P>prefix<M>middle``, the
    latter for draws below ``spm_below`` of 100.  A text stays as it is, form ``plain`` and with
    NULL lengths, if it is empty, holds one of the marks, or is drawn from ``plain_from`` of 100
    on; so ``restore`` gives every text back.

    A NULL text counts as an empty one, a NULL id is drawn for as an empty id; rows with the same
    id are drawn alike.  Other columns are ignored; no rows give no rows.
    """
    size = block or BLOCK

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(unit, re.DOTALL) if unit else None
        for batch in rows:
            texts = batch.column(1).cast(pa.binary())
            draws = zip(*(batch.column(i).to_pylist() for i in range(2, 6)))
            counts, forms, prefixes, middles, outputs = [], [], [], [], []
            for cell, (h1, h2, h3, h4) in zip(texts, draws):
                text = cell.as_py() or b""
                tree = BlockTree(text, pattern, size)
                n = tree.units_all
                counts.append(n)
                if not text or any(mark in text for mark in _MARKS) or h3 % 100 >= plain_from:
                    forms.append("plain")
                    prefixes.append(None)
                    middles.append(None)
                    outputs.append(text)
                    continue
                low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
                (first, before), (second, until) = tree.cut(low), tree.cut(high)
                parts = (_MARKS[0], text[:first]), (_MARKS[1], text[second:])
                spm = h4 % 100 < spm_below
                forms.append("spm" if spm else "psm")
                prefixes.append(before)
                middles.append(until - before)
                ordered = (*(parts[::-1] if spm else parts), (_MARKS[2], text[first:second]))
                outputs.append(b"".join(mark + part for mark, part in ordered))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(forms, pa.string()),
                    pa.array(prefixes, pa.int64()),
                    pa.array(middles, pa.int64()),
                    pa.array(outputs, pa.binary()).cast(pa.string()),
                ],
                names=["id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.make_valid_utf8(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), *_draws(seed, id_col))
    done = rows.mapInArrow(
        batches,
        f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string",
    )
    return done.withColumnRenamed("id", unused(done.drop("id"), id_col))


def restore(output: Column, form: Column) -> Column:
    """The text that ``rearrange`` made an output of.

    A text that is not plain holds no mark, and no mark arises where parts meet, as each starts
    with the one character that it has only there.
    """
    part = F.split(output, "<[PSM]>", -1)
    return (
        F.when(form == "psm", F.concat(F.get(part, 1), F.get(part, 3), F.get(part, 2)))
        .when(form == "spm", F.concat(F.get(part, 2), F.get(part, 3), F.get(part, 1)))
        .otherwise(output)
    )
