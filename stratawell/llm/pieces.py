"""Encoding and decoding with a sentencepiece BPE model, by backtracking.

A split of a text into pieces is what merging yields if, and only if, each two neighbours are what
merging yields for the two alone.  So the encoder walks from left to right: it takes the longest
piece that starts here (an Aho-Corasick automaton tells), or the next shorter one, as long as it
is compatible with the piece before, which is tested by merging the two again.  Where nothing
fits, it marks the position as failed and takes back the last piece.  Each position fails once at
most, so the work is linear in the length of the text.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

SPACE = "▁"
#: What one worker remembers; beyond it, it starts anew.
KEPT_WORDS = 1_000_000
KEPT_PAIRS = 300_000


def merged(text: str, rank: dict[str, int]) -> list[str]:
    """The symbols left of a text after merging neighbours, the piece of lowest rank first."""
    symbols = list(text)
    while len(symbols) > 1:
        at, best = -1, None
        for i in range(len(symbols) - 1):
            found = rank.get(symbols[i] + symbols[i + 1])
            if found is not None and (best is None or found < best):
                at, best = i, found
        if best is None:
            break
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
    return symbols


class _Fits(dict):
    """Whether two symbols stay apart when what they spell is merged."""

    def __init__(self, rank: dict[str, int]):
        super().__init__()
        self._rank = rank

    def __missing__(self, pair: tuple[str, str]) -> bool:
        if len(self) > KEPT_PAIRS:
            self.clear()
        left, right = pair
        known = self[pair] = merged(left + right, self._rank) == [left, right]
        return known


class _Shorter(dict):
    """The longest piece that a longer one starts with; a single character always counts."""

    def __init__(self, automaton: ahocorasick.Automaton):
        super().__init__()
        self._exists = automaton.exists

    def __missing__(self, piece: str) -> str | None:
        lengths = range(len(piece) - 1, 1, -1)
        shorter = next((piece[:n] for n in lengths if self._exists(piece[:n])), None)
        found = self[piece] = shorter or (piece[:1] if len(piece) > 1 else None)
        return found


class PieceModel(dict):
    """The encoder of a BPE model without user-defined pieces.

    As a dict, it has the packed ids of the words seen of late.
    """

    def __init__(self, path: str):
        super().__init__()
        self.library = library = sentencepiece.SentencePieceProcessor(model_file=path)
        special = (library.is_unknown, library.is_control, library.is_unused, library.is_byte)
        self._ids = {
            library.id_to_piece(i): i
            for i in range(library.get_piece_size())
            if not any(kind(i) for kind in special)
        }
        by_score = sorted(self._ids, key=lambda piece: -library.get_score(self._ids[piece]))
        rank = {piece: at for at, piece in enumerate(by_score)}
        self._bytes = [library.piece_to_id(f"<0x{byte:02X}>") for byte in range(256)]
        # A piece that merging never builds from its characters cannot come out of merging.
        self._automaton = ahocorasick.Automaton()
        for piece in self._ids:
            if merged(piece, rank) == [piece]:
                self._automaton.add_word(piece, len(piece))
        self._automaton.make_automaton()
        self._shorter = _Shorter(self._automaton)
        self._fits = _Fits(rank)
        #: No piece continues over the start of a word, so words can be encoded one by one.
        self._by_word = not any(SPACE in piece.lstrip(SPACE) for piece in self._ids)

    def split(self, word: str) -> list[str]:
        """The symbols that merging yields for a word, found by backtracking."""
        size, fits, shorter = len(word), self._fits, self._shorter
        longest = [1] * size
        for end, length in self._automaton.iter(word):
            if length > longest[end - length + 1]:
                longest[end - length + 1] = length
        # the bitfield: positions from which, as far as is known, the rest can be split
        open_ = bytearray(b"\1") * (size + 1)
        symbols: list[str] = []
        at, last = 0, None
        piece: str | None = word[: longest[0]]
        while at < size:
            while piece is not None:
                end = at + len(piece)
                if open_[end] and (last is None or fits[last, piece]):
                    break
                piece = shorter[piece]
            if piece is not None:
                symbols.append(piece)
                at, last = end, piece
                piece = word[at : at + longest[at]] if at < size else None
            else:
                open_[at] = 0
                piece = symbols.pop()
                at -= len(piece)
                last = symbols[-1] if symbols else None
        return symbols

    def __missing__(self, word: str) -> bytes:
        ids: list[int] = []
        for symbol in self.split(word):
            known = self._ids.get(symbol)
            if known is not None:
                ids.append(known)
            else:
                ids += [self._bytes[byte] for byte in symbol.encode()]
        packed = self[word] = struct.pack(f"<{len(ids)}i", *ids)
        return packed

    _words = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall

    def encode(self, text: str) -> bytes:
        """Ids as little-endian signed 32-bit numbers."""
        if len(self) > KEPT_WORDS:
            self.clear()
        normal = self.library.normalize(text)
        words = self._words(normal) if self._by_word else [normal] if normal else []
        return b"".join(map(self.__getitem__, words))


@lru_cache(maxsize=2)
def _model(path: str) -> PieceModel:
    return PieceModel(path)  # kept by a worker for its next tasks


def encode_decode(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id_col, ids, decoded) of each row: its piece ids, and the text the library makes of them.

    A NULL or empty text has no ids and decodes to the empty text.  A row with a NULL or repeated
    id is treated like any other; other columns are ignored; no rows give no rows.
    """

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _model(model)
        for batch in rows:
            packed = [pieces.encode(text.as_py() or "") for text in batch.column(1)]
            ends = np.cumsum([0, *(len(ids) // 4 for ids in packed)], dtype=np.int32)
            values = np.frombuffer(b"".join(packed), dtype="<i4")
            decode = pieces.library.decode
            decoded = [
                decode(values[a:b].tolist()) if b > a else "" for a, b in zip(ends[:-1], ends[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
                    pa.array(decoded, pa.string()),
                ],
                names=["id", "ids", "decoded"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    encoded = docs.select(id_col, text_col).mapInArrow(
        batches, f"id {kind}, ids array<int>, decoded string"
    )
    return encoded.withColumnRenamed("id", id_col)
