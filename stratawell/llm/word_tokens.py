"""Token ids of texts by a word-level BPE of the tokenizers library, word by word."""

from __future__ import annotations

import re
import struct

from tokenizers import Tokenizer

#: Words kept with their ids by one worker; beyond it, it starts anew.
KEPT_WORDS = 1_200_000


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordTokens(dict):
    """Ids of a text as little-endian unsigned 32-bit numbers, remembered by word.

    Holds for tokenizers that drop white space and treat what stands between as separate texts, as
    those with lower case, NFC and a split at white space do.  Words of printable ASCII are
    lower-cased and split here and go to the BPE model; any other goes through the whole tokenizer.

    Names of the tokenizer's added tokens in a text are text, unless ``added_tokens`` is set: then
    they have their own ids, as by the tokenizer's default, and a text with one goes through the
    whole tokenizer in one.
    """

    #: The tokenizer's own split, for lower-case ASCII.
    _parts = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+").findall
    _plain = re.compile(r"[!-~]*").fullmatch

    def __init__(self, path: str, added_tokens: bool = False):
        super().__init__()
        self._whole = Tokenizer.from_file(path)
        self._whole.encode_special_tokens = not added_tokens
        self._model = self._whole.model
        names = [t.content for t in self._whole.get_added_tokens_decoder().values()]
        # in any case: too many texts may go through the whole tokenizer, but not too few
        pattern = re.compile("|".join(map(re.escape, names)), re.IGNORECASE)
        self._has_added = pattern.search if added_tokens and names else None

    def __missing__(self, word: str) -> bytes:
        if self._plain(word):
            tokenize = self._model.tokenize
            ids = [token.id for part in self._parts(word.lower()) for token in tokenize(part)]
        else:
            ids = self._whole_ids(word)
        packed = self[word] = _packed(ids)
        return packed

    def _whole_ids(self, text: str) -> list[int]:
        return self._whole.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> bytes:
        if len(self) > KEPT_WORDS:
            self.clear()
        if self._has_added and self._has_added(text):
            return _packed(self._whole_ids(text))
        if text.isascii():
            text = text.lower()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))
