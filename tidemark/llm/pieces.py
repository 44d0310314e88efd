"""Fast exact token ids: the tokenizer library codes each distinct word piece once per worker.

A byte-pair tokenizer first cuts a text into pieces and then codes every piece on its own, so equal
pieces have equal ids. Texts made of common Latin characters are cut here with the tokenizer's own
pattern and their pieces looked up; all other texts, and texts that hold a special token's string,
go to the library whole. Either way the ids are the library's.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

from tidemark.llm.common import keeps, only

#: a worker keeps the ids of so many pieces and codes all others each time: bounds its memory
KEPT_PIECES = 500_000

_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ſ"
#: texts of these characters only are cut here: for them lower case and letter classes are beyond doubt
_PLAIN = re.compile(f"[\t\n\r -~{_LETTERS}]*")

# The patterns that the two tokenizer files name, for the characters above.
_PATTERNS = {
    "words": re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+"),
    "bytes": re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+"),
}


class _Known(dict):
    """Piece to its ids, coded when first asked for."""

    def __init__(self, code) -> None:
        super().__init__()
        self._code = code

    def __missing__(self, piece: str):
        value = self._code(piece)
        # frequent pieces come early
        if len(self) < KEPT_PIECES:
            self[piece] = value
        return value


class PieceCoder:
    """Ids of whole texts by a tokenizer file of the ``tokenizers`` library.

    ``kind`` names the pattern of the file: ``words`` (lower case, white space dropped) or ``bytes``.
    """

    def __init__(self, path: str, kind: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self._library = Tokenizer.from_file(path)
        self._cut = _PATTERNS[kind].findall
        self._lower = kind == "words"
        self._special = [t.content for t in self._library.get_added_tokens_decoder().values()]
        # the library's model codes a piece once its bytes are written as the vocabulary writes them
        written = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        signs = {ord(c): written(c)[0][0] for c in map(chr, range(0x180)) if _PLAIN.fullmatch(c)}
        model = self._library.model
        self._bytes = _Known(lambda p: np.array([t.id for t in model.tokenize(p.translate(signs))], "<u4").tobytes())
        self._counts = _Known(lambda p: len(model.tokenize(p.translate(signs))))

    def _ids(self, text: str) -> list[int]:
        return self._library.encode(text, add_special_tokens=False).ids

    def _pieces(self, text: str) -> list[str] | None:
        if _PLAIN.fullmatch(text) is None or any(s in text for s in self._special):
            return None
        return self._cut(text.lower() if self._lower else text)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        pieces = self._pieces(text)
        if pieces is None:
            return np.array(self._ids(text), "<u4").tobytes()
        return b"".join(map(self._bytes.__getitem__, pieces))

    def count(self, text: str) -> int:
        pieces = self._pieces(text)
        if pieces is None:
            return len(self._ids(text))
        return sum(map(self._counts.__getitem__, pieces))


@lru_cache(maxsize=4)
def _coder(path: str, kind: str) -> PieceCoder:
    return PieceCoder(path, kind)


keeps("pieces", _coder.cache_clear)


def coder(path: str, kind: str) -> PieceCoder:
    """The worker's coder; what it kept for other operators goes."""
    only("pieces")
    return _coder(path, kind)
