"""Token ids of whole texts by a public tokenizer file, each distinct pre-token encoded once per worker.

The tokenizer lower-cases, cuts a text into pre-tokens (letter runs, single digits, symbol runs, a few
contractions) and merges within each of them; white space is dropped. So a text's ids are those of its
pre-tokens in order. Texts of Latin-1 characters, where lower case and letters depend on nothing but the
character, are cut into pre-tokens here, and only these go to the tokenizer's merges, so that a word is the
same with a comma and without. All other texts go to the tokenizer whole.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Sequence
from operator import attrgetter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ledgerloom.llm.common import KEPT_BY_WORKER, begin_other_work

#: The tokenizer file of the registered queries, and the id that ends a document.
TOKENIZER = "word_bpe_49k.json"
END_ID = 1

#: Pre-tokens a worker remembers, in two halves: when the newer is full, the older goes. This bounds memory and
#: changes no result. A half just fits a dictionary of 2**18 places, two thirds of which may be taken.
REMEMBERED = 348_000
LONGEST_REMEMBERED = 64
#: Texts that are encoded at once.
BATCH_TEXTS = 256

# Fixed values of the tokenizer, for the bytes of Latin-1 texts: letters, numbers and white space, all else being
# symbols; contractions; what begins a special token. Upper case becomes lower case, white space a blank.
_SPACE, _LETTER, _NUMBER, _SYMBOL = range(4)
_SPACES = {*range(0x09, 0x0E), 0x20, 0x85, 0xA0}
_NUMBERS = {*b"0123456789\xb2\xb3\xb9\xbc\xbd\xbe"}
_LOWERED = bytes(0x20 if byte in _SPACES else ord(chr(byte).lower()) for byte in range(256))
_KINDS = bytes(
    _SPACE if byte in _SPACES else _NUMBER if byte in _NUMBERS else _LETTER if chr(byte).isalpha() else _SYMBOL
    for byte in range(256)
)
_CONTRACTIONS = re.compile(rb"'(?:s|t|re|ve|m|ll|d)")
_SPECIAL = b"<|"
#: Bytes as the merges know them: those that print in Latin-1 stand for themselves, the others follow from 256 on.
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_OTHERS = [byte for byte in range(256) if byte not in _PRINTED]
_BYTE_LEVEL = {byte: chr(byte) for byte in _PRINTED} | {byte: chr(256 + n) for n, byte in enumerate(_OTHERS)}
_LEVELLED = {n: "".join(_BYTE_LEVEL[byte] for byte in chr(n).encode()) for n in range(256)}


def tokenizer_path(name: str = TOKENIZER) -> str:
    return public_tokenizers.path(name)


_PACKERS = [struct.Struct(f"<{n}I") for n in range(LONGEST_REMEMBERED)]


def _packed(ids: Sequence[int]) -> bytes:
    if len(ids) < len(_PACKERS):
        return _PACKERS[len(ids)].pack(*ids)
    return np.asarray(ids, dtype="<u4").tobytes()


_ID = attrgetter("id")


class _PreTokens(dict):
    """Latin-1 bytes of a pre-token -> ids. What is not there is learned, and kept if it is not long."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self._merges = tokenizer.model.tokenize
        self._before: dict[bytes, bytes] = {}

    def __missing__(self, pre_token: bytes) -> bytes:
        ids = self._before.get(pre_token)
        if ids is None:
            text = pre_token.decode("latin-1")
            levelled = text if pre_token.isalpha() else text.translate(_LEVELLED)
            ids = _packed(list(map(_ID, self._merges(levelled))))
            if len(pre_token) > LONGEST_REMEMBERED:
                return ids
        if len(self) >= REMEMBERED // 2:
            self._before = dict(self)
            self.clear()
        self[pre_token] = ids
        return ids


def _pre_tokens(data: bytes) -> list[bytes]:
    """The pre-tokens of a lower-cased Latin-1 text: blanks go between them, so that they are its words."""
    kinds = np.frombuffer(data.translate(_KINDS), np.uint8)
    before, after = kinds[:-1], kinds[1:]
    cut = (before != after) | (after == _NUMBER)
    cut &= (before != _SPACE) & (after != _SPACE)
    # Where symbols begin with a contraction, it is a pre-token; elsewhere the apostrophe is one symbol of many.
    for found in _CONTRACTIONS.finditer(data):
        start, end = found.span()
        if not start or kinds[start - 1] != _SYMBOL:
            cut[start] = False
            if end < len(data):
                cut[end - 1] = kinds[end] != _SPACE
    return np.insert(np.frombuffer(data, np.uint8), np.flatnonzero(cut) + 1, 0x20).tobytes().split()


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        self._tokenizer = Tokenizer.from_file(path)
        self.known = _PreTokens(self._tokenizer)

    def whole(self, text: str) -> bytes:
        return _packed(self._tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text; null counts as empty."""
        text = text or ""
        try:
            data = text.encode("latin-1")
        except UnicodeEncodeError:
            return self.whole(text)
        if _SPECIAL in data:
            return self.whole(text)
        return b"".join(map(self.known.__getitem__, _pre_tokens(data.translate(_LOWERED))))

    def encode_batch(self, texts: Sequence[str | None]) -> list[bytes]:
        return list(map(self.encode, texts))


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a tokenizer file, kept until the worker does other work, whose memory it takes."""
    if path not in KEPT_BY_WORKER:
        begin_other_work()
        KEPT_BY_WORKER[path] = WordEncoder(path)
    return KEPT_BY_WORKER[path]
