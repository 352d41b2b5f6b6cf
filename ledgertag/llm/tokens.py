"""Token ids of public tokenizers.

A word-level BPE never joins what white space parts, so the ids of a text are those of its words. Most
words are repeated; a worker process keeps the ids of words it has met, within a bound. The byte-level
one is fast enough on whole texts, and a memory of words only slows it down.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import public_tokenizers

# Words of one generation; the one before is kept, too, and words that are met again move up.
MAX_KEPT_WORDS = 500_000
WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.tiktoken"


class WordIds(dict):
    """Ids (little-endian, four bytes each) by word, for a tokenizer file with word ends.

    The keys are words in Latin-1, lower-cased in A-Z. A plain word, letters and at most one full
    stop or comma, goes right to the merges; all others go through the whole tokenizer.
    """

    plain = re.compile(rb"[a-z\xdf-\xf6\xf8-\xff]+[.,]?").fullmatch

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        visible = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # The merges know bytes as visible characters. Only continuation and lead bytes of
        # Latin-1 letters are needed here.
        self.visible = {}
        for code in [*range(0xDF, 0xF7), *range(0xF8, 0x100)]:
            shown = visible.pre_tokenize_str(chr(code))[0][0]
            self.visible |= dict(zip(chr(code).encode(), shown, strict=True))
        self.marks = {b: self.ids(chr(b)) for b in b".,"}
        self.before: dict[bytes, bytes] = {}

    def ids(self, text: str) -> bytes:
        found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(found, "<u4").tobytes()

    def _found(self, word: bytes) -> bytes:
        if not self.plain(word):
            return self.ids(word.decode("latin-1"))
        if word[-1] in self.marks:
            return self[word[:-1]] + self.marks[word[-1]]
        shown = word.decode("latin-1")
        if not shown.isascii():
            shown = "".join(self.visible.get(b, chr(b)) for b in shown.encode())
        return np.array([t.id for t in self.merges.tokenize(shown)], "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        value = self.before.get(word)
        if value is None:
            value = self._found(word)
        if len(self) >= MAX_KEPT_WORDS:
            self.before = dict(self)
            self.clear()
        self[word] = value
        return value

    def encode(self, text: str) -> bytes:
        try:
            # bytes.lower() and bytes.split() know ASCII only, which is what the tokenizer agrees to.
            words = text.encode("latin-1").lower().split()
        except UnicodeEncodeError:
            return self.ids(text)
        return b"".join(map(self.__getitem__, words))


class ByteIds:
    """Ids for a file of byte-level ranks, a whole text at a time."""

    def __init__(self, path: str) -> None:
        import base64

        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoder = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def ids(self, text: str) -> bytes:
        """Two bytes for each id."""
        return np.array(self.encoder.encode_ordinary(text), "<u2").tobytes()

    encode = ids


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One for each worker process."""
    return WordIds(path)


@lru_cache(maxsize=2)
def byte_ids(path: str) -> ByteIds:
    return ByteIds(path)
