"""Texts to padded token ids in Arrow batches.

The same ids as cleaning, splitting, pairing and hashing by column expressions, which run in Spark's
interpreter. Here a batch is classified byte by byte in one array; only hashing looks at single tokens.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgertag.domain import NOISE_PATTERN

# Batch functions travel with their code, as in ``vectors``.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _kept_bytes() -> np.ndarray:
    """By byte: letters in lower case and digits; zero for all others, which become spaces."""
    kept = np.zeros(256, np.uint8)
    for byte in b"abcdefghijklmnopqrstuvwxyz0123456789":
        kept[byte] = kept[ord(chr(byte).upper())] = byte
    return kept


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each text begins and the last one ends."""
    _, places, content = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    ends = np.frombuffer(places, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    flat = np.frombuffer(content, np.uint8) if content else np.zeros(0, np.uint8)
    return flat[ends[0] : ends[-1]], ends - ends[0]


def _words(flat: np.ndarray, ends: np.ndarray, table: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """All tokens of all texts in their order, and the text that each belongs to.

    Letters and digits that stand alone are kept; a token is a run of them within a text.
    """
    low = table[flat]
    first = np.zeros(len(flat) + 1, bool)
    first[ends] = True  # of its text; one past the last byte, too
    digit = (low >= ord("0")) & (low <= ord("9"))
    paired = digit[1:] & digit[:-1] & ~first[1:-1]  # with the byte before
    kept = low > 0
    kept[1:] &= ~paired
    kept[:-1] &= ~paired
    begins, stops = kept.copy(), kept.copy()
    joined = kept[1:] & kept[:-1] & ~first[1:-1]
    begins[1:] &= ~joined
    stops[:-1] &= ~joined
    starts = np.flatnonzero(begins)
    whole = low.tobytes()
    words = [whole[a:b] for a, b in zip(starts.tolist(), (np.flatnonzero(stops) + 1).tolist(), strict=True)]
    return words, np.searchsorted(ends, starts, side="right") - 1


def _long_text_words(text: str, noise: re.Pattern, most: int) -> list[bytes]:
    """Tokens of a text with as many as allowed or more: the last one holds all that remains."""
    cleaned = noise.sub(" ", text).lower().lstrip(" ")
    pieces = [cleaned] if most == 1 else re.split(" +", cleaned, maxsplit=max(most - 1, 0))
    return [piece.encode() for piece in pieces if piece]


def batch_token_ids(texts: pa.Array, length: int, buckets: int) -> pa.Array:
    """Ids of all tokens of a text, then of all neighbouring pairs, padded with zeros; null for null."""
    most, noise = length // 2, re.compile(NOISE_PATTERN, re.ASCII)
    filled = texts.fill_null("")
    words, of = _words(*_flat(filled), _kept_bytes())
    counts = np.bincount(of, minlength=len(texts))
    known: dict[bytes, int] = {}

    def id_of(gram: bytes) -> int:
        found = known.get(gram)
        if found is None:
            digest = hashlib.md5(gram, usedforsecurity=False).digest()
            found = known[gram] = int.from_bytes(digest[:4], "big") % (buckets - 1) + 1
        return found

    ids = np.zeros((len(texts), length), np.int32)
    place = np.arange(len(words)) - (np.cumsum(counts) - counts)[of]
    short = counts < most
    left = np.flatnonzero(of[1:] == of[:-1])
    second = counts[of[left]] + place[left]
    singles = np.flatnonzero(short[of])
    pairs = np.flatnonzero(short[of[left]])
    ids[of[singles], place[singles]] = [id_of(words[j]) for j in singles.tolist()]
    at = left[pairs]
    ids[of[at], second[pairs]] = [id_of(words[j] + b" " + words[j + 1]) for j in at.tolist()]
    for row in np.flatnonzero(~short).tolist():
        some = _long_text_words(filled[row].as_py(), noise, most)
        grams = some + [a + b" " + b for a, b in zip(some, some[1:])]
        ids[row, : len(grams)] = [id_of(gram) for gram in grams[:length]]
    places = pa.array(np.arange(0, (len(texts) + 1) * length, max(length, 1), dtype=np.int32)[: len(texts) + 1])
    missing = pa.array(~texts.is_valid().to_numpy(zero_copy_only=False))
    return pa.ListArray.from_arrays(places, pa.array(ids.ravel()), mask=missing)


def token_ids_udf(length: int, buckets: int) -> Callable[..., Column]:
    """text -> padded token ids."""

    @F.arrow_udf("array<int>")
    def padded_token_ids(texts: pa.Array) -> pa.Array:
        return batch_token_ids(texts, length, buckets)

    return padded_token_ids
