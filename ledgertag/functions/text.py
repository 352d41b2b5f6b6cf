"""Text to token ids, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgertag.domain import (
    NOISE_PATTERN,
    SEQUENCE_LENGTH,
    TEST_LABEL_PATTERN,
    VOCABULARY_SIZE,
)
from ledgertag.functions.hashing import hex_to_long
from ledgertag.functions.token_batches import token_ids_udf

PAD_ID = 0


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Use a value several times but compute it once: a one-element transform names it.

    ``use`` must not refer to the value from inside another lambda; Spark then fails to hand
    the result to a Python function.
    """
    return F.transform(F.array(value), lambda bound: use(bound))[0]


def clean_text(text: Column) -> Column:
    """Letters and single digits stay; everything else becomes a space. Lower case."""
    return F.lower(F.regexp_replace(text, NOISE_PATTERN, " "))


def split_tokens(cleaned: Column, max_tokens: int = SEQUENCE_LENGTH // 2) -> Column:
    """Tokens between blanks; the last allowed token holds all the text that remains.

    A split at single blanks needs no pattern and is all that short texts take. Texts with as
    many tokens as allowed, or with very many blanks, are split by pattern and with the limit.
    """
    pieces = F.split(cleaned, " ", 2 * max_tokens)
    words = F.filter(pieces, lambda token: token != "")
    by_pattern = F.split(F.ltrim(cleaned), " +", max_tokens)
    short = (F.size(pieces) < 2 * max_tokens) & (F.size(words) < max_tokens)
    return F.when(short, words).otherwise(F.filter(by_pattern, lambda token: token != ""))


def one_and_two_grams(tokens: Column) -> Column:
    """All tokens, then all neighbouring pairs."""

    def grams(words: Column) -> Column:
        pairs = F.greatest(F.size(words) - 1, F.lit(0))
        first, second = F.slice(words, F.lit(1), pairs), F.slice(words, F.lit(2), pairs)
        return F.concat(words, F.zip_with(first, second, lambda a, b: F.concat(a, F.lit(" "), b)))

    return bind(tokens, grams)


def token_bucket(token: Column, buckets: int = VOCABULARY_SIZE) -> Column:
    """Hash a token to 1 .. buckets-1; 0 is left for padding alone."""
    bucket = hex_to_long(F.md5(token), 1, 8) % F.lit(buckets - 1)
    return (bucket + F.lit(1)).cast("int")


def pad_ids(ids: Column, length: int = SEQUENCE_LENGTH) -> Column:
    return F.slice(F.concat(ids, F.array_repeat(F.lit(PAD_ID), length)), 1, length)


def token_ids(
    text: Column, length: int = SEQUENCE_LENGTH, buckets: int = VOCABULARY_SIZE
) -> Column:
    """Clean, tokenise, pair up, hash and pad, a batch of texts at a time.

    The same ids as ``token_ids_expression``, at a fraction of its time.
    """
    return token_ids_udf(length, buckets)(text)


def token_ids_expression(
    text: Column, length: int = SEQUENCE_LENGTH, buckets: int = VOCABULARY_SIZE
) -> Column:
    """The ids as a column expression, for places that take no Python function."""
    tokens = bind(clean_text(text), lambda cleaned: split_tokens(cleaned, length // 2))
    grams = one_and_two_grams(tokens)
    return pad_ids(F.transform(grams, lambda gram: token_bucket(gram, buckets)), length)


def labels_in_text(text: Column) -> Column:
    """Every capitalised word of the text, once."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(TEST_LABEL_PATTERN), F.lit(1)))
