"""Hashes that give the same draw on every run, partitioning and engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TEXT = "~"


def row_text(columns: list[str | Column]) -> Column:
    """The columns as one text that no other values have: each with its length, or the null mark."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return F.concat_ws("|", *[F.coalesce(measured(t), F.lit(NULL_TEXT)) for t in texts])


def measured(text: Column) -> Column:
    """The text after its length, so that it can be told where it ends."""
    return F.concat(F.length(text).cast("string"), F.lit(":"), text)


def row_digest(columns: list[str | Column], seed: int | None = None) -> Column:
    """128-bit digest of the columns, in hexadecimal."""
    text = row_text(columns)
    return F.md5(text if seed is None else F.concat(text, F.lit(f"#{seed}")))


def hex_to_long(digest: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")


def unit_draw(columns: list[str | Column], seed: int) -> Column:
    """A repeatable number in [0, 1) from the first 52 bits of the digest."""
    return hex_to_long(row_digest(columns, seed), 1, 13) / F.lit(float(2**52))
