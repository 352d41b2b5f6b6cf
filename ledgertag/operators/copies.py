"""Rows that occur several times.

A group of equal rows is carried as one row and a count for as long as possible, because the
count can be built before a shuffle and the rows cannot. Where every copy matters, copies are
numbered, so that each row has an identity of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertag.session import materialize

# A larger group is cut into pieces of this size, which are spread over the cluster.
PIECE = 100_000


def collapse_copies(df: DataFrame, count: str = "copies") -> DataFrame:
    return df.groupBy(*df.columns).agg(F.count("*").alias(count))


def repeat_rows(df: DataFrame, count: str = "copies", number: str = "copy_no") -> DataFrame:
    """Turn each row into ``count`` rows, numbered from 1.

    The counted rows are written once; nothing before that runs twice. Rows up to PIECE copies are repeated
    where they are read. The few larger ones (their files are found by the counts in the footers) are
    cut into pieces that are spread over the cluster.
    """
    last = F.col(count)
    counted = materialize(df)
    small = counted.where(last <= PIECE).withColumn(number, F.explode(F.sequence(F.lit(1), last)))
    largest = counted.agg(F.max(count)).first()[0] or 0
    if largest > PIECE:
        pieces = counted.where(last > PIECE).withColumn(
            "piece", F.explode(F.sequence(F.lit(0), F.expr(f"({count} - 1) div {PIECE}")))
        )
        first = F.col("piece") * PIECE
        copies = F.sequence(first + 1, F.least(last, first + PIECE))
        keys = [c for c in df.columns if c != count]
        large = pieces.repartition("piece", *keys).withColumn(number, F.explode(copies)).drop("piece")
        small = small.unionByName(large)
    return small.drop(count).withColumn(number, F.col(number).cast("bigint"))


def number_copies(df: DataFrame, number: str = "copy_no") -> DataFrame:
    """Number equal rows 1, 2, ... without ever sorting them into one task."""
    return repeat_rows(collapse_copies(df), number=number)
