"""Intermediate tables in the shared folder, and small helpers around Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertag.session import scratch_path

# Bytes of text that are worked on at once inside a task; one longer text is still taken whole.
SLICE_BYTES = 2 << 20


def stage(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write a frame as Parquet below the shared folder and read it back.

    Later steps start from the files, so a lost executor costs no more than their own tasks.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(compression="zstd", **(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def smallest(df: DataFrame, digest: Column, ties: list[str], count: int) -> DataFrame:
    """The ``count`` rows with the smallest digest, a 64-bit number that spreads evenly.

    Digests are counted by their first 16 bits, so that only rows up to the cut are sorted, and not
    ``count`` rows of every partition.
    """
    prefix = F.shiftright(digest, 48)
    counts = dict(df.groupBy(prefix.alias("prefix")).count().toLocalIterator())
    total, cut = 0, None
    for cut in sorted(counts):
        total += counts[cut]
        if total >= count:
            break
    if total <= count:
        return df if cut is None else df.where(prefix <= cut)
    return df.where(prefix <= cut).orderBy(digest, *ties).limit(count)


# 128 bits that name a row by its id and text; only equal rows share them.
ROW = ["row_a", "row_b"]


def with_row_keys(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(
        *columns,
        F.xxhash64("doc_id", "text").alias("row_a"),
        F.xxhash64("text", "doc_id").alias("row_b"),
    )


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str, slice_bytes: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that each part holds about ``slice_bytes`` of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column))
        size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        lot = np.cumsum(size, dtype=np.int64) // slice_bytes
        cuts = [0, *(np.flatnonzero(np.diff(lot)) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            yield batch.slice(low, high - low)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of UTF-8 bytes, and where each text starts and ends in it."""
    texts = pa.concat_arrays([pc.fill_null(texts, "").cast(pa.large_string())])
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(bounds):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]
