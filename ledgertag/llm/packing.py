"""Best-fit packing of documents into sequences by the sum-of-squares rule."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgertag.llm.storage import column, stage, text_slices
from ledgertag.llm.tokens import WORD_BPE, word_ids

CAPACITY = 4096
END = 1
# Pieces that one task packs at once; more pieces mean more tasks.
GROUP_SIZE = 65_536


def pieces(
    docs: DataFrame,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end: int = END,
    keep_ids: bool = True,
) -> DataFrame:
    """Token ids of each text and the end token, cut every ``capacity`` tokens.

    Null text counts as empty: one piece that holds the end token. Repeated rows and rows without
    id give their own pieces. Other columns of ``docs`` are left out. ``lot`` is a number from the
    place of the row in the input that spreads pieces evenly; it is fixed once the frame is staged.
    """
    path = tokenizer or public_tokenizers.path(WORD_BPE)
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", id_type),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("lot", T.LongType()),
        *([T.StructField("ids", T.BinaryType())] if keep_ids else []),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(path).encode
        last = np.uint32(end).tobytes()
        step = capacity * 4
        task = TaskContext.get().partitionId() << 40
        for batch in text_slices(batches, "text"):
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for k, text in enumerate(column(batch, "text").to_pylist()):
                data = encode(text or "") + last
                for low in range(0, len(data), step):
                    part = data[low : low + step]
                    row.append(k)
                    piece.append(low // step)
                    start.append(low // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        ids.append(part)
            lot = np.arange(task, task + len(row))
            task += len(row)
            arrays = [
                column(batch, "doc_id").take(pa.array(row, pa.int64())),
                pa.array(piece, pa.int32()),
                *(pa.array(x, pa.int64()) for x in (start, length, crc, lot)),
            ]
            if keep_ids:
                arrays.append(pa.array(ids, pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each item, longest items first.

    ``open_bins[g]`` is the number of sequences with room for g more tokens. Moving a bin from gap
    g to gap g - s changes the sum of the squared counts by 2 (open_bins[g-s] - open_bins[g] + 1);
    gap 0 doesn't count. The open sequence with the smallest sum is taken, the tightest of equal ones.
    A new sequence is opened only if no open one has room: the plain rule also opens one where that
    alone makes the sum smaller, which took up to 5 percent more sequences.
    """
    open_bins = np.zeros(capacity + 1, np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    count = 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        rest = open_bins[: capacity - size + 1]  # by the gap that would remain
        before = open_bins[size:]
        change = 2 * (rest - before) + 2
        change[0] = 1 - 2 * before[0]  # a full sequence counts no more
        change[before == 0] = np.iinfo(np.int64).max
        best = int(change.argmin())
        if before[best]:
            number = waiting[best + size].pop()
            open_bins[best + size] -= 1
        else:
            number, best = count, capacity - size
            count += 1
        sequence[k] = number
        offset[k] = capacity - size - best
        if best:
            open_bins[best] += 1
            waiting[best].append(number)
    return sequence, offset


def pack(items: DataFrame, capacity: int = CAPACITY, group_size: int = GROUP_SIZE) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` and a ``lot``.

    Rows are dealt evenly into groups of about ``group_size``, and each group is packed by itself,
    so a group leaves a few sequences unfilled. No item is cut. A length over ``capacity`` or below
    1 raises. ``items`` must not change between reads (stage it first). Rows keep their columns;
    columns named ``sequence_id``, ``offset`` or ``packing_group`` are replaced.
    """
    items = items.drop("sequence_id", "offset", "packing_group")
    groups = max(1, math.ceil(items.count() / group_size))
    schema = T.StructType([
        *items.schema.fields,
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ])

    def place(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lengths = rows["length"].to_numpy(np.int64)
        if len(lengths) and (lengths.max() > capacity or lengths.min() < 1):
            raise ValueError("a length is outside 1 to the capacity")
        sequence, offset = sum_of_squares(lengths, capacity)
        rows = rows.drop(columns="packing_group")
        return rows.assign(sequence_id=sequence + (int(key[0]) << 32), offset=offset)

    dealt = items.withColumn("packing_group", F.pmod(F.xxhash64("lot"), F.lit(groups)))
    return dealt.groupBy("packing_group").applyInPandas(place, schema)


def packed(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """Pieces of all documents with their place; token ids stay behind (see ``sequences``)."""
    return pack(stage(pieces(docs, tokenizer, capacity, keep_ids=False), "pieces"), capacity)


def sequences(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``length`` and ``ids`` (4 bytes each)."""
    placed = pack(stage(pieces(docs, tokenizer, capacity), "pieces"), capacity)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.aggregate(parts, F.lit(b""), lambda done, x: F.concat(done, x["ids"])).alias("ids"),
    )
