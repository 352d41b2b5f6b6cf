"""Repeated passages, found by anchors: non-overlapping blocks of a document, probed by every window.

A window of ``window`` words holds a whole aligned block of (window + 1) / 2 words of the document
it is taken from. So for every repeated window some aligned block of the first document occurs among
the rolling blocks of the other. Two rounds of messages find them:

1. Every slice of the corpus sends the hashes of its rolling blocks, marking the aligned ones, to
   the bucket of each hash. The bucket answers which blocks occur more than once and are aligned
   somewhere: the hits.
2. Around each hit the windows are compared: the slice sends their hashes with the smallest document
   that has them, and learns whether a smaller one exists elsewhere. Windows that follow each other
   make up the maximal repeats.

Within a slice equal hashes are sent once, so a passage that is everywhere is one entry for each
slice and not one for each document; no pairs of documents are made. Answers are one bit for each
entry sent; the slice works out its entries again. Slices are therefore named by their content, and
an answer that is missing stops the job.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgertag.llm.storage import column, stage, text_slices
from ledgertag.llm.words import NOT_SPACE, Words, covered

WINDOW = 13
# Bytes of text whose blocks share a bucket, on average; more text means more buckets.
BUCKET_BYTES = 16 << 20
LEAST_BUCKETS = 64
# Bytes of text in a slice; a task holds some fifty bytes for each word of one slice at a time.
SLICE_BYTES = 1 << 20
NO_ID = np.iinfo(np.int64).max
SLICE = ["slice_a", "slice_b"]


def _slices(docs: DataFrame) -> DataFrame:
    """Slices as rows: a name from the content, and ids and texts in a compressed batch."""
    schema = T.StructType([
        *(T.StructField(name, T.LongType()) for name in SLICE),
        T.StructField("payload", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in text_slices(batches, "text", SLICE_BYTES):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as writer:
                writer.write_batch(batch)
            data = sink.getvalue().to_pybytes()
            name = np.frombuffer(hashlib.blake2b(data, digest_size=16).digest(), np.int64)
            rows = [[int(name[0])], [int(name[1])], [packer.compress(data)]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0]), pa.array(rows[1]), pa.array(rows[2], pa.binary())],
                names=schema.names,
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


class Slice:
    """The words of a slice, its rolling blocks and windows."""

    def __init__(self, payload: bytes, window: int, buckets: int) -> None:
        data = zstandard.ZstdDecompressor().decompress(payload)
        batch = pa.ipc.open_stream(data).read_next_batch()
        self.ids = column(batch, "doc_id")
        self.order = self.ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)
        self.words = Words(column(batch, "text"), NOT_SPACE, lower=False)
        self.hashes = self.words.hashes()
        self.row = self.words.row
        self.window = window
        self.block = (window + 1) // 2
        self.shift = np.uint64(64 - int(math.log2(buckets)))

    def blocks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rolling blocks: their first words, the different hashes (40 bits and more), which of them
        each is, and two marks for each hash: aligned somewhere, more than once."""
        at = np.flatnonzero(self.words.whole(self.block))
        values = self.words.sequences(self.hashes, self.block)[at]
        # The bucket bits and the 32 bits after them.
        values = values >> (self.shift - np.uint64(32))
        different, which, count = np.unique(values, return_inverse=True, return_counts=True)
        aligned = np.zeros(len(different), bool)
        aligned[which[(at - self.words.first[self.row[at]]) % self.block == 0]] = True
        return at, different, which, np.stack([aligned, count > 1])

    def windows(self, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows that hold a hit: their first words, bucket and hash of the different ones (in
        order of both), and which of them each is."""
        seen = np.concatenate([[0], np.cumsum(hits)])
        at = np.flatnonzero(self.words.whole(self.window))
        at = at[seen[at + self.window - self.block + 1] > seen[at]]
        value = self.words.sequences(self.hashes, self.window)[at]
        second = self.words.sequences(self.words.hashes(1), self.window, 1)[at]
        both = np.empty(len(at), [("bucket", np.uint64), ("value", np.uint64)])
        both["bucket"], both["value"] = second >> self.shift, value
        different, which = np.unique(both, return_inverse=True)
        return at, different["bucket"], different["value"], which


def _bits(answers: list, buckets: np.ndarray) -> np.ndarray:
    """The answers to all entries of a slice, in their order."""
    found = np.zeros(len(buckets), bool)
    known = {a["bucket"]: a["bits"] for a in answers or []}
    numbers, first, count = np.unique(buckets, return_index=True, return_counts=True)
    for bucket, low, n in zip(numbers.tolist(), first.tolist(), count.tolist(), strict=True):
        if bucket not in known:
            raise ValueError("the input changed between two reads; write it to a table first")
        found[low : low + n] = np.unpackbits(np.frombuffer(known[bucket], np.uint8), count=n)
    return found


def _per_bucket(buckets: np.ndarray) -> Iterator[tuple[int, slice]]:
    numbers, first, count = np.unique(buckets, return_index=True, return_counts=True)
    for bucket, low, n in zip(numbers.tolist(), first.tolist(), count.tolist(), strict=True):
        yield bucket, slice(low, low + n)


ENTRIES = T.StructType([
    T.StructField("bucket", T.LongType()),
    *(T.StructField(name, T.LongType()) for name in SLICE),
    T.StructField("values", T.BinaryType()),
    T.StructField("marks", T.BinaryType()),
    T.StructField("base", T.LongType()),
])
ANSWERS = T.StructType([
    *(T.StructField(name, T.LongType()) for name in SLICE),
    T.StructField("bucket", T.LongType()),
    T.StructField("bits", T.BinaryType()),
])


def _rows(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = {T.LongType(): pa.int64(), T.BinaryType(): pa.binary(), T.StringType(): pa.string()}
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kinds[f.dataType]) for c, f in zip(columns, schema, strict=True)],
        names=schema.names,
    )


def _block_entries(slices: DataFrame, window: int, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, values, _, marks = Slice(row["payload"], window, buckets).blocks()
                yield _rows(
                    [
                        (
                            bucket,
                            row["slice_a"],
                            row["slice_b"],
                            (values[own] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(),
                            np.packbits(marks[:, own]).tobytes(),
                            0,
                        )
                        for bucket, own in _per_bucket(values >> np.uint64(32))
                    ],
                    ENTRIES,
                )

    return slices.mapInArrow(run, ENTRIES)


def _block_answers(rows: pd.DataFrame) -> pd.DataFrame:
    """Which blocks occur more than once and are aligned somewhere."""
    values = [np.frombuffer(v, "<u4") for v in rows["values"]]
    marks = [
        np.unpackbits(np.frombuffer(m, np.uint8), count=2 * len(v)).reshape(2, -1)
        for m, v in zip(rows["marks"], values, strict=True)
    ]
    different, which = np.unique(np.concatenate(values), return_inverse=True)
    aligned, several = np.concatenate(marks, axis=1)
    anywhere, again = np.zeros(len(different), bool), np.bincount(which) > 1
    anywhere[which[aligned.view(bool)]] = True
    again[which[several.view(bool)]] = True
    hit = anywhere & again
    return _answered(rows, hit[which], [len(v) for v in values])


def _answered(rows: pd.DataFrame, bits: np.ndarray, lengths: list[int]) -> pd.DataFrame:
    parts = np.split(bits, np.cumsum(lengths)[:-1])
    return rows[[*SLICE, "bucket"]].assign(bits=[np.packbits(p).tobytes() for p in parts])


def _window_entries(answered: DataFrame, window: int, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                one = Slice(row["payload"], window, buckets)
                at, bucket, value, which = one.windows(_hits(one, row["blocks"]))
                least = np.full(len(value), NO_ID)
                np.minimum.at(least, which, one.order[one.row[at]])
                rows = []
                for number, own in _per_bucket(bucket):
                    ids = least[own]
                    base = int(ids.min())
                    # Ids of a slice lie close together; the gap to the smallest is a short number.
                    gaps = (ids - base).astype(np.uint64)
                    width = np.min_scalar_type(int(gaps.max())).str.replace("|", "<")
                    rows.append((
                        number,
                        row["slice_a"],
                        row["slice_b"],
                        value[own].astype("<u8").tobytes(),
                        gaps.astype(width).tobytes(),
                        base,
                    ))
                yield _rows(rows, ENTRIES)

    return answered.mapInArrow(run, ENTRIES)


def _hits(one: Slice, answers: list) -> np.ndarray:
    """Which words begin a block that was hit."""
    at, different, which, _ = one.blocks()
    bits = _bits(answers, different >> np.uint64(32))
    hits = np.zeros(len(one.words), bool)
    hits[at[bits[which]]] = True
    return hits


def _window_answers(rows: pd.DataFrame) -> pd.DataFrame:
    """Which windows occur in a smaller document than the smallest of their slice."""
    values = [np.frombuffer(v, "<u8") for v in rows["values"]]
    ids = [
        np.frombuffer(m, f"<u{len(m) // len(v)}").astype(np.int64) + base
        for m, v, base in zip(rows["marks"], values, rows["base"].tolist(), strict=True)
    ]
    own = np.concatenate(ids)
    different, which = np.unique(np.concatenate(values), return_inverse=True)
    least = np.full(len(different), NO_ID)
    np.minimum.at(least, which, own)
    return _answered(rows, least[which] < own, [len(v) for v in values])


RESULT = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_words", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("kept_sha256", T.StringType()),
    T.StructField("kept", T.StringType()),
])


def _result(answered: DataFrame, window: int, buckets: int, keep_text: bool) -> DataFrame:
    schema = RESULT if keep_text else T.StructType(RESULT.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                one = Slice(row["payload"], window, buckets)
                words, ids = one.words, one.order
                at, bucket, value, which = one.windows(_hits(one, row["blocks"]))
                smaller = _bits(row["windows"], bucket)
                least = np.full(len(value), NO_ID)
                np.minimum.at(least, which, ids[one.row[at]])
                repeat = smaller[which] | (least[which] < ids[one.row[at]])
                gone = covered(at[repeat], window, len(words))
                removed = np.concatenate([[0], np.cumsum(gone)])[words.first]
                kept = np.flatnonzero(~gone)
                # The kept words, each followed by one blank.
                size = words.end[kept] - words.start[kept] + 1
                stop = np.cumsum(size)
                source = np.arange(size.sum()) + np.repeat(words.start[kept] - (stop - size), size)
                joined = words.data[np.minimum(source, max(len(words.data) - 1, 0))]
                joined[stop - 1] = 0x20
                data = joined.tobytes()
                ends = np.concatenate([[0], stop])[np.searchsorted(kept, words.first)]
                texts = [
                    data[low : max(high - 1, low)]
                    for low, high in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
                ]
                arrays = [
                    one.ids,
                    pa.array(words.count.astype(np.int64)),
                    pa.array(np.diff(removed)),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                ]
                if keep_text:
                    arrays.append(pa.array([t.decode() for t in texts]))
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return answered.mapInArrow(run, schema)


def _gathered(answers: DataFrame, name: str) -> DataFrame:
    """All answers to a slice; as many as there are buckets at most."""
    return answers.groupBy(*SLICE).agg(F.collect_list(F.struct("bucket", "bits")).alias(name))


def deduplicate(docs: DataFrame, window: int = WINDOW, keep_text: bool = False) -> DataFrame:
    """Remove every word that lies in a window which a document with a smaller id has, too.

    Words are what white space parts. One row for each row of ``docs``: ``doc_id``, ``n_words``,
    ``n_removed``, ``kept_sha256`` and, if wanted, ``kept``, the remaining words joined by blanks.
    Windows are judged on the input. Null and blank texts have no words. Rows without id come after
    all others and, like rows that share an id, take nothing from each other. ``window`` must be
    odd. Hashes of at least 70 bits stand for the words. An empty table gives no rows.
    """
    if window < 3 or window % 2 == 0:
        raise ValueError("the window must be an odd number of words, three at least")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 << max(
        int(math.log2(LEAST_BUCKETS)), math.ceil(math.log2(max(size / BUCKET_BYTES, 1)))
    )
    slices = _slices(docs)
    blocks = stage(
        _block_entries(slices, window, buckets)
        .groupBy("bucket")
        .applyInPandas(_block_answers, ANSWERS),
        "blocks",
    )
    hit = slices.join(_gathered(blocks, "blocks"), SLICE, "left")
    windows = stage(
        _window_entries(hit, window, buckets)
        .groupBy("bucket")
        .applyInPandas(_window_answers, ANSWERS),
        "windows",
    )
    answered = hit.join(_gathered(windows, "windows"), SLICE, "left")
    return _result(answered, window, buckets, keep_text)
