"""Token sequences in training order, as binary shards.

Texts become one stream of ids, cut into sequences of a fixed length. A keyed permutation of the
numbers below the count of sequences gives each its slot: a Feistel network on the next even number
of bits, walked again from every value that is out of range (cycle-walking). Slots are dealt by
range, and every range is written as a file in which a slot has a fixed place, so a run can be
resumed anywhere by seeking.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgertag.llm.files import Published, located
from ledgertag.llm.storage import column, stage, text_slices
from ledgertag.llm.tokens import BYTE_BPE, byte_ids
from ledgertag.llm.words import mixed
from ledgertag.session import scratch_path

END = 50256
LENGTH = 1024
SHARD = 16_384
ROUNDS = 8
SEED = 20_240_607
# Token ids are the bulk of what lies on disk at once, so their table is compressed harder.
DENSE = {"parquet.compression.codec.zstd.level": "9", "parquet.page.size": str(8 << 20)}


class Permutation:
    """A keyed bijection of the numbers 0 to count - 1."""

    def __init__(self, count: int, seed: int = SEED, rounds: int = ROUNDS) -> None:
        if not 0 <= count <= 1 << 62:
            raise ValueError("the count is out of range")
        self.count = count
        self.half = np.uint64(max(1, (max(count - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        with np.errstate(over="ignore"):
            self.keys = mixed(np.arange(1, rounds + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(1000003))

    def _round(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed(x + key) & self.mask

    def _forward(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys:
            left, right = right, left ^ self._round(right, key)
        return left << self.half | right

    def _backward(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys[::-1]:
            left, right = right ^ self._round(left, key), left
        return left << self.half | right

    def _walk(self, numbers: np.ndarray, step) -> np.ndarray:
        out = step(np.asarray(numbers).astype(np.uint64))
        # The cycle through a value in range comes back into the range, so this ends.
        while (far := out >= np.uint64(self.count)).any():
            out[far] = step(out[far])
        return out.astype(np.int64)

    def slots(self, numbers: np.ndarray) -> np.ndarray:
        """The slot of each sequence number."""
        return self._walk(numbers, self._forward)

    def numbers(self, slots: np.ndarray) -> np.ndarray:
        """The sequence number in each slot."""
        return self._walk(slots, self._backward)


def sequences(
    docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end: int = END
) -> DataFrame:
    """The stream of each input partition, an end id after every text, cut into sequences.

    ``part`` and ``number`` tell the place; ``n_tokens`` is below ``length`` in the last of a part
    only; ``first_doc`` is the id of the document that the first token belongs to; ``ids`` holds
    two bytes for each id, which a table compresses best as they are. Null text is empty. Write the
    result to a table before use.
    """
    path = tokenizer or public_tokenizers.path(BYTE_BPE)
    schema = T.StructType([
        T.StructField("part", T.LongType()),
        T.StructField("number", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("first_doc", docs.schema["doc_id"].dataType),
        T.StructField("ids", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = byte_ids(path).encode, np.array([end], "<u2").tobytes()
        part, size = TaskContext.get().partitionId(), 2 * length
        rest, rest_doc, number = b"", None, 0

        def rows(found: list[tuple]) -> pa.RecordBatch:
            nonlocal number
            numbers = range(number, number + len(found))
            number += len(found)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(found), pa.int64()),
                    pa.array(numbers, pa.int64()),
                    pa.array([len(data) // 2 for _, data in found], pa.int64()),
                    pa.array([doc for doc, _ in found], kind),
                    pa.array([data for _, data in found], pa.binary()),
                ],
                names=schema.names,
            )

        kind = None
        for batch in text_slices(batches, "text"):
            kind = column(batch, "doc_id").type
            found = []
            ids = column(batch, "doc_id").to_pylist()
            for doc, text in zip(ids, column(batch, "text").to_pylist(), strict=True):
                if not rest:
                    rest_doc = doc
                open_before = len(rest)
                data = rest + encode(text or "") + last
                whole = len(data) - len(data) % size
                for low in range(0, whole, size):
                    found.append((rest_doc if low < open_before else doc, data[low : low + size]))
                rest = data[whole:]
                if whole:
                    rest_doc = doc
            if found:
                yield rows(found)
        if rest:
            yield rows([(rest_doc, rest)])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def materialize(
    docs: DataFrame,
    folder: str | None = None,
    seed: int = SEED,
    length: int = LENGTH,
    shard: int = SHARD,
    tokenizer: str | None = None,
    end: int = END,
) -> DataFrame:
    """Write all sequences in the order of their slots and return the manifest.

    ``folder`` (below the shared folder by default) gets a file ``shard-<number>.ids`` for each
    ``shard`` slots. Slot s lies in file s // shard at byte (s % shard) * 2 * length; a sequence that
    is short is filled up with end ids. The manifest has a row for each sequence: ``slot``, ``part``
    and ``number`` (where it comes from), ``sequence`` (its number in the corpus), ``first_doc``,
    ``n_tokens``, ``file``, ``byte_offset`` and ``ids_crc32`` of what the file has there. Repeated
    rows give repeated sequences, and an empty table gives no files and no rows.
    """
    target = folder or scratch_path(docs.sparkSession, f"order-{uuid.uuid4().hex}")
    cut = stage(sequences(docs, tokenizer, length, end), "sequences", DENSE)
    # A row for each task that read the input, whatever the corpus holds.
    counts = dict(cut.groupBy("part").count().orderBy("part").toLocalIterator())
    base = dict(zip(counts, np.cumsum([0, *counts.values()]).tolist(), strict=False))
    order = Permutation(sum(counts.values()), seed)
    shards = max(1, -(-order.count // shard))
    with_slots = T.StructType([
        T.StructField("slot", T.LongType()),
        T.StructField("sequence", T.LongType()),
        *cut.schema.fields,
    ])
    manifest = T.StructType([
        *with_slots.fields[:-1],
        T.StructField("file", T.StringType()),
        T.StructField("byte_offset", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=9)  # for the shuffle
        for batch in batches:
            parts = column(batch, "part").to_numpy()
            own = np.array([base[p] for p in parts.tolist()], np.int64)
            number = own + column(batch, "number").to_numpy()
            slot = order.slots(number)
            packed = [packer.compress(data) for data in column(batch, "ids").to_pylist()]
            kept = [column(batch, f.name) for f in with_slots.fields[2:-1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot), pa.array(number), *kept, pa.array(packed, pa.binary())],
                names=with_slots.names,
            )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker, filler = zstandard.ZstdDecompressor(), np.array([end], "<u2").tobytes()
        file, name, at = None, "", 0
        for batch in batches:
            slots = column(batch, "slot").to_pylist()
            names, offsets, sums = [], [], []
            for slot, packed in zip(slots, column(batch, "ids").to_pylist(), strict=True):
                number, place = divmod(slot, shard)
                if place == 0:
                    if file is not None:
                        file.close()
                    name, at = f"shard-{number:08d}.ids", 0
                    file = Published(target, name)
                if place != at:
                    raise ValueError("slots are missing")
                data = unpacker.decompress(packed)
                data += filler * (length - len(data) // 2)
                file.write(data)
                names.append(name)
                offsets.append(place * 2 * length)
                sums.append(zlib.crc32(data))
                at += 1
            kept = [column(batch, f.name) for f in with_slots.fields[:-1]]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(names, pa.string()), pa.array(offsets, pa.int64()), pa.array(sums, pa.int64())],
                names=manifest.names,
            )
        if file is not None:
            file.close()

    placed = cut.mapInArrow(assign, with_slots)
    ranges = placed.repartitionById(shards, F.floor(F.col("slot") / shard).cast("int"))
    return stage(ranges.sortWithinPartitions("slot").mapInArrow(write, manifest), "manifest")


def read_slots(
    folder: str, first: int, count: int, length: int = LENGTH, shard: int = SHARD
) -> np.ndarray:
    """Sequences of consecutive slots, a row of ids each, by seeking in the shards."""
    system, path = located(folder)
    out = np.zeros((count, length), np.uint16)
    done = 0
    while done < count:
        number, place = divmod(first + done, shard)
        rows = min(count - done, shard - place)
        with system.open_input_file(f"{path}/shard-{number:08d}.ids") as file:
            file.seek(place * 2 * length)
            data = file.read(rows * 2 * length)
        out[done : done + rows] = np.frombuffer(data, "<u2").reshape(rows, length)
        done += rows
    return out
