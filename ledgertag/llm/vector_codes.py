"""Codes for vectors: one byte for each part, by integer codebooks.

Which entry of a codebook is nearest to a part is found by slicing and intersecting. For each
dimension the entries' coordinates are sorted, and a mask of entries is kept for every prefix of that
order. A radius selects a range of each sorted list; the masks of its two ends differ in just the
entries within, and the masks of all dimensions, ANDed word by word, leave the entries inside a box.
The first radius is a guess from sorted coordinates; the nearest entry of a box gives a second one
that no closer entry can lie outside of, so the answer is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgertag.llm.storage import column, stage
from ledgertag.session import BROADCAST_ROWS

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
# Vectors that are looked up at once, a bound on the memory for their candidates.
BLOCK = 1024
# Squared distances of all parts together stay below 2**63 for components below this (up to 512 of them).
LARGEST = 1 << 26


class Slices:
    """The entries of one codebook, sorted along each dimension, with a mask for every prefix."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        count, width = entries.shape
        self.words = -(-count // 64)
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, order, axis=0)
        one = np.zeros((count, self.words), np.uint64)
        number = np.arange(count)
        one[number, number // 64] = np.uint64(1) << (number % 64).astype(np.uint64)
        self.all = np.bitwise_or.reduce(one, axis=0)
        # prefix[d, k] holds the k entries with the smallest coordinates in dimension d.
        self.prefix = np.zeros((width, count + 1, self.words), np.uint64)
        for d in range(width):
            np.bitwise_or.accumulate(one[order[:, d]], axis=0, out=self.prefix[d, 1:])

    def guess(self, points: np.ndarray) -> np.ndarray:
        """A first radius: in the widest dimension, an eighth of the entries are as close as this."""
        count, width = self.entries.shape
        if not width:
            return np.zeros(len(points), np.int64)
        d = int((self.sorted[-1] - self.sorted[0]).argmax())
        line, at = self.sorted[:, d], points[:, d]
        near = np.searchsorted(line, at)
        reach = max(1, count // 16)
        low = line[np.clip(near - reach, 0, count - 1)]
        high = line[np.clip(near + reach, 0, count - 1)]
        return np.maximum(np.abs(at - low), np.abs(at - high))

    def box(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """A mask for each point: the entries no farther than the radius in any dimension."""
        mask = np.tile(self.all, (len(points), 1))
        for d in range(self.entries.shape[1]):
            line = self.sorted[:, d]
            low = np.searchsorted(line, points[:, d] - radius, "left")
            high = np.searchsorted(line, points[:, d] + radius, "right")
            mask &= self.prefix[d, high] ^ self.prefix[d, low]
        return mask

    def _best(self, points: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry in each mask and its squared distance (-1 where the mask is empty)."""
        count = len(self.entries)
        bits = np.unpackbits(mask.astype("<u8").view(np.uint8), axis=1, bitorder="little")[:, :count]
        row, entry = np.nonzero(bits)
        apart = points[row] - self.entries[entry]
        square = np.einsum("ij,ij->i", apart, apart)
        best, distance = np.full(len(points), -1), np.full(len(points), -1, np.int64)
        if len(row):
            begins = np.flatnonzero(np.diff(row, prepend=-1))
            least = np.minimum.reduceat(square, begins)
            found = row[begins]
            distance[found] = least
            # Candidates are in the order of their indexes, so the first of equal ones is kept.
            hit = np.flatnonzero(square == distance[row])
            first = hit[np.flatnonzero(np.diff(row[hit], prepend=-1))]
            best[row[first]] = entry[first]
        return best, distance

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each point the nearest entry, the lower index of equally near ones, and its squared distance."""
        best, distance = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
        for low in range(0, len(points), BLOCK):
            block = points[low : low + BLOCK]
            open_rows, radius = np.arange(len(block)), self.guess(block)
            while len(open_rows):
                entry, square = self._best(block[open_rows], self.box(block[open_rows], radius))
                # Integers: an entry at least as near has no coordinate farther than the root, rounded down.
                root = integer_root(np.maximum(square, 0))
                done = (square >= 0) & (root <= radius)
                at = low + open_rows[done]
                best[at], distance[at] = entry[done], square[done]
                radius = np.where(square >= 0, root, 2 * radius + 1)[~done]
                open_rows = open_rows[~done]
        return best, distance


def integer_root(squares: np.ndarray) -> np.ndarray:
    """The root of each number, rounded down."""
    root = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    root -= root * root > squares
    return root + ((root + 1) * (root + 1) <= squares)


@dataclass
class Codebooks:
    """Integer entries by part, entry and position in the part."""

    entries: np.ndarray

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def slices(self) -> list[Slices]:
        return [Slices(part) for part in self.entries]

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The vectors that codes stand for; a row of part indexes each."""
        return np.concatenate([part[codes[:, p]] for p, part in enumerate(self.entries)], axis=1)


def usable(vectors: DataFrame, vector: str, label: str) -> DataFrame:
    """Rows whose vector can be coded, as ``vec_id``, ``label`` and ``ints``, staged.

    Left out are null vectors and those with null or non-finite components. Only vectors of one length
    can be compared; if there are several, the length that most rows have counts (the longer of equally
    frequent ones) and rows of another length are left out, too.
    """
    v = F.col(vector)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ints = F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    kept = vectors.where(v.isNotNull() & good).select(
        "vec_id", F.col(label).alias("label"), ints.alias("ints")
    )
    kept = stage(kept, "integers")
    # A row for each length.
    lengths = kept.groupBy(F.size("ints").alias("length")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    return kept.where(F.size("ints") == common[0]["length"]) if common else kept


def first_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """The parts of the vectors with the smallest ids, in that order; equal ids by their components.

    Rows without id are coded, but never taken here.
    """
    ids = rows.where("vec_id is not null")
    # Ids alone first, so that no more than a few numbers of each task meet; then just those rows.
    least = [r[0] for r in ids.select("vec_id").orderBy("vec_id").limit(entries).collect()]
    if not least:
        return Codebooks(np.zeros((parts, 0, 0), np.int64))
    taken = ids.where(F.col("vec_id") <= F.lit(least[-1])).orderBy("vec_id", "ints").limit(entries)
    found = np.array([r["ints"] for r in taken.collect()], np.int64).reshape(len(least), -1)
    if found.shape[1] % parts:
        raise ValueError(f"vectors of {found.shape[1]} components can't be cut into {parts} equal parts")
    return Codebooks(np.stack(np.split(found, parts, axis=1)))


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    values = column(batch, "ints").flatten().to_numpy(zero_copy_only=False)
    if len(values) and max(int(values.max()), -int(values.min())) >= LARGEST:
        raise ValueError(f"a component is {LARGEST // SCALE} or more, too large for squared distances")
    return values.reshape(batch.num_rows, width)


def _refined(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry replaced by the mean of its parts, rounded down; unused ones stay.

    A task sends one sum for each entry, whatever it has read.
    """
    parts, count, width = books.entries.shape
    sums = [f"sum_{d}" for d in range(width)]
    names = ["part", "entry", "n", *sums]
    schema = T.StructType([T.StructField(name, T.LongType()) for name in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = books.slices()
        used = np.zeros((parts, count), np.int64)
        total = np.zeros((parts, count, width), np.int64)
        for batch in batches:
            points = _matrix(batch, parts * width)
            for p, part in enumerate(np.split(points, parts, axis=1)):
                best, _ = slices[p].nearest(part)
                used[p] += np.bincount(best, minlength=count)
                for d in range(width):  # exact: a batch's sums are far below 2**53
                    total[p, :, d] += np.bincount(best, part[:, d], count).astype(np.int64)
        p, entry = np.nonzero(used)
        arrays = [p, entry, used[p, entry], *total[p, entry].T]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in arrays], names=names)

    totals = rows.select("ints").mapInArrow(run, schema).groupBy("part", "entry")
    found = totals.agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in sums))
    entries = books.entries.copy()
    for row in found.collect():  # parts times entries at most
        entries[row["part"], row["entry"]] = [row[c] // row["n"] for c in sums]
    return Codebooks(entries)


def train(
    rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Codebooks:
    """Codebooks from all ``usable`` rows: a pass over them for each round."""
    books = first_codebooks(rows, parts, entries)
    for _ in range(rounds if books.entries.size else 0):
        books = _refined(rows, books)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id``, ``label``, ``codes`` (an entry for each part) and ``error`` of ``usable`` rows.

    The error is the squared distance to the nearest entry, summed over the parts.
    """
    parts, count, width = books.entries.shape
    schema = T.StructType([
        rows.schema["vec_id"],
        rows.schema["label"],
        T.StructField("codes", T.ArrayType(T.IntegerType())),
        T.StructField("error", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = books.slices()
        for batch in batches:
            points = _matrix(batch, parts * width)
            codes = np.zeros((len(points), parts), np.int32)
            error = np.zeros(len(points), np.int64)
            for p, part in enumerate(np.split(points, parts, axis=1)):
                codes[:, p], distance = slices[p].nearest(part)
                error += distance
            offsets = pa.array(np.arange(len(points) + 1, dtype=np.int32) * parts)
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "vec_id"),
                    column(batch, "label"),
                    pa.ListArray.from_arrays(offsets, pa.array(codes.ravel())),
                    pa.array(error),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)


def compress(
    vectors: DataFrame,
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks]:
    """Codes of all usable vectors (see ``usable``, ``encode``) and the codebooks, fitted on all of them.

    Added is ``label_error``, the error summed over the rows of a label; rows without label count
    together. Repeated rows are coded each for itself and count in the means as often as they occur.
    With fewer vectors than entries the codebooks have fewer entries. An empty table gives no rows.
    A length that ``parts`` doesn't divide and components of 65536 and more raise. Other columns are
    left out, so their names don't matter. If no row has an id there is no codebook and no row comes out.
    """
    rows = usable(vectors, vector, label)
    books = train(rows, parts, entries, rounds)
    if not books.entries.shape[1]:
        none = rows.where("false")
        return (
            none.select(
                "vec_id",
                "label",
                F.lit(None).cast("array<int>").alias("codes"),
                F.lit(None).cast("long").alias("error"),
                F.lit(None).cast("long").alias("label_error"),
            ),
            books,
        )
    coded = stage(encode(rows, books), "codes")
    sums = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label_errors")
    side = F.broadcast(sums) if sums.count() <= BROADCAST_ROWS else sums
    same = coded["label"].eqNullSafe(side["label"])
    return coded.join(side, same).select(coded["*"], "label_error"), books
