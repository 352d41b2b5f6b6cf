"""Benchmark decontamination by winnowing.

Both sides are cut into grams of ``GRAM`` words. In every run of consecutive grams that makes up a
window of ``window`` words, the gram with the smallest hash is kept. A window that both sides share
has the same grams on both sides, so it shares a kept gram: no shared window is missed. Kept grams
are joined; around each hit the whole windows are compared, by 128-bit hashes of their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgertag.llm.storage import ROW, column, stage, text_slices, with_row_keys
from ledgertag.llm.words import LETTERS_DIGITS, Words

WINDOW = 10
GRAM = 5
# Bits of a filter of fixed size that spares most grams of the corpus the join.
FILTER_BITS = 20


def winnowed(grams: np.ndarray, whole: np.ndarray, width: int) -> np.ndarray:
    """Which grams are the smallest of some run of ``width`` grams; ``whole`` marks where runs begin."""
    size = len(grams) - width + 1
    kept = np.zeros(len(grams), bool)
    if size <= 0:
        return kept
    least = np.min([grams[k : k + size] for k in range(width)], axis=0)
    begins = whole[:size]
    for k in range(width):
        kept[k : k + size] |= begins & (grams[k : k + size] == least)
    return kept


def _fingerprints(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of each kept gram."""
    grams = words.sequences(words.hashes(), gram)
    kept = np.flatnonzero(winnowed(grams, words.whole(window), window - gram + 1))
    return kept, grams[kept].view(np.int64)


def _benchmark(benchmark: DataFrame, window: int, gram: int) -> DataFrame:
    """Windows (``hash_a``, ``hash_b``) and grams (``hash_a``) of all items, with their length.

    ``kind`` is "gram" for kept grams, "window" for windows. An item with fewer words than a window
    is one window, and its only gram is the item.
    """
    schema = T.StructType([
        T.StructField("item_id", benchmark.schema["item_id"].dataType),
        T.StructField("kind", T.StringType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("hash_a", T.LongType()),
        T.StructField("hash_b", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            words = Words(column(batch, "text"), LETTERS_DIGITS, lower=True)
            hashes = [words.hashes(lane) for lane in (0, 1)]
            row = words.row

            def rows(kind, size, at, a, b):
                return pa.RecordBatch.from_arrays(
                    [
                        column(batch, "item_id").take(pa.array(row[at])),
                        pa.array(np.full(len(at), kind)),
                        pa.array(np.full(len(at), size, np.int32)),
                        pa.array(a.view(np.int64)),
                        pa.array(b.view(np.int64)),
                    ],
                    names=schema.names,
                )

            at, found = _fingerprints(words, window, gram)
            yield rows("gram", window, at, found, np.zeros_like(found))
            for size in np.unique(np.minimum(words.count[words.count > 0], window)).tolist():
                if size < window:
                    at = words.first[:-1][words.count == size]
                else:
                    at = np.flatnonzero(words.whole(window))
                a, b = (words.sequences(h, size, k)[at] for k, h in enumerate(hashes))
                yield rows("window", size, at, a, b)
                if size < window:
                    yield rows("gram", size, at, a, np.zeros_like(a))

    return benchmark.select("item_id", "text").mapInArrow(run, schema)


def _candidates(docs: DataFrame, allowed: dict[int, np.ndarray], window: int, gram: int) -> DataFrame:
    """Kept grams of the documents that pass the filter, and with ``size`` 0 the number of words."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("row_a", T.LongType()),
        T.StructField("row_b", T.LongType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("place", T.LongType()),
        T.StructField("hash_a", T.LongType()),
    ])
    low_bits = (1 << FILTER_BITS) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            words = Words(column(batch, "text"), LETTERS_DIGITS, lower=True)
            first, row_of = words.first, words.row

            def rows(size, row, place, found):
                row = pa.array(row)
                return pa.RecordBatch.from_arrays(
                    [
                        *(column(batch, n).take(row) for n in ("doc_id", *ROW)),
                        pa.array(np.full(len(row), size, np.int32)),
                        pa.array(place),
                        pa.array(found),
                    ],
                    names=schema.names,
                )

            every = np.arange(batch.num_rows)
            yield rows(0, every, words.count.astype(np.int64), np.zeros(len(every), np.int64))
            for size, bits in allowed.items():
                if size == window:
                    at, found = _fingerprints(words, window, gram)
                else:
                    at = np.flatnonzero(words.whole(size))
                    found = words.sequences(words.hashes(), size)[at].view(np.int64)
                passed = bits[found & low_bits]
                at, found = at[passed], found[passed]
                yield rows(size, row_of[at], at - first[row_of[at]], found)

    return docs.mapInArrow(run, schema)


def _windows(hits: DataFrame, window: int, gram: int) -> DataFrame:
    """The windows around each hit: ``size``, ``place`` of the first word, and their hashes."""
    schema = T.StructType([
        T.StructField("row_a", T.LongType()),
        T.StructField("row_b", T.LongType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("place", T.LongType()),
        T.StructField("hash_a", T.LongType()),
        T.StructField("hash_b", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            words = Words(column(batch, "text"), LETTERS_DIGITS, lower=True)
            hashes = [words.hashes(lane) for lane in (0, 1)]
            sizes, places = column(batch, "sizes"), column(batch, "places")
            count = np.diff(sizes.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), count)
            size, place = sizes.flatten().to_numpy(), places.flatten().to_numpy()
            for n in np.unique(size).tolist():
                own = size == n
                at = words.first[row[own]] + place[own]
                if n == window:  # all windows that hold the gram
                    at = (at[:, None] - np.arange(window - gram + 1)).ravel()
                    at = np.unique(at[at >= 0])
                    at = at[words.whole(window)[at]]
                else:
                    at = np.unique(at)
                of = words.row[at]
                a, b = (words.sequences(h, n, k)[at] for k, h in enumerate(hashes))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(column(batch, x).take(pa.array(of)) for x in ROW),
                        pa.array(np.full(len(at), n, np.int32)),
                        pa.array(at - words.first[of]),
                        pa.array(a.view(np.int64)),
                        pa.array(b.view(np.int64)),
                    ],
                    names=schema.names,
                )

    return hits.mapInArrow(run, schema)


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """What of each document occurs in the benchmark, one row for each row of ``docs``.

    ``doc_id``, ``n_words``, ``spans`` (array of ``place``, ``size``: the windows found, in
    words), ``n_hit`` (words inside any of them), ``items`` (their item ids as strings, sorted),
    and the row's keys ``row_a``, ``row_b``. Null, empty and word-free texts have no words and no hits;
    so has every row if the benchmark is empty. Items without id count as the id "null". Equal rows
    get equal results, and rows with the same id but other texts are kept apart.
    """
    if not 0 < gram <= window:
        raise ValueError("a gram has at least one word and fits into a window")
    keyed = with_row_keys(docs, "doc_id", "text")
    known = stage(_benchmark(benchmark, window, gram), "benchmark").distinct()
    grams = known.where("kind = 'gram'").select("size", "hash_a").distinct()
    low = F.col("hash_a").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)).cast("int")
    # At most 2**FILTER_BITS numbers for each of the window's lengths.
    allowed: dict[int, np.ndarray] = {}
    for size, bit in grams.select("size", low.alias("bit")).distinct().toLocalIterator():
        allowed.setdefault(size, np.zeros(1 << FILTER_BITS, bool))[bit] = True
    seen = stage(_candidates(keyed, allowed, window, gram), "grams")
    hits = (
        seen.where("size > 0")
        .join(grams, ["size", "hash_a"], "left_semi")
        .groupBy(*ROW)
        .agg(
            F.array_sort(F.collect_set(F.struct("size", "place"))).alias("found"),
        )
        .select(*ROW, F.col("found.size").alias("sizes"), F.col("found.place").alias("places"))
    )
    texts = keyed.select("text", *ROW).join(hits, ROW)
    windows = known.where("kind = 'window'").drop("kind")
    around = _windows(texts, window, gram).distinct()
    matched = stage(
        around.join(windows.drop("item_id").distinct(), ["size", "hash_a", "hash_b"]), "windows"
    )
    spans = matched.groupBy(*ROW).agg(
        F.array_sort(F.collect_set(F.struct("place", "size"))).alias("spans")
    )
    item = F.coalesce(F.col("item_id").cast("string"), F.lit("null"))
    items = (
        matched.select(*ROW, "size", "hash_a", "hash_b")
        .distinct()
        .join(windows, ["size", "hash_a", "hash_b"])
        .groupBy(*ROW)
        .agg(F.array_sort(F.collect_set(item)).alias("items"))
    )
    # Words in the union of the spans, which come in order of their places.
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def further(done, span):
        end = span["place"] + span["size"]
        more = F.greatest(F.lit(0), end - F.greatest(done["end"], span["place"]))
        return F.struct(
            F.greatest(done["end"], end).alias("end"), (done["n"] + more).alias("n")
        )

    total = F.aggregate("spans", zero, further, lambda done: done["n"])
    return (
        seen.where("size = 0")
        .select("doc_id", *ROW, F.col("place").alias("n_words"))
        .join(spans.select(*ROW, "spans", total.alias("n_hit")), ROW, "left")
        .join(items, ROW, "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            "spans",
            *ROW,
        )
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, with all their columns."""
    hit = contamination(docs, benchmark).where("n_hit > 0").select(*ROW).distinct()
    a, b = F.xxhash64("doc_id", "text"), F.xxhash64("text", "doc_id")
    return docs.join(hit, (a == hit["row_a"]) & (b == hit["row_b"]), "left_anti")
