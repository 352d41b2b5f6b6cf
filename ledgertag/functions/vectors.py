"""Vector arithmetic: plain column expressions, and Arrow batches for the heavy part.

Scoring multiplies a vector per row with a few dozen label vectors. As nested lambdas this
runs in Spark's interpreter, element by element; as one matrix product per Arrow batch it is
about ten times faster, and stays a row-local step without any shuffle.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgertag.domain import EMBEDDING_SIZE

# Batch functions travel with their code, so executors need numpy and pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- Fixed value: squared lengths below this count as this, so that zero stays zero ---------
SMALLEST_SQUARE = 1e-12

# --- Fixed values of the token vectors: a hash family h_j(t) = (a_j t + b_j) mod p -----------
HASH_PRIME = 2_147_483_647
HASH_A = 1_103_515_245
HASH_B = 12_345


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2_normalize(vector: Column) -> Column:
    """Divide by the length; a zero vector stays zero."""
    length = F.sqrt(F.greatest(dot(vector, vector), F.lit(SMALLEST_SQUARE)))
    return F.transform(vector, lambda x: x.cast("double") / length)


def component_means(vector: Column, size: int) -> Column:
    """Aggregate: the mean vector of a group, component by component."""
    return F.array(*[F.avg(vector[i].cast("double")) for i in range(size)])


def token_vector(token_id: Column, size: int = EMBEDDING_SIZE) -> Column:
    """The +1/-1 vector of a token id (signed feature hashing), as a column expression."""
    return F.array(*[
        F.when(
            (token_id.cast("bigint") * F.lit(a) + F.lit(b)) % F.lit(HASH_PRIME)
            < F.lit(HASH_PRIME // 2),
            F.lit(-1.0),
        ).otherwise(F.lit(1.0))
        for a, b in hash_parameters(size)
    ])


def hash_parameters(size: int) -> list[tuple[int, int]]:
    """One (a, b) per component, by a rule so that any engine can repeat them."""
    return [
        (HASH_A * (2 * j + 1) % HASH_PRIME, HASH_B * (j + 1) * (j + 1) % HASH_PRIME)
        for j in range(size)
    ]


def _rows(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values of a list array and the length of every row (0 for null rows)."""
    lengths = np.nan_to_num(
        np.asarray(vectors.value_lengths().to_numpy(zero_copy_only=False), dtype=float)
    ).astype(np.int64)
    return vectors.flatten().to_numpy(zero_copy_only=False), lengths


def _matrix(vectors: pa.Array, size: int) -> np.ndarray:
    """Rows as a dense matrix; a null row becomes NaN, and one of another length raises."""
    values, lengths = _rows(vectors)
    if len(lengths) and (lengths == size).all():
        return values.astype(np.float64).reshape(-1, size)
    present = vectors.is_valid().to_numpy(zero_copy_only=False)
    if (lengths[present] != size).any():
        other = int(lengths[present & (lengths != size)][0])
        raise ValueError(f"a vector has {other} components instead of {size}")
    matrix = np.full((len(lengths), size), np.nan)
    matrix[present] = values.astype(np.float64).reshape(-1, size)
    return matrix


def _unit(matrix: np.ndarray) -> np.ndarray:
    squares = (matrix * matrix).sum(axis=1, keepdims=True)
    return matrix / np.sqrt(np.maximum(squares, SMALLEST_SQUARE))


def _lists(matrix: np.ndarray) -> pa.Array:
    """A dense matrix as a list array; rows that hold a NaN become null."""
    rows, size = matrix.shape
    offsets = np.arange(0, (rows + 1) * size, size, dtype=np.int32)
    undefined = np.isnan(matrix).any(axis=1)
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.array(matrix.ravel()), mask=pa.array(undefined)
    )


def packed_ids(ids: list[int]) -> bytes:
    """A set of ids as bits."""
    known = np.zeros(max(ids, default=0) + 1, bool)
    known[ids] = True
    return np.packbits(known).tobytes()


def _mean_token_vectors(ids: pa.Array, size: int, known: bytes | None = None) -> np.ndarray:
    """Mean of the token vectors of every row, leaving out padding; zeros without tokens.

    With ``known``, bits by id, tokens that are not in it are left out, too.
    """
    values, lengths = _rows(ids)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    real = values != 0
    if known is not None:
        bits = np.unpackbits(np.frombuffer(known, np.uint8)).astype(bool)
        real &= (values < len(bits)) & bits[np.minimum(values, len(bits) - 1)]
    values, rows = values[real].astype(np.int64), rows[real]
    tokens, inverse = np.unique(values, return_inverse=True)
    table = np.stack(
        [np.where((tokens * a + b) % HASH_PRIME < HASH_PRIME // 2, -1.0, 1.0)
         for a, b in hash_parameters(size)],
        axis=1,
    )
    sums = np.zeros((len(lengths), size))
    counts = np.bincount(rows, minlength=len(lengths))
    for j in range(size):
        sums[:, j] = np.bincount(rows, weights=table[inverse, j], minlength=len(lengths))
    return sums / np.maximum(counts, 1)[:, None]


def transaction_vector_udf(
    size: int = EMBEDDING_SIZE, known: bytes | None = None
) -> Callable[..., Column]:
    """(token ids, numeric features) -> unit vector of text part and numeric part."""

    @F.arrow_udf("array<double>")
    def transaction_vector(ids: pa.Array, numbers: pa.Array) -> pa.Array:
        numeric = _matrix(numbers, 3)
        return _lists(_unit(np.hstack([_mean_token_vectors(ids, size, known), numeric])))

    return transaction_vector


def text_vector_udf(size: int = EMBEDDING_SIZE) -> Callable[..., Column]:
    """token ids -> mean of their hash vectors."""

    @F.arrow_udf("array<double>")
    def text_vector(ids: pa.Array) -> pa.Array:
        return _lists(_mean_token_vectors(ids, size))

    return text_vector


def gathered_mean_udf(ids: np.ndarray, matrix: np.ndarray) -> Callable[..., Column]:
    """token ids -> mean of their rows of a matrix; ``ids`` are sorted and name the rows.

    Padding, unknown and missing ids are left out; zeros without any other, also for a null row.
    """

    @F.arrow_udf("array<double>")
    def gathered_mean(tokens: pa.Array) -> pa.Array:
        values, lengths = _rows(tokens)
        rows = np.repeat(np.arange(len(lengths)), lengths)
        values = np.nan_to_num(values.astype(np.float64)).astype(np.int64)  # null as padding
        known = (values != 0) & (len(ids) > 0)
        place = np.searchsorted(ids, values)
        known &= ids[np.minimum(place, max(len(ids) - 1, 0))] == values if len(ids) else False
        place, rows = place[known], rows[known]
        counts = np.bincount(rows, minlength=len(lengths))
        means = np.zeros((len(lengths), matrix.shape[1]))
        for j in range(matrix.shape[1]):
            means[:, j] = np.bincount(rows, weights=matrix[place, j], minlength=len(lengths))
        return _lists(means / np.maximum(counts, 1)[:, None])

    return gathered_mean


def unit_vector_udf(size: int) -> Callable[..., Column]:
    """vector -> vector of length one; null for a null or incomplete vector."""

    @F.arrow_udf("array<double>")
    def unit_vector(vectors: pa.Array) -> pa.Array:
        return _lists(_unit(_matrix(vectors, size)))

    return unit_vector


def similarity_udf(
    label_vectors: np.ndarray, directions: np.ndarray | None = None
) -> Callable[..., Column]:
    """vector -> cosine similarity with every label vector, in label order.

    With ``directions``, a row for each new component, both sides are mapped first. The matrices
    travel with the function; they have one row per label of the fixed domain.
    """
    unit_labels = _unit(np.asarray(label_vectors, dtype=np.float64))
    labels, size = unit_labels.shape
    turn = None if directions is None else np.asarray(directions, dtype=np.float64).T
    if turn is not None:
        unit_labels = _unit(unit_labels @ turn)

    @F.arrow_udf("array<double>")
    def similarity(vectors: pa.Array) -> pa.Array:
        rows = _unit(_matrix(vectors, size))
        return _lists((rows if turn is None else _unit(rows @ turn)) @ unit_labels.T)

    return similarity


def moment_partials(
    batches: Iterator[pa.RecordBatch], weights: dict, size: int
) -> Iterator[pa.RecordBatch]:
    """Of batches of (label, unit vector): weighted sums by label, and of products of components.

    A task gives one row for each number: ``place`` of the label in the weights (null for products), ``i``,
    ``j`` and ``value``.
    """
    labels = list(weights)
    sums, products = np.zeros((len(labels), size)), np.zeros((size, size))
    for batch in batches:
        names = batch.column(0).to_pylist()
        place = np.array([labels.index(name) for name in names], np.int64)
        rows = _matrix(batch.column(1), size)
        weighted = rows * np.array([weights[name] for name in names])[:, None]
        products += weighted.T @ rows
        np.add.at(sums, place, weighted)
    i, j = np.divmod(np.arange(size * size), size)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([k for k in range(len(labels)) for _ in range(size)] + [None] * (size * size), pa.int32()),
            pa.array(np.concatenate([np.tile(np.arange(size), len(labels)), i]).astype(np.int32)),
            pa.array(np.concatenate([np.full(size * len(labels), -1), j]).astype(np.int32)),
            pa.array(np.concatenate([sums.ravel(), products.ravel()])),
        ],
        names=["place", "i", "j", "value"],
    )
