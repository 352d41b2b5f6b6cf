"""Vectors, label vectors, similarities, and the losses measured on them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgertag.domain import EMBEDDING_SIZE, TRAINING_LABELS, TRANSACTION_LABELS, TRIPLET_MARGIN
from ledgertag.functions.text import PAD_ID
from ledgertag.functions.vectors import (
    component_means,
    gathered_mean_udf,
    moment_partials,
    packed_ids,
    similarity_udf,
    transaction_vector_udf,
    unit_vector_udf,
)

N_NUMERIC = 3
# Token vectors that are sent to all tasks take no more than this.
MAX_MATRIX_BYTES = 64 << 20
MAX_LABELS = 10_000
RIDGE = 0.1


def masked_mean(
    df: DataFrame,
    token_vectors: DataFrame,
    key: str,
    size: int = EMBEDDING_SIZE,
    max_bytes: int = MAX_MATRIX_BYTES,
    vocabulary: int | None = None,
) -> DataFrame:
    """Mean vector of a row's tokens, looked up in a table; padding and unknown ids are left out.

    Rows without tokens get zeros; ``key`` names the rows and must be unique. A table of at most
    ``max_bytes`` (counted first) with one whole vector for each token is sent to the tasks as a matrix, so
    rows stay where they are. Any other table is joined: Spark shuffles tokens and splits frequent
    ones at run time, and a row's tokens are summed up before the second shuffle.

    With ``vocabulary``, the token ids of the rows are below it: other rows of the table can't be looked up
    and are left out first, so the matrix has the size of the vocabulary, however large the table is.
    """
    table = token_vectors.select("token_id", "vector")
    if vocabulary is not None:
        table = table.where(F.col("token_id").between(PAD_ID + 1, vocabulary - 1))
    if _fits(table, size, max_bytes):
        known = table.toArrow()
        ids = known["token_id"].to_numpy().astype(np.int64)
        order = np.argsort(ids)
        matrix = known["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        gather = gathered_mean_udf(ids[order], matrix.astype(np.float64).reshape(-1, size)[order])
        return df.select(key, gather(F.col("token_ids")).alias("vector"))
    real = F.filter("token_ids", lambda t: t != PAD_ID)
    tokens = df.select(key, F.explode_outer(real).alias("token_id"))
    found = tokens.join(table, "token_id", "left")
    mean = [F.avg(F.col("vector")[i].cast("double")) for i in range(size)]
    return found.groupBy(key).agg(
        F.array(*[F.coalesce(m, F.lit(0.0)) for m in mean]).alias("vector")
    )


def _fits(table: DataFrame, size: int, max_bytes: int) -> bool:
    """Whether the table is small, has each token once, and only whole vectors."""
    most = max_bytes // (8 * size + 8)
    whole = F.coalesce((F.size("vector") == size) & F.forall("vector", lambda x: x.isNotNull()), F.lit(False))
    rows = table.limit(most + 1).agg(
        F.count("*").alias("n"),
        F.count_distinct("token_id").alias("tokens"),
        F.count_if(whole).alias("whole"),
    ).first()
    return rows["n"] <= most and rows["n"] == rows["tokens"] == rows["whole"]


def with_transaction_vector(
    df: DataFrame, size: int = EMBEDDING_SIZE, known: bytes | None = None
) -> DataFrame:
    """Unit vector of text part and numeric part, from the features of a row.

    With ``known`` (``seen_tokens``), other tokens don't take part in the text part.
    """
    vector = transaction_vector_udf(size, known)
    return df.withColumn("vector", vector("token_ids", "numeric_features"))


def fit_label_vectors(
    df: DataFrame, label: str, vector: str = "vector", size: int = EMBEDDING_SIZE + N_NUMERIC
) -> DataFrame:
    """One unit vector per label: the mean direction of the label's rows.

    Plain partial averages per label: each task sends one row per label, whatever their sizes.
    """
    unit = unit_vector_udf(size)
    return (
        df.select(label, unit(F.col(vector)).alias("unit"))
        .where(F.col("unit").isNotNull() & F.col(label).isNotNull())
        .groupBy(label)
        .agg(component_means(F.col("unit"), size).alias("mean"))
        .select(label, unit(F.col("mean")).alias("vector"))
    )


def seen_tokens(df: DataFrame, tokens: str = "token_ids") -> bytes:
    """The token ids that occur, as bits: no more of them than the vocabulary has."""
    ids = df.select(F.explode(tokens).alias("id")).where("id IS NOT NULL").distinct()
    return packed_ids([row["id"] for row in ids.toLocalIterator()])


def label_moments(
    df: DataFrame, label: str, vector: str = "vector", size: int = EMBEDDING_SIZE + N_NUMERIC,
    max_labels: int = MAX_LABELS,
) -> DataFrame:
    """Mean unit vector of each label, and the mean product of any two components.

    Every label weighs the same, whatever its size. Rows of means have ``label``, ``i`` and -1 for ``j``,
    those of products no label, ``i`` and ``j``. Two passes: sizes of labels, then sums of which each
    task sends a fixed number. Rows without label or vector don't count.
    """
    rows = df.where(F.col(label).isNotNull() & F.col(vector).isNotNull())
    rows = rows.select(F.col(label).alias("label"), unit_vector_udf(size)(F.col(vector)).alias("unit"))
    rows = rows.where("unit IS NOT NULL")
    sizes = rows.groupBy("label").count().limit(max_labels + 1).collect()
    if len(sizes) > max_labels:
        raise ValueError(f"more than {max_labels} labels")
    weights = {row["label"]: 1.0 / row["count"] for row in sizes}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return moment_partials(batches, weights, size)

    parts = rows.mapInArrow(run, "place int, i int, j int, value double")
    totals = parts.groupBy("place", "i", "j").agg(F.sum("value").alias("value"))
    share = F.when(F.col("place").isNull(), F.lit(1.0 / max(len(weights), 1))).otherwise(F.lit(1.0))
    names = F.array(*map(F.lit, weights)).cast(T.ArrayType(rows.schema["label"].dataType))
    return totals.where(F.lit(bool(weights))).select(
        F.get(names, F.col("place")).alias("label"), "i", "j", (F.col("value") * share).alias("value")
    )


def ridge_directions(
    moments: DataFrame, labels: list, size: int = EMBEDDING_SIZE + N_NUMERIC, ridge: float = RIDGE
) -> tuple[list[list[float]], list[list[float]]]:
    """Mean vectors of the labels, and the directions that tell them apart best by least squares.

    A direction is the weight of each component in a linear guess of a label from a unit vector, with
    ``ridge`` times the mean squared component added to the squares. Components that no labelled row
    has get no weight. Zeros for a label without rows.
    """
    place = {label: k for k, label in enumerate(labels)}
    means, products = np.zeros((len(labels), size)), np.zeros((size, size))
    for row in moments.collect():  # labels x size + size x size numbers
        if row["label"] is None:
            products[row["i"], row["j"]] = row["value"]
        elif row["label"] in place:
            means[place[row["label"]], row["i"]] = row["value"]
    present = max(int((means != 0).any(axis=1).sum()), 1)
    damped = products + max(ridge * np.trace(products) / size, 1e-12) * np.eye(size)
    return means.tolist(), (np.linalg.solve(damped, means.T).T / present).tolist()


def known_labels(df: DataFrame, label: str, max_labels: int = MAX_LABELS) -> list:
    """The labels of a frame in their order. More than ``max_labels`` raise."""
    found = df.select(label).where(F.col(label).isNotNull()).distinct().limit(max_labels + 1).collect()
    if len(found) > max_labels:
        raise ValueError(f"more than {max_labels} labels")
    return sorted(row[0] for row in found)


def label_matrix(label_vectors: DataFrame, label: str, labels: list, size: int) -> list[list[float]]:
    """Label vectors in the order of ``labels``; zeros for a label that has none.

    Only listed labels are fetched, so the driver gets at most one short row for each.
    """
    found = dict(
        label_vectors.where(F.col(label).isin(labels)).select(label, "vector").collect()
    )
    return [list(found.get(name) or [0.0] * size) for name in labels]


def with_similarities(
    df: DataFrame,
    matrix: list[list[float]],
    vector: str = "vector",
    directions: list[list[float]] | None = None,
) -> DataFrame:
    """Cosine similarity with every label, as an array in label order. No join, no shuffle.

    With ``directions``, vectors and label vectors are mapped by them first. A null vector has no
    similarities, and one of another length than the label vectors raises.
    """
    return df.withColumn("similarities", similarity_udf(matrix, directions)(F.col(vector)))


def similarities_long(df: DataFrame, labels: list, key: str, column: str = "similarities") -> DataFrame:
    """One row per label, for reports."""
    return df.select(key, F.posexplode(column).alias("position", "similarity")).select(
        key,
        F.lit(labels)[F.col("position")].alias("label"),
        "similarity",
    )


def transaction_label_similarities(similarities: Column) -> Column:
    """The part of the similarities that belongs to transaction labels."""
    return F.array(*[similarities[TRAINING_LABELS.index(label)] for label in TRANSACTION_LABELS])


def row_triplet_loss(
    similarities: Column, label_id: Column, margin: float = TRIPLET_MARGIN
) -> Column:
    """Loss of one row: distance to the closest wrong label that is not above the right one.

    A wrong label above the right one counts as the smallest wrong similarity of the row.
    """
    right = F.get(similarities, label_id)
    wrong = F.filter(similarities, lambda s, i: i != label_id)
    lowest = F.array_min(wrong)
    closest = F.array_max(F.transform(wrong, lambda s: F.when(s < right, s).otherwise(lowest)))
    return F.greatest(F.lit(0.0), closest - right + F.lit(margin))


def triplet_loss(
    df: DataFrame, label_id: str, similarities: str = "similarities",
    margin: float = TRIPLET_MARGIN,
) -> DataFrame:
    loss = row_triplet_loss(F.col(similarities), F.col(label_id), margin)
    return df.agg(F.avg(loss).alias("triplet_loss"))
