"""The label model: fitted by two aggregations, applied as a row-local plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertag.domain import (
    EMBEDDING_SIZE,
    SIMILARITY_THRESHOLD,
    TAX_RULES,
    TEST_DESCRIPTION_PREFIX,
    TRAINING_LABELS,
    TaxRule,
)
from ledgertag.operators.assemble import trainable_rows
from ledgertag.operators.features import INPUT_DEFAULTS, AmountScale, with_features
from ledgertag.operators.rules import (
    apply_label_rules,
    apply_similarity_rules,
    eliminate_conflicts,
    indicators,
    label_set,
)
from ledgertag.operators.scoring import (
    N_NUMERIC,
    fit_label_vectors,
    label_matrix,
    label_moments,
    ridge_directions,
    seen_tokens,
    with_similarities,
    with_transaction_vector,
)
from ledgertag.session import materialize

VECTOR_SIZE = EMBEDDING_SIZE + N_NUMERIC
KEPT = "_kept_columns"


@dataclass(frozen=True)
class LabelModel:
    """Amount scale and one vector per training label.

    ``directions`` map transactions and labels to one component per label before they are compared;
    ``known`` holds the tokens that were seen in training. Without them vectors are compared as they are.
    """

    scale: AmountScale
    matrix: list[list[float]]
    directions: list[list[float]] | None = None
    known: bytes | None = None

    @staticmethod
    def fit(training: DataFrame, method: str = "ridge") -> LabelModel:
        """Fit on long labelled rows: range of amounts, then mean vector and direction per label.

        ``ridge`` leaves out tokens never seen in training and compares by least-squares directions;
        ``mean`` compares with the mean vectors. All passes read a table of the columns needed, so the
        input is computed once.
        """
        if method not in ("ridge", "mean"):
            raise ValueError(f"unknown method {method!r}")
        needed = [c for c in (*INPUT_DEFAULTS, "target_label") if c in training.columns]
        rows = materialize(trainable_rows(training.select(*needed)))
        scale = AmountScale.fit(rows)
        features = with_features(rows, scale)
        if method == "mean":
            vectors = with_transaction_vector(features)
            fitted = fit_label_vectors(vectors, "target_label")
            return LabelModel(scale, label_matrix(fitted, "target_label", TRAINING_LABELS, VECTOR_SIZE))
        # Texts are cut into tokens once; three passes read the ids.
        labelled = materialize(
            features.where(F.col("target_label").isin(TRAINING_LABELS))
            .select("target_label", "token_ids", "numeric_features")
        )
        known = seen_tokens(labelled)
        vectors = with_transaction_vector(labelled, known=known)
        moments = label_moments(vectors, "target_label")
        means, directions = ridge_directions(moments, TRAINING_LABELS)
        return LabelModel(scale, means, directions, known)

    def similarities(self, df: DataFrame) -> DataFrame:
        """Similarity of each row with each training label; helper columns stay."""
        vectors = with_transaction_vector(with_features(df, self.scale), known=self.known)
        return with_similarities(vectors, self.matrix, directions=self.directions)

    def indicators(self, df: DataFrame, threshold: float = SIMILARITY_THRESHOLD) -> DataFrame:
        """Add ``predicted``: 0/1 per transaction label, after rules and conflicts."""
        scored = eliminate_conflicts(apply_similarity_rules(self.similarities(df)))
        flags = indicators(F.col("similarities"), threshold=threshold)
        return scored.withColumn("predicted", flags).select(*df.columns, "predicted")

    def predict(
        self,
        df: DataFrame,
        tax_rules: list[TaxRule] = TAX_RULES,
        test_prefix: str = TEST_DESCRIPTION_PREFIX,
        keep: list[str] | None = None,
        threshold: float = SIMILARITY_THRESHOLD,
    ) -> DataFrame:
        """Label sets. Only ``labels`` is returned, unless ``keep`` names more columns.

        Kept columns come back as they were, also those that share a name with a feature.
        """
        kept = F.struct(*(keep or [])) if keep else F.lit(None)
        flagged = self.indicators(df.withColumn(KEPT, kept), threshold)
        labelled = flagged.withColumn("labels", label_set(F.col("predicted")))
        result = apply_label_rules(labelled, tax_rules, test_prefix)
        return result.select(*(F.col(f"{KEPT}.`{name}`") for name in keep or []), "labels")

    def save(self, spark: SparkSession, path: str) -> None:
        """One small table: a row per label, and the known tokens in the first of them."""
        low, high = self.scale.low, self.scale.high
        directions = self.directions or [None] * len(TRAINING_LABELS)
        rows = [
            (label, v, w, None if k else self.known, low, high)
            for k, (label, v, w) in enumerate(zip(TRAINING_LABELS, self.matrix, directions, strict=True))
        ]
        schema = (
            "label string, vector array<double>, direction array<double>, known_tokens binary, "
            "amount_min double, amount_max double"
        )
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> LabelModel:
        stored = spark.read.parquet(path).where(F.col("label").isin(TRAINING_LABELS))
        found = {row["label"]: row for row in stored.collect()}
        none = [0.0] * VECTOR_SIZE
        rows = [found.get(label) for label in TRAINING_LABELS]
        matrix = [list(row["vector"]) if row else none for row in rows]
        first = next(row for row in rows if row)
        directions = known = None
        if first["direction"] is not None:
            directions = [list(row["direction"]) if row else none for row in rows]
            known = next((bytes(row["known_tokens"]) for row in rows if row and row["known_tokens"]), b"")
        return LabelModel(AmountScale(first["amount_min"], first["amount_max"]), matrix, directions, known)
