"""Model inputs and numeric features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertag.functions.text import token_ids

# --- Fixed values: model inputs, their types, and what stands in for a missing one -------
INPUT_DEFAULTS = {
    "description": ("string", ""),
    "amount": ("float", 0.0),
    "transaction_type": ("string", ""),
    "internal_transaction": ("string", ""),
}
HISTOGRAM_WIDTH = 10
HISTOGRAM_BINS = 25


def align_inputs(df: DataFrame) -> DataFrame:
    """Make sure all inputs are there, of the right type and without nulls."""
    columns = {}
    for name, (kind, default) in INPUT_DEFAULTS.items():
        missing = F.lit(default).cast(kind)
        columns[name] = (
            F.coalesce(F.col(name).cast(kind), missing) if name in df.columns else missing
        )
    return df.withColumns(columns)


@dataclass(frozen=True)
class AmountScale:
    low: float | None
    high: float | None

    @staticmethod
    def fit(df: DataFrame) -> AmountScale:
        """Smallest and largest amount of the training rows, before nulls are filled."""
        amount = F.col("amount").cast("float")
        low, high = df.agg(F.min(amount), F.max(amount)).first()
        return AmountScale(low, high)


def amount_range(df: DataFrame) -> DataFrame:
    """The same two numbers as a one-row frame."""
    amount = F.col("amount").cast("float").cast("double")
    return df.agg(F.min(amount).alias("amount_min"), F.max(amount).alias("amount_max"))


def scaled_amount(scale: AmountScale) -> Column:
    """Position of the amount between low and high; null when they are equal or unknown."""
    low, high = F.lit(scale.low).cast("double"), F.lit(scale.high).cast("double")
    return F.try_divide(F.col("amount").cast("double") - low, high - low)


def numeric_features(df: DataFrame, scale: AmountScale) -> DataFrame:
    """Scaled amount and the two flags, of aligned inputs; also as one vector in this order."""
    return df.withColumns({
        "scaled_amount": scaled_amount(scale),
        "is_debit_transaction": (F.col("transaction_type") == "debit").cast("double"),
        "is_internal_transaction": (F.col("internal_transaction") != "").cast("double"),
    }).withColumn(
        "numeric_features",
        F.array("scaled_amount", "is_debit_transaction", "is_internal_transaction"),
    )


def with_features(df: DataFrame, scale: AmountScale) -> DataFrame:
    """Everything the model looks at: token ids and numeric features."""
    aligned = numeric_features(align_inputs(df), scale)
    return aligned.withColumn("token_ids", token_ids(F.col("description")))


def length_histogram(df: DataFrame, text: str = "description") -> DataFrame:
    """Share of rows per text length, in bins of ten characters up to 250.

    The last bin includes its right edge; longer texts are in no bin but count as rows. All
    bins are counted in one pass, so empty ones need no join.
    """
    last = HISTOGRAM_WIDTH * HISTOGRAM_BINS
    length = F.length(text)
    counts = []
    for i in range(HISTOGRAM_BINS):
        low, high = i * HISTOGRAM_WIDTH, (i + 1) * HISTOGRAM_WIDTH
        inside = (length >= low) & ((length <= high) if high == last else (length < high))
        counts.append(F.struct(F.lit(high).alias("bin"), F.count_if(inside).alias("n")))
    return (
        df.agg(F.count("*").alias("n_rows"), F.array(*counts).alias("bins"))
        .select("n_rows", F.explode("bins").alias("b"))
        .select("b.bin", F.try_divide(F.col("b.n").cast("double"), F.col("n_rows")).alias("share"))
    )
