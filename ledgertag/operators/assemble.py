"""From the two kinds of feedback to labelled rows with ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertag.domain import GENERAL, HASHED_KEY, LABELS, MODEL_INPUTS
from ledgertag.functions.hashing import measured, row_digest
from ledgertag.operators.copies import collapse_copies, repeat_rows

ROW_ID = "unique_transaction_id"


def feedback_outer(
    categories: DataFrame, labels: DataFrame, null_safe: bool = False
) -> DataFrame:
    """Full outer join of category rows and label rows; equal result rows are counted.

    By default all nine shared columns must be equal, so a transaction with a missing
    description or country stays in two rows, one per side. ``null_safe`` compares only the
    four ids, missing ones included, and takes the other columns from whichever side has them.
    Both sides enter with their copies counted, so a transaction that is present m times on one
    side and n times on the other is one joined row that stands for m * n.
    """
    shared = [*HASHED_KEY, *MODEL_INPUTS, "country_code"]
    left = collapse_copies(categories, "left_copies")
    right = collapse_copies(labels, "right_copies")
    if null_safe:
        other = right.withColumnsRenamed({c: f"other_{c}" for c in shared})
        same = [F.col(c).eqNullSafe(F.col(f"other_{c}")) for c in HASHED_KEY]
        joined = left.join(other, same, "outer").select(
            *[F.coalesce(c, f"other_{c}").alias(c) for c in shared],
            "target_category", "label_counts", "left_copies", "right_copies",
        )
    else:
        joined = left.join(right, shared, "outer")
    copies = F.coalesce("left_copies", F.lit(1)) * F.coalesce("right_copies", F.lit(1))
    return (
        joined.withColumn("copies", copies)
        .drop("left_copies", "right_copies")
        .fillna(GENERAL, subset=["target_category"])
        .fillna("", subset=["description"])
    )


def labels_text(counts: Column) -> Column:
    """Counted labels as text, for digests."""
    entry = F.transform(
        counts, lambda e: F.concat(measured(e["label"]), F.lit("*"), e["copies"].cast("string"))
    )
    return F.array_join(entry, ",")


def with_row_id(df: DataFrame, copies: str | None = None) -> DataFrame:
    """Give every row an id that is the same on every run: a digest of content and copy number.

    ``copies`` names a column with the number of times each row counts; the rows are then
    repeated. Without it, equal rows are counted first.
    """
    numbered = repeat_rows(collapse_copies(df) if copies is None else df, copies or "copies")
    content: list[str | Column] = [
        labels_text(F.col(c)) if c == "label_counts" else F.col(c) for c in numbered.columns
    ]
    return numbered.withColumn(ROW_ID, row_digest(content)).drop("copy_no")


def wide_rows(
    categories: DataFrame, labels: DataFrame, null_safe: bool = False
) -> DataFrame:
    """One row per transaction with feedback: inputs, country, category, labels and id."""
    joined = feedback_outer(categories, labels, null_safe)
    return with_row_id(joined, "copies").select(
        *MODEL_INPUTS, "country_code", "target_category", "label_counts", ROW_ID
    )


def label_table(df: DataFrame) -> DataFrame:
    """The label domain as a frame: name and id. It has one row per known label, no more."""
    rows = [(label, i) for i, label in enumerate(LABELS)]
    return df.sparkSession.createDataFrame(rows, "label string, label_id int")


def long_targets(wide: DataFrame, distinct: bool = False) -> DataFrame:
    """One row per category and one per label, with label ids; unknown labels have none.

    Category and labels of a row are put into one array. Repeated labels give repeated rows,
    unless ``distinct``; a label that was given very often is repeated in pieces, by many tasks.
    """
    category = F.array(F.struct(F.col("target_category").alias("label"), F.lit(1).cast("bigint").alias("n")))
    entry = F.transform(
        "label_counts",
        lambda e: F.struct(
            e["label"].alias("label"),
            (F.lit(1) if distinct else e["copies"]).cast("bigint").alias("n"),
        ),
    )
    targets = F.concat(category, F.coalesce(entry, F.array().cast("array<struct<label:string,n:bigint>>")))
    kept = [c for c in wide.columns if c not in ("target_category", "label_counts")]
    single = wide.select(*kept, F.explode(targets).alias("target"))
    rows = single.select(*kept, "target.label", "target.n").withColumnRenamed("label", "target_label")
    if distinct:
        return with_label_ids(rows.drop("n"))
    return with_label_ids(repeat_rows(rows, "n", "_number").drop("_number"))


def with_label_ids(df: DataFrame) -> DataFrame:
    """Add ``target_label_int``, the position of the label in the domain."""
    known = label_table(df).withColumnsRenamed(
        {"label": "known_label", "label_id": "target_label_int"}
    )
    return df.join(
        F.broadcast(known), F.col("target_label") == F.col("known_label"), "left"
    ).drop("known_label")


def trainable_rows(df: DataFrame, excluded: list[str] = [GENERAL]) -> DataFrame:
    """Rows whose label takes part in training; a missing label is not an excluded one."""
    return df.where(~F.coalesce(F.col("target_label").isin(excluded), F.lit(False)))
