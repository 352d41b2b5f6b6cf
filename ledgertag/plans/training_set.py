"""The job that turns raw tables into labelled train, validation and test sets."""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ledgertag.domain import HASHED_KEY, MODEL_INPUTS, NL_SITE_IDS, PLAIN_KEY
from ledgertag.operators.assemble import ROW_ID, long_targets, wide_rows
from ledgertag.operators.eligibility import (
    any_period,
    eligible_transactions,
    eligible_users,
    live_accounts,
)
from ledgertag.operators.feedback import (
    join_labels,
    join_latest,
    labels_per_transaction,
    latest_feedback,
    union_feedback,
)
from ledgertag.operators.reducers import KeySet, maybe_among
from ledgertag.operators.sampling import sample_to_size, split_by_class
from ledgertag.session import materialize, scratch_scope
from ledgertag.sources.sinks import run_metadata, write_metadata, write_splits
from ledgertag.sources.tables import load_tables

CATEGORY_TABLES = [
    "historical_categories_feedback",
    "user_single_feedback_created_categories",
    "user_multiple_feedback_created_categories",
    "user_multiple_feedback_applied_categories",
]


@dataclass(frozen=True)
class TrainingSetConfig:
    start: dt.date
    nl_start: dt.date
    end: dt.date
    n_labels_feedback: int | None
    n_categories_feedback: int | None
    n_validation: int
    n_test: int
    nl_site_ids: list[str] = field(default_factory=lambda: list(NL_SITE_IDS))
    period_mode: str = "compat"
    null_safe_ids: bool = False
    conflicts_first: bool = False
    distinct_labels: bool = False
    strict_split: bool = False

    @staticmethod
    def from_text(settings: dict[str, str]) -> TrainingSetConfig:
        """Read the settings of a job description, where all values are text."""

        def day(name: str) -> dt.date:
            return dt.datetime.strptime(settings[name], "%Y-%m-%d").date()

        return TrainingSetConfig(
            start=day("sample_start_date"),
            nl_start=day("nl_sample_start_date"),
            end=day("sample_end_date"),
            n_labels_feedback=int(settings["n_labels_feedback_per_country_per_label"]),
            n_categories_feedback=int(settings["n_categories_feedback"]),
            n_validation=int(settings["n_validation_samples"]),
            n_test=int(settings["n_test_samples"]),
        )


def labelled_rows(tables: dict[str, DataFrame], config: TrainingSetConfig) -> DataFrame:
    """One wide row per eligible transaction with feedback.

    Transactions are by far the largest table, few of them have feedback, and both kinds of feedback
    are about the same transactions. So each kind is reduced to one row per transaction first, and the
    raw transactions are scanned once, keeping what lies in the period and may have feedback of either
    kind. That is told by account, id and date, since the user may come from another table. Users and accounts are joined to those, and that narrow table meets both kinds.
    """
    users = eligible_users(tables["users"], tables["test_users"])
    accounts = live_accounts(tables["accounts"])
    transactions = tables["transactions"]

    latest = materialize(
        latest_feedback(union_feedback(*[tables[name] for name in CATEGORY_TABLES], distinct=False))
    )
    per_transaction = materialize(
        labels_per_transaction(
            tables["historical_labels_feedback"], users, config.n_labels_feedback,
            config.conflicts_first,
        )
    )
    needed = list(dict.fromkeys([*PLAIN_KEY, *HASHED_KEY, *MODEL_INPUTS, "month", "year"]))
    period = (config.start, config.nl_start, config.end)
    some = maybe_among(
        transactions.select(*needed).where(any_period(*period, config.period_mode)),
        KeySet(latest, PLAIN_KEY[1:], transactions),
        KeySet(per_transaction, HASHED_KEY[1:], transactions),
    )
    base = materialize(
        eligible_transactions(
            users, accounts, some, *period, config.nl_site_ids, config.period_mode
        ).select(*dict.fromkeys([*PLAIN_KEY, *HASHED_KEY, *MODEL_INPUTS, "country_code"]))
    )

    inputs = [*HASHED_KEY, *MODEL_INPUTS, "country_code"]
    categories = join_latest(latest, base).select(*inputs, "target_category")
    if config.n_categories_feedback is not None:
        categories = sample_to_size(materialize(categories), config.n_categories_feedback)
    labels = join_labels(per_transaction, base).select(*inputs, "label_counts")
    return wide_rows(categories, labels, config.null_safe_ids)


def training_set(tables: dict[str, DataFrame], config: TrainingSetConfig) -> DataFrame:
    """Long labelled rows with a ``split`` column.

    Rows are split while they are wide, so all labels of a row are in the same set.
    """
    wide = materialize(labelled_rows(tables, config))
    split = split_by_class(
        wide, config.n_validation, config.n_test, "target_category", ROW_ID,
        strict=config.strict_split,
    )
    return long_targets(split, config.distinct_labels)


def run(
    spark: SparkSession, paths: dict[str, str], config: TrainingSetConfig, output: str
) -> None:
    """Read the tables, write the three sets below ``output/sets`` and the run's metadata.

    Intermediate tables are dropped once all is written.
    """
    started = time.time()
    sets_path = f"{output.rstrip('/')}/sets"
    with scratch_scope(spark, "training-set"):
        write_splits(training_set(load_tables(spark, paths), config), sets_path)
        elapsed = time.strftime("%H:%M:%S", time.gmtime(time.time() - started))
        metadata = run_metadata(spark.read.parquet(sets_path), asdict(config), elapsed)
        write_metadata(metadata, f"{output.rstrip('/')}/metadata")
