"""User feedback: latest category per transaction, label lists per transaction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgertag.domain import HASHED_KEY, MODEL_INPUTS, PLAIN_KEY
from ledgertag.operators.reducers import KeySet, maybe_among
from ledgertag.operators.sampling import sample_per_stratum, sample_to_size
from ledgertag.session import materialize

CATEGORY_COLUMNS = [*PLAIN_KEY, "feedback_time", "category"]
LABEL_COLUMNS = [*HASHED_KEY, "feedback_time", "transaction_label"]
MAX_CATEGORIES = 100_000
CODES = 1_000_000  # numbers of categories are below this
NO_TIME = -(2**63)  # sorts before every time
MAX_LISTED = 1_000_000  # labels of a plain list, repetitions included


def union_feedback(*tables: DataFrame, distinct: bool = True) -> DataFrame:
    """All category feedback in one frame; events that were delivered twice count once."""
    rows = reduce(DataFrame.unionByName, [t.select(*CATEGORY_COLUMNS) for t in tables])
    return rows.dropDuplicates() if distinct else rows


def latest_feedback(feedback: DataFrame, max_categories: int = MAX_CATEGORIES) -> DataFrame:
    """The last category given to each transaction.

    A maximum, not a window: every task first reduces its rows to one per transaction, so a
    transaction with very many events costs no more than any other. Missing times come last;
    equal times are decided by the greater category. Repeated events change nothing, so the
    rows need not be made distinct before.

    Categories are few, so they are numbered in their order first, and time and number are one decimal
    number. Its maximum has a fixed width: rows are hashed and never sorted. With more categories than
    ``max_categories``, or times of another type, the maximum of the pair is taken.
    """
    kind = dict(feedback.dtypes)["feedback_time"]
    if kind not in ("timestamp", "timestamp_ntz"):
        return _latest_pair(feedback)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    if kind == "timestamp":
        to_micros, from_micros = F.unix_micros("feedback_time"), F.timestamp_micros
    else:  # without a zone: no clock change may move it
        to_micros = F.timestamp_diff("MICROSECOND", epoch, F.col("feedback_time"))

        def from_micros(n: Column) -> Column:
            return F.timestamp_add("MICROSECOND", n, epoch)

    names = feedback.select("category").where("category IS NOT NULL").distinct()
    codes = materialize(
        names.select(
            F.col("category").alias("named"),
            F.row_number().over(Window.orderBy("category")).alias("code"),
        )
    )
    if codes.count() > max_categories:
        return _latest_pair(feedback)
    codes = F.broadcast(codes)  # max_categories rows at most
    time = F.coalesce(to_micros, F.lit(NO_TIME)).cast("decimal(19,0)")
    moment = time * F.lit(CODES).cast("decimal(7,0)") + F.coalesce("code", F.lit(0)).cast("decimal(7,0)")
    last = (
        feedback.join(codes, F.col("category") == F.col("named"), "left")
        .groupBy(*PLAIN_KEY)
        .agg(F.max(moment).alias("last"))
        .withColumn("last_code", F.pmod("last", F.lit(CODES).cast("decimal(7,0)")).cast("int"))
    )
    micros = ((F.col("last") - F.col("last_code")) / F.lit(CODES).cast("decimal(7,0)")).cast("bigint")
    return last.join(codes, F.col("last_code") == F.col("code"), "left").select(
        *PLAIN_KEY,
        from_micros(F.nullif(micros, F.lit(NO_TIME))).alias("feedback_time"),
        F.col("named").alias("category"),
    )


def _latest_pair(feedback: DataFrame) -> DataFrame:
    last = F.max(F.struct("feedback_time", "category")).alias("last")
    return feedback.groupBy(*PLAIN_KEY).agg(last).select(*PLAIN_KEY, "last.*")


def join_latest(latest: DataFrame, transactions: DataFrame) -> DataFrame:
    """Latest feedback with its transaction; all transaction columns stay."""
    return latest.drop("feedback_time").join(transactions, PLAIN_KEY, "inner").withColumnRenamed(
        "category", "target_category"
    )


def category_feedback(
    tables: list[DataFrame], transactions: DataFrame, n_samples: int | None = None
) -> DataFrame:
    """One category per transaction with feedback, thinned out to about ``n_samples`` rows.

    Other transactions are dropped before they are joined or shuffled.
    """
    latest = materialize(latest_feedback(union_feedback(*tables, distinct=False)))
    some = maybe_among(transactions, KeySet(latest, PLAIN_KEY[1:], transactions))
    joined = join_latest(latest, some).select(
        *HASHED_KEY, *MODEL_INPUTS, "country_code", "target_category"
    )
    return joined if n_samples is None else sample_to_size(materialize(joined), n_samples)


def label_feedback_with_country(feedback: DataFrame, users: DataFrame) -> DataFrame:
    return feedback.join(users, "user_id_hashed", "inner").select(*LABEL_COLUMNS, "country_code")


def label_counts(feedback: DataFrame) -> DataFrame:
    """Per transaction: its labels, and how often each was given.

    This is the label list with its repetitions, in bounded space: a transaction holds no more
    entries than there are labels, however much feedback it got. Counting happens before the
    shuffle.
    """
    keys = [*HASHED_KEY, "country_code"]
    counted = feedback.groupBy(*keys, "transaction_label").agg(F.count("*").alias("copies"))
    entry = F.when(
        F.col("transaction_label").isNotNull(),
        F.struct(F.col("transaction_label").alias("label"), "copies"),
    )
    return counted.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("label_counts"))


def label_runs(counts: Column) -> Column:
    """The counted labels as text, ``Gym*3,Rent``: bounded, however often a label was given."""
    many = F.transform(
        counts,
        lambda e: F.when(e["copies"] == 1, e["label"]).otherwise(
            F.concat(e["label"], F.lit("*"), e["copies"].cast("string"))
        ),
    )
    return F.array_join(many, ",")


def label_list(counts: Column, most: int = MAX_LISTED) -> Column:
    """The counted labels as a plain list, repetitions included.

    For transactions with little feedback: a list of more than ``most`` labels would not fit a row
    and raises. ``label_runs`` and ``long_targets`` take any number.
    """
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda n, e: n + e["copies"])
    few = F.flatten(F.transform(counts, lambda e: F.array_repeat(e["label"], F.least(e["copies"], F.lit(most)).cast("int"))))
    too_many = F.raise_error(F.concat(F.lit("too many labels for a list: "), total.cast("string")))
    return F.when(F.coalesce(total, F.lit(0)) <= most, few).otherwise(too_many.cast("array<string>"))


def without_conflicts(
    df: DataFrame,
    exclusive: str = "Salary",
    exclusive_pairs: list[tuple[str, str]] = [("Energy", "Internet_mobile")],
) -> DataFrame:
    """Drop transactions whose labels contradict each other."""
    labels = F.col("label_counts")["label"]
    conflict = F.array_contains(labels, exclusive) & (F.size(labels) > 1)
    for one, other in exclusive_pairs:
        conflict |= F.array_contains(labels, one) & F.array_contains(labels, other)
    return df.where(~conflict)


def labels_per_transaction(
    feedback: DataFrame,
    users: DataFrame,
    n_samples: int | None = None,
    conflicts_first: bool = False,
) -> DataFrame:
    """Label feedback of known users, thinned out per country and label, one row per transaction.

    By default sampling comes first, so a label that was left out can hide a conflict; with
    ``conflicts_first`` the conflicting transactions are dropped before.
    """
    rows = label_feedback_with_country(feedback, users)
    if conflicts_first:
        keys = [*HASHED_KEY, "country_code"]
        good = without_conflicts(label_counts(rows)).select(
            *[F.col(k).alias(f"good_{k}") for k in keys]
        )
        same = [F.col(k).eqNullSafe(F.col(f"good_{k}")) for k in keys]
        rows = rows.join(good, same, "left_semi")
    if n_samples is not None:
        # Counting, ratios and draws read the rows several times.
        rows = sample_per_stratum(
            materialize(rows), n_samples, ["country_code", "transaction_label"], "transaction_id_hashed"
        )
    return without_conflicts(label_counts(rows))


def join_labels(per_transaction: DataFrame, transactions: DataFrame) -> DataFrame:
    """Transactions that have labels; all transaction columns stay."""
    return transactions.join(per_transaction.drop("country_code"), HASHED_KEY, "inner")


def label_feedback(
    feedback: DataFrame,
    users: DataFrame,
    transactions: DataFrame,
    n_samples: int | None = None,
    conflicts_first: bool = False,
) -> DataFrame:
    per_transaction = materialize(
        labels_per_transaction(feedback, users, n_samples, conflicts_first)
    )
    some = maybe_among(transactions, KeySet(per_transaction, HASHED_KEY[1:], transactions))
    return join_labels(per_transaction, some).select(
        *HASHED_KEY, *MODEL_INPUTS, "country_code", "label_counts"
    )
