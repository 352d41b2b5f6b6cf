"""Multi-label and ranking metrics, per country group, and the quality gate.

Truth and prediction are arrays of 0/1 in label order. All metrics come from sums that can be
added up, so one pass builds them per country; groups of countries are sums of those few rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertag.domain import (
    COUNTRY_GROUPS,
    LABELS,
    MAX_RECALL_RANK,
    MIN_F1,
    MIN_PRECISION,
    MIN_RECALL,
    MODEL_INPUTS,
    TRANSACTION_LABELS,
)
from ledgertag.operators.assemble import ROW_ID

UNUSED_LABEL_ID = 99  # fixed value: stands where the model expects a single label id


def multi_hot(labels_present: Column, labels: list[str] = TRANSACTION_LABELS) -> Column:
    return F.array(*[F.array_contains(labels_present, label).cast("int") for label in labels])


def one_hot(label_id: Column, size: int) -> Column:
    return F.array(*[F.coalesce((label_id == i).cast("int"), F.lit(0)) for i in range(size)])


def prepare_test_set(df: DataFrame, labels: list[str] = TRANSACTION_LABELS) -> DataFrame:
    """Long rows to one row per transaction, with all its labels as 0/1.

    Inputs depend on the id, so grouping by both gives distinct inputs and joined labels at
    once. Each label is a maximum; nothing is collected.
    """
    flags = [
        F.coalesce(F.max((F.col("target_label") == label).cast("int")), F.lit(0))
        for label in labels
    ]
    return (
        df.groupBy(*MODEL_INPUTS, "country_code", ROW_ID)
        .agg(F.array(*flags).alias("target_label"))
        .withColumn("target_label_int", F.lit(UNUSED_LABEL_ID))
    )


def missing_labels(
    df: DataFrame, column: str = "target_label", expected: list[str] = LABELS
) -> DataFrame:
    """Expected labels that no row has."""
    wanted = df.sparkSession.createDataFrame([(label,) for label in expected], "label string")
    present = df.where(F.col(column).isin(expected)).select(F.col(column).alias("label"))
    return wanted.join(present.distinct(), "label", "left_anti")


def missing_multi_hot_labels(
    df: DataFrame, column: str = "target_label", labels: list[str] = TRANSACTION_LABELS
) -> DataFrame:
    """Labels whose flag is 0 in all rows."""
    seen = df.agg(*[F.max(F.col(column)[i]).alias(f"seen{i}") for i in range(len(labels))])
    entries = [
        F.struct(F.lit(label).alias("label"), F.coalesce(F.col(f"seen{i}"), F.lit(0)).alias("seen"))
        for i, label in enumerate(labels)
    ]
    return (
        seen.select(F.explode(F.array(*entries)).alias("e"))
        .where(F.col("e.seen") == 0)
        .select("e.label")
    )


def _ratio(part: Column, whole: Column) -> Column:
    """Division where nothing out of nothing is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


def _sum(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def metric_sums(
    df: DataFrame,
    labels: list[str],
    truth: str = "target_label",
    predicted: str = "predicted",
    group: str | None = None,
) -> DataFrame:
    """Everything the metrics need, in one aggregation per group (or overall)."""
    size = len(labels)
    y = [F.col(f"y{i}") for i in range(size)]
    p = [F.col(f"p{i}") for i in range(size)]
    flat = df.select(
        *([group] if group else []),
        *[F.col(truth)[i].cast("int").alias(f"y{i}") for i in range(size)],
        *[F.col(predicted)[i].cast("int").alias(f"p{i}") for i in range(size)],
    )
    rows = flat.withColumns({
        "hits": _sum([a * b for a, b in zip(y, p)]),
        "true_labels": _sum(y),
        "predicted_labels": _sum(p),
        "wrong": _sum([(a != b).cast("int") for a, b in zip(y, p)]),
    }).withColumns({
        "row_precision": _ratio(F.col("hits"), F.col("predicted_labels")),
        "row_recall": _ratio(F.col("hits"), F.col("true_labels")),
    })
    sums = []
    for i in range(size):
        sums += [
            F.sum(y[i] * p[i]).alias(f"hit{i}"),
            F.sum(p[i]).alias(f"predicted{i}"),
            F.sum(y[i]).alias(f"support{i}"),
        ]
    sums += [
        F.count("*").alias("n_rows"),
        F.sum("row_precision").alias("row_precision"),
        F.sum("row_recall").alias("row_recall"),
        F.sum(_f1(F.col("row_precision"), F.col("row_recall"))).alias("row_f1"),
        F.count_if(F.col("wrong") == 0).alias("exact"),
        F.sum("wrong").alias("wrong"),
        F.count_if(F.col("true_labels") > 0).alias("labelled"),
    ]
    return (rows.groupBy(group) if group else rows).agg(*sums)


def metric_sums_by_group(
    df: DataFrame,
    labels: list[str],
    groups: dict[str, list[str]] = COUNTRY_GROUPS,
    country: str = "country_code",
    **columns: str,
) -> DataFrame:
    """Sums per group of countries; a group without rows has zeros. Other countries are left out.

    The rows are summed per country first; only those few rows are then given to each of their
    groups.
    """
    members = sorted({c for countries in groups.values() for c in countries})
    per_country = metric_sums(
        df.where(F.col(country).isin(members)), labels, group=country, **columns
    )
    pairs = [(g, c) for g, countries in groups.items() for c in countries]
    membership = df.sparkSession.createDataFrame(pairs, f"`group` string, {country} string")
    values = [c for c in per_country.columns if c != country]
    return (
        membership.join(per_country, country, "left")
        .groupBy("group")
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in values])
    )


def label_report(sums: DataFrame, labels: list[str], keep: list[str] = []) -> DataFrame:
    """Precision, recall, F1 and support per label."""
    entries = [
        F.struct(
            F.lit(label).alias("label"),
            F.col(f"hit{i}").alias("hit"),
            F.col(f"predicted{i}").alias("predicted"),
            F.col(f"support{i}").alias("support"),
        )
        for i, label in enumerate(labels)
    ]
    return (
        sums.select(*keep, F.explode(F.array(*entries)).alias("e"))
        .select(*keep, "e.*")
        .withColumn("precision", _ratio(F.col("hit"), F.col("predicted")))
        .withColumn("recall", _ratio(F.col("hit"), F.col("support")))
        .withColumn("f1", _f1(F.col("precision"), F.col("recall")))
        .select(*keep, "label", "precision", "recall", "f1", "support")
    )


def report_averages(sums: DataFrame, labels: list[str], keep: list[str] = []) -> DataFrame:
    """Micro, macro, weighted and samples averages of the report."""
    size = len(labels)
    hit, predicted, support = (
        [F.col(f"{kind}{i}") for i in range(size)] for kind in ("hit", "predicted", "support")
    )
    precision = [_ratio(h, p) for h, p in zip(hit, predicted)]
    recall = [_ratio(h, s) for h, s in zip(hit, support)]
    f1 = [_f1(p, r) for p, r in zip(precision, recall)]
    total = _sum(support)

    def weighted(values: list[Column]) -> Column:
        return _ratio(_sum([v * s for v, s in zip(values, support)]), total)

    micro = [_ratio(_sum(hit), _sum(predicted)), _ratio(_sum(hit), total)]
    averages = {
        "micro avg": [*micro, _f1(*micro)],
        "macro avg": [_sum(v) / size for v in (precision, recall, f1)],
        "weighted avg": [weighted(v) for v in (precision, recall, f1)],
        "samples avg": [
            _ratio(F.col(c), F.col("n_rows")) for c in ("row_precision", "row_recall", "row_f1")
        ],
    }
    entries = [
        F.struct(
            F.lit(name).alias("average"),
            p.alias("precision"), r.alias("recall"), f.alias("f1"), total.alias("support"),
        )
        for name, (p, r, f) in averages.items()
    ]
    return sums.select(*keep, F.explode(F.array(*entries)).alias("e")).select(*keep, "e.*")


def report_summary(sums: DataFrame, labels: list[str], keep: list[str] = []) -> DataFrame:
    """Share of exact rows, share of wrong flags, true labels per row, rows with any label."""
    size = len(labels)
    n_rows = F.col("n_rows")
    support = _sum([F.col(f"support{i}") for i in range(size)])
    return sums.select(
        *keep,
        F.bround(F.try_divide(F.col("exact").cast("double"), n_rows), 4).alias("subset_accuracy"),
        F.bround(F.try_divide(F.col("wrong").cast("double"), n_rows * size), 4)
        .alias("hamming_loss"),
        F.bround(F.try_divide(support.cast("double"), n_rows), 4).alias("coverage"),
        F.bround(F.try_divide(F.col("labelled").cast("double"), n_rows), 4)
        .alias("any_label_rate"),
        "n_rows",
    )


def label_ranks(scores: Column) -> Column:
    """Label positions by falling score, equal scores by position: a sort inside the row."""
    pairs = F.transform(scores, lambda s, i: F.struct((-s).alias("order"), i.alias("position")))
    return F.transform(F.array_sort(pairs), lambda pair: pair["position"])


def hits_by_rank(scores: Column, label_id: Column, max_rank: int = MAX_RECALL_RANK + 1) -> Column:
    """Running count of the right label along the ranks: 1 from the rank where it stands."""
    place = F.array_position(label_ranks(scores), label_id)
    return F.array(*[(place <= rank).cast("double") for rank in range(1, max_rank + 1)])


def reciprocal_rank(scores: Column, label_id: Column) -> Column:
    """1 / number of labels scored at least as high as the right one."""
    right = F.get(scores, label_id)
    return F.try_divide(F.lit(1.0), F.size(F.filter(scores, lambda s: s >= right)))


def ranking_metrics(df: DataFrame, scores: str, label_id: str) -> DataFrame:
    """Mean reciprocal rank and mean recall at the first ranks."""
    hits = hits_by_rank(F.col(scores), F.col(label_id))
    return df.select(
        reciprocal_rank(F.col(scores), F.col(label_id)).alias("reciprocal_rank"),
        hits.alias("hits"),
    ).agg(
        F.avg("reciprocal_rank").alias("mean_reciprocal_rank"),
        *[
            F.avg(F.col("hits")[i]).alias(f"recall_at_{i + 1}")
            for i in range(MAX_RECALL_RANK + 1)
        ],
    )


def performance_gate(
    report: DataFrame,
    min_precision: float = MIN_PRECISION,
    min_recall: float = MIN_RECALL,
    min_f1: float = MIN_F1,
) -> DataFrame:
    """True if every label of every group reaches all three limits."""
    good = (
        (F.col("precision") >= min_precision)
        & (F.col("recall") >= min_recall)
        & (F.col("f1") >= min_f1)
    )
    return report.agg(
        F.coalesce(F.bool_and(good), F.lit(False)).alias("performant"),
        F.count_if(~good).alias("n_below"),
    )


def golden_check(df: DataFrame, expected: str, predicted: str = "labels") -> DataFrame:
    """True if predicted and expected label sets are equal in all rows."""
    same = F.array_sort(F.array_distinct(F.col(expected))) == F.array_sort(
        F.array_distinct(F.col(predicted))
    )
    return df.agg(
        F.coalesce(F.bool_and(F.coalesce(same, F.lit(False))), F.lit(True)).alias("passed"),
        F.count_if(~F.coalesce(same, F.lit(False))).alias("n_different"),
    )
