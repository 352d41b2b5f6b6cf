import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgertag.domain import COUNTRY_GROUPS, LABELS, TRANSACTION_LABELS
from ledgertag.operators.evaluate import (
    golden_check,
    hits_by_rank,
    label_ranks,
    label_report,
    metric_sums,
    metric_sums_by_group,
    missing_labels,
    missing_multi_hot_labels,
    multi_hot,
    one_hot,
    performance_gate,
    prepare_test_set,
    reciprocal_rank,
    report_averages,
    report_summary,
)

JUDGED = "target_label array<int>, predicted array<int>, country_code string"


def eight_rows(spark):
    """Row i has label i; always the last label is predicted."""
    last = [0] * 7 + [1]
    return spark.createDataFrame(
        [([int(i == j) for j in range(8)], last, "GB") for i in range(8)], JUDGED
    )


def test_known_numbers(spark):
    sums = metric_sums(eight_rows(spark), TRANSACTION_LABELS)
    averages = {r.average: r for r in report_averages(sums, TRANSACTION_LABELS).collect()}
    weighted = averages["weighted avg"]
    assert round(weighted.precision, 3) == 0.016
    assert round(weighted.recall, 3) == 0.125
    assert round(weighted.f1, 3) == 0.028
    assert weighted.support == 8
    assert averages["micro avg"].precision == averages["samples avg"].f1 == 0.125
    summary = report_summary(sums, TRANSACTION_LABELS).first()
    assert (summary.subset_accuracy, summary.coverage, summary.any_label_rate) == (0.125, 1.0, 1.0)
    assert summary.hamming_loss == 0.2188  # 14 / 64 = 0.21875


def test_groups_add_up_and_empty_groups_are_zero(spark):
    df = eight_rows(spark).withColumn("country_code", F.lit("GB")).union(
        eight_rows(spark).withColumn("country_code", F.lit("DE"))
    )
    report = label_report(metric_sums_by_group(df, TRANSACTION_LABELS), TRANSACTION_LABELS, ["group"])
    support = {r.group: r.n for r in report.groupBy("group").agg(F.sum("support").alias("n")).collect()}
    assert support == {"GB": 8, "FR": 0, "IT": 0, "NL": 0, "ALL": 8}
    assert report.where("isnan(precision) OR precision IS NULL").count() == 0


def gate_report(spark, **changes):
    data = [
        (g, label, *changes.get(f"{g}_{label}", (0.8, 0.8, 0.8)))
        for g in COUNTRY_GROUPS for label in TRANSACTION_LABELS
    ]
    return spark.createDataFrame(data, "`group` string, label string, precision double, recall double, f1 double")


def test_gate_looks_at_all_groups(spark):
    assert performance_gate(gate_report(spark)).first().performant is True
    bad = gate_report(spark, ALL_Video_streaming=(0.1, 0.8, 0.8))
    assert performance_gate(bad).first().performant is False
    assert performance_gate(bad).first().n_below == 1
    assert performance_gate(gate_report(spark, GB_Gym=(0.6, 0.6, 0.6))).first().performant is True


def test_golden_sets_compare_without_order(spark):
    schema = "expected array<string>, labels array<string>"
    same = spark.createDataFrame([(["a", "b"], ["b", "a"]), ([], [])], schema)
    assert tuple(golden_check(same, "expected").first()) == (True, 0)
    other = same.union(spark.createDataFrame([(["a"], []), (["a"], None)], schema))
    assert tuple(golden_check(other, "expected").first()) == (False, 2)


def test_test_set_joins_labels_of_a_transaction(spark):
    df = spark.createDataFrame(
        [("x", 1.0, "debit", None, "GB", "1", "Salary"), ("x", 1.0, "debit", None, "GB", "1", "Rent"),
         ("x", 1.0, "debit", None, "GB", "1", "Gym"), ("x", 1.0, "debit", None, "GB", "2", None)],
        "description string, amount double, transaction_type string, internal_transaction string, "
        "country_code string, unique_transaction_id string, target_label string",
    )
    found = {r.unique_transaction_id: r for r in prepare_test_set(df).collect()}
    assert found["1"].target_label == [1, 0, 0, 0, 0, 0, 1, 0]
    assert found["2"].target_label == [0] * 8
    assert found["1"].target_label_int == 99


def test_missing_labels(spark):
    df = spark.createDataFrame([(label,) for label in LABELS[:-2]] + [(None,), ("odd",)], "target_label string")
    assert rows(missing_labels(df)) == [("Bonus_money",), ("General",)]
    flags = spark.createDataFrame([([1, 0, 0],), ([0, 0, 1],)], "target_label array<int>")
    assert rows(missing_multi_hot_labels(flags, labels=["a", "b", "c"])) == [("b",)]
    empty = flags.where("false")
    assert missing_multi_hot_labels(empty, labels=["a", "b", "c"]).count() == 3


def test_hot_encodings(spark):
    df = spark.createDataFrame([(["Gym", "Rent"], 1), ([], 7)], "l array<string>, i int")
    assert [r[0] for r in df.select(multi_hot(F.col("l"))).collect()] == [[0] * 6 + [1, 0], [0] * 8]
    assert [r[0] for r in df.select(one_hot(F.col("i"), 3)).collect()] == [[0, 1, 0], [0, 0, 0]]


def test_ranking_with_ties(spark):
    df = spark.createDataFrame([([0.6, 0.5, 0.7, 0.6], 3), ([0.9, 0.1, 0.1, 0.1], 0)], "s array<double>, y int")
    s, y = F.col("s"), F.col("y")
    assert [r[0] for r in df.select(label_ranks(s)).collect()] == [[2, 0, 3, 1], [0, 1, 2, 3]]
    assert [r[0] for r in df.select(hits_by_rank(s, y)).collect()] == [[0, 0, 1, 1], [1, 1, 1, 1]]
    assert [r[0] for r in df.select(reciprocal_rank(s, y)).collect()] == pytest.approx([1 / 3, 1.0])
