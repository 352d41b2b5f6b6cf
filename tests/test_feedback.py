import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgertag.operators.feedback import (
    label_counts,
    label_list,
    label_runs,
    labels_per_transaction,
    latest_feedback,
    union_feedback,
    without_conflicts,
)

DAY = dt.date(2020, 1, 1)


def at(hour):
    return dt.datetime(2020, 1, 1, hour)


def feedback(spark, entries):
    return spark.createDataFrame(
        [("u", "a", tx, DAY, time, category) for tx, time, category in entries],
        "user_id string, account_id string, transaction_id string, date date, "
        "feedback_time timestamp, category string",
    )


def labels(spark, entries, user="u"):
    return spark.createDataFrame(
        [(user, "a", tx, DAY, at(1), label) for tx, label in entries],
        "user_id_hashed string, account_id_hashed string, transaction_id_hashed string, "
        "date date, feedback_time timestamp, transaction_label string",
    )


def test_latest_wins_and_missing_time_loses(spark):
    df = feedback(spark, [
        ("t1", at(1), "Rent"), ("t1", at(2), "Bills"), ("t2", None, "Rent"), ("t2", at(1), "Cash"),
        ("t3", at(1), "Cash"), ("t3", at(1), "Rent"), ("t4", None, "Pets"),
    ])
    found = {r.transaction_id: r.category for r in latest_feedback(df).collect()}
    assert found == {"t1": "Bills", "t2": "Cash", "t3": "Rent", "t4": "Pets"}


def test_union_drops_events_delivered_twice(spark):
    one = feedback(spark, [("t1", at(1), "Rent"), ("t1", at(1), "Rent")])
    two = feedback(spark, [("t1", at(1), "Rent"), ("t2", None, "Rent"), ("t2", None, "Rent")])
    assert union_feedback(one, two).count() == 2
    assert union_feedback(one, two, distinct=False).count() == 5
    assert rows(latest_feedback(union_feedback(one, two))) == rows(
        latest_feedback(union_feedback(one, two, distinct=False))
    )


def test_label_lists_keep_repetitions_and_conflicts_are_dropped(spark):
    df = labels(spark, [
        ("t1", "Salary"), ("t1", "Salary"), ("t2", "Salary"), ("t2", "Gym"),
        ("t3", "Energy"), ("t3", "Internet_mobile"), ("t4", "Gym"), ("t4", "Energy"), ("t5", None),
    ]).withColumn("country_code", F.lit(None).cast("string"))
    counted = without_conflicts(label_counts(df))
    lists = {
        r.transaction_id_hashed: r.labels
        for r in counted.withColumn("labels", label_list(F.col("label_counts"))).collect()
    }
    assert lists == {"t1": ["Salary", "Salary"], "t4": ["Energy", "Gym"], "t5": []}


def test_sampling_can_hide_a_conflict_unless_conflicts_come_first(spark):
    entries = [(f"t{i}", label) for i in range(200) for label in ("Salary", "Gym")]
    users = spark.createDataFrame([("u", "GB")], "user_id_hashed string, country_code string")
    df = labels(spark, entries)
    assert labels_per_transaction(df, users, 100).count() > 0
    assert labels_per_transaction(df, users, 100, conflicts_first=True).count() == 0


def test_a_hot_transaction_is_one_row_with_counts(spark):
    df = spark.range(30_000).selectExpr(
        "'u' AS user_id_hashed", "'a' AS account_id_hashed",
        "IF(id % 3 = 0, 'hot', concat('t', id)) AS transaction_id_hashed",
        "date'2020-01-01' AS date", "'Gym' AS transaction_label", "'GB' AS country_code",
    )
    hot = label_counts(df).where("transaction_id_hashed = 'hot'").collect()
    assert [(e["label"], e["copies"]) for e in hot[0].label_counts] == [("Gym", 10_000)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_both_ways_to_the_latest_feedback_agree(spark, kind):
    df = spark.range(3_000).selectExpr(
        "concat('u', id % 7) AS user_id", "IF(id % 11 = 0, null, 'a') AS account_id",
        "concat('t', id % 40) AS transaction_id", "date'2020-01-01' AS date",
        "CASE id % 5 WHEN 0 THEN null WHEN 1 THEN timestamp'0001-01-01 00:00:00' WHEN 2 THEN timestamp'9999-12-31 23:59:59.999999' "
        "ELSE timestamp_micros(id * 7919 % 13) END AS feedback_time",
        "CASE WHEN id % 13 = 0 THEN null ELSE concat('c', id * 31 % 17) END AS category",
    ).withColumn("feedback_time", F.col("feedback_time").cast(kind))
    quick = latest_feedback(df)
    assert quick.dtypes == latest_feedback(df, 0).dtypes
    shown = [F.col(c).cast("string") for c in quick.columns]  # Python has no years near 0 and 10000
    assert rows(quick.select(*shown)) == rows(latest_feedback(df, 0).select(*shown))
    assert quick.count() == df.select("user_id", "account_id", "transaction_id").distinct().count()
    assert latest_feedback(df.where("false")).count() == 0


def test_a_label_given_very_often_stays_one_entry(spark):
    counts = spark.createDataFrame(
        [([("Gym", 3_000_000_000), ("Rent", 1)],), ([("Gym", 2)],), ([],), (None,)],
        "label_counts array<struct<label:string,copies:bigint>>",
    )
    found = [r[0] for r in counts.select(label_runs(F.col("label_counts"))).collect()]
    assert found == ["Gym*3000000000,Rent", "Gym*2", "", None]
    lists = counts.select(label_list(F.col("label_counts")).alias("l"))
    with pytest.raises(Exception, match="too many labels"):
        lists.collect()
