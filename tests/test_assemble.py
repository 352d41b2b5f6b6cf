import datetime as dt

from conftest import rows
from ledgertag.operators.assemble import (
    ROW_ID,
    feedback_outer,
    long_targets,
    trainable_rows,
    wide_rows,
    with_row_id,
)

KEY = "user_id_hashed string, account_id_hashed string, transaction_id_hashed string, date date"
INPUTS = "description string, amount double, transaction_type string, internal_transaction string, country_code string"
DAY = dt.date(2020, 1, 1)


def side(spark, entries, column):
    return spark.createDataFrame(
        [("u", "a", tx, DAY, text, 1.5, "debit", "", "GB", extra) for tx, text, extra in entries],
        f"{KEY}, {INPUTS}, {column}",
    )


def both(spark):
    categories = side(
        spark, [("t1", "shop", "Rent"), ("t2", None, "Cash"), ("t3", "x", "Pets")],
        "target_category string",
    )
    labels = side(
        spark, [("t1", "shop", [("Gym", 2)]), ("t2", None, [("Energy", 1)]), ("t4", "y", [("Gym", 1)])],
        "label_counts array<struct<label: string, copies: bigint>>",
    )
    return categories, labels


def test_missing_description_keeps_both_sides_apart(spark):
    joined = feedback_outer(*both(spark))
    found = rows(joined.selectExpr("transaction_id_hashed", "description", "target_category", "size(label_counts)"))
    assert found == [
        ("t1", "shop", "Rent", 1), ("t2", "", "Cash", None), ("t2", "", "General", 1),
        ("t3", "x", "Pets", None), ("t4", "y", "General", 1),
    ]


def test_null_safe_join_compares_ids_only(spark):
    joined = feedback_outer(*both(spark), null_safe=True)
    found = rows(joined.selectExpr("transaction_id_hashed", "description", "target_category", "size(label_counts)"))
    assert found == [
        ("t1", "shop", "Rent", 1), ("t2", "", "Cash", 1), ("t3", "x", "Pets", None),
        ("t4", "y", "General", 1),
    ]


def test_copies_multiply_and_every_row_gets_its_own_id(spark):
    categories, labels = both(spark)
    wide = wide_rows(categories.union(categories), labels.union(labels).union(labels))
    assert wide.where("description = 'shop'").count() == 6
    assert wide.select(ROW_ID).distinct().count() == wide.count()
    again = wide_rows(categories.union(categories).repartition(5), labels.union(labels).union(labels))
    assert rows(wide.select(ROW_ID)) == rows(again.select(ROW_ID))


def test_row_ids_of_a_plain_frame(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", "")], "x string, y string")
    assert with_row_id(df).select(ROW_ID).distinct().count() == 3


def test_long_form_repeats_labels_and_numbers_known_ones(spark):
    categories = side(spark, [("t1", "shop", "Rent"), ("t3", "x", "Odd")], "target_category string")
    labels = side(
        spark, [("t1", "shop", [("Gym", 2), ("Salary", 1)]), ("t5", "z", [])],
        "label_counts array<struct<label: string, copies: bigint>>",
    )
    wide = wide_rows(categories, labels)
    found = rows(long_targets(wide).select("description", "target_label", "target_label_int"))
    assert found == [
        ("shop", "Gym", 36), ("shop", "Gym", 36), ("shop", "Rent", 24), ("shop", "Salary", 30),
        ("x", "Odd", None), ("z", "General", 38),
    ]
    assert long_targets(wide, distinct=True).count() == 5


def test_missing_label_is_not_an_excluded_one(spark):
    df = spark.createDataFrame([("General",), (None,), ("Gym",)], "target_label string")
    assert rows(trainable_rows(df)) == [("Gym",), (None,)]
