import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgertag.operators import copies
from ledgertag.operators.copies import number_copies, repeat_rows
from ledgertag.operators.sampling import (
    _shares,
    sample_per_stratum,
    sample_to_size,
    split_by_class,
)


def test_small_frames_are_kept_whole(spark):
    df = spark.range(50)
    assert sample_to_size(df, 50).count() == 50
    assert sample_to_size(df.where("id < 0"), 50).count() == 0


def test_sample_size_and_independence_of_partitioning(spark):
    df = spark.range(20_000)
    for key in (None, ["id"]):
        one = rows(sample_to_size(df.repartition(1), 5_000, key))
        many = rows(sample_to_size(df.repartition(16), 5_000, key))
        assert one == many
        assert abs(len(one) - 5_000) < 300


def test_equal_rows_are_drawn_each_on_their_own(spark):
    """A third of all rows are copies of one; about half of them stay."""
    df = spark.range(9_000).selectExpr("IF(id % 3 = 0, -1, id) AS id")
    sample = sample_to_size(df, 4_500)
    assert abs(sample.where("id = -1").count() - 1_500) < 150


def test_strata_have_their_own_ratio_and_nulls_are_a_stratum(spark):
    df = spark.range(9_000).selectExpr(
        "id", "CASE id % 3 WHEN 0 THEN 'GB' WHEN 1 THEN 'NL' END AS country",
        "IF(id < 300, 'rare', 'common') AS label",
    )
    sample = sample_per_stratum(df, 500, ["country", "label"], "id")
    sizes = {(r.country, r.label): r["count"] for r in sample.groupBy("country", "label").count().collect()}
    assert len(sizes) == 6
    for (_, label), size in sizes.items():
        assert size == 100 if label == "rare" else abs(size - 500) < 100
    again = sample_per_stratum(df.repartition(16), 500, ["country", "label"], "id", key=["id"])
    assert again.groupBy("country").count().count() == 3


def test_copies_are_numbered_also_when_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(copies, "PIECE", 7)
    df = spark.createDataFrame([("a", 1), ("b", 7), ("c", 8), ("d", 30)], "k string, n bigint")
    found = repeat_rows(df, "n", "no").groupBy("k").agg(
        F.count("*"), F.count_distinct("no"), F.min("no"), F.max("no")
    )
    assert rows(found) == [("a", 1, 1, 1, 1), ("b", 7, 7, 1, 7), ("c", 8, 8, 1, 8), ("d", 30, 30, 1, 30)]
    doubled = number_copies(spark.createDataFrame([(1, None), (1, None), (2, 1)], "a int, b int"))
    assert rows(doubled) == [(1, None, 1), (1, None, 2), (2, 1, 1)]


def split_frame(spark, n=3_000):
    """A third of the rows are in one class, and one class has no name."""
    return spark.range(n).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('c', id % 5) END AS class_name"
    )


@pytest.mark.parametrize("n_validation, n_test", [(100, 333), (0, 1), (1, 0), (1_000, 2_000)])
def test_split_totals_are_exact_and_proportional(spark, n_validation, n_test):
    df = split_frame(spark)
    split = split_by_class(df, n_validation, n_test, "class_name", "id")
    sizes = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    assert sizes.get("test", 0) == n_test
    assert sizes.get("validation", 0) == n_validation
    assert split.select("id").distinct().count() == 3_000
    share = {r.class_name: r["count"] / 3_000 for r in df.groupBy("class_name").count().collect()}
    for r in split.where("split = 'test'").groupBy("class_name").count().collect():
        assert abs(r["count"] - n_test * share[r.class_name]) <= 1


def test_split_does_not_depend_on_partitioning(spark):
    one = split_by_class(split_frame(spark).repartition(1), 50, 70, "class_name", "id")
    many = split_by_class(split_frame(spark).repartition(16), 50, 70, "class_name", "id")
    assert rows(one) == rows(many)


def test_split_refuses_impossible_totals(spark):
    df = split_frame(spark, 20)
    with pytest.raises(ValueError, match="wanted"):
        split_by_class(df, 15, 6, "class_name", "id")
    with pytest.raises(ValueError, match="classes"):
        split_by_class(df, 2, 2, "class_name", "id", strict=True)


def test_a_cut_in_a_large_prefix_is_looked_for_with_longer_ones(spark):
    df = split_frame(spark)
    whole = split_by_class(df, 100, 333, "class_name", "id")
    fine = split_by_class(df, 100, 333, "class_name", "id", rows_per_cut=0)
    assert rows(whole) == rows(fine)


def test_split_refuses_repeated_keys_at_a_cut(spark):
    df = spark.range(100).selectExpr("id % 2 AS id", "'a' AS class_name")
    with pytest.raises(ValueError, match="unique"):
        split_by_class(df, 0, 10, "class_name", "id")


def test_quotas_of_large_classes_do_not_overflow(spark):
    sizes = spark.createDataFrame([("a", 10**11), ("b", 3 * 10**11)], "class string, size long")
    found = rows(_shares(sizes, "size", 10**8, "quota").select("class", "quota"))
    assert found == [("a", 25_000_000), ("b", 75_000_000)]
