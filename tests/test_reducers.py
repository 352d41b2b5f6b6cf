import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgertag.operators import reducers
from ledgertag.operators.reducers import KeySet, maybe_among, not_among


def frames(spark, n=2_000):
    large = spark.range(n).selectExpr("id", "concat('k', id % 700) AS k", "IF(id % 9 = 0, null, id % 5) AS j", "'x' AS other")
    keys = spark.createDataFrame(
        [(f"k{i}", i % 5) for i in range(0, 60)] + [("none", 1), (None, 2), ("k3", None), ("k1", 1), ("k1", 1)],
        "k string, j bigint",
    )
    return large, keys


@pytest.mark.parametrize("bits", [16, 1])
def test_no_partner_is_lost_and_most_others_go(spark, bits, monkeypatch):
    monkeypatch.setattr(reducers, "BITS_PER_KEY", bits)
    large, keys = frames(spark)
    among = KeySet(keys, ["k", "j"], large)
    kept = maybe_among(large, among)
    assert kept.columns == large.columns
    joined = large.join(keys.distinct(), ["k", "j"]).select(large.columns)
    assert rows(kept.join(keys.distinct(), ["k", "j"]).select(large.columns)) == rows(joined)
    assert joined.count() <= kept.count() < 400
    # The other part is exactly the rest.
    assert rows(kept.unionByName(not_among(large, among))) == rows(large)
    assert "Exchange hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()


def test_bits_beyond_the_bound_only_let_more_rows_pass(spark, monkeypatch):
    monkeypatch.setattr(reducers, "BLOCK_WORDS", 1)
    monkeypatch.setattr(reducers, "BLOCK_BITS", 64)
    monkeypatch.setattr(reducers, "MAX_BITS", 128)
    large, keys = frames(spark)
    among = KeySet(keys, ["k", "j"], large)
    assert among.bits == 128 and among.table.count() == 2
    kept = maybe_among(large, among)
    wanted = large.join(keys.distinct(), ["k", "j"], "left_semi").select(large.columns)
    assert wanted.exceptAll(kept).count() == 0 and kept.count() < 2_000


def test_either_of_two_sets(spark):
    large, _ = frames(spark)
    one = KeySet(spark.createDataFrame([("k5",)], "k string"), ["k"], large)
    two = KeySet(spark.createDataFrame([(17,)], "id bigint"), ["id"], large)
    found = {r.id for r in maybe_among(large, one, two).collect()}
    assert {5, 705, 1405, 17} <= found and len(found) < 300


def test_columns_of_another_type_are_not_compared(spark):
    large, _ = frames(spark)
    keys = spark.createDataFrame([("k5", "2")], "k string, j string")
    among = KeySet(keys, ["k", "j"], large)
    assert among.columns == ["k"]
    assert {5, 705, 1405} <= {r.id for r in maybe_among(large, among).collect()}
    only = KeySet(keys.select("j"), ["j"], large)
    assert only.table is None and maybe_among(large, only).count() == 2_000 and not_among(large, only).count() == 0


def test_empty_sets_and_tables(spark):
    large, keys = frames(spark)
    none = KeySet(keys.where("false"), ["k", "j"], large)
    assert maybe_among(large, none).count() == 0 and not_among(large, none).count() == 2_000
    assert maybe_among(large.where("false"), KeySet(keys, ["k", "j"], large)).count() == 0


def test_hot_key(spark):
    large = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    assert maybe_among(large, KeySet(spark.createDataFrame([(-1,)], "k bigint"), ["k"], large)).where("k = -1").count() == 3_334
