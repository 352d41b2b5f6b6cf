import pyarrow as pa
from pyspark.sql import functions as F

from ledgertag.functions.text import token_ids, token_ids_expression
from ledgertag.functions.token_batches import batch_token_ids
from ledgertag.operators.features import AmountScale, with_features


def test_batched_token_ids_are_those_of_the_expression(spark):
    """Odd texts, limits of tokens and ids, and batches that begin inside a buffer."""
    words = " ".join(f"w{i % 9}x" for i in range(29))
    texts = [
        None, "", " ", "Red WIDGET 12 Brand#3", "12", "1", "a1b22c3", "9", "8 7", "é1ü2", "2024-12-24 Café", "a!!12!!b",
        "tail1", "2head", "x\ty\nz", "٠١ a", "İstanbul K", words, f"{words} a", f"{words} a ", f"{words} a  b!!77 c ",
        f" {words}  {words}", "q" * 400, "x " * 200, "a 1 22 333 b4 55c", "\U0001f600 ok",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for length, buckets in ((60, 600_000), (6, 50), (2, 10), (7, 5)):
            both = df.select(
                "text", token_ids(F.col("text"), length, buckets).alias("batched"),
                token_ids_expression(F.col("text"), length, buckets).alias("expression"),
            )
            for row in both.collect():
                assert row["batched"] == row["expression"], (length, row["text"])
        assert df.where("k < 0").select(token_ids(F.col("text"))).collect() == []
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    whole = pa.array(["zz"] + texts)
    assert batch_token_ids(whole.slice(1), 60, 99).to_pylist() == batch_token_ids(
        pa.array(texts), 60, 99
    ).to_pylist()


def test_features_need_no_interpreted_lambdas(spark):
    """Nested SQL lambdas took most of the time of scoring."""
    df = spark.createDataFrame([("Gym abo", 1.0, "debit", "")], "description string, amount double, transaction_type string, internal_transaction string")
    found = with_features(df, AmountScale(0.0, 2.0)).select("token_ids")
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in text and "regexp_replace" not in text
    assert found.first()[0] == df.select(token_ids_expression(F.col("description"))).first()[0]
