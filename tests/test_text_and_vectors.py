import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from __spark_entry__ import queries
from ledgertag.functions.text import clean_text, labels_in_text, split_tokens, token_ids
from ledgertag.functions.vectors import text_vector_udf, token_vector
from ledgertag.operators.features import AmountScale, align_inputs, length_histogram, with_features
from ledgertag.operators.scoring import (
    fit_label_vectors,
    label_matrix,
    masked_mean,
    row_triplet_loss,
    with_similarities,
    with_transaction_vector,
)


def one(df):
    return df.first()[0]


def text(spark, value):
    return spark.createDataFrame([(value,)], "t string")


def test_cleaning_keeps_single_digits(spark):
    df = text(spark, "Avro-Energy 12 5é X9")
    assert one(df.select(clean_text(F.col("t")))) == "avro energy   5 x9"


def test_last_token_holds_the_rest(spark):
    words = [f"w{chr(97 + i % 26)}" for i in range(40)]
    df = text(spark, " " + "  ".join(words) + " ")
    tokens = one(df.select(split_tokens(F.col("t"))))
    assert len(tokens) == 30
    assert tokens[:29] == words[:29]
    assert tokens[29] == "  ".join(words[29:]) + " "
    for n in (0, 1, 28, 29, 30):
        assert len(one(text(spark, " ".join(words[:n])).select(split_tokens(F.col("t"))))) == n


def test_seven_ids_for_four_tokens(spark):
    ids = one(text(spark, "Avro Energy Energy 5").select(token_ids(F.col("t"))))
    assert len(ids) == 60
    assert sum(i != 0 for i in ids) == 7
    assert len(set(ids)) == 7
    assert one(text(spark, "").select(token_ids(F.col("t")))) == [0] * 60


def test_labels_in_text(spark):
    df = text(spark, "x:Test_music_streaming, Test_gym Test_gym")
    assert one(df.select(labels_in_text(F.col("t")))) == ["Test_music_streaming", "Test_gym"]


def model_input(spark):
    return spark.createDataFrame(
        [("Avro Energy Energy 5", 4000.0, "12341id", "debit"), (None, None, None, None)],
        "description string, amount double, internal_transaction string, transaction_type string",
    )


def test_numeric_features_and_undefined_scale(spark):
    found = with_features(model_input(spark), AmountScale(0.0, 8000.0)).collect()
    assert found[0].numeric_features == [0.5, 1.0, 1.0]
    assert found[1].numeric_features == [0.0, 0.0, 0.0]
    same = AmountScale.fit(model_input(spark))
    assert (same.low, same.high) == (4000.0, 4000.0)
    flat = with_transaction_vector(with_features(model_input(spark), same))
    assert [r.scaled_amount for r in flat.collect()] == [None, None]
    assert [r.vector for r in flat.collect()] == [None, None]


def test_missing_columns_get_defaults(spark):
    found = align_inputs(spark.createDataFrame([(1,)], "x int")).first()
    assert (found.description, found.amount, found.transaction_type) == ("", 0.0, "")
    assert align_inputs(spark.createDataFrame([], "x int")).count() == 0


def test_masked_mean_ignores_padding(spark):
    df = spark.createDataFrame(
        [(1, [0, 0, 0, 0]), (2, [32, 0, 0, 0]), (3, [32, 32, 0, 0]), (4, [32, 5, 99, 0])],
        "k int, token_ids array<int>",
    )
    table = spark.createDataFrame([(32, [1.0, 2.0]), (5, [3.0, -2.0])], "token_id int, vector array<double>")
    found = {r.k: r.vector for r in masked_mean(df, table, "k", 2).collect()}
    assert found == {1: [0.0, 0.0], 2: [1.0, 2.0], 3: [1.0, 2.0], 4: [2.0, 0.0]}


def test_batch_and_column_token_vectors_agree(spark):
    df = spark.createDataFrame([(1, [7, 0]), (2, [599_999, 7]), (3, [0, 0])], "k int, token_ids array<int>")
    table = spark.createDataFrame([(7,), (599_999,)], "token_id int").withColumn(
        "vector", token_vector(F.col("token_id"))
    )
    looked_up = {r.k: r.vector for r in masked_mean(df, table, "k").collect()}
    computed = {r.k: r.v for r in df.select("k", text_vector_udf()("token_ids").alias("v")).collect()}
    assert looked_up == computed
    assert set(looked_up[1]) == {-1.0, 1.0}
    assert looked_up[3] == [0.0] * 32


def test_label_vectors_and_similarities(spark):
    df = spark.createDataFrame(
        [("a", [2.0, 0.0]), ("a", [0.0, 5.0]), ("b", [0.0, -1.0]), (None, [1.0, 1.0]), ("b", None)],
        "label string, vector array<double>",
    )
    matrix = label_matrix(fit_label_vectors(df, "label", size=2), "label", ["a", "b", "c"], 2)
    assert np.allclose(matrix, [[math.sqrt(0.5)] * 2, [0.0, -1.0], [0.0, 0.0]])
    scored = with_similarities(
        spark.createDataFrame([([3.0, 3.0],), ([0.0, 0.0],), (None,)], "vector array<double>"), matrix
    )
    found = [r.similarities for r in scored.collect()]
    assert np.allclose(found[0], [1.0, -math.sqrt(0.5), 0.0])
    assert found[1] == [0.0, 0.0, 0.0]
    assert found[2] is None


def test_triplet_loss_by_hand(spark):
    df = spark.createDataFrame(
        [([0.5, 0.45, 0.9, -0.2], 0), ([0.9, 0.1, 0.2, 0.3], 0), ([0.1, 0.5, 0.6, 0.7], 0)],
        "s array<double>, y int",
    )
    found = [r[0] for r in df.select(row_triplet_loss(F.col("s"), F.col("y"))).collect()]
    # Closest below; far below; all above: the smallest of them counts.
    assert np.allclose(found, [0.05, 0.0, 0.5])


def test_length_histogram(spark):
    lengths = [0, 9, 10, 249, 250, 251, 999]
    df = spark.createDataFrame([("x" * n,) for n in lengths] + [(None,)], "description string")
    found = {r.bin: r.share for r in length_histogram(df).collect()}
    assert len(found) == 25
    assert {b: s for b, s in found.items() if s} == {10: 2 / 8, 20: 1 / 8, 250: 2 / 8}


@given(
    st.lists(st.one_of(st.none(), st.lists(st.one_of(st.none(), st.integers(0, 12)), max_size=6)), max_size=8),
    st.lists(st.tuples(st.integers(1, 10), st.lists(st.integers(-4, 4), min_size=3, max_size=3)), max_size=8, unique_by=lambda x: x[0]),
)
@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_gather_and_join_give_the_same_means(spark, texts, vectors):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, token_ids array<int>")
    table = spark.createDataFrame([(t, [float(x) for x in v]) for t, v in vectors], "token_id int, vector array<float>")
    gathered, joined = masked_mean(df, table, "k", 3), masked_mean(df, table, "k", 3, max_bytes=-1)
    found, wanted = ({r.k: r.vector for r in means.collect()} for means in (gathered, joined))
    assert found.keys() == wanted.keys() and all(found[k] == pytest.approx(wanted[k]) for k in found)
    text = gathered._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Join" not in text


@pytest.mark.parametrize("table", [[(1, [1.0]), (1, [3.0])], [(1, [1.0]), (2, None)], [(1, [1.0]), (2, [None])]])
def test_odd_tables_are_joined(spark, table):
    df = spark.createDataFrame([(1, [1, 2])], "k int, token_ids array<int>")
    found = masked_mean(df, spark.createDataFrame(table, "token_id int, vector array<double>"), "k", 1)
    assert "Join" in found._jdf.queryExecution().executedPlan().toString()
    assert found.first().vector == [sum(v[0] for _, v in table if v and v[0]) / sum(1 for _, v in table if v and v[0])]


def test_a_vector_of_another_length_raises(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "label int, vector array<double>")
    assert [r.similarities for r in with_similarities(df, [[1.0, 0.0]]).orderBy("label").collect()] == [[1.0], None]
    assert fit_label_vectors(df, "label", size=2).count() == 1
    for scored in (with_similarities(df, [[1.0, 0.0, 0.0]]), fit_label_vectors(df, "label", size=3)):
        with pytest.raises(Exception, match="2 components instead of 3"):
            scored.collect()


def test_labels_and_size_come_from_the_table(spark, tmp_path):
    rows = [(i, [float(i % 3 == 0), float(i % 3 == 1), float(i % 3 == 2)], (0, 4, 10)[i % 3]) for i in range(12)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries()["similarity"](spark, str(tmp_path)).collect()
    assert {r.label for r in found} == {0, 4, 10} and len(found) == 36
    assert {r.similarity for r in found if r.label == rows[r.vec_id][2]} == {1.0}
    assert queries()["ranking_metrics"](spark, str(tmp_path)).first().mean_reciprocal_rank == 1.0
    assert all(r.reciprocal_rank == 1.0 for r in queries()["mrr"](spark, str(tmp_path)).collect())
    assert queries()["triplet_loss"](spark, str(tmp_path)).first().triplet_loss == 0.0
    frame.unionByName(spark.createDataFrame([(99, [1.0], 4)], frame.schema)).write.parquet(f"{tmp_path}/odd/embeddings.parquet")
    with pytest.raises(Exception, match="1 components instead of 3"):
        queries()["similarity"](spark, f"{tmp_path}/odd").collect()
