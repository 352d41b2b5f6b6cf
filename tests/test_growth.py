"""What is shuffled, stored and sent out must not grow faster than the part of the input that is needed."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgertag.catalogue import tables as t
from ledgertag.domain import HASHED_KEY
from ledgertag.operators import feedback, scoring
from ledgertag.operators.eligibility import eligible_transactions
from ledgertag.operators.reducers import KeySet, maybe_among
from ledgertag.operators.scoring import masked_mean, seen_tokens
from ledgertag.plans import model


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """As for tables beyond the broadcast limit."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def few_events(spark, tmp_path):
    """200 accounts of five lines each; events about the first three accounts."""
    spark.sql(
        "SELECT id AS o_orderkey, id % 7 AS o_custkey, 'O' AS o_orderstatus, '1-URGENT' AS o_orderpriority FROM range(200)"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql(
        """SELECT id div 5 AS l_orderkey, id % 11 AS l_partkey, id % 3 AS l_suppkey, CAST(id % 5 + 1 AS INT) AS l_linenumber,
        1.5 AS l_extendedprice, 'N' AS l_returnflag, 'O' AS l_linestatus, timestamp'1997-05-01' AS l_shipdate FROM range(1000)"""
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql(
        """SELECT id AS event_id, timestamp'2020-01-01' AS ts, 'click' AS event_type, 2.0 AS value,
        concat('{"k": ', id % 4, '}') AS props FROM range(24)"""
    ).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def below_first_exchange(text, table):
    """The operators between the scan of a table and the first shuffle above it."""
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and table in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    found = []
    for line in reversed(lines[:at]):
        own = len(line) - len(line.lstrip(" :+-"))
        if own < depth:
            if "Exchange hashpartitioning" in line:
                return found
            found.append(line)
            depth = own
    return found


def test_lines_without_events_go_before_the_shuffle(spark, few_events, no_broadcast):
    events = t.feedback_events(spark, few_events)
    assert any("BroadcastHashJoin" in line for line in below_first_exchange(plan(events), "l_linenumber"))
    found = events.select("event_id", "account_id", "cycle_id").collect()
    assert sorted((r.event_id, r.account_id, r.cycle_id) for r in found) == [(i, i // 8, i % 4 + 1) for i in range(24)]


def test_condition_on_one_side_of_a_join_reaches_its_scan(spark, few_events, no_broadcast):
    lines = t.transaction_lines(spark, few_events)
    wanted = lines.where("account_id IN (3, 77)").select("account_id", "transaction_id", "date")
    kept = maybe_among(lines, KeySet(wanted, wanted.columns, lines))
    assert any("BroadcastHashJoin" in line for line in below_first_exchange(plan(kept), "l_linenumber"))
    assert rows(kept.where("account_id IN (3, 77)")) == rows(lines.where("account_id IN (3, 77)"))
    assert kept.count() < 300


def test_rows_that_are_drawn_are_stored_first(spark, monkeypatch):
    stored = []
    keep = feedback.materialize
    monkeypatch.setattr(feedback, "materialize", lambda df: stored.append(df.columns) or keep(df))
    users = spark.sql("SELECT id AS user_id_hashed, 'GB' AS country_code FROM range(3)")
    given = spark.sql(
        """SELECT id % 3 AS user_id_hashed, id AS account_id_hashed, 't' AS transaction_id_hashed, date'2020-01-01' AS date,
        timestamp'2020-01-01' AS feedback_time, 'Gym' AS transaction_label FROM range(9)"""
    )
    assert feedback.labels_per_transaction(given, users, 100).count() == 9
    assert [*feedback.LABEL_COLUMNS, "country_code"] in stored


def test_token_vectors_beyond_the_vocabulary_are_not_sent(spark, monkeypatch):
    sent = []
    gather = scoring.gathered_mean_udf
    monkeypatch.setattr(scoring, "gathered_mean_udf", lambda ids, matrix: sent.append(len(ids)) or gather(ids, matrix))
    df = spark.createDataFrame([(1, [2, 3, 0]), (2, [0, 0, 0]), (3, [4, 2, 2]), (4, None)], "k int, token_ids array<int>")
    table = spark.range(-5, 5_000).select(
        F.col("id").cast("int").alias("token_id"), F.array(F.col("id") * 1.0, F.lit(1.0)).alias("vector")
    )
    found = masked_mean(df, table, "k", 2, vocabulary=5)
    whole = masked_mean(df, table, "k", 2)
    assert rows(found) == rows(whole) and sent == [4, 5_005]
    # Small enough only without the rest: still no join.
    small = masked_mean(df, table, "k", 2, max_bytes=100 * 24, vocabulary=5)
    assert rows(small) == rows(whole) and "Join" not in plan(small)


def test_texts_of_examples_are_tokenised_once(spark, monkeypatch):
    stored = []
    keep = model.materialize
    monkeypatch.setattr(model, "materialize", lambda df: stored.append(df.columns) or keep(df))
    monkeypatch.setattr(model, "seen_tokens", lambda df: seen.append(plan(df)) or seen_tokens(df))
    seen = []
    examples = spark.createDataFrame(
        [("gym abo", 1.0, "debit", "", "Gym"), ("salary may", 9.0, "credit", "", "Salary"), ("x", 2.0, "debit", "", None)],
        "description string, amount double, transaction_type string, internal_transaction string, target_label string",
    )
    fitted = model.LabelModel.fit(examples)
    assert ["target_label", "token_ids", "numeric_features"] in stored
    assert "md5" not in seen[0]
    assert sum(any(v) for v in fitted.matrix) == 2


def test_label_feedback_drops_other_lines_at_their_scan(spark, few_events, no_broadcast):
    """The condition names an account, which accounts and transactions both have."""
    lines = t.transaction_lines(spark, few_events)
    users = spark.sql("SELECT id AS user_id_hashed, 'GB' AS country_code, 0 AS test_user FROM range(7)")
    accounts = t.accounts(spark, few_events).drop("deleted")
    period = (dt.date(1996, 1, 1), dt.date(1996, 1, 1), dt.date(2000, 1, 1))
    base = eligible_transactions(users, accounts, lines, *period)
    wanted = lines.where("account_id IN (3, 77)").select(*HASHED_KEY)
    kept = maybe_among(base, KeySet(wanted, HASHED_KEY[1:], base))
    assert any("BroadcastHashJoin" in line for line in below_first_exchange(plan(kept), "l_linenumber"))
    assert base.count() == 1000 and kept.where("account_id IN (3, 77)").count() == 10 and kept.count() < 300
