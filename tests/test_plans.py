"""Plans: what is read, what is shuffled, and that nothing goes through one place."""

import datetime as dt

import pytest

from ledgertag.catalogue import tables as t
from ledgertag.domain import SIMILARITY_THRESHOLD
from ledgertag import session
from ledgertag.operators import copies, feedback, reducers, sampling
from ledgertag.operators.copies import collapse_copies, number_copies
from ledgertag.operators.eligibility import eligible_transactions, eligible_users, live_accounts
from ledgertag.operators.evaluate import metric_sums_by_group
from ledgertag.operators.feedback import label_counts, latest_feedback
from ledgertag.operators.features import AmountScale
from ledgertag.plans import training_set
from ledgertag.plans.model import VECTOR_SIZE, LabelModel

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def partitioned(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables") / "transactions")
    t.transactions(spark, SF_DIR).write.partitionBy("year", "month").parquet(path)
    return spark.read.parquet(path)


def test_period_prunes_folders_and_columns(spark, partitioned):
    base = eligible_transactions(
        eligible_users(t.users(spark, SF_DIR), t.test_users(spark, SF_DIR)),
        live_accounts(t.accounts(spark, SF_DIR)),
        partitioned, dt.date(1998, 3, 1), dt.date(1996, 2, 1), dt.date(2000, 12, 31), t.SITES,
    ).select("amount", "country_code")
    text = plan(base)
    scan = next(line for line in text.splitlines() if "FileScan" in line and "l_" not in line and "amount" in line)
    filters = scan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "year" in filters and "month" in filters
    assert "description" not in scan.split("ReadSchema")[1]
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_prediction_needs_no_shuffle(spark):
    model = LabelModel(AmountScale(0.0, 1.0), [[1.0] * VECTOR_SIZE] * 38)
    rows = spark.read.parquet(f"{SF_DIR}/part.parquet").selectExpr(
        "p_name AS description", "p_retailprice AS amount", "p_brand AS transaction_type",
        "p_type AS internal_transaction", "p_size",
    )
    text = plan(model.predict(rows, threshold=SIMILARITY_THRESHOLD))
    assert "Exchange" not in text
    assert text.count("ArrowEvalPython") == 1
    assert "p_size" not in text and "p_partkey" not in text


def test_feedback_is_reduced_before_the_shuffle(spark):
    feedback = t.feedback_events(spark, SF_DIR).selectExpr(
        "user_id", "account_id", "transaction_id", "date", "feedback_time", "event_type AS category"
    )
    text = plan(latest_feedback(feedback))
    assert "partial_max" in text and "Window" not in text
    labels = t.label_events(t.feedback_events(spark, SF_DIR)).selectExpr("*", "'GB' AS country_code")
    assert "partial_count" in plan(label_counts(labels))


def test_metrics_shuffle_partial_sums_only(spark):
    text = plan(metric_sums_by_group(t.judged_documents(spark, SF_DIR), ["quality", "toxic"]))
    assert "partial_sum" in text and "Window" not in text and "collect_list" not in text


def test_hot_user_is_split_in_the_join(spark):
    """One account holds a third of all transactions."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        owner = "IF(id % 3 = 0, '7', cast(id % 3000 AS string))"
        users = spark.range(3000).selectExpr("cast(id AS string) AS user_id_hashed", "'GB' AS country_code")
        accounts = users.selectExpr("user_id_hashed", "user_id_hashed AS account_id_hashed", "'x' AS site_id")
        transactions = spark.range(0, 60_000, 1, 8).selectExpr(
            f"{owner} AS user_id_hashed", f"{owner} AS account_id_hashed",
            "2018 AS year", "1 AS month", "md5(cast(id AS string)) AS description",
        )
        day = dt.date(2018, 1, 1)
        joined = eligible_transactions(users, accounts, transactions, day, day, day, ["x"])
        assert len(joined.collect()) == 60_000
        assert "skew=true" in plan(joined)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def test_equal_rows_are_counted_once_for_both_paths(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").select("event_type")
    counting = plan(collapse_copies(events))
    assert "partial_count" in counting and "Window" not in counting
    numbered = number_copies(events)
    assert numbered.count() == 1_000
    # The counts are stored, and what was counted is not read again.
    text = plan(numbered)
    assert "events.parquet" not in text and text.count("FileScan") == 1 and "Exchange" not in text


def test_latest_feedback_hashes_and_never_sorts(spark):
    events = t.feedback_events(spark, SF_DIR).selectExpr(
        "user_id", "account_id", "transaction_id", "date", "feedback_time", "event_type AS category"
    )
    text = plan(latest_feedback(events))
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text and "HashAggregate" in text


def test_draws_shuffle_and_store_no_wide_column(spark, monkeypatch):
    stored = []
    for module in (sampling, reducers, copies):
        keep = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, keep=keep: stored.append(df.columns) or keep(df))
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    once = lines.selectExpr("*", "monotonically_increasing_id() AS id")
    sample = sampling.sample_to_size(once, 500)
    assert 300 < sample.count() < 700
    assert "Exchange hashpartitioning" not in plan(sample)
    assert all(set(columns) <= {"_row_hash", "n", "block", "words"} for columns in stored)


def test_transactions_are_scanned_once_for_both_feedbacks(spark, partitioned, tmp_path, monkeypatch):
    path = str(tmp_path / "all_transactions")
    partitioned.write.partitionBy("year", "month").parquet(path)
    tables = t.pipeline_tables(spark, SF_DIR) | {"transactions": spark.read.parquet(path)}
    plans = []
    for module in (training_set, feedback, sampling, reducers, copies, session):
        if hasattr(module, "materialize"):
            keep = module.materialize
            monkeypatch.setattr(module, "materialize", lambda df, keep=keep: plans.append(plan(df)) or keep(df))
    plain = training_set.labelled_rows(tables, t.CONFIG)
    plans.append(plan(plain))
    # Of all tables read, only the transactions have folders to prune.
    scans = [line for text in plans for line in text.splitlines() if "FileScan" in line and "PartitionFilters: [isnotnull" in line]
    assert len(scans) == 1 and "cycle_id" not in scans[0]
    assert "year" in scans[0].split("PartitionFilters: [")[1].split("], PushedFilters")[0]
