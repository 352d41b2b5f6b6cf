"""The jobs from files to files."""

import datetime as dt
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ledgertag.domain import LABELS, TRANSACTION_LABELS
from ledgertag.plans import training, training_set
from ledgertag.plans.model import LabelModel
from ledgertag.plans.training_set import TrainingSetConfig, labelled_rows
from ledgertag.sources.sinks import read_split
from ledgertag.sources.tables import TABLES, load_table, load_tables

SETTINGS = {
    "sample_start_date": "2017-01-01",
    "nl_sample_start_date": "2017-01-01",
    "sample_end_date": "2020-12-31",
    "n_labels_feedback_per_country_per_label": "100",
    "n_categories_feedback": "300",
    "n_validation_samples": "50",
    "n_test_samples": "50",
}
WORDS = {"Salary": "salary payment", "Gym": "classpass gym", "Energy": "vattenfall energy"}


def write_inputs(spark, folder):
    """Sixty users with ten transactions each, as CSV files and nested JSON events."""
    country = "CASE id % 4 WHEN 0 THEN 'GB' WHEN 1 THEN 'FR' WHEN 2 THEN 'IT' ELSE 'NL' END"
    users = spark.range(60).selectExpr("concat('h', id) AS user_id_hashed", f"{country} AS country_code")
    tests = spark.createDataFrame([("h3",), ("h4",)], "user_id_hashed string")
    accounts = spark.range(60).selectExpr(
        "concat('h', id) AS user_id_hashed", "concat('a', id) AS account_id_hashed",
        "IF(id % 10 = 9, true, null) AS deleted", "'b02fca30-65f6-470f-af1b-fbd5704abd56' AS site_id",
    )
    label = "element_at(array('Salary', 'Gym', 'Energy'), cast(id % 3 + 1 AS int))"
    text = f"element_at(map{tuple(x for pair in WORDS.items() for x in pair)}, {label})"
    transactions = spark.range(600).selectExpr(
        "concat('u', id div 10) AS user_id", "concat('p', id div 10) AS account_id",
        "concat('t', id) AS transaction_id", "date'2018-03-05' AS date", "1 AS pending",
        f"{text} AS description", "'' AS internal_transaction",
        "IF(id % 3 = 0, 'credit', 'debit') AS transaction_type", "cast(id AS decimal(18,2)) AS amount",
        "'c' AS cycle_id", "concat('h', id div 10) AS user_id_hashed",
        "concat('a', id div 10) AS account_id_hashed", "concat('x', id) AS transaction_id_hashed",
        "3 AS month", "2018 AS year",
    )
    time = "timestamp'2020-01-01 00:00:00' AS feedback_time"
    labels = transactions.selectExpr(
        "user_id_hashed", "account_id_hashed", "transaction_id_hashed", "date", "pending", time,
        f"element_at(array('Salary', 'Gym', 'Energy'), cast(int(amount) % 3 + 1 AS int)) AS transaction_label",
    )
    categories = transactions.where("amount % 2 = 0").selectExpr(
        "user_id", "account_id", "transaction_id", "date", "pending", time, "'Rent' AS category"
    )
    events = transactions.where("amount % 5 = 0").selectExpr(
        "struct(user_id AS userId, account_id AS accountId, transaction_id AS transactionId, "
        "date AS localDate, pending AS pendingType) AS id",
        "timestamp'2020-02-01 00:00:00' AS time", "struct('Bills' AS category) AS fact",
    )
    paths = {}

    def csv(name, df, suffix=""):
        path = f"{folder}/{name}"
        df.write.option("header", "true").csv(path)
        paths[name] = path + (suffix or "/*.csv")

    csv("users", users)
    csv("test_users", tests)
    csv("accounts", accounts)
    csv("transactions", transactions)
    csv("historical_categories_feedback", categories)
    csv("historical_labels_feedback", labels)
    for name in TABLES:
        if name.startswith("user_") and name.endswith("_categories"):
            events.write.json(f"{folder}/{name}.json")
            paths[name] = f"{folder}/{name}.json"
    return paths


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    return write_inputs(spark, str(tmp_path_factory.mktemp("inputs")))


@pytest.fixture(scope="module")
def output(spark, inputs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("output"))
    training_set.run(spark, inputs, TrainingSetConfig.from_text(SETTINGS), folder)
    return folder


def test_events_are_flattened(spark, inputs):
    events = load_table(spark, "user_single_feedback_created_categories",
                        inputs["user_single_feedback_created_categories"])
    assert events.columns == [
        "user_id", "account_id", "transaction_id", "date", "pending", "feedback_time", "category",
    ]
    first = events.where("transaction_id = 't5'").first()
    assert (first.user_id, first.date, first.category) == ("u0", dt.date(2018, 3, 5), "Bills")


def test_only_wanted_columns_are_read(spark, inputs):
    loaded = load_tables(spark, inputs)
    assert loaded["users"].columns == ["user_id_hashed", "country_code"]
    assert loaded["accounts"].where("deleted IS NOT NULL").count() == 6


def test_training_set_has_exact_splits_and_known_labels(spark, output):
    sets = spark.read.parquet(f"{output}/sets")
    ids = {
        r.split: r.n
        for r in sets.groupBy("split").agg(F.count_distinct("unique_transaction_id").alias("n")).collect()
    }
    assert ids["test"] == 50 and ids["validation"] == 50 and ids["train"] > 200
    # A transaction is in one set only, with all its labels.
    assert sets.groupBy("unique_transaction_id").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    known = {(r.target_label, r.target_label_int) for r in sets.select("target_label", "target_label_int").distinct().collect()}
    assert known <= set(zip(LABELS, range(39)))
    labels = {label for label, _ in known}
    assert {"Salary", "Gym", "Energy", "Rent", "Bills", "General"} == labels


def test_test_users_and_deleted_accounts_are_out(spark, inputs):
    config = TrainingSetConfig(
        dt.date(2017, 1, 1), dt.date(2017, 1, 1), dt.date(2020, 12, 31), None, None, 1, 1
    )
    tables = load_tables(spark, inputs)
    rows = labelled_rows(tables, replace(config, null_safe_ids=True))
    # 60 users, less one foreign test user and six deleted accounts, ten transactions each.
    assert rows.count() == 530
    assert rows.where("target_category = 'Bills'").count() == 106
    # CSV reads empty texts as missing, so by default the two sides of a transaction do not meet.
    with_category = rows.where("target_category <> 'General'").count()
    assert labelled_rows(tables, config).count() == 530 + with_category


def test_run_metadata(spark, output):
    lines = spark.read.text(f"{output}/metadata").collect()
    assert len(lines) == 1
    metadata = json.loads(lines[0].value)
    assert json.loads(metadata["config"])["n_test"] == 50
    sizes = metadata["train_data_size_per_country"]
    train = read_split(spark, f"{output}/sets", "train")
    assert sum(sizes.values()) == train.count()
    assert list(sizes) == sorted(sizes)


def test_training_job_and_saved_model(spark, output, tmp_path):
    golden = spark.createDataFrame(
        [("salary payment", 250.0, "credit", "", "GB", ["Salary"]), ("salary payment", 250.0, "debit", "", "GB", [])],
        "description string, amount double, transaction_type string, internal_transaction string, "
        "country_code string, expected array<string>",
    )
    performant = training.run(spark, f"{output}/sets", str(tmp_path), golden)
    assert performant is False  # labels without any example score zero
    report = spark.read.parquet(f"{tmp_path}/report")
    assert report.count() == 5 * 8
    metadata = json.loads(spark.read.text(f"{tmp_path}/metadata").first().value)
    assert metadata["missing_labels"]["test"] == sorted(set(TRANSACTION_LABELS) - set(WORDS))
    model = LabelModel.load(spark, f"{tmp_path}/model")
    found = [set(r.labels) for r in model.predict(golden, keep=["expected"]).collect()]
    assert found[0] == {"Salary"}
    assert "Salary" not in found[1]
    assert model.predict(golden).columns == ["labels"]
    assert model.predict(golden.where("false")).count() == 0


def test_no_split_when_too_few_rows(spark, inputs):
    config = TrainingSetConfig.from_text({**SETTINGS, "n_test_samples": "5000"})
    with pytest.raises(ValueError, match="wanted"):
        training_set.training_set(load_tables(spark, inputs), config)
