"""Example transactions with the labels a good model gives them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- Fixed values: id, description, amount, type, internal transaction, expected labels ---
GOLDEN_ROWS = [
    ("1111", "Salary payment wuhuuu", 250.0, "credit", "", ["Salary"]),
    ("1112", "Salary", 250.0, "debit", "", []),
    ("1113", "amount too low but still somehow salary", 10.0, "credit", "", ["Salary"]),
    ("1114", " amazon Refund", 10.0, "credit", "", ["Refund"]),
    ("1115", "Refund", 10.0, "debit", "", []),
    ("1116", "Salary refun but not really", 1500.0, "credit", "", ["Salary"]),
    ("1117", "Naam: Vattenfall Klantenservice", 100.0, "debit", "", ["Energy"]),
    ("1118", "EE & T-MOBILE", 21.0, "debit", "", ["Internet_mobile"]),
    ("1119", "NETFLIX.COM", 10.0, "debit", "", ["Video_streaming"]),
    ("1120", "Amazon Music", 10.0, "debit", "", ["Music_streaming"]),
    ("1121", "SPOTIFY UK", 10.0, "debit", "", ["Music_streaming"]),
    ("1122", "Classpass Monthly, Classpass.com", 15.0, "debit", "", ["Gym"]),
    ("1123", "amazon", 100.0, "credit", "", ["Bonus_money"]),
    ("1125", "WWW.SKYBET.COM", 100.0, "debit", "", []),
    ("1126", "WWW.SKYBET.COM", 100.0, "credit", "ABC", []),
]


def golden_rows(spark: SparkSession) -> DataFrame:
    """All examples are British and have no counterparty account."""
    rows = [(*row[:5], "GB", "", row[5]) for row in GOLDEN_ROWS]
    return spark.createDataFrame(
        rows,
        "unique_transaction_id string, description string, amount double, "
        "transaction_type string, internal_transaction string, country_code string, "
        "bank_counterparty_iban string, expected array<string>",
    )
