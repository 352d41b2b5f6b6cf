import datetime as dt

from conftest import rows
from ledgertag.operators.eligibility import (
    eligible_transactions,
    eligible_users,
    live_accounts,
    period_filter,
)

DAY = dt.date(2018, 6, 1)


def test_test_users_stay_only_in_the_netherlands(spark):
    users = spark.createDataFrame(
        [("gb", "GB"), ("gb_test", "GB"), ("nl_test", "NL"), ("none", None), ("none_test", None)],
        "user_id_hashed string, country_code string",
    )
    # A user listed twice must not be doubled.
    listed = [("gb_test",), ("nl_test",), ("nl_test",), ("none_test",)]
    tests = spark.createDataFrame(listed, "user_id_hashed string")
    assert rows(eligible_users(users, tests)) == [
        ("gb", "GB", 0), ("nl_test", "NL", 1), ("none", None, 0),
    ]


def test_any_deletion_mark_counts(spark):
    accounts = spark.createDataFrame(
        [("a", None), ("b", False), ("c", True)], "account_id_hashed string, deleted boolean"
    )
    assert rows(live_accounts(accounts)) == [("a", None)]


def dated(spark, days, countries=("GB",)):
    return spark.createDataFrame(
        [(c, d, d.year, d.month) for c in countries for d in days],
        "country_code string, date date, year int, month int",
    )


def test_compat_period_compares_year_and_month_apart(spark):
    days = [dt.date(2018, 1, 9), dt.date(2018, 3, 9), dt.date(2019, 1, 9), dt.date(2020, 12, 31)]
    df = dated(spark, days)
    start, end = dt.date(2018, 2, 1), dt.date(2020, 3, 1)
    kept = [r.date for r in df.where(period_filter(start, start, end)).collect()]
    assert kept == [days[1], days[3]]
    kept = [r.date for r in df.where(period_filter(start, start, end, "range")).collect()]
    assert kept == [days[1], days[2]]


def test_period_of_dutch_users_and_of_unknown_countries(spark):
    df = dated(spark, [DAY], ["GB", "NL", None])
    late, early, end = dt.date(2019, 1, 1), dt.date(2018, 1, 1), dt.date(2020, 12, 31)
    for mode in ("compat", "range"):
        kept = df.where(period_filter(late, early, end, mode))
        assert [r.country_code for r in kept.collect()] == ["NL"]


def test_site_list_concerns_dutch_users_only(spark):
    users = spark.createDataFrame(
        [(c, c) for c in ("GB", "NL")], "user_id_hashed string, country_code string"
    )
    accounts = spark.createDataFrame(
        [(u, f"{u}-{s}", s) for u in ("GB", "NL") for s in ("good", "bad", None)],
        "user_id_hashed string, account_id_hashed string, site_id string",
    )
    transactions = accounts.selectExpr(
        "user_id_hashed", "account_id_hashed", "date'2018-06-01' AS date",
        "2018 AS year", "6 AS month",
    )
    kept = eligible_transactions(
        users, accounts, transactions, dt.date(2018, 1, 1), dt.date(2018, 1, 1),
        dt.date(2018, 12, 31), ["good"],
    )
    assert sorted(r.account_id_hashed for r in kept.collect()) == [
        "GB-None", "GB-bad", "GB-good", "NL-good",
    ]
