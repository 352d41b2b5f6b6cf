"""Which users, accounts and transactions take part."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertag.domain import NL_SITE_IDS


def eligible_users(users: DataFrame, test_users: DataFrame) -> DataFrame:
    """All users but the test users outside the Netherlands.

    A test user without a country is dropped: the comparison with NL is unknown, and so is
    its negation.
    """
    flags = test_users.select("user_id_hashed").dropDuplicates().withColumn("test_user", F.lit(1))
    foreign_test_user = (F.col("country_code") != "NL") & (F.col("test_user") == 1)
    return (
        users.join(flags, "user_id_hashed", "left")
        .fillna(0, subset=["test_user"])
        .where(~foreign_test_user)
    )


def live_accounts(accounts: DataFrame) -> DataFrame:
    """Accounts without any deletion mark; ``deleted = false`` is a mark, too."""
    return accounts.where(F.col("deleted").isNull())


def _since(first: dt.date, end: dt.date, mode: str) -> Column:
    if mode not in ("compat", "range"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "range":
        return F.col("date").between(F.lit(first), F.lit(end))
    return (
        (F.col("year") >= first.year)
        & (F.col("month") >= first.month)
        & (F.col("year") <= end.year)
    )


def period_filter(
    start: dt.date, nl_start: dt.date, end: dt.date, mode: str = "compat"
) -> Column:
    """The date condition, with an own start for Dutch users.

    ``compat`` compares year and month each on its own (so a start in March drops every
    January) and ignores the month of the end; ``range`` is a true range of dates. Rows
    without a country fail either.
    """
    dutch = F.col("country_code") == "NL"
    return (~dutch & _since(start, end, mode)) | (dutch & _since(nl_start, end, mode))


def any_period(
    start: dt.date, nl_start: dt.date, end: dt.date, mode: str = "compat"
) -> Column:
    """What every row within the period fulfils, whatever its country: transaction columns only."""
    return _since(start, end, mode) | _since(nl_start, end, mode)


def site_filter(site_ids: list[str]) -> Column:
    """Dutch users need an account on a listed site; other users may be on any."""
    return ~((F.col("country_code") == "NL") & ~F.col("site_id").isin(site_ids))


def eligible_transactions(
    users: DataFrame,
    accounts: DataFrame,
    transactions: DataFrame,
    start: dt.date,
    nl_start: dt.date,
    end: dt.date,
    nl_site_ids: list[str] = NL_SITE_IDS,
    mode: str = "compat",
) -> DataFrame:
    """Transactions of eligible users on live accounts, within the period.

    The site condition is tested on the accounts, before transactions are joined. The parts
    of the period condition that name only transaction columns reach their scan, where
    ``year`` and ``month`` prune folders. The ids are those of the transactions, so a later
    condition on all key columns reaches that scan, too.
    """
    keys = ["user_id_hashed", "account_id_hashed"]
    owned = users.join(accounts, "user_id_hashed", "inner").where(site_filter(nl_site_ids))
    rows = transactions.join(owned, keys, "inner").where(period_filter(start, nl_start, end, mode))
    return rows.select(*dict.fromkeys([*keys, *owned.columns, *transactions.columns]))
