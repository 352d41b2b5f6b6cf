"""The pipeline's concepts on the provided tables, as frames and as SQL common table expressions.

Customers are users, orders are accounts, line items are transactions. An event is feedback on
one line of the order whose key is its number divided by eight.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertag.domain import (
    CATEGORY_LABELS,
    HASHED_KEY,
    LABELS,
    MODEL_INPUTS,
    PLAIN_KEY,
    TRANSACTION_LABELS,
)
from ledgertag.operators.reducers import KeySet, maybe_among
from ledgertag.plans.training_set import TrainingSetConfig
from ledgertag.session import materialize
from ledgertag.sources.tables import TABLES

SITES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
CONFIG = TrainingSetConfig(
    start=dt.date(1996, 3, 1),
    nl_start=dt.date(1995, 6, 1),
    end=dt.date(2000, 12, 31),
    n_labels_feedback=40,
    n_categories_feedback=120,
    n_validation=5,
    n_test=8,
    nl_site_ids=SITES,
)
LABEL_EVENT_TYPES = ["error", "signup", "click"]
CATEGORY_EVENT_TYPES = {
    "historical_categories_feedback": "view",
    "user_single_feedback_created_categories": "click",
    "user_multiple_feedback_created_categories": "purchase",
    "user_multiple_feedback_applied_categories": "signup",
}
COUNTRY_OF_LANGUAGE = {"en": "GB", "fr": "FR", "es": "IT", "de": "NL"}

COUNTRY_SQL = (
    "CASE c_nationkey % 5 WHEN 0 THEN 'GB' WHEN 1 THEN 'FR' WHEN 2 THEN 'IT' "
    "WHEN 3 THEN 'NL' END"
)
DELETED_SQL = "CASE o_orderstatus WHEN 'F' THEN true WHEN 'P' THEN false END"
DESCRIPTION_SQL = (
    "CASE WHEN p_name <> 'red widget' THEN concat_ws(' ', p_name, p_type, p_brand) END"
)
INTERNAL_SQL = (
    "CASE WHEN l_linestatus = 'O' THEN '' WHEN l_linenumber < 7 "
    "THEN concat('own-', l_suppkey) END"
)
TYPE_SQL = "CASE WHEN l_returnflag = 'R' THEN 'credit' ELSE 'debit' END"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id_hashed"), F.expr(COUNTRY_SQL).alias("country_code")
    )


def test_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    machinery = read(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "MACHINERY")
    return machinery.select(F.col("c_custkey").alias("user_id_hashed"))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_id_hashed"),
        F.col("o_orderkey").alias("account_id_hashed"),
        F.expr(DELETED_SQL).alias("deleted"),
        F.expr("nullif(o_orderpriority, '5-LOW')").alias("site_id"),
    )


def transaction_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All transaction columns but the description, which needs the parts."""
    lines = read(spark, sf_dir, "lineitem")
    owners = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    day = F.to_date("l_shipdate")
    number = F.concat_ws(
        "-", *[F.col(c).cast("string") for c in ("l_linenumber", "l_partkey", "l_suppkey")]
    )
    return lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_orderkey").alias("account_id"),
        number.alias("transaction_id"),
        day.alias("date"),
        F.when(F.col("l_returnflag") == "N", 2).otherwise(1).alias("pending"),
        F.expr(INTERNAL_SQL).alias("internal_transaction"),
        F.expr(TYPE_SQL).alias("transaction_type"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_linenumber").alias("cycle_id"),
        F.col("o_custkey").alias("user_id_hashed"),
        F.col("l_orderkey").alias("account_id_hashed"),
        number.alias("transaction_id_hashed"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        "l_partkey",
    )


def with_description(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    parts = read(spark, sf_dir, "part").select(
        "p_partkey", F.expr(DESCRIPTION_SQL).alias("description")
    )
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left").drop(
        "l_partkey", "p_partkey"
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_description(spark, sf_dir, transaction_lines(spark, sf_dir))
    return rows.select(*TABLES["transactions"].columns)


def event_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        "event_id", "ts", "event_type", "value",
        F.from_json("props", "k int")["k"].alias("k"),
    )


def _pick(names: list[str], position: Column) -> Column:
    return F.get(F.lit(names), position.cast("int"))


def feedback_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the transaction they are about.

    Lines of accounts without any event are dropped while they are scanned.
    """
    about = (F.col("account_id") == F.expr("event_id div 8")) & (
        F.col("cycle_id") == F.col("k") % 4 + 1
    )
    events = event_fields(spark, sf_dir).withColumn(
        "feedback_time", F.when(F.col("value") >= 1, F.col("ts"))
    )
    lines = transaction_lines(spark, sf_dir)
    named = events.select(F.expr("event_id div 8").alias("account_id")).distinct()
    return events.join(maybe_among(lines, KeySet(named, ["account_id"], lines)), about)


def category_of(k: Column) -> Column:
    return F.get(F.lit(CATEGORY_LABELS), k % len(CATEGORY_LABELS))


def label_of(k: Column) -> Column:
    return F.get(F.lit(TRANSACTION_LABELS), (F.floor(k / 4) % len(TRANSACTION_LABELS)).cast("int"))


def kept_feedback_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feedback events for callers that make several tables out of them: computed once."""
    return materialize(
        feedback_events(spark, sf_dir).select(
            *PLAIN_KEY, *HASHED_KEY[:3], "pending", "feedback_time", "event_type", "k"
        )
    )


def category_tables(events: DataFrame) -> dict[str, DataFrame]:
    rows = events.select(
        *PLAIN_KEY, "pending", "feedback_time", "event_type",
        category_of(F.col("k")).alias("category"),
    )
    return {
        table: rows.where(F.col("event_type") == kind).drop("event_type")
        for table, kind in CATEGORY_EVENT_TYPES.items()
    }


def label_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type").isin(LABEL_EVENT_TYPES)).select(
        *HASHED_KEY, "pending", "feedback_time", label_of(F.col("k")).alias("transaction_label")
    )


def pipeline_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    events = kept_feedback_events(spark, sf_dir)
    return {
        "users": users(spark, sf_dir),
        "test_users": test_users(spark, sf_dir),
        "accounts": accounts(spark, sf_dir),
        "transactions": transactions(spark, sf_dir),
        "historical_labels_feedback": label_events(events),
        **category_tables(events),
    }


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feedback event with its transaction: rows to fit label vectors on."""
    kind = F.col("event_type")
    targets = F.array_compact(F.array(
        F.when(kind.isin(list(CATEGORY_EVENT_TYPES.values())), category_of(F.col("k"))),
        F.when(kind.isin(LABEL_EVENT_TYPES), label_of(F.col("k"))),
    ))
    rows = with_description(spark, sf_dir, feedback_events(spark, sf_dir))
    return rows.select(*MODEL_INPUTS, F.explode(targets).alias("target_label"))


def judged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with two true flags and two guessed ones; unlabelled documents have no flag."""
    labels = read(spark, sf_dir, "labels")
    return (
        read(spark, sf_dir, "documents")
        .join(labels, "doc_id", "left")
        .select(
            "doc_id",
            F.array(*[F.coalesce(F.col(c), F.lit(0)) for c in ("quality", "toxic")])
            .alias("target_label"),
            F.array(
                (F.col("n_chars") >= 500).cast("int"),
                F.col("text").rlike(r"\d{3,}").cast("int"),
            ).alias("predicted"),
            F.expr(
                "CASE lang WHEN 'en' THEN 'GB' WHEN 'fr' THEN 'FR' WHEN 'es' THEN 'IT' "
                "WHEN 'de' THEN 'NL' END"
            ).alias("country_code"),
        )
    )


# --- the same in SQL ----------------------------------------------------------------------


def sql_list(names: list) -> str:
    return "[" + ", ".join(f"'{n}'" if isinstance(n, str) else str(n) for n in names) + "]"


def sql_in(names: list[str]) -> str:
    return ", ".join(f"'{n}'" for n in names)


def sql_text(columns: list[str]) -> str:
    """The text that digests are made of."""
    return "concat_ws('|', " + ", ".join(
        f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '~')"
        for c in columns
    ) + ")"


def sql_draw(columns: list[str], seed: int) -> str:
    digest = f"md5({sql_text(columns)} || '#{seed}')"
    return f"(CAST('0x' || substr({digest}, 1, 13) AS BIGINT) / 4503599627370496.0)"


KEY = "user_id_hashed, account_id_hashed, transaction_id_hashed, date"
INPUTS = "description, amount, transaction_type, internal_transaction"

CTES: dict[str, str] = {
    "users": f"SELECT c_custkey AS user_id_hashed, {COUNTRY_SQL} AS country_code FROM customer",
    "test_users": (
        "SELECT c_custkey AS user_id_hashed FROM customer WHERE c_mktsegment = 'MACHINERY'"
    ),
    "accounts": (
        "SELECT o_custkey AS user_id_hashed, o_orderkey AS account_id_hashed, "
        f"{DELETED_SQL} AS deleted, nullif(o_orderpriority, '5-LOW') AS site_id FROM orders"
    ),
    "transactions": f"""
        SELECT o_custkey AS user_id, l_orderkey AS account_id,
          concat_ws('-', l_linenumber, l_partkey, l_suppkey) AS transaction_id,
          CAST(l_shipdate AS DATE) AS date,
          CASE WHEN l_returnflag = 'N' THEN 2 ELSE 1 END AS pending,
          {DESCRIPTION_SQL} AS description, {INTERNAL_SQL} AS internal_transaction,
          {TYPE_SQL} AS transaction_type, l_extendedprice AS amount, l_linenumber AS cycle_id,
          o_custkey AS user_id_hashed, l_orderkey AS account_id_hashed,
          concat_ws('-', l_linenumber, l_partkey, l_suppkey) AS transaction_id_hashed,
          CAST(month(l_shipdate) AS INTEGER) AS month, CAST(year(l_shipdate) AS INTEGER) AS year
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
          LEFT JOIN part ON l_partkey = p_partkey""",
    "event_fields": (
        "SELECT event_id, ts, event_type, value, "
        "CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events"
    ),
    "feedback_events": """
        SELECT user_id, account_id, transaction_id, date, pending,
          CASE WHEN value >= 1 THEN ts END AS feedback_time, event_type, k
        FROM event_fields JOIN transactions
          ON account_id = event_id // 8 AND cycle_id = k % 4 + 1""",
    "category_events": f"""
        SELECT user_id, account_id, transaction_id, date, feedback_time, event_type,
          {sql_list(CATEGORY_LABELS)}[k % {len(CATEGORY_LABELS)} + 1] AS category
        FROM feedback_events WHERE event_type IN ({sql_in(list(CATEGORY_EVENT_TYPES.values()))})""",
    "label_events": f"""
        SELECT user_id AS user_id_hashed, account_id AS account_id_hashed,
          transaction_id AS transaction_id_hashed, date, feedback_time,
          {sql_list(TRANSACTION_LABELS)}[(k // 4) % 8 + 1] AS transaction_label
        FROM feedback_events WHERE event_type IN ({sql_in(LABEL_EVENT_TYPES)})""",
    "eligible_users": """
        SELECT user_id_hashed, country_code, coalesce(test_user, 0) AS test_user
        FROM users LEFT JOIN (SELECT DISTINCT user_id_hashed, 1 AS test_user FROM test_users)
          USING (user_id_hashed)
        WHERE NOT (country_code <> 'NL' AND coalesce(test_user, 0) = 1)""",
    "live_accounts": "SELECT * FROM accounts WHERE deleted IS NULL",
    "owned": f"""
        SELECT user_id_hashed, country_code, account_id_hashed, site_id
        FROM eligible_users JOIN live_accounts USING (user_id_hashed)
        WHERE NOT (country_code = 'NL' AND NOT site_id IN ({sql_in(SITES)}))""",
    "base": """
        SELECT t.*, country_code, site_id
        FROM owned o JOIN transactions t
          ON o.user_id_hashed = t.user_id_hashed AND o.account_id_hashed = t.account_id_hashed
        WHERE (country_code <> 'NL' AND year >= 1996 AND month >= 3 AND year <= 2000)
           OR (country_code = 'NL' AND year >= 1995 AND month >= 6 AND year <= 2000)""",
    "latest": """
        SELECT user_id, account_id, transaction_id, date, feedback_time, category
        FROM category_events
        QUALIFY row_number() OVER (PARTITION BY user_id, account_id, transaction_id, date
          ORDER BY feedback_time DESC NULLS LAST, category DESC) = 1""",
    "category_rows": f"""
        SELECT {KEY}, {INPUTS}, country_code, category AS target_category
        FROM latest JOIN base USING (user_id, account_id, transaction_id, date)""",
    "label_rows": f"""
        SELECT {KEY}, feedback_time, transaction_label, country_code
        FROM label_events JOIN eligible_users USING (user_id_hashed)""",
    "label_lists": f"""
        SELECT {KEY}, country_code, list_sort(list(transaction_label)) AS target_label
        FROM label_rows GROUP BY ALL""",
    "good_lists": """
        SELECT * FROM label_lists
        WHERE NOT (list_contains(target_label, 'Salary') AND len(list_distinct(target_label)) > 1)
          AND NOT (list_contains(target_label, 'Energy')
            AND list_contains(target_label, 'Internet_mobile'))""",
    "documents_judged": """
        SELECT doc_id, coalesce(quality, 0) AS y0, coalesce(toxic, 0) AS y1,
          CAST(n_chars >= 500 AS INTEGER) AS p0,
          CAST(regexp_matches(text, '[0-9]{3,}') AS INTEGER) AS p1,
          CASE lang WHEN 'en' THEN 'GB' WHEN 'fr' THEN 'FR' WHEN 'es' THEN 'IT'
            WHEN 'de' THEN 'NL' END AS country_code
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "label_ids": (
        f"SELECT unnest({sql_list(LABELS)}) AS label, "
        f"unnest(range({len(LABELS)})) AS label_id"
    ),
}


def sql(body: str, *names: str, **own: str) -> str:
    """A statement with the named expressions, and those they build on, before it."""
    order: list[str] = []
    everything = {**CTES, **own}

    def add(name: str) -> None:
        if name in order:
            return
        text = everything[name]
        for other in everything:
            if other != name and re.search(rf"\b{other}\b", text):
                add(other)
        order.append(name)

    for name in [*names, *own]:
        add(name)
    for name in everything:
        if re.search(rf"\b(FROM|JOIN)\s+{name}\b", body):
            add(name)
    parts = ",\n".join(f"{name} AS ({everything[name].strip()})" for name in order)
    return f"WITH {parts}\n{body.strip()}" if parts else body.strip()
