"""Queries: sources, eligibility, feedback, sampling, splitting, training set."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgertag.catalogue import tables as t
from ledgertag.catalogue.registry import query
from ledgertag.catalogue.tables import CONFIG, INPUTS, KEY, sql, sql_draw, sql_list, sql_text
from ledgertag.domain import CATEGORY_LABELS, GENERAL, HASHED_KEY, LABELS
from ledgertag.operators.assemble import (
    ROW_ID,
    feedback_outer,
    long_targets,
    trainable_rows,
    wide_rows,
    with_label_ids,
)
from ledgertag.operators.eligibility import (
    eligible_transactions,
    eligible_users,
    live_accounts,
)
from ledgertag.operators.feedback import (
    LABEL_COLUMNS,
    category_feedback,
    label_counts,
    label_feedback,
    label_feedback_with_country,
    label_list,
    label_runs,
    latest_feedback,
    union_feedback,
    without_conflicts,
)
from ledgertag.operators.sampling import (
    sample_per_stratum,
    sample_to_size,
    split_by_class,
    stratum_ratios,
)
from ledgertag.plans.training_set import CATEGORY_TABLES, training_set
from ledgertag.session import materialize, scratch_path
from ledgertag.sources.sinks import (
    SPLITS,
    run_metadata,
    split_counts_by_country,
    write_metadata,
    write_splits,
)
from ledgertag.sources.tables import TableSpec, load_table


def day() -> Column:
    return F.col("date").cast("string").alias("date")


def plain(df: DataFrame) -> DataFrame:
    """Dates as text, so that every engine reports them alike."""
    return df.withColumn("date", F.col("date").cast("string"))


# --- sources and sinks --------------------------------------------------------------------

CUSTOMER = TableSpec(
    columns=["c_custkey", "c_nationkey", "c_mktsegment"],
    schema=T.StructType(),
    aliases={"c_custkey": "user_id", "c_mktsegment": "segment"},
)
NATION = TableSpec(
    columns=["n_nationkey", "n_name", "n_regionkey"],
    schema=T.StructType([
        T.StructField("n_nationkey", T.IntegerType()),
        T.StructField("n_name", T.StringType()),
        T.StructField("n_regionkey", T.IntegerType()),
    ]),
    aliases={"n_name": "nation"},
)


@query(
    "load_project_rename",
    """SELECT c_custkey AS user_id, c_mktsegment AS segment, n_name AS nation
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def load_project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = load_table(spark, CUSTOMER, f"{sf_dir}/customer.parquet")
    nations = load_table(spark, NATION, f"{sf_dir}/nation.parquet")
    joined = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.drop("c_nationkey", "n_nationkey", "n_regionkey")


@query("csv_source", "SELECT n_nationkey, n_name AS nation, n_regionkey FROM nation")
def csv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written with its columns in another order and one more; read by name."""
    folder = scratch_path(spark, "nation")
    nations = t.read(spark, sf_dir, "nation")
    shuffled = nations.select("n_regionkey", F.lit("x").alias("extra"), "n_name", "n_nationkey")
    shuffled.write.option("header", "true").csv(folder)
    return load_table(spark, NATION, f"{folder}/*.csv")


@query(
    "partitioned_source",
    """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag, count(*) AS n_rows,
      round(sum(l_quantity), 2) AS quantity
    FROM lineitem WHERE year(l_shipdate) >= 1998 GROUP BY ALL""",
)
def partitioned_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "lineitem")
    lines = t.read(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    # Rows of a year go together, but a large year is split over several tasks.
    lines.hint("rebalance", "year").write.partitionBy("year").parquet(folder)
    spec = TableSpec(columns=["year", "l_returnflag", "l_quantity"], schema=T.StructType())
    return (
        load_table(spark, spec, folder)
        .where(F.col("year") >= 1998)
        .groupBy("year", "l_returnflag")
        .agg(F.count("*").alias("n_rows"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
    )


@query(
    "event_json_fields",
    """SELECT event_id, user_id AS "user", strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS feedback_time,
      CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
)
def event_json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as nested JSON lines, then read by schema with nested columns."""
    folder = scratch_path(spark, "events")
    written = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    t.read(spark, sf_dir, "events").select(
        F.struct("event_id", F.col("user_id").alias("userId")).alias("id"),
        written.alias("time"),
        F.struct(F.from_json("props", "k int")["k"].alias("k")).alias("fact"),
    ).write.json(folder)
    spec = TableSpec(
        columns=["id.event_id", "id.userId", "time", "fact.k"],
        schema=T.StructType.fromDDL(
            "id struct<event_id: bigint, userId: bigint>, time string, fact struct<k: int>"
        ),
        aliases={"userId": "user", "time": "feedback_time"},
    )
    return load_table(spark, spec, folder, "json")


@query(
    "parquet_round_trip",
    "SELECT doc_id, lang, source, n_chars, CASE WHEN n_chars < 400 THEN 'test' "
    "WHEN n_chars < 800 THEN 'validation' ELSE 'train' END AS split FROM documents",
)
def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "sets")
    split = (
        F.when(F.col("n_chars") < 400, "test")
        .when(F.col("n_chars") < 800, "validation")
        .otherwise("train")
    )
    write_splits(
        t.read(spark, sf_dir, "documents")
        .select("doc_id", "lang", "source", "n_chars", split.alias("split")),
        path,
    )
    return spark.read.parquet(path).withColumn("split", F.col("split").cast("string"))


# --- eligibility --------------------------------------------------------------------------


@query("eligible_users", sql("SELECT * FROM eligible_users"))
def eligible_users_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eligible_users(t.users(spark, sf_dir), t.test_users(spark, sf_dir))


@query(
    "live_accounts",
    sql("SELECT user_id_hashed, account_id_hashed, site_id FROM live_accounts"),
)
def live_accounts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live_accounts(t.accounts(spark, sf_dir)).drop("deleted")


def base(spark: SparkSession, sf_dir: str, mode: str = "compat") -> DataFrame:
    return eligible_transactions(
        eligible_users(t.users(spark, sf_dir), t.test_users(spark, sf_dir)),
        live_accounts(t.accounts(spark, sf_dir)),
        t.transactions(spark, sf_dir),
        CONFIG.start, CONFIG.nl_start, CONFIG.end, CONFIG.nl_site_ids, mode,
    )


BASE_COLUMNS = [*HASHED_KEY, "country_code", "site_id", "year", "month", "amount"]
BASE_SQL = (
    "user_id_hashed, account_id_hashed, transaction_id_hashed, CAST(date AS VARCHAR) AS date, "
    "country_code, site_id, year, month, amount"
)


@query("transactions_compat", sql(f"SELECT {BASE_SQL} FROM base"))
def transactions_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(base(spark, sf_dir).select(*BASE_COLUMNS))


@query(
    "transactions_range",
    sql(
        f"SELECT {BASE_SQL} FROM ranged",
        ranged="""
        SELECT t.*, country_code, site_id
        FROM owned o JOIN transactions t
          ON o.user_id_hashed = t.user_id_hashed AND o.account_id_hashed = t.account_id_hashed
        WHERE (country_code <> 'NL' AND date BETWEEN DATE '1996-03-01' AND DATE '2000-12-31')
           OR (country_code = 'NL' AND date BETWEEN DATE '1995-06-01' AND DATE '2000-12-31')""",
    ),
)
def transactions_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(base(spark, sf_dir, "range").select(*BASE_COLUMNS))


@query(
    "eligible_by_country_year",
    sql(
        """SELECT country_code, year, count(*) AS n_transactions,
          round(sum(amount), 2) AS total_amount
        FROM base GROUP BY ALL"""
    ),
)
def eligible_by_country_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base(spark, sf_dir).groupBy("country_code", "year").agg(
        F.count("*").alias("n_transactions"), F.round(F.sum("amount"), 2).alias("total_amount")
    )


# --- feedback -----------------------------------------------------------------------------

TIME_SQL = "strftime(feedback_time, '%Y-%m-%d %H:%M:%S.%f') AS feedback_time"
PLAIN_SQL = "user_id, account_id, transaction_id, CAST(date AS VARCHAR) AS date"


def time() -> Column:
    return F.date_format("feedback_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("feedback_time")


def all_category_feedback(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return in_order(t.category_tables(t.kept_feedback_events(spark, sf_dir)))


def in_order(tables: dict[str, DataFrame]) -> list[DataFrame]:
    return [tables[name] for name in CATEGORY_TABLES]


@query(
    "feedback_union_dedup",
    sql(f"SELECT DISTINCT {PLAIN_SQL}, {TIME_SQL}, category FROM category_events"),
)
def feedback_union_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = union_feedback(*all_category_feedback(spark, sf_dir))
    return rows.select("user_id", "account_id", "transaction_id", day(), time(), "category")


@query("latest_feedback", sql(f"SELECT {PLAIN_SQL}, {TIME_SQL}, category FROM latest"))
def latest_feedback_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = union_feedback(*all_category_feedback(spark, sf_dir), distinct=False)
    return latest_feedback(rows).select(
        "user_id", "account_id", "transaction_id", day(), time(), "category"
    )


HASHED_SQL = (
    "user_id_hashed, account_id_hashed, transaction_id_hashed, CAST(date AS VARCHAR) AS date"
)


@query(
    "category_feedback",
    sql(f"SELECT {HASHED_SQL}, {INPUTS}, country_code, target_category FROM category_rows"),
)
def category_feedback_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(category_feedback(all_category_feedback(spark, sf_dir), base(spark, sf_dir)))


def label_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = eligible_users(t.users(spark, sf_dir), t.test_users(spark, sf_dir))
    return label_feedback_with_country(t.label_events(t.feedback_events(spark, sf_dir)), known)


LIST_SQL = (
    f"SELECT {HASHED_SQL}, country_code, array_to_string(target_label, ',') AS target_label, "
    "CAST(len(list_distinct(target_label)) AS BIGINT) AS n_labels FROM "
)


def with_label_list(df: DataFrame) -> DataFrame:
    return plain(df).select(
        *HASHED_KEY, "country_code",
        F.array_join(label_list(F.col("label_counts")), ",").alias("target_label"),
        F.size("label_counts").cast("bigint").alias("n_labels"),
    )


@query("label_lists", sql(f"{LIST_SQL} label_lists"))
def label_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_label_list(label_counts(label_rows(spark, sf_dir)))


@query("label_conflicts", sql(f"{LIST_SQL} good_lists"))
def label_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_label_list(without_conflicts(label_counts(label_rows(spark, sf_dir))))


@query(
    "label_feedback",
    sql(
        f"""SELECT {HASHED_SQL}, {INPUTS}, b.country_code,
          array_to_string(target_label, ',') AS target_label
        FROM base b JOIN (SELECT * EXCLUDE (country_code) FROM good_lists)
          USING ({KEY})"""
    ),
)
def label_feedback_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = label_feedback(
        t.label_events(t.feedback_events(spark, sf_dir)),
        eligible_users(t.users(spark, sf_dir), t.test_users(spark, sf_dir)),
        base(spark, sf_dir),
    )
    listed = F.array_join(label_list(F.col("label_counts")), ",")
    return plain(rows).withColumn("target_label", listed).drop("label_counts")


# --- sampling and splitting ---------------------------------------------------------------

LINE_KEY = ["account_id", "transaction_id", "date"]


@query(
    "sample_fraction",
    sql(
        f"""SELECT {PLAIN_SQL}, amount FROM transactions
        WHERE {sql_draw(LINE_KEY, 123)}
          < 20000.0 / (SELECT count(*) FROM transactions)"""
    ),
)
def sample_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sample_to_size(t.transactions(spark, sf_dir), 20_000, LINE_KEY)
    return rows.select("user_id", "account_id", "transaction_id", day(), "amount")


@query(
    "stratum_ratios",
    sql(
        """SELECT country_code, transaction_label, count(transaction_id_hashed) AS n_rows,
          round(least(1.0, 40.0 / count(transaction_id_hashed)), 6) AS ratio
        FROM label_rows GROUP BY country_code, transaction_label"""
    ),
)
def stratum_ratios_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratios = stratum_ratios(
        label_rows(spark, sf_dir), 40, ["country_code", "transaction_label"],
        "transaction_id_hashed",
    )
    return ratios.withColumn("ratio", F.round("ratio", 6))


SAMPLED_LABELS_SQL = f"""
    SELECT {KEY}, feedback_time, transaction_label, country_code FROM (
      SELECT *, row_number() OVER (PARTITION BY {KEY}, feedback_time, transaction_label,
          country_code ORDER BY date) AS copy_no,
        count(transaction_id_hashed) OVER (PARTITION BY country_code, transaction_label) AS n_rows
      FROM label_rows)
    WHERE {sql_draw([*LABEL_COLUMNS, "country_code", "copy_no"], 42)} < 40.0 / n_rows"""


@query(
    "sample_stratified",
    sql(
        f"SELECT {HASHED_SQL}, {TIME_SQL}, transaction_label, country_code FROM sampled_labels",
        sampled_labels=SAMPLED_LABELS_SQL,
    ),
)
def sample_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sample_per_stratum(
        materialize(label_rows(spark, sf_dir)), 40, ["country_code", "transaction_label"],
        "transaction_id_hashed",
    )
    return rows.select(
        *HASHED_KEY[:3], day(), time(), "transaction_label", "country_code"
    )


def split_sql(rows: str, class_column: str, key: str, n_validation: int, n_test: int) -> dict:
    """Expressions that assign exact, proportional splits."""

    def quotas(source: str, size: str, total: int, name: str) -> str:
        return f"""
            SELECT *, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, class)
                <= {total} - sum(whole) OVER () THEN 1 ELSE 0 END AS {name}
            FROM (SELECT *, {total} * {size} // sum({size}) OVER () AS whole,
                {total} * {size} % sum({size}) OVER () AS rest FROM {source})"""

    return {
        "class_sizes": f"SELECT {class_column} AS class, count(*) AS size FROM {rows} GROUP BY 1",
        "test_quotas": quotas("class_sizes", "size", n_test, "test_quota"),
        "remaining": (
            'SELECT class, test_quota, size - test_quota AS "left" FROM test_quotas'
        ),
        "quotas": quotas("remaining", '"left"', n_validation, "validation_quota"),
        "split_rows": f"""
            SELECT r.*, CASE WHEN place <= test_quota THEN 'test'
                WHEN place <= test_quota + validation_quota THEN 'validation'
                ELSE 'train' END AS split
            FROM (SELECT *, row_number() OVER (PARTITION BY {class_column}
                ORDER BY md5({sql_text([key])} || '#42')) AS place FROM {rows}) r
            JOIN quotas ON {class_column} IS NOT DISTINCT FROM class""",
    }


@query(
    "split_stratified",
    sql(
        "SELECT order_id, priority, split FROM split_rows",
        order_rows="SELECT o_orderkey AS order_id, o_orderpriority AS priority FROM orders",
        **split_sql("order_rows", "priority", "order_id", 300, 500),
    ),
)
def split_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("priority")
    )
    return split_by_class(rows, 300, 500, "priority", "order_id")


@query(
    "split_counts_by_country",
    sql(
        """SELECT split, country_code, count(*) AS n_rows FROM split_rows
        WHERE country_code IS NOT NULL GROUP BY ALL""",
        split_users="SELECT user_id_hashed, country_code FROM users",
        **split_sql("split_users", "country_code", "user_id_hashed", 30, 40),
    ),
)
def split_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = split_by_class(t.users(spark, sf_dir), 30, 40, "country_code", "user_id_hashed")
    return split_counts_by_country(split)


# --- assembling ---------------------------------------------------------------------------

SHARED = ["user_id_hashed", "account_id_hashed", "transaction_id_hashed", "date",
          "description", "amount", "transaction_type", "internal_transaction", "country_code"]


def outer_sql(categories: str, labels: str, null_safe: bool = False) -> str:
    if null_safe:
        same = " AND ".join(f"c.{k} IS NOT DISTINCT FROM l.{k}" for k in HASHED_KEY)
    else:
        same = " AND ".join(f"c.{k} = l.{k}" for k in SHARED)
    columns = ", ".join(
        f"coalesce(c.{k}, l.{k}{', ' + repr('') if k == 'description' else ''}) AS {k}"
        for k in SHARED
    )
    return f"""
        SELECT {columns}, coalesce(target_category, '{GENERAL}') AS target_category, target_label
        FROM {categories} c FULL JOIN {labels} l ON {same}"""


LABELLED_SQL = f"""
    SELECT {", ".join(f"b.{c}" for c in SHARED)}, target_label
    FROM base b JOIN (SELECT * EXCLUDE (country_code) FROM good_lists) USING ({KEY})"""
OUTER_SELECT = (
    f"SELECT {HASHED_SQL}, {INPUTS}, country_code, target_category, "
    "array_to_string(target_label, ',') AS target_label, CAST(1 AS BIGINT) AS copies FROM outer_rows"
)


def both_feedbacks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    eligible = base(spark, sf_dir)
    events = t.kept_feedback_events(spark, sf_dir)
    known = eligible_users(t.users(spark, sf_dir), t.test_users(spark, sf_dir))
    return (
        category_feedback(in_order(t.category_tables(events)), eligible),
        label_feedback(t.label_events(events), known, eligible),
    )


def outer_query(spark: SparkSession, sf_dir: str, null_safe: bool) -> DataFrame:
    joined = feedback_outer(*both_feedbacks(spark, sf_dir), null_safe)
    listed = F.array_join(label_list(F.col("label_counts")), ",")
    return plain(joined).withColumn("target_label", listed).drop("label_counts")


@query(
    "feedback_outer",
    sql(OUTER_SELECT, labelled=LABELLED_SQL, outer_rows=outer_sql("category_rows", "labelled")),
)
def feedback_outer_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outer_query(spark, sf_dir, False)


@query(
    "feedback_outer_nullsafe",
    sql(
        OUTER_SELECT, labelled=LABELLED_SQL,
        outer_rows=outer_sql("category_rows", "labelled", True),
    ),
)
def feedback_outer_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outer_query(spark, sf_dir, True)


# The label list as counted text: what the row id is made of.
COUNTED_SQL = """
    (SELECT array_to_string(list(length(label) || ':' || label || '*' || n ORDER BY label), ',')
     FROM (SELECT label, count(*) AS n
           FROM (SELECT unnest(target_label) AS label) GROUP BY label))"""


def wide_sql(source: str) -> str:
    content = [*SHARED, "target_category", "counted", "copy_no"]
    return f"""
        SELECT {INPUTS}, country_code, target_category, target_label,
          md5({sql_text(content)}) AS {ROW_ID}
        FROM (
          SELECT *, row_number() OVER (PARTITION BY {", ".join(SHARED)}, target_category, counted)
            AS copy_no
          FROM (SELECT *, CASE WHEN target_label IS NOT NULL THEN {COUNTED_SQL} END AS counted
                FROM {source}))"""


def long_sql(source: str, columns: str = "") -> str:
    return f"""
        SELECT {INPUTS}, country_code, {ROW_ID}{columns}, target_label,
          CAST(label_id AS INTEGER) AS target_label_int
        FROM (
          SELECT * EXCLUDE (target_category, target_label), target_category AS target_label
          FROM {source}
          UNION ALL BY NAME
          SELECT * EXCLUDE (target_category, target_label), unnest(target_label) AS target_label
          FROM {source})
        LEFT JOIN label_ids ON target_label = label"""


@query(
    "long_targets",
    sql(
        "SELECT * FROM long_rows",
        labelled=LABELLED_SQL,
        outer_rows=outer_sql("category_rows", "labelled"),
        wide=wide_sql("outer_rows"),
        long_rows=long_sql("wide"),
    ),
)
def long_targets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long_targets(wide_rows(*both_feedbacks(spark, sf_dir)))


@query(
    "label_ids",
    sql(
        f"""SELECT event_id, target_label, CAST(label_id AS INTEGER) AS target_label_int
        FROM (SELECT event_id, CASE WHEN k < 60 THEN {sql_list(CATEGORY_LABELS)}[k % 30 + 1]
            ELSE event_type END AS target_label FROM event_fields)
          LEFT JOIN label_ids ON target_label = label"""
    ),
)
def label_ids_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known and unknown label names looked up."""
    names = F.get(F.lit(CATEGORY_LABELS), F.col("k") % 30)
    rows = t.event_fields(spark, sf_dir).select(
        "event_id",
        F.when(F.col("k") < 60, names).otherwise(F.col("event_type")).alias("target_label"),
    )
    return with_label_ids(rows)


@query(
    "trainable_rows",
    sql(
        f"""SELECT event_id, target_label
        FROM (SELECT event_id, nullif({sql_list(LABELS)}[k % 39 + 1], 'Pets') AS target_label
              FROM event_fields)
        WHERE target_label <> '{GENERAL}' OR target_label IS NULL"""
    ),
)
def trainable_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.get(F.lit(LABELS), F.col("k") % len(LABELS))
    rows = t.event_fields(spark, sf_dir).select(
        "event_id", F.nullif(label, F.lit("Pets")).alias("target_label")
    )
    return trainable_rows(rows)


# --- the whole job ------------------------------------------------------------------------

SAMPLED_CATEGORIES_SQL = f"""
    SELECT {", ".join(SHARED)}, target_category FROM (
      SELECT *, row_number() OVER (PARTITION BY {", ".join(SHARED)}, target_category) AS copy_no
      FROM category_rows)
    WHERE {sql_draw([*SHARED, "target_category", "copy_no"], 123)}
      < {float(CONFIG.n_categories_feedback)} / (SELECT count(*) FROM category_rows)"""
TRAINING_SET_CTES = {
    "sampled_labels": SAMPLED_LABELS_SQL,
    "sampled_lists": t.CTES["label_lists"].replace("label_rows", "sampled_labels"),
    "sampled_good": t.CTES["good_lists"].replace("label_lists", "sampled_lists"),
    "labelled": LABELLED_SQL.replace("good_lists", "sampled_good"),
    "sampled_categories": SAMPLED_CATEGORIES_SQL,
    "outer_rows": outer_sql("sampled_categories", "labelled"),
    "wide": wide_sql("outer_rows"),
    **split_sql("wide", "target_category", ROW_ID, CONFIG.n_validation, CONFIG.n_test),
    "wide_split": (
        f"SELECT {INPUTS}, country_code, {ROW_ID}, split, target_category, target_label "
        "FROM split_rows"
    ),
    "training_rows": long_sql("wide_split", ", split"),
}


@query("training_set", sql("SELECT * FROM training_rows", **TRAINING_SET_CTES))
def training_set_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_set(t.pipeline_tables(spark, sf_dir), CONFIG)


@query(
    "training_set_counts",
    sql(
        """SELECT split, country_code, count(*) AS n_rows FROM training_rows
        WHERE country_code IS NOT NULL GROUP BY ALL""",
        **TRAINING_SET_CTES,
    ),
)
def training_set_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: raw tables to labelled, sampled and split rows, written and counted."""
    path = scratch_path(spark, "sets")
    write_splits(training_set_query(spark, sf_dir), path)
    rows = spark.read.parquet(path).withColumn("split", F.col("split").cast("string"))
    return split_counts_by_country(rows)


@query(
    "run_metadata",
    sql(
        f"""SELECT split AS name, country_code,
          count(*) AS n_rows, {CONFIG.n_test} AS n_test, {CONFIG.n_validation} AS n_validation,
          '00:00:07' AS elapsed
        FROM training_rows WHERE country_code IS NOT NULL GROUP BY split, country_code""",
        **TRAINING_SET_CTES,
    ),
)
def run_metadata_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata of a run as written and read again; its maps of sizes as rows."""
    folder = scratch_path(spark, "metadata")
    sets = materialize(training_set_query(spark, sf_dir))
    write_metadata(run_metadata(sets, asdict(CONFIG), "00:00:07"), folder)
    sizes = "map<string,bigint>"
    schema = ", ".join(["config string", "preprocessing_time string", *(f"{s}_data_size_per_country {sizes}" for s in SPLITS)])
    written = spark.read.schema(schema).json(folder)
    config = F.from_json("config", "n_test int, n_validation int")
    by_split = F.create_map(*(x for s in SPLITS for x in (F.lit(s), F.col(f"{s}_data_size_per_country"))))
    rows = written.select(config.alias("c"), "preprocessing_time", F.explode(by_split).alias("name", "sizes"))
    rows = rows.select("c.*", "preprocessing_time", "name", F.explode("sizes").alias("country_code", "n_rows"))
    return rows.select(
        "name", "country_code", "n_rows", "n_test", "n_validation", F.col("preprocessing_time").alias("elapsed")
    )


RUNS_SQL = """
    SELECT account_id_hashed, transaction_id_hashed, CAST(date AS VARCHAR) AS date, country_code,
      coalesce(string_agg(CASE WHEN n = 1 THEN transaction_label ELSE transaction_label || '*' || n END, ','
        ORDER BY transaction_label), '') AS labels, sum(n)::BIGINT AS n_rows
    FROM (SELECT user_id_hashed, account_id_hashed, transaction_id_hashed, date, country_code, transaction_label,
        count(*) AS n FROM label_rows WHERE transaction_label IS NOT NULL GROUP BY ALL)
    GROUP BY user_id_hashed, account_id_hashed, transaction_id_hashed, date, country_code"""


@query("label_runs", sql(RUNS_SQL, "label_rows"))
def label_runs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label lists in their bounded form."""
    rows = plain(label_counts(label_rows(spark, sf_dir).where("transaction_label IS NOT NULL")))
    total = F.aggregate("label_counts", F.lit(0).cast("bigint"), lambda n, e: n + e["copies"])
    return rows.select(
        "account_id_hashed", "transaction_id_hashed", "date", "country_code",
        label_runs(F.col("label_counts")).alias("labels"), total.alias("n_rows"),
    )
