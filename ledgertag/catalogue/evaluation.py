"""Queries: test-set preparation, metrics, reports, gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertag.catalogue import tables as t
from ledgertag.catalogue.preparation import TRAINING_SET_CTES, training_set_query
from ledgertag.catalogue.registry import query
from ledgertag.catalogue.tables import INPUTS, sql, sql_list
from ledgertag.domain import CATEGORY_LABELS, LABELS, TRANSACTION_LABELS
from ledgertag.operators.assemble import ROW_ID
from ledgertag.operators.evaluate import (
    golden_check,
    label_report,
    metric_sums,
    metric_sums_by_group,
    missing_labels,
    missing_multi_hot_labels,
    multi_hot,
    one_hot,
    performance_gate,
    prepare_test_set,
    report_averages,
    report_summary,
)

FLAGS = ["quality", "toxic"]


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(
    "multi_hot_targets",
    sql(
        f"""SELECT {INPUTS}, country_code, {ROW_ID}, 99 AS target_label_int,
          concat({", ".join(
              f"max(CAST(target_label = '{label}' AS INTEGER))" for label in TRANSACTION_LABELS
          )}) AS target_label
        FROM training_rows GROUP BY {INPUTS}, country_code, {ROW_ID}""",
        **TRAINING_SET_CTES,
    ),
)
def multi_hot_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = prepare_test_set(training_set_query(spark, sf_dir))
    flags = F.array_join(F.col("target_label").cast("array<string>"), "")
    return prepared.withColumn("target_label", flags)


@query(
    "multi_hot_lists",
    sql(
        f"""SELECT user_id, concat({", ".join(
            f"max(CAST(event_type = '{kind}' AS INTEGER))" for kind in ("click", "view", "error")
        )}) AS flags FROM events GROUP BY user_id"""
    ),
)
def multi_hot_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label lists per user to 0/1; labels outside the list are left out."""
    lists = t.read(spark, sf_dir, "events").groupBy("user_id").agg(
        F.collect_set("event_type").alias("kinds")
    )
    flags = multi_hot(F.col("kinds"), ["click", "view", "error"]).cast("array<string>")
    return lists.select("user_id", F.array_join(flags, "").alias("flags"))


@query(
    "one_hot_ids",
    "SELECT vec_id, concat(" + ", ".join(
        f"CAST(label = {i} AS INTEGER)" for i in range(10)
    ) + ") AS flags FROM embeddings",
)
def one_hot_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = one_hot(F.col("label"), 10).cast("array<string>")
    return t.read(spark, sf_dir, "embeddings").select(
        "vec_id", F.array_join(flags, "").alias("flags")
    )


@query(
    "missing_labels",
    sql(
        f"""SELECT label FROM (SELECT unnest({sql_list(LABELS)}) AS label)
        WHERE label NOT IN (SELECT {sql_list(CATEGORY_LABELS)}[k % 25 + 1] FROM event_fields)""",
        "event_fields",
    ),
)
def missing_labels_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.get(F.lit(CATEGORY_LABELS), F.col("k") % 25)
    return missing_labels(t.event_fields(spark, sf_dir).select(name.alias("target_label")))


@query(
    "missing_multi_hot_labels",
    """SELECT label FROM (SELECT unnest(['label3', 'label12', 'label15']) AS label,
        unnest([3, 12, 15]) AS id) WHERE id NOT IN (SELECT label FROM embeddings)""",
)
def missing_multi_hot_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["label3", "label12", "label15"]
    flags = F.array(*[(F.col("label") == i).cast("int") for i in (3, 12, 15)])
    rows = t.read(spark, sf_dir, "embeddings").select(flags.alias("target_label"))
    return missing_multi_hot_labels(rows, labels=names)


# --- metrics ------------------------------------------------------------------------------


def ratio_sql(part: str, whole: str) -> str:
    return f"coalesce(CAST({part} AS DOUBLE) / nullif({whole}, 0), 0.0)"


def f1_sql(p: str, r: str) -> str:
    return f"coalesce(2.0 * {p} * {r} / nullif({p} + {r}, 0.0), 0.0)"


REPORT_CTES = {
    "flags": """
        SELECT doc_id, country_code, 'quality' AS label, y0 AS y, p0 AS p FROM documents_judged
        UNION ALL SELECT doc_id, country_code, 'toxic', y1, p1 FROM documents_judged""",
    "grouped_flags": """
        SELECT g AS grp, flags.* FROM flags JOIN (
          SELECT country_code AS g, country_code AS c FROM (
            SELECT unnest(['GB', 'FR', 'IT', 'NL']) AS country_code)
          UNION ALL SELECT 'ALL', unnest(['GB', 'FR', 'IT', 'NL'])) ON c = country_code""",
    "report": f"""
        SELECT *, {f1_sql('"precision"', 'recall')} AS f1 FROM (
          SELECT label, {ratio_sql('sum(y * p)', 'sum(p)')} AS "precision",
            {ratio_sql('sum(y * p)', 'sum(y)')} AS recall, CAST(sum(y) AS BIGINT) AS support
          FROM flags GROUP BY label)""",
    "row_scores": f"""
        SELECT *, {f1_sql('rp', 'rr')} AS rf FROM (
          SELECT doc_id, {ratio_sql('sum(y * p)', 'sum(p)')} AS rp,
            {ratio_sql('sum(y * p)', 'sum(y)')} AS rr FROM flags GROUP BY doc_id)""",
    "micro": f"""
        SELECT {ratio_sql('sum(y * p)', 'sum(p)')} AS mp,
          {ratio_sql('sum(y * p)', 'sum(y)')} AS mr FROM flags""",
    "totals": "SELECT CAST(sum(y) AS BIGINT) AS support FROM flags",
}


def sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_sums(t.judged_documents(spark, sf_dir), FLAGS)


@query(
    "multilabel_report",
    sql(
        """SELECT label, round("precision", 6) AS precision, round(recall, 6) AS recall,
          round(f1, 6) AS f1, support FROM report""",
        **REPORT_CTES,
    ),
)
def multilabel_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(label_report(sums(spark, sf_dir), FLAGS), "precision", "recall", "f1")


def average_sql(name: str, p: str, r: str, f: str, source: str) -> str:
    return f"""SELECT '{name}' AS average, round({p}, 6) AS precision, round({r}, 6) AS recall,
        round({f}, 6) AS f1, (SELECT support FROM totals) AS support FROM {source}"""


@query(
    "report_averages",
    sql(
        " UNION ALL ".join([
            average_sql("micro avg", "mp", "mr", f1_sql("mp", "mr"), "micro"),
            average_sql("macro avg", 'avg("precision")', "avg(recall)", "avg(f1)", "report"),
            average_sql(
                "weighted avg",
                *[f"{ratio_sql(f'sum({c} * support)', 'sum(support)')}"
                  for c in ('"precision"', "recall", "f1")],
                "report",
            ),
            average_sql("samples avg", "avg(rp)", "avg(rr)", "avg(rf)", "row_scores"),
        ]),
        "totals",
        **REPORT_CTES,
    ),
)
def report_averages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(report_averages(sums(spark, sf_dir), FLAGS), "precision", "recall", "f1")


@query(
    "multilabel_summary",
    sql(
        """SELECT round_even(avg(CAST(y0 = p0 AND y1 = p1 AS DOUBLE)), 4) AS subset_accuracy,
          round_even(avg((CAST(y0 <> p0 AS DOUBLE) + CAST(y1 <> p1 AS DOUBLE)) / 2), 4)
            AS hamming_loss,
          round_even(CAST(sum(y0 + y1) AS DOUBLE) / count(*), 4) AS coverage,
          round_even(avg(CAST(y0 + y1 > 0 AS DOUBLE)), 4) AS any_label_rate,
          count(*) AS n_rows FROM documents_judged"""
    ),
)
def multilabel_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_summary(sums(spark, sf_dir), FLAGS)


GROUP_REPORT_SQL = f"""
    SELECT *, {f1_sql('"precision"', 'recall')} AS f1 FROM (
      SELECT grp, label, {ratio_sql('sum(y * p)', 'sum(p)')} AS "precision",
        {ratio_sql('sum(y * p)', 'sum(y)')} AS recall, CAST(sum(y) AS BIGINT) AS support
      FROM grouped_flags GROUP BY grp, label)"""


def group_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_group = metric_sums_by_group(t.judged_documents(spark, sf_dir), FLAGS)
    return label_report(by_group, FLAGS, ["group"])


@query(
    "report_by_country_group",
    sql(
        """SELECT grp AS "group", label, round("precision", 6) AS precision,
          round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM group_report""",
        **REPORT_CTES,
        group_report=GROUP_REPORT_SQL,
    ),
)
def report_by_country_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(group_report(spark, sf_dir), "precision", "recall", "f1")


@query(
    "performance_gate",
    sql(
        """SELECT bool_and("precision" >= 0.6 AND recall >= 0.6 AND f1 >= 0.6) AS performant,
          CAST(count_if(NOT ("precision" >= 0.6 AND recall >= 0.6 AND f1 >= 0.6)) AS BIGINT)
            AS n_below
        FROM group_report""",
        **REPORT_CTES,
        group_report=GROUP_REPORT_SQL,
    ),
)
def performance_gate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return performance_gate(group_report(spark, sf_dir))


@query(
    "golden_check",
    """SELECT bool_and(y = p) AS passed, CAST(count_if(NOT y = p) AS BIGINT) AS n_different
    FROM (SELECT o_orderpriority IN ('1-URGENT', '2-HIGH') AS y, o_totalprice > 250000 AS p
          FROM orders)""",
)
def golden_check_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected and predicted sets, in different order where both hold two labels."""
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    dear = F.col("o_totalprice") > 250_000
    rows = t.read(spark, sf_dir, "orders").select(
        F.when(urgent, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a")))
        .alias("expected"),
        F.when(dear, F.array(F.lit("b"), F.lit("a"))).otherwise(F.array(F.lit("a")))
        .alias("labels"),
    )
    return golden_check(rows, "expected")
