"""Queries: text and numeric features, vectors, similarities, rules, label sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertag.catalogue import tables as t
from ledgertag.catalogue.registry import query
from ledgertag.catalogue.tables import sql, sql_list
from ledgertag.domain import (
    NOISE_PATTERN,
    SIMILARITY_RULES,
    TRAINING_LABELS,
    TRANSACTION_LABELS,
    TaxRule,
)
from ledgertag.functions.text import (
    bind,
    clean_text,
    one_and_two_grams,
    split_tokens,
    token_ids,
)
from ledgertag.functions.vectors import HASH_PRIME, hash_parameters, l2_normalize, dot
from ledgertag.operators.evaluate import ranking_metrics, reciprocal_rank, hits_by_rank
from ledgertag.operators.features import (
    AmountScale,
    align_inputs,
    amount_range,
    length_histogram,
    numeric_features,
    with_features,
)
from ledgertag.operators.rules import (
    add_tax_labels,
    apply_label_rules,
    apply_similarity_rules,
    apply_test_descriptions,
    eliminate_conflicts,
    indicators,
    label_set,
)
from ledgertag.operators.scoring import (
    fit_label_vectors,
    known_labels,
    label_matrix,
    label_moments,
    masked_mean,
    similarities_long,
    transaction_label_similarities,
    triplet_loss,
    with_similarities,
    with_transaction_vector,
)
from ledgertag.plans.model import LabelModel

# --- text ---------------------------------------------------------------------------------


def clean_sql(text: str) -> str:
    return f"lower(regexp_replace({text}, '{NOISE_PATTERN}', ' ', 'g'))"


def token_ctes(source: str, text: str, key: str, buckets: int = 600_000) -> dict[str, str]:
    """Cleaned text, tokens, n-grams and padded ids, of any frame with a key and a text."""
    return {
        "cleaned": f"SELECT {key}, {clean_sql(text)} AS cleaned FROM {source}",
        "words": f"""
            SELECT {key}, cleaned, string_split_regex(ltrim(cleaned), ' +') AS parts,
              regexp_extract(ltrim(cleaned), '^(?:[^ ]+ +){{29}}(.*)$', 1) AS rest
            FROM cleaned""",
        "tokens": f"""
            SELECT {key}, cleaned, list_filter(
              CASE WHEN len(parts) >= 30 THEN list_append(parts[1:29], rest) ELSE parts END,
              lambda w: w <> '') AS tokens FROM words""",
        "grams": f"""
            SELECT {key}, cleaned, tokens, list_concat(tokens, list_transform(
              range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1])) AS grams
            FROM tokens""",
        "ids": f"""
            SELECT {key}, list_resize(list_transform(grams, lambda g:
              CAST(CAST('0x' || substr(md5(g), 1, 8) AS BIGINT) % {buckets - 1} + 1 AS INTEGER)),
              60, 0) AS ids, tokens FROM grams""",
    }


DOCUMENT_TOKENS = token_ctes("documents", "text", "doc_id")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.read(spark, sf_dir, "documents")


@query(
    "text_clean",
    sql(
        """SELECT doc_id, CAST(length(cleaned) AS INTEGER) AS cleaned_length,
          md5(cleaned) AS cleaned_digest FROM cleaned""",
        **DOCUMENT_TOKENS,
    ),
)
def text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select("doc_id", clean_text(F.col("text")).alias("cleaned"))
    return rows.select(
        "doc_id", F.length("cleaned").alias("cleaned_length"),
        F.md5("cleaned").alias("cleaned_digest"),
    )


@query(
    "text_tokens",
    sql(
        """SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n_tokens,
          md5(array_to_string(tokens, '|')) AS token_digest FROM tokens""",
        **DOCUMENT_TOKENS,
    ),
)
def text_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bind(clean_text(F.col("text")), split_tokens)
    rows = documents(spark, sf_dir).select("doc_id", tokens.alias("tokens"))
    return rows.select(
        "doc_id", F.size("tokens").alias("n_tokens"),
        F.md5(F.array_join("tokens", "|")).alias("token_digest"),
    )


@query(
    "text_ngrams",
    sql(
        """SELECT doc_id, CAST(len(grams) AS INTEGER) AS n_grams,
          md5(array_to_string(grams, '|')) AS gram_digest FROM grams""",
        **DOCUMENT_TOKENS,
    ),
)
def text_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    grams = one_and_two_grams(bind(clean_text(F.col("text")), split_tokens))
    rows = documents(spark, sf_dir).select("doc_id", grams.alias("grams"))
    return rows.select(
        "doc_id", F.size("grams").alias("n_grams"),
        F.md5(F.array_join("grams", "|")).alias("gram_digest"),
    )


@query(
    "token_ids",
    sql("SELECT doc_id, array_to_string(ids, ',') AS token_ids FROM ids", **DOCUMENT_TOKENS),
)
def token_ids_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.array_join(token_ids(F.col("text")).cast("array<string>"), ",")
    return documents(spark, sf_dir).select("doc_id", ids.alias("token_ids"))


@query(
    "token_ids_short",
    sql(
        "SELECT p_partkey, array_to_string(ids, ',') AS token_ids FROM ids",
        **token_ctes("part", "p_name || ' ' || p_brand", "p_partkey"),
    ),
)
def token_ids_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat_ws(" ", "p_name", "p_brand")
    ids = F.array_join(token_ids(text).cast("array<string>"), ",")
    return t.read(spark, sf_dir, "part").select("p_partkey", ids.alias("token_ids"))


@query(
    "length_histogram",
    sql(
        """SELECT CAST(b AS INTEGER) AS bin, round(coalesce(n, 0) / total, 6) AS share
        FROM (SELECT unnest(range(10, 260, 10)) AS b)
          CROSS JOIN (SELECT CAST(count(*) AS DOUBLE) AS total FROM lengths)
          LEFT JOIN (SELECT CASE WHEN n_chars = 250 THEN 250 ELSE (n_chars // 10 + 1) * 10 END AS b,
              count(*) AS n FROM lengths WHERE n_chars <= 250 GROUP BY 1) USING (b)""",
        lengths="SELECT length(text) AS n_chars FROM conversations",
    ),
)
def length_histogram_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    histogram = length_histogram(t.read(spark, sf_dir, "conversations"), "text")
    return histogram.withColumn("share", F.round("share", 6))


# --- numeric features -----------------------------------------------------------------------


@query(
    "amount_range",
    sql(
        """SELECT CAST(min(CAST(amount AS FLOAT)) AS DOUBLE) AS amount_min,
          CAST(max(CAST(amount AS FLOAT)) AS DOUBLE) AS amount_max FROM transactions"""
    ),
)
def amount_range_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return amount_range(t.transactions(spark, sf_dir))


@query(
    "numeric_features",
    sql(
        """SELECT account_id, transaction_id, CAST(date AS VARCHAR) AS date,
          round((CAST(CAST(amount AS FLOAT) AS DOUBLE) - low) / (high - low), 6) AS scaled_amount,
          CAST(transaction_type = 'debit' AS DOUBLE) AS is_debit_transaction,
          CAST(coalesce(internal_transaction, '') <> '' AS DOUBLE) AS is_internal_transaction
        FROM transactions CROSS JOIN (
          SELECT CAST(min(CAST(amount AS FLOAT)) AS DOUBLE) AS low,
            CAST(max(CAST(amount AS FLOAT)) AS DOUBLE) AS high FROM transactions)"""
    ),
)
def numeric_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.transactions(spark, sf_dir)
    lines = t.read(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("amount"))
    featured = numeric_features(align_inputs(rows), AmountScale.fit(lines))
    return featured.select(
        "account_id", "transaction_id", F.col("date").cast("string").alias("date"),
        F.round("scaled_amount", 6).alias("scaled_amount"),
        "is_debit_transaction", "is_internal_transaction",
    )


@query(
    "align_inputs",
    sql(
        """SELECT account_id, transaction_id, CAST(date AS VARCHAR) AS date,
          coalesce(description, '') AS description, '' AS transaction_type,
          coalesce(internal_transaction, '') AS internal_transaction FROM transactions"""
    ),
)
def align_inputs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame without transaction types: the missing column gets its default."""
    rows = align_inputs(t.transactions(spark, sf_dir).drop("transaction_type"))
    return rows.select(
        "account_id", "transaction_id", F.col("date").cast("string").alias("date"),
        "description", "transaction_type", "internal_transaction",
    )


# --- vectors over the embeddings ------------------------------------------------------------

DIMENSIONS = 64
UNIT_SQL = "list_transform({v}, lambda component: component / sqrt(greatest(list_dot_product({v}, {v}), 1e-12)))"


def unit_sql(vector: str) -> str:
    return UNIT_SQL.replace("{v}", vector)


EMBEDDING_CTES = {
    "raw_vectors": "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings",
    "unit_vectors": f"SELECT vec_id, label, {unit_sql('v')} AS u FROM raw_vectors",
    "positions": """
        SELECT label, unnest(range(1, len(u) + 1)) AS i, unnest(u) AS x FROM unit_vectors""",
    "means": """
        SELECT label, list(m ORDER BY i) AS c
        FROM (SELECT label, i, avg(x) AS m FROM positions GROUP BY label, i) GROUP BY label""",
    "centroids": f"SELECT label, {unit_sql('c')} AS c FROM means",
    "sims": """
        SELECT vec_id, u.label AS true_label, c.label AS label, list_dot_product(u.u, c.c) AS s
        FROM unit_vectors u CROSS JOIN centroids c""",
}


def embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.read(spark, sf_dir, "embeddings")
    return fit_label_vectors(rows, "label", "embedding", vector_size(rows))


def vector_size(embeddings: DataFrame) -> int:
    """Components of the longest vector; a shorter one then raises where it is used."""
    return embeddings.agg(F.max(F.size("embedding"))).first()[0] or 0


def scored_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarities with all labels of the table in their order; ``label_id`` is the place of the own."""
    rows = t.read(spark, sf_dir, "embeddings")
    labels = known_labels(rows, "label")
    matrix = label_matrix(embedding_vectors(spark, sf_dir), "label", labels, vector_size(rows))
    place = F.array_position(F.lit(labels), F.col("label")).cast("int") - 1
    return with_similarities(rows, matrix, "embedding").withColumn("label_id", place)


@query(
    "label_centroids",
    sql(
        """SELECT label, CAST(unnest(range(len(c))) AS INTEGER) AS component,
          round(unnest(c), 6) AS value FROM centroids""",
        **EMBEDDING_CTES,
    ),
)
def label_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = embedding_vectors(spark, sf_dir).select(
        "label", F.posexplode("vector").alias("component", "value")
    )
    return rows.withColumn("value", F.round("value", 6))


@query(
    "similarity",
    sql("SELECT vec_id, label, round(s, 6) AS similarity FROM sims", **EMBEDDING_CTES),
)
def similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = known_labels(t.read(spark, sf_dir, "embeddings"), "label")
    rows = similarities_long(scored_embeddings(spark, sf_dir), labels, "vec_id")
    return rows.withColumn("similarity", F.round("similarity", 6))


@query(
    "label_moments",
    sql(
        """SELECT label, CAST(i - 1 AS INTEGER) AS i, -1 AS j, round(avg(x), 6) + 0.0 AS value
        FROM positions GROUP BY label, i
        UNION ALL
        SELECT NULL, CAST(i - 1 AS INTEGER), CAST(j - 1 AS INTEGER), round(avg(value), 6) + 0.0 FROM (
          SELECT label, i, j, avg(x * u[j]) AS value FROM (
            SELECT label, u, i, x, unnest(range(1, len(u) + 1)) AS j FROM (
              SELECT label, u, unnest(range(1, len(u) + 1)) AS i, unnest(u) AS x FROM unit_vectors))
          GROUP BY label, i, j) GROUP BY i, j""",
        **EMBEDDING_CTES,
    ),
)
def label_moments_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the least-squares directions are solved from."""
    rows = t.read(spark, sf_dir, "embeddings")
    found = label_moments(rows, "label", "embedding", vector_size(rows))
    return found.withColumn("value", F.round("value", 6) + F.lit(0.0))


@query(
    "vector_products",
    sql(
        """SELECT vec_id, round(list_dot_product(v, v), 6) AS squared_length,
          round(u[1], 6) AS first_component FROM raw_vectors JOIN unit_vectors USING (vec_id)""",
        **EMBEDDING_CTES,
    ),
)
def vector_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    vector = F.col("embedding")
    return t.read(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.round(dot(vector, vector), 6).alias("squared_length"),
        F.round(l2_normalize(vector)[0], 6).alias("first_component"),
    )


@query(
    "triplet_loss",
    sql(
        """SELECT round(avg(greatest(0.0, closest - positive + 0.1)), 6) AS triplet_loss
        FROM (SELECT n.vec_id, positive,
            max(CASE WHEN s < positive THEN s ELSE lowest END) AS closest
          FROM sims n JOIN rights USING (vec_id) WHERE label <> true_label GROUP BY ALL)""",
        **EMBEDDING_CTES,
        rights="""
          SELECT vec_id, max(CASE WHEN label = true_label THEN s END) AS positive,
            min(CASE WHEN label <> true_label THEN s END) AS lowest FROM sims GROUP BY vec_id""",
    ),
)
def triplet_loss_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    loss = triplet_loss(scored_embeddings(spark, sf_dir), "label_id")
    return loss.withColumn("triplet_loss", F.round("triplet_loss", 6))


RANK_CTES = {
    **EMBEDDING_CTES,
    "places": """
        SELECT vec_id, true_label, label, s,
          row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, label) AS place FROM sims""",
    "hits": """
        SELECT vec_id, place, label = true_label AS hit,
          sum(CAST(label = true_label AS INTEGER)) OVER (PARTITION BY vec_id ORDER BY place
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS found FROM places""",
    "ranks": """
        SELECT n.vec_id, count(*) AS rank FROM sims n JOIN sims p
          ON n.vec_id = p.vec_id AND p.label = p.true_label AND n.s >= p.s GROUP BY n.vec_id""",
}


@query(
    "mrr",
    sql("SELECT vec_id, round(1.0 / rank, 6) AS reciprocal_rank FROM ranks", **RANK_CTES),
)
def mrr(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = reciprocal_rank(F.col("similarities"), F.col("label_id"))
    return scored_embeddings(spark, sf_dir).select(
        "vec_id", F.round(rank, 6).alias("reciprocal_rank")
    )


@query(
    "recall_at_rank",
    sql(
        """SELECT vec_id, CAST(place AS INTEGER) AS rank, CAST(found AS DOUBLE) AS recall
        FROM hits WHERE place <= 4""",
        **RANK_CTES,
    ),
)
def recall_at_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = hits_by_rank(F.col("similarities"), F.col("label_id"))
    rows = scored_embeddings(spark, sf_dir).select(
        "vec_id", F.posexplode(hits).alias("position", "recall")
    )
    return rows.select("vec_id", (F.col("position") + 1).alias("rank"), "recall")


@query(
    "ranking_metrics",
    sql(
        """SELECT round(avg(1.0 / rank), 6) AS mean_reciprocal_rank,
          """
        + ", ".join(
            f"(SELECT round(avg(found), 6) FROM hits WHERE place = {i}) AS recall_at_{i}"
            for i in range(1, 5)
        )
        + " FROM ranks",
        "hits",
        **RANK_CTES,
    ),
)
def ranking_metrics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = ranking_metrics(scored_embeddings(spark, sf_dir), "similarities", "label_id")
    return metrics.select(*[F.round(c, 6).alias(c) for c in metrics.columns])


@query(
    "masked_mean",
    sql(
        f"""SELECT doc_id, CAST(i - 1 AS INTEGER) AS component,
          round(coalesce(value, 0.0), 6) AS value
        FROM (SELECT doc_id, unnest(range(1, {DIMENSIONS + 1})) AS i FROM documents)
        LEFT JOIN (
          SELECT doc_id, i, avg(x) AS value FROM doc_tokens
            JOIN (SELECT vec_id, unnest(range(1, {DIMENSIONS + 1})) AS i, unnest(v) AS x
                  FROM raw_vectors) ON vec_id = token
          GROUP BY doc_id, i) USING (doc_id, i)""",
        "raw_vectors",
        **token_ctes("documents", "text", "doc_id", 500),
        **EMBEDDING_CTES,
        doc_tokens="SELECT doc_id, token FROM (SELECT doc_id, unnest(ids) AS token FROM ids) "
        "WHERE token <> 0",
    ),
)
def masked_mean_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = 500
    rows = documents(spark, sf_dir).select(
        "doc_id", token_ids(F.col("text"), buckets=buckets).alias("token_ids")
    )
    table = t.read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("int").alias("token_id"), F.col("embedding").alias("vector")
    )
    means = masked_mean(rows, table, "doc_id", DIMENSIONS, vocabulary=buckets)
    exploded = means.select("doc_id", F.posexplode("vector").alias("component", "value"))
    return exploded.withColumn("value", F.round("value", 6))


# --- a model over the transactions ------------------------------------------------------------

A = [a for a, _ in hash_parameters(32)]
B = [b for _, b in hash_parameters(32)]
MODEL_CTES = {
    "example_keys": """
        SELECT user_id, account_id, transaction_id, date, category AS target_label
        FROM category_events
        UNION ALL
        SELECT user_id_hashed, account_id_hashed, transaction_id_hashed, date, transaction_label
        FROM label_events""",
    "scale": """
        SELECT CAST(min(CAST(amount AS FLOAT)) AS DOUBLE) AS low,
          CAST(max(CAST(amount AS FLOAT)) AS DOUBLE) AS high
        FROM example_keys JOIN transactions USING (user_id, account_id, transaction_id, date)""",
    "descriptions": "SELECT DISTINCT coalesce(description, '') AS description FROM transactions",
    **token_ctes("descriptions", "description", "description"),
    "texts": f"""
        SELECT description, list_transform(range(1, 33), lambda j: CASE WHEN len(tokens) = 0
            THEN 0.0 ELSE list_avg(list_transform(list_filter(ids, lambda t: t <> 0), lambda t:
              CASE WHEN (CAST(t AS BIGINT) * {sql_list(A)}[j] + {sql_list(B)}[j]) % {HASH_PRIME}
                < {HASH_PRIME // 2} THEN -1.0 ELSE 1.0 END)) END) AS v
        FROM ids""",
    "featured": """
        SELECT t.user_id, t.account_id, t.transaction_id, t.date,
          coalesce(t.description, '') AS description,
          CAST(transaction_type = 'debit' AS DOUBLE) AS is_debit,
          CAST(coalesce(internal_transaction, '') <> '' AS DOUBLE) AS is_internal,
          list_concat(CAST(v AS DOUBLE[]), [
            (CAST(CAST(amount AS FLOAT) AS DOUBLE) - low) / (high - low),
            CAST(transaction_type = 'debit' AS DOUBLE),
            CAST(coalesce(internal_transaction, '') <> '' AS DOUBLE)]) AS x
        FROM transactions t JOIN texts ON texts.description = coalesce(t.description, '')
          CROSS JOIN scale""",
    "vectors": f"SELECT *, {unit_sql('x')} AS u FROM featured",
    "label_means": """
        SELECT target_label AS label, list(m ORDER BY i) AS c FROM (
          SELECT target_label, i, avg(y) AS m FROM (
            SELECT target_label, unnest(range(1, 36)) AS i, unnest(u) AS y
            FROM example_keys JOIN vectors USING (user_id, account_id, transaction_id, date))
          GROUP BY target_label, i) GROUP BY target_label""",
    "label_vectors": f"SELECT label, {unit_sql('c')} AS c FROM label_means",
    "label_row": "SELECT " + ", ".join(
        f"(SELECT c FROM label_vectors WHERE label = '{label}') AS c{i}"
        for i, label in enumerate(TRANSACTION_LABELS)
    ),
    "scored": "SELECT vectors.*, " + ", ".join(
        f"coalesce(list_dot_product(u, c{i}), 0.0) AS s{i}" for i in range(8)
    ) + " FROM vectors CROSS JOIN label_row",
    "ruled": "SELECT * EXCLUDE (" + ", ".join(f"s{i}" for i in range(8)) + "), " + ", ".join(
        "CASE "
        + " ".join(
            f"WHEN {'is_debit' if r.feature == 'is_debit_transaction' else 'is_internal'} = 1.0 "
            "THEN -1.0"
            for r in SIMILARITY_RULES if r.label == label
        )
        + f" ELSE s{i} END AS s{i}"
        for i, label in enumerate(TRANSACTION_LABELS)
    ) + " FROM scored",
    # Every pair is (Salary, other): the closed form of taking the pairs one by one.
    "eliminated": "SELECT * EXCLUDE (" + ", ".join(f"s{i}" for i in range(8)) + "), "
    + f"CASE WHEN s0 < greatest({', '.join(f's{i}' for i in range(1, 8))}) THEN -1.0 ELSE s0 END AS s0, "
    + ", ".join(
        f"CASE WHEN s{i} < s0"
        + "".join(f" AND s{j} <= s0" for j in range(1, i))
        + f" THEN -1.0 ELSE s{i} END AS s{i}"
        for i in range(1, 8)
    ) + " FROM ruled",
    "flagged": "SELECT *, [" + ", ".join(
        f"CAST(s{i} >= 0.55 AS INTEGER)" for i in range(8)
    ) + "] AS flags FROM eliminated",
    "labelled_lines": f"""
        SELECT *, list_filter(list_transform(range(1, 9), lambda i: CASE WHEN flags[i] = 1
          THEN {sql_list(TRANSACTION_LABELS)}[i] END), lambda l: l IS NOT NULL) AS labels
        FROM flagged""",
}
LINE_SQL = "account_id, transaction_id, CAST(date AS VARCHAR) AS date"


def line() -> list:
    return ["account_id", "transaction_id", F.col("date").cast("string").alias("date")]


def model(spark: SparkSession, sf_dir: str) -> LabelModel:
    """Compared by mean vectors, which SQL can repeat."""
    return LabelModel.fit(t.examples(spark, sf_dir), method="mean")


def suppressed_sql(table: str) -> str:
    return (
        f"SELECT {LINE_SQL}, array_to_string(list_filter([" + ", ".join(
            f"CASE WHEN s{i} = -1.0 THEN '{label}' END"
            for i, label in enumerate(TRANSACTION_LABELS)
        ) + f"], lambda l: l IS NOT NULL), ',') AS suppressed FROM {table}"
    )


def suppressed(similarities: Column) -> Column:
    entries = [
        F.when(similarities[TRAINING_LABELS.index(label)] == -1.0, F.lit(label))
        for label in TRANSACTION_LABELS
    ]
    return F.array_join(F.array(*entries), ",").alias("suppressed")


@query(
    "transaction_vectors",
    sql(
        f"""SELECT {LINE_SQL}, round(u[1], 6) AS first_text, round(u[32], 6) AS last_text,
          round(u[33], 6) AS amount_part, round(u[34], 6) AS debit_part,
          round(u[35], 6) AS internal_part, round(list_sum(u), 6) AS total FROM vectors""",
        **MODEL_CTES,
    ),
)
def transaction_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    scale = AmountScale.fit(t.examples(spark, sf_dir))
    rows = with_transaction_vector(with_features(t.transactions(spark, sf_dir), scale))
    vector = F.col("vector")
    total = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x)
    parts = {
        "first_text": vector[0], "last_text": vector[31], "amount_part": vector[32],
        "debit_part": vector[33], "internal_part": vector[34], "total": total,
    }
    return rows.select(*line(), *[F.round(v, 6).alias(name) for name, v in parts.items()])


@query(
    "transaction_label_similarities",
    sql(
        f"SELECT {LINE_SQL}, "
        + ", ".join(f"round(s{i}, 6) AS s{i}" for i in range(8))
        + " FROM scored",
        **MODEL_CTES,
    ),
)
def transaction_label_similarities_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = model(spark, sf_dir).similarities(t.transactions(spark, sf_dir))
    part = transaction_label_similarities(F.col("similarities"))
    return scored.withColumn("part", part).select(
        *line(), *[F.round(F.col("part")[i], 6).alias(f"s{i}") for i in range(8)]
    )


@query("business_rules", sql(suppressed_sql("ruled"), **MODEL_CTES))
def business_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = model(spark, sf_dir).similarities(t.transactions(spark, sf_dir))
    return apply_similarity_rules(scored).select(*line(), suppressed(F.col("similarities")))


@query("label_elimination", sql(suppressed_sql("eliminated"), **MODEL_CTES))
def label_elimination(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = model(spark, sf_dir).similarities(t.transactions(spark, sf_dir))
    rows = eliminate_conflicts(apply_similarity_rules(scored))
    return rows.select(*line(), suppressed(F.col("similarities")))


@query(
    "indicators",
    sql(
        f"SELECT {LINE_SQL}, array_to_string(flags, '') AS flags FROM flagged",
        **MODEL_CTES,
    ),
)
def indicators_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = model(spark, sf_dir).indicators(t.transactions(spark, sf_dir))
    flags = F.array_join(F.col("predicted").cast("array<string>"), "")
    return rows.select(*line(), flags.alias("flags"))


@query(
    "label_sets",
    sql(
        f"SELECT {LINE_SQL}, array_to_string(labels, ',') AS labels FROM labelled_lines",
        **MODEL_CTES,
    ),
)
def label_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity and conflict rules, then threshold and label names."""
    scored = model(spark, sf_dir).similarities(t.transactions(spark, sf_dir))
    flags = indicators(F.col("similarities"))
    rows = eliminate_conflicts(apply_similarity_rules(scored)).withColumn("flags", flags)
    return rows.select(*line(), F.array_join(label_set(F.col("flags")), ",").alias("labels"))


# --- tax labels and test descriptions ---------------------------------------------------------

QUERY_TAX_RULES = [
    TaxRule("NL", "Ring_tax", (("description", "ring"), ("transaction_type", "^debit$"))),
    TaxRule("NL", "Bolt_tax", (("description", "bolt"),)),
    TaxRule("GB", "Ring_tax", (("description", "ring"),)),
    TaxRule("GB", "Rod_tax", (("description", r"\brod\b"), ("internal_transaction", "^own"))),
]


def tax_sql(country: str) -> str:
    """First rule that fits, by country."""
    cases = " ".join(
        "WHEN "
        + " AND ".join(
            f"regexp_matches(coalesce({c}, ''), '{p}')" for c, p in rule.patterns
        )
        + f" THEN 'Tax_{country.lower()}_{rule.label.lower()}'"
        for rule in QUERY_TAX_RULES if rule.country_code == country
    )
    return (
        f"CASE WHEN coalesce(country_code, '') IN ('{country}', '') THEN CASE {cases} END END"
    )


@query(
    "tax_labels",
    sql(
        f"""SELECT {LINE_SQL}, country_code,
          array_to_string(list_filter([{tax_sql('NL')}, {tax_sql('GB')}],
            lambda l: l IS NOT NULL), ',') AS labels
        FROM (SELECT t.* EXCLUDE (user_id_hashed), coalesce(country_code, '') AS country_code
              FROM transactions t JOIN users u ON t.user_id = u.user_id_hashed)""",
        "transactions", "users",
    ),
)
def tax_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.transactions(spark, sf_dir).join(t.users(spark, sf_dir), "user_id_hashed")
    empty = F.array().cast("array<string>")
    tagged = add_tax_labels(rows.withColumn("labels", empty), QUERY_TAX_RULES)
    return tagged.select(*line(), "country_code", F.array_join("labels", ",").alias("labels"))


@query(
    "test_mode_labels",
    """SELECT doc_id, array_to_string(list_sort(list_distinct(CASE WHEN starts_with(text, 'The')
        THEN regexp_extract_all(text, '([A-Z][a-z_]+)', 1) ELSE [lang] END)), ',') AS labels
    FROM documents""",
)
def test_mode_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select(
        "doc_id", F.col("text").alias("description"), F.array("lang").alias("labels")
    )
    tagged = apply_test_descriptions(rows, "The")
    return tagged.select("doc_id", F.array_join(F.array_sort("labels"), ",").alias("labels"))


@query(
    "label_rule_chain",
    sql(
        f"""SELECT {LINE_SQL}, array_to_string(list_sort(CASE WHEN starts_with(description, 'red')
            THEN list_distinct(regexp_extract_all(description, '([A-Z][a-z_]+)', 1))
            ELSE list_filter(['Base', {tax_sql('NL')}, {tax_sql('GB')}],
              lambda l: l IS NOT NULL) END), ',') AS labels
        FROM (SELECT account_id, transaction_id, date, internal_transaction, transaction_type,
                coalesce(description, '') AS description, NULL AS country_code
              FROM transactions)"""
    ),
)
def label_rule_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames without any country: the rules of all countries apply."""
    rows = t.transactions(spark, sf_dir).withColumn("labels", F.array(F.lit("Base")))
    tagged = apply_label_rules(rows, QUERY_TAX_RULES, "red")
    return tagged.select(*line(), F.array_join(F.array_sort("labels"), ",").alias("labels"))


@query(
    "predict",
    sql(
        f"""SELECT {LINE_SQL}, array_to_string(list_sort(
            CASE WHEN starts_with(description, 'red')
              THEN list_distinct(regexp_extract_all(description, '([A-Z][a-z_]+)', 1))
            ELSE list_filter(list_concat(labels, [{tax_sql('NL')}, {tax_sql('GB')}]),
              lambda l: l IS NOT NULL) END), ',') AS labels
        FROM (SELECT l.account_id, l.transaction_id, l.date, l.description, labels, country_code,
                internal_transaction, transaction_type
              FROM labelled_lines l JOIN transactions t
                USING (user_id, account_id, transaction_id, date)
              JOIN users ON users.user_id_hashed = user_id)""",
        "labelled_lines", "users",
        **MODEL_CTES,
    ),
)
def predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = model(spark, sf_dir)
    rows = t.transactions(spark, sf_dir).join(t.users(spark, sf_dir), "user_id_hashed")
    labelled = fitted.predict(
        rows, QUERY_TAX_RULES, "red", keep=["account_id", "transaction_id", "date"]
    )
    return labelled.select(*line(), F.array_join(F.array_sort("labels"), ",").alias("labels"))


@query("predict_ridge")
def predict_ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compared by least-squares directions over tokens seen in training. SQL can't solve for them."""
    fitted = LabelModel.fit(t.examples(spark, sf_dir))
    rows = t.transactions(spark, sf_dir).join(t.users(spark, sf_dir), "user_id_hashed")
    labelled = fitted.predict(
        rows, QUERY_TAX_RULES, "red", keep=["account_id", "transaction_id", "date"]
    )
    return labelled.select(*line(), F.array_join(F.array_sort("labels"), ",").alias("labels"))
