"""One query for each operator, over its whole table, with the digest columns agreed for it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ledgertag.llm import (
    conversation_trie,
    decontaminate,
    grid_join,
    licenses,
    packing,
    quality,
    secret_scan,
    separators,
    simhash,
    substring,
    toxicity,
    training_order,
    vector_codes,
)
from ledgertag.llm.storage import stage
from ledgertag.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of the shards, a row for each sequence of all documents."""
    return training_order.materialize(table(spark, sf_dir, "documents"))


def op2_randomness_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in secret_scan.KINDS[:3]),
        F.sha2("base_text", 256).alias("base_sha256"),
        F.col("spans_text").alias("spans"),
    )


def op3_grid_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.linked(table(spark, sf_dir, "embeddings"))


def op4_clause_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trained = toxicity.in_training(F.col("doc_id"))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), trained)
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id",
        F.coalesce(~trained, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op5_fixed_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.deduplicate(table(spark, sf_dir, "documents"))


def op6_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in the flat files that all documents are written to."""
    folder = scratch_path(spark, "flat")
    written = separators.write_flat(table(spark, sf_dir, "documents"), folder)
    places = stage(written, "places")
    counts = separators.token_counts(spark, folder)
    return places.join(counts, ["file", "number"]).select("doc_id", "n_tokens")


def op8_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan(table(spark, sf_dir, "documents")))


def op9_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.packed(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered turns of the conversations as the contract rebuilds them, and all conversations.

    The first h turns come from the conversation that the hundred begins with, up to 5 of them.
    """
    c = F.col("conv_id")
    h = F.crc32(c.cast("string").cast("binary")) % 6
    turn = F.struct("position", "a", "b", "size")
    heads = turns.where((c % 100 == 0) & (F.col("position") <= 5)).groupBy(c.alias("base"))
    heads = heads.agg(F.array_sort(F.collect_list(turn)).alias("head"))
    own = turns.select("conv_id").distinct().withColumn("base", c - c % 100)
    lead = F.coalesce(F.slice("head", 1, h.cast("int")), F.array().cast(heads.schema["head"].dataType))
    own = stage(own.join(heads, "base", "left").select("conv_id", lead.alias("lead")), "leads")
    first = own.select("conv_id", F.explode("lead").alias("turn")).select("conv_id", "turn.*")
    later = turns.where(F.col("position") > h).join(own.select("conv_id", F.size("lead").alias("n")), "conv_id")
    later = later.select("conv_id", (F.col("position") - h + F.col("n")).alias("position"), "a", "b", "size")
    return first.unionByName(later), own.select("conv_id")


def op11_conversation_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.numbered_turns(table(spark, sf_dir, "conversations"))
    nodes, members = conversation_trie.trie(*rebuilt(turns))
    nodes = stage(nodes, "trie")
    digests = conversation_trie.member_digests(members)
    # Nodes where nothing ends need no partner, and would all meet in one task as nulls.
    ended = nodes.where("ending is not null").join(digests, F.col("ending") == F.col("conv"))
    passed = nodes.where("ending is null").withColumn("ends_sha256", F.sha2(F.lit(""), 256))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves"]
    return ended.select(*nodes.columns, "ends_sha256").unionByName(passed).select(
        *names, F.col("saved").alias("saved_tokens"), "ends_sha256"
    )


def op12_bradley_terry_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trained = quality.in_training(F.col("doc_id"))
    model = quality.fit(docs, table(spark, sf_dir, "labels"), trained)
    return quality.score(docs, model, keep=["doc_id"]).select(
        "doc_id",
        F.coalesce(~trained, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op13_slice_intersect_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    digits = [F.lpad(F.lower(F.hex(F.col("codes")[p])), 2, "0") for p in range(vector_codes.PARTS)]
    return coded.select(
        "vec_id",
        F.concat(*digits).alias("code"),
        "error",
        "label_error",
        F.lit(books.sha256).alias("codebooks_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_training_order": op1_training_order,
    "op2_randomness_tests": op2_randomness_tests,
    "op3_grid_order_join": op3_grid_order_join,
    "op4_clause_grammar": op4_clause_grammar,
    "op5_fixed_block_anchors": op5_fixed_block_anchors,
    "op6_covering_simhash": op6_covering_simhash,
    "op7_separator_scan": op7_separator_scan,
    "op8_license_dice": op8_license_dice,
    "op9_sum_of_squares_packing": op9_sum_of_squares_packing,
    "op10_winnowing": op10_winnowing,
    "op11_conversation_burst_trie": op11_conversation_burst_trie,
    "op12_bradley_terry_quality": op12_bradley_terry_quality,
    "op13_slice_intersect_codes": op13_slice_intersect_codes,
    "pipeline": corpus_pipeline.run,
}
# DuckDB has no crc32, so its bits are shifted one by one: each byte is followed by eight steps.
TRIE_SQL = """
with ids as (
  select conv_id, conv_id - conv_id % 100 as base,
    xor(list_reduce(
      list_concat([4294967295::bigint], flatten(list_transform(
        string_split(conv_id::varchar, ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda crc, x: case when x >= 0 then xor(crc, x) else xor(crc >> 1, (crc & 1) * 3988292384) end
    ), 4294967295::bigint) % 6 as h
  from (select distinct conv_id from conversations where conv_id is not null)
), own as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, role, text) as position
  from conversations where conv_id is not null
), turns as (
  select i.conv_id, o.position, o.role, o.text from ids i join own o on o.conv_id = i.base and o.position <= i.h
  union all
  select i.conv_id, o.position + 1000000, o.role, o.text
  from ids i join own o on o.conv_id = i.conv_id and o.position > i.h
), paths as (
  select conv_id, row_number() over w as depth, length(text) as size,
    list({'role': role, 'text': text}) over (w rows between unbounded preceding and current row) as path
  from turns window w as (partition by conv_id order by position)
  union all
  select conv_id, 0, 0, [] from ids
), lengths as (
  select conv_id, max(depth) as depth from paths group by all
), nodes as (
  select path, p.depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(size) as size,
    coalesce(string_agg(case when l.depth = p.depth then conv_id::varchar end, ',' order by conv_id), '') as ends
  from paths p join lengths l using (conv_id)
  group by path, p.depth
), ways as (
  select p.conv_id, p.depth, n.conv_id as node
  from paths p join nodes n on n.depth = p.depth and n.path = p.path
), links as (
  select n.*, w.node as parent_conv_id from nodes n left join ways w on w.conv_id = n.conv_id and w.depth = n.depth - 1
), children as (
  select parent_conv_id as conv_id, depth - 1 as depth, count(*) as n_children from links where depth > 0 group by all
), counted as (
  select l.*, coalesce(c.n_children, 0) as n_children from links l left join children c using (conv_id, depth)
), subtrees as (
  select w.node as conv_id, w.depth, sum((c.n_children = 0)::int) as n_leaves, sum((c.n_convs - 1) * c.size) as saved_tokens
  from counted c join ways w on w.conv_id = c.conv_id and w.depth <= c.depth
  group by all
)
select conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves::bigint as n_leaves,
  saved_tokens::bigint as saved_tokens, sha256(ends) as ends_sha256
from counted join subtrees using (conv_id, depth)
"""

SQL: dict[str, str] = {"op11_conversation_burst_trie": TRIE_SQL}
