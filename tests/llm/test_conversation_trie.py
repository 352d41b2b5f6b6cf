import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgertag.llm import conversation_trie, queries

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string, position long, ids string"
NAMES = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def brute_trie(paths):
    """Nodes from whole paths, {conv_id: [(role, text), ...]}, by plain dictionaries."""
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    found, totals = [], {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        below = [totals[x] for x in children.get(node, [])]
        totals[node] = (sum(x[0] for x in below) or 1, own + sum(x[1] for x in below))
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in who if len(paths[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        found.append((
            min(who), len(node), parent, len(who), len(children.get(node, [])), *totals[node],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(found, key=repr)


def originals(rows):
    by_conv = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            by_conv.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(turns)] for c, turns in by_conv.items()}


def rebuilt(rows):
    own = originals(rows)
    out = {}
    for c, path in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + path[h:]
    return out


def query(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op11_conversation_burst_trie(spark, str(tmp_path))
    assert found.columns == NAMES
    return sorted((tuple(r) for r in found.collect()), key=repr)


def conversations():
    rng = np.random.default_rng(7)
    rows = []
    for c in [*range(0, 40), *range(100, 160), 205, 300, 301, 302, 1_000_000_007]:
        for turn in range(int(rng.integers(1, 9))):
            text = ["hello", "wörld 😀", "", None, f"t{c}"][int(rng.integers(0, 5))]
            rows.append((c, turn, [None, "user", "assistant"][turn % 3], text, 1, "x"))
    rows += [(400 + k, t, "user", f"copy {t}", None, None) for k in range(60) for t in range(7)]
    rows += [(500, t, "user", f"long {t % 3}", None, None) for t in range(1500)]
    rows += [(500 + k, t, "user", f"long {t % 3}", None, None) for k in (3, 8) for t in range(1400)]
    rows += [(None, 1, "user", "lost", 1, "x"), (0, None, "user", "first of all", 1, "x"), (0, None, "user", "first of all", 1, "x")]
    return rows


def test_query_equals_brute_force(spark, tmp_path):
    rows = conversations()
    assert query(spark, rows, tmp_path) == brute_trie(rebuilt(rows))


@pytest.mark.parametrize("rows", [[], [(None, 1, "a", "b", 1, "")]])
def test_nothing(spark, tmp_path, rows):
    assert query(spark, rows, tmp_path) == []


def test_turnless_only(spark, tmp_path):
    # 101 has no base, and its first turns give way to nothing.
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)
    empty = hashlib.sha256(str(c).encode()).hexdigest()
    assert query(spark, [(c, 1, "u", "x", 1, ""), (c, 2, "u", "y", 1, "")], tmp_path) == [(c, 0, None, 1, 0, 1, 0, empty)]


def paths_of(kind):
    rng = np.random.default_rng(11)
    if kind == "random":
        return {c: [("r", "abc"[int(x)]) for x in rng.integers(0, 2, rng.integers(0, 10))] for c in range(150)}
    if kind == "chain":  # every path goes on where another one ends
        return {c: [("r", str(d)) for d in range(c % 23)] for c in range(60)}
    if kind == "copies":
        return {c: [("r", "same")] * 9 for c in range(50)} | {100: [("r", "same")] * 12, 101: []}
    if kind == "comb":  # a common beginning, then all different
        return {c: [("r", "head")] * 11 + [("u", str(c % 30))] * (c % 4) for c in range(90)}
    return {}


CASES = [
    ("random", 512, 65536, 16), ("random", 512, 12, 2), ("chain", 512, 12, 2), ("comb", 512, 12, 2), ("random", 4, 10, 3),
    ("copies", 4, 10, 3), ("chain", 1, 3, 1), ("comb", 3, 100, 16), ("none", 512, 65536, 16),
]


@pytest.mark.parametrize("kind, piece, limit, levels", CASES)
def test_parameters_change_nothing(spark, kind, piece, limit, levels):
    paths = paths_of(kind)
    data = [(c, t, role, text) for c, path in paths.items() for t, (role, text) in enumerate(path)]
    frame = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    turns = conversation_trie.numbered_turns(frame)
    convs = spark.createDataFrame([(c,) for c in paths], "conv_id long")
    nodes, members = conversation_trie.trie(turns, convs, piece, limit, levels)
    digests = {r[0]: r[1] for r in conversation_trie.member_digests(members).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    found = [(*r[:7], digests[r["ending"]] if r["ending"] is not None else empty) for r in nodes.collect()]
    assert sorted(found, key=repr) == brute_trie(paths)


def test_numbers_run_through_borders_of_tasks(spark):
    # One conversation has most of the rows, so it lies in many tasks.
    frame = spark.range(4000).select(
        F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(F.lit(5)).alias("conv_id"),
        F.when(F.col("id") == 77, None).otherwise(5000 - F.col("id")).alias("turn"),
        F.lit("u").alias("role"), F.col("id").cast("string").alias("text"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    found = conversation_trie.numbered_turns(frame)
    assert {r["n"] for r in found.groupBy("conv_id").agg(F.count("*").alias("n")).where("conv_id = 5").collect()} == {3600}
    numbers = sorted(r["position"] for r in found.where("conv_id = 5").collect())
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert numbers == list(range(1, 3601))
    first = found.where("conv_id = 5 and position = 1").first()
    wanted = frame.where("text = '77'").select(F.xxhash64("role", "text")).first()[0]
    assert first["a"] == wanted


def test_sql_twin(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    rows = con.execute(queries.SQL["op11_conversation_burst_trie"])
    assert [d[0] for d in rows.description] == NAMES
    wanted = sorted((tuple(r) for r in rows.fetchall()), key=repr)
    found = queries.op11_conversation_burst_trie(spark, SF).collect()
    assert sorted((tuple(r) for r in found), key=repr) == wanted


def test_digest_of_many_members(spark):
    ids = list(range(0, 60_000, 2))
    members = spark.createDataFrame([(i, 0) for i in ids], "conv_id long, conv long").repartition(7)
    found = conversation_trie.member_digests(members).collect()
    assert [tuple(r) for r in found] == [(0, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())]
