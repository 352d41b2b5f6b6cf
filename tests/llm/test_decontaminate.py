import re

import pytest

from ledgertag.llm import decontaminate

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, spans string, row_a int"


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


@pytest.fixture(scope="module")
def tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    items += [(900, "the of"), (901, ""), (902, None), (903, items[0][1]), (904, "Zz qq"), (905, "erha")]
    docs += [
        (5001, None), (5002, ""), (5003, "zz  QQ zz qq!zz"), (5003, "other"), (5003, "other"),
        (None, items[1][1]), (5004, "x " + items[2][1].upper() + " y"), (5005, "é " * 20_000 + items[3][1]),
    ]
    return docs, items


def test_same_as_brute_force(spark, tables):
    docs, items = tables
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(10, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(str(item))
    want = []
    for doc, text in docs:
        w, found = words(text), set()
        hit = [0] * len(w)
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                if own := windows.get(tuple(w[k : k + size])):
                    found |= own
                    hit[k : k + size] = [1] * size
        want.append((doc, len(w), sum(hit), sorted(found)))
    frame = spark.createDataFrame([(*d, "s", 1) for d in docs], SCHEMA).repartition(4)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    result = decontaminate.contamination(frame, benchmark).select("doc_id", "n_words", "n_hit", "items")
    assert sorted((tuple(r) for r in result.collect()), key=repr) == sorted(want, key=repr)
    clean = decontaminate.clean_documents(frame, benchmark)
    assert clean.columns == frame.columns
    assert sorted((r.doc_id for r in clean.collect()), key=repr) == sorted(
        (w[0] for w in want if not w[2]), key=repr
    )


def test_empty_tables(spark, tables):
    docs, items = tables
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b", "s", 1)], SCHEMA)
    assert [r.n_hit for r in decontaminate.contamination(some, none).collect()] == [0]
    empty = spark.createDataFrame([], SCHEMA)
    assert decontaminate.contamination(empty, spark.createDataFrame(items, none.schema)).count() == 0
