import hashlib
import re

import pytest

from ledgertag.llm import substring

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, kept string, blocks int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_force(docs, window):
    rank = lambda i: 1 << 62 if i is None else i
    first = {}
    for doc, text in docs:
        w = words(text)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, 1 << 63), rank(doc))
    out = []
    for doc, text in docs:
        w = words(text)
        gone = [0] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < rank(doc):
                gone[k : k + window] = [1] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


@pytest.mark.parametrize("window", [13, 3])
def test_same_as_brute_force(spark, window):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    docs += [
        (5001, None), (5002, ""), (5003, docs[3][1]), (5003, docs[3][1]), (None, docs[4][1]), (None, docs[4][1]),
        (5004, "x " * 30_000), (5005, "x " * 20), (5006, " \n é "), (5007, " ".join(docs[5][1].split()[5:40]) + " zz"),
        (5008, "a b c d e f g h i j k l m"), (5009, "0 a b c d e f g h i j k l m n"),
    ]
    frame = spark.createDataFrame([(*d, "k", 1) for d in docs], SCHEMA).repartition(5)
    found = [tuple(r) for r in substring.deduplicate(frame, window, keep_text=True).collect()]
    assert sorted(found, key=repr) == sorted(brute_force(docs, window), key=repr)


def test_empty_table_and_wrong_windows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert substring.deduplicate(empty).count() == 0
    with pytest.raises(ValueError):
        substring.deduplicate(empty, 12)
