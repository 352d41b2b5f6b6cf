import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgertag.llm import quality, queries

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, good string, score string"
LABELS = "doc_id long, quality int, toxic int, text string"


def corpus(n=240):
    rng = np.random.default_rng(5)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(list("abcdefgé"), rng.integers(2, 8))) for _ in range(rng.integers(5, 60))]
        if i % 3 == 0:
            words = [w + "$$$" for w in words] if i % 2 else [w for w in words for _ in range(4)]
        docs.append((i, " ".join(words) + ".", "en", "s", 1, "g", "s"))
        labels.append((i, int(i % 3 != 0), 0, "t"))
    return docs, labels


def table(spark, docs, labels, tmp_path):
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    return queries.op12_bradley_terry_quality(spark, str(tmp_path))


def test_held_out_accuracy(spark):
    found = queries.op12_bradley_terry_quality(spark, SF)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in rows)
    assert len(rows) > 50 and right / len(rows) >= 0.95
    all_rows = found.collect()
    assert len(all_rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in all_rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_labels_of_held_out_rows_and_other_columns_are_not_used(spark, tmp_path):
    docs, labels = corpus()
    first = {r["doc_id"]: r["score"] for r in table(spark, docs, labels, tmp_path / "a").collect()}
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i in range(len(docs))]
    turned = [(i, 1 - q if held[i] else q, *rest) for i, q, *rest in labels]
    other = [(d[0], d[1], "xx", f"src{d[0] % 3}", None, None, None) for d in docs]
    second = {r["doc_id"]: r["score"] for r in table(spark, other, turned, tmp_path / "b").collect()}
    assert first.keys() == second.keys()
    assert max(abs(first[k] - second[k]) for k in first) < 1e-6


def test_odd_rows(spark, tmp_path):
    docs, labels = corpus(60)
    text = docs[1][1]
    docs += [
        (100, None, None, None, None, None, None), (101, "", None, None, None, None, None),
        (102, " \n\t", None, None, None, None, None), (None, text, None, None, None, None, None),
        (1, text, "en", "s", 1, "g", "s"), (103, "word " * 300_000, None, None, None, None, None),
        (104, "x" * 1_000_000, None, None, None, None, None),
    ]
    labels += [(1, 1, 0, ""), (1, 0, 0, ""), (None, 1, 0, ""), (100, None, 0, ""), (999, 1, 0, "")]
    rows = table(spark, docs, labels, tmp_path).collect()
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 for r in rows)
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert by_id[None][0]["held_out"] is False
    assert len(by_id[1]) == 2 and len({r["score"] for r in by_id[1] + by_id[None]}) == 1
    assert len({by_id[k][0]["score"] for k in (100, 101, 102)}) == 1
    assert by_id[103][0]["predicted"] == 0


@pytest.mark.parametrize("kept", [[], [0, 3], [1, 2]])
def test_without_rows_of_both_kinds_scores_are_equal(spark, tmp_path, kept):
    docs, labels = corpus(12)
    found = table(spark, docs, [labels[i] for i in kept], tmp_path).collect()
    assert len(found) == 12 and len({r["score"] for r in found}) == 1


def test_empty_table(spark, tmp_path):
    assert table(spark, [], [], tmp_path).collect() == []


def test_features_by_hand():
    names, found = quality.features(pa.array(["Ab cd. Ab, the the the the\nWOW!! YES!! NO!!", None, "é é"]))
    value = dict(zip(names, found.T, strict=True))
    assert names == quality.NAMES and (found[1] == 0).all() and np.isfinite(found).all()
    assert value["capitals"][0] == 3 / 10 and value["repeats"].tolist() == [3 / 10, 0, 1 / 2]
    assert value["repeats twice"][0] == 2 / 10 and value["ends with comma"][0] == 1 / 10
    assert value["ends with stop"][0] == 4 / 10 and value["one capital"][0] == 2 / 10
    assert value["lines: capitals"][0] == 1 / 2 and value["any line: repeats"][0] == 1
    assert value["lower"][0] == 16 / 43 and value["high"][2] == 4 / 5
    assert value["distinct words"][0] == pytest.approx(7 / (10 * 10**0.5))
    # Each text on its own, whatever its neighbours are.
    alone = [quality.features(pa.array([t]))[1][0] for t in ("é é", "x")]
    together = quality.features(pa.array(["é é", "x"]))[1]
    assert np.array_equal(alone, together)


@pytest.mark.parametrize("n_good, n_bad, partners", [(7, 3, 4), (3, 7, 4), (5, 5, 9), (1, 4, 16), (0, 3, 2), (2, 0, 2)])
def test_pairs(spark, n_good, n_bad, partners):
    data = [(i, True, [float(i)]) for i in range(n_good)] + [(100 + i, False, [1000.0 * (i + 1)]) for i in range(n_bad)]
    rows = spark.createDataFrame(data, "doc_id long, good boolean, _features array<double>")
    found = [r[0][0] for r in quality.preference_pairs(rows, partners).collect()]
    rare, many = min(n_good, n_bad), max(n_good, n_bad)
    # Good minus bad; different partners for each row of the rarer kind.
    assert len(found) == len(set(found)) == rare * min(partners, many)
    assert all(x < 0 for x in found)
    met = {}
    for x in found:
        bad = -(x // 1000) * 1000
        own = x + bad if n_good >= n_bad else bad
        met[own] = met.get(own, 0) + 1
    assert not met or max(met.values()) - min(met.values()) <= 1 or len(met) < many


def test_weights_are_the_minimum_of_the_loss(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0.4, 1, (400, 3))
    pairs = spark.createDataFrame([(v.tolist(),) for v in x], "difference array<double>").repartition(3)
    w = quality._bradley_terry(pairs, np.ones(3))

    def loss(w):
        return np.log1p(np.exp(-(x @ w))).mean() + quality.RIDGE / 2 * (w @ w)

    assert loss(w) < loss(np.zeros(3))
    for d in range(3):
        for step in (-1e-2, 1e-2):
            assert loss(w) < loss(w + step * np.eye(3)[d])


def test_share_by_quantile(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, DOCS)
    model = quality.fit(frame, spark.createDataFrame(labels, LABELS), F.lit(True))
    best = quality.best_documents(frame, model, 0.5)
    assert best.columns == frame.columns
    kept = {r["doc_id"] for r in best.collect()}
    assert abs(len(kept) - 120) <= 2 and not any(i % 3 == 0 for i in kept)
    assert quality.best_documents(frame, model, 1.0).count() == len(docs)
    assert quality.best_documents(frame.where("false"), model, 0.5).count() == 0
    with pytest.raises(ValueError, match="share"):
        quality.best_documents(frame, model, 0)


def test_sample_of_labels_is_bounded(spark):
    labels = spark.createDataFrame([(i, i % 2, 0, "") for i in range(4000)], LABELS)
    found = quality.training_rows(labels, F.lit(True), 1000)
    assert 850 < found.count() < 1150
