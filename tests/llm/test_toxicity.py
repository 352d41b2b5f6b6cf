import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgertag.llm import toxicity as tox
from ledgertag.llm.storage import smallest

SF_DIR = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, score string, toxic int, outcomes int"
NO_TERMS = ({}, np.zeros(0, np.uint64))


def counts(text):
    return dict(
        zip(tox.OUTCOMES, tox.text_outcomes(pa.array([text]), tox.Lexicon(*NO_TERMS), tox.grammar())[0], strict=True)
    )


@pytest.mark.parametrize(
    "text, outcome",
    [
        ("What an IDIOT.", "insult"),
        ("You are an idiot.", "targeted insult"),
        ("I will kill you", "targeted threat"),
        ("I will kill, he wrote", "targeted threat"),
        ("kill him now", "targeted threat"),
        ("idiot that you are", "targeted insult"),
        ("Ich werde dir nicht sagen: umbringen", "threat"),
        ("frapper te", "targeted threat"),
        ("Fear to kill", "threat"),
        ("You are not only an idiot.", "targeted insult"),
        ("Du bist nicht nur ein idiot", "targeted insult"),
        ("Only an idiot", "insult"),
        ("You are not an only idiot", "negated"),
        ("They will hurt them", "targeted threat"),
        ("You are not an idiot.", "negated"),
        ("She said he is an idiot.", "reported"),
    ],
)
def test_a_match_has_the_outcome_of_its_clause(text, outcome):
    found = counts(text)
    assert found.pop(outcome) == 1
    assert not any(found.values())


def test_negation_and_reports_end():
    assert counts("not one two three idiot")["insult"] == 1
    assert counts("He said so. An idiot!")["insult"] == 1
    assert counts("you. idiot")["insult"] == 1
    assert not any(counts("A fine day").values())


def test_composition_equals_one_after_the_other():
    rng = np.random.default_rng(1)
    whole = tox.grammar()
    for _ in range(300):
        clause = rng.integers(0, 7, 12).tolist()
        symbols = clause
        for machine, way in ((tox.negation(), 1), (tox.reported(), 1), (tox.targeted(), 1), (tox.targeted(), -1)):
            state, out = machine.start, []
            for s in symbols[::way]:
                state, o = machine.step(state, s)
                out.append(o)
            symbols = out[::way]
        want = [0] * len(tox.OUTCOMES)
        for s in symbols:
            if s in tox.OUTCOME_OF:
                want[tox.OUTCOME_OF[s]] += 1
        assert tox.outcomes(whole, clause) == want


def test_all_matches_count_and_more_never_say_less():
    assert counts("you idiot " * 5000)["targeted insult"] == 5000
    model = tox.Model(*NO_TERMS, tox._fit([]))
    many = np.array([[0, n, 0, 0, 0, 0] for n in (0, 1, 2, 100, 10**6)])
    assert (np.diff(model.scores(many)) > 0).all()


def test_all_strong_terms_are_kept(spark):
    words = [f"{a}{b}{c}zzz" for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyzabcd"]
    rows = [(" ".join(words), 1)] * 30 + [("plain words here", 0)] * 200
    terms, _ = tox._learn_terms(spark.createDataFrame(rows, "text string, toxic int"))
    assert len(terms[0]) == 1000


def test_the_smallest_digests(spark):
    frame = spark.range(5000).repartition(7)
    digest = F.xxhash64("id")
    for count in (0, 1, 700, 5000, 9000):
        want = [r.id for r in frame.orderBy(digest, "id").limit(count).collect()]
        assert sorted(r.id for r in smallest(frame, digest, ["id"], count).collect()) == sorted(want)
    assert smallest(frame.where("id < 0"), digest, ["id"], 5).count() == 0


def test_without_labels_seeds_decide_and_odd_rows_have_a_score(spark):
    rows = [(1, "you idiot"), (2, None), (3, ""), (3, ""), (None, "moron"), (4, "nice"), (5, "fine day " * 30_000 + "idiot")]
    docs = spark.createDataFrame([(*r, "s", 1, 2) for r in rows], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = tox.fit(docs, labels, F.lit(True))
    found = {(r.doc_id, r.score) for r in tox.score(docs, model).collect()}
    assert all(0 <= s <= 1 for _, s in found)
    assert {i for i, s in found if s >= 0.7} == {1, 5, None}
    kept = tox.clean_documents(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 3, 4]
    empty = spark.createDataFrame([], SCHEMA)
    assert tox.score(empty, tox.fit(empty, labels, F.lit(True))).count() == 0


def test_held_out_rows_are_found_and_clean_ones_left_alone(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    trained = tox.in_training(F.col("doc_id"))
    model = tox.fit(docs, labels, trained)
    found = tox.score(docs, model, ["doc_id"]).where(~trained).join(labels, "doc_id")
    table = {(r.toxic, r.hit): r["count"] for r in found.groupBy("toxic", (F.col("score") >= 0.7).alias("hit")).count().collect()}
    assert table[1, True] >= 0.8 * (table[1, True] + table.get((1, False), 0))
    assert table.get((0, True), 0) <= 0.01 * table[0, False]
