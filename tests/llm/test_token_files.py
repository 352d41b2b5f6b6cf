import tempfile
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgertag.llm import separators, tokens, training_order
from ledgertag.llm.storage import stage
from ledgertag.llm.tokens import ByteIds

SCHEMA = "doc_id long, text string, file string, number int"
TEXTS = [
    (1, "The quick brown fox jumps."), (2, None), (3, ""), (3, " a  b \n c"), (3, "x"), (None, "y"), (4, "two\n\nlines "),
    (5, "word " * 9_000), (6, "é 中文 \U0001f600 <|endoftext|>"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*t, "f", 1) for t in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def coder():
    return ByteIds(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_words_with_their_blanks_give_the_ids_of_the_text(coder):
    for _, text in TEXTS:
        assert coder.encode(text or "") == coder.ids(text or "")


@pytest.mark.parametrize("block", [3, 1000, separators.BLOCK])
def test_counts_from_flat_files(spark, docs, coder, block):
    folder = tempfile.mkdtemp()
    places = stage(separators.write_flat(docs, folder, file_ids=100), "places")
    counts = separators.token_counts(spark, folder, block=block)
    assert counts.where("not ended").count() == 0
    found = places.join(counts, ["file", "number"]).select("doc_id", "n_tokens").collect()
    want = [(i, len(coder.ids(t or "")) // 2) for i, t in TEXTS]
    assert sorted((tuple(r) for r in found), key=repr) == sorted(want, key=repr)


def test_open_ends_empty_files_and_long_documents(spark):
    folder = tempfile.mkdtemp()
    np.array([5, 6, 50256, 50256, 7] + [8] * 3000, "<u2").tofile(f"{folder}/a.ids")
    open(f"{folder}/b.ids", "wb").close()
    np.array([50256], "<u2").tofile(f"{folder}/c.ids")
    found = separators.token_counts(spark, folder, block=100).orderBy("file", "number").collect()
    assert [tuple(r) for r in found] == [
        ("a.ids", 0, 2, True), ("a.ids", 1, 0, True), ("a.ids", 2, 3001, False), ("c.ids", 0, 0, True),
    ]


@pytest.mark.parametrize("block, run", [(1, 1), (2, 3), (5, 2), (64, 1), (7, 100)])
def test_runs_of_a_file_are_stitched_and_read_by_many_tasks(spark, block, run):
    rng = np.random.default_rng(block)
    folder, want = tempfile.mkdtemp(), []
    for name, share in (("a.ids", 0.3), ("b.ids", 0.01), ("c.ids", 0.0), ("d.ids", 1.0)):
        ids = np.where(rng.random(rng.integers(150, 300)) < share, 50256, 9).astype("<u2")
        ids.tofile(f"{folder}/{name}")
        parts = np.split(ids, np.flatnonzero(ids == 50256) + 1)
        want += [(name, k, len(x) - 1, True) for k, x in enumerate(parts[:-1])]
        if len(parts[-1]):
            want.append((name, len(parts) - 1, len(parts[-1]), False))
    # The limit of the source stands for files of 2 GB: what is only listed may be longer.
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "10")
    try:
        found = separators.token_counts(spark, folder, block=block, run=run).collect()
        runs = separators._runs(spark, folder, 2, block, run)
        used = runs.select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert sorted(tuple(r) for r in found) == sorted(want)
    assert used > 1


def test_a_file_that_ends_within_an_id_raises(spark):
    folder = tempfile.mkdtemp()
    with open(f"{folder}/a.ids", "wb") as file:
        file.write(b"abc")
    with pytest.raises(Exception, match="whole ids"):
        separators.token_counts(spark, folder).collect()


@pytest.mark.parametrize("count", [0, 1, 2, 3, 7, 1000, 1025])
def test_slots_are_a_permutation_that_can_be_undone(count):
    order = training_order.Permutation(count)
    slots = order.slots(np.arange(count))
    assert sorted(slots.tolist()) == list(range(count))
    assert (order.numbers(slots) == np.arange(count)).all()
    if count == 1000:
        assert (slots != training_order.Permutation(count, seed=1).slots(np.arange(count))).any()


def test_shards_hold_every_text_once_in_the_order_of_the_slots(docs, coder):
    folder = tempfile.mkdtemp()
    found = training_order.materialize(docs, folder, length=16, shard=7).orderBy("slot").collect()
    assert [r.slot for r in found] == list(range(len(found)))
    ids = training_order.read_slots(folder, 0, len(found), length=16, shard=7)
    assert all(zlib.crc32(ids[r.slot].astype("<u2").tobytes()) == r.ids_crc32 for r in found)
    assert (training_order.read_slots(folder, 5, 9, length=16, shard=7) == ids[5:14]).all()
    stream = np.concatenate([ids[r.slot][: r.n_tokens] for r in sorted(found, key=lambda r: r.sequence)])
    texts = np.split(stream, np.flatnonzero(stream == 50256) + 1)[:-1]
    want = sorted(coder.ids(t or "") for _, t in TEXTS)
    assert sorted(t[:-1].astype("<u2").tobytes() for t in texts) == want


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert training_order.materialize(empty, tempfile.mkdtemp()).count() == 0
    folder = tempfile.mkdtemp()
    assert separators.write_flat(empty, folder).count() == 0
    assert separators.token_counts(spark, folder).count() == 0


def test_ids_are_those_of_the_other_library(coder):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    for _, text in TEXTS:
        wanted = whole.encode((text or "")[:20_000], add_special_tokens=False).ids
        assert np.frombuffer(coder.encode((text or "")[:20_000]), "<u2").tolist() == wanted


@pytest.mark.parametrize("most", [1, 3, 500_000])
def test_word_ids_with_a_small_memory(monkeypatch, most):
    monkeypatch.setattr(tokens, "MAX_KEPT_WORDS", most)
    path = public_tokenizers.path(tokens.WORD_BPE)
    words, whole = tokens.WordIds(path), Tokenizer.from_file(path)
    texts = ["Hello, hello world. World, été Été. x1y2 don't 42. ...", "hello　日本 world.", "a a a. b, a", ""]
    for text in texts * 3:
        wanted = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(words.encode(text), "<u4").tolist() == wanted
        assert len(words) <= most and len(words.before) <= most
