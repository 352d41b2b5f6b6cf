import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgertag.llm import packing
from ledgertag.llm.storage import stage

SCHEMA = "doc_id long, text string, packing_group int, extra string"
TEXTS = [
    (1, "The quick brown fox, jumps over 13 lazy dogs. It's ÉTÉ; naïve Straße!"),
    (2, None),
    (3, ""),
    (3, ""),
    (None, "x y z"),
    (4, "word " * 400),
    (5, "mixed\x1cwhite space\tand 中文 <|endoftext|> \U0001f600 İΣ"),
    (6, "a" * 3000),
    (7, "Hello, World. hello, world."),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 1, "e") for i, t in TEXTS], SCHEMA)


def expected(capacity):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for doc, text in TEXTS:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), capacity):
            part = np.array(ids[k : k + capacity], "<u4").tobytes()
            out.append((doc, k // capacity, k, len(part) // 4, zlib.crc32(part)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("capacity", [50, 4096])
def test_pieces_are_those_of_the_tokenizer_and_fill_sequences_without_gaps(docs, capacity):
    found = packing.packed(docs, capacity).collect()
    assert sorted((tuple(r)[:5] for r in found), key=repr) == expected(capacity)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def test_sequences_hold_the_ids(docs):
    total = sum(e[3] for e in expected(50))
    found = packing.sequences(docs, 50).collect()
    assert sum(r.length for r in found) == total
    assert all(len(r.ids) == 4 * r.length for r in found)


def test_few_sequences_more_than_the_bound():
    lengths = np.random.default_rng(1).integers(1, 4097, 3000)
    sequence, _ = packing.sum_of_squares(lengths, 4096)
    assert sequence.max() + 1 <= 1.03 * lengths.sum() / 4096 + 1


def test_groups_and_wrong_lengths(spark):
    items = stage(spark.range(500).selectExpr("id % 7 AS doc_id", "1 + id % 90 AS length", "id AS lot"), "items")
    found = packing.pack(items, 100, group_size=100)
    assert found.count() == 500
    fill = found.groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in fill) <= 100
    with pytest.raises(Exception, match="outside"):
        packing.pack(items, 50).collect()


def test_empty_table(spark):
    assert packing.packed(spark.createDataFrame([], SCHEMA)).count() == 0
