import hashlib

import numpy as np
import pytest

from ledgertag.llm import queries, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, codes string, ints long"


def brute_force(rows, parts=4, entries=256, rounds=4):
    """Codes, errors and label errors by plain comparison with every entry, in Python's numbers."""
    usable = [r for r in rows if r[1] is not None and None not in r[1] and np.isfinite(r[1]).all()]
    whole = [[int(np.floor(1024 * float(np.float32(x)))) for x in r[1]] for r in usable]
    first = sorted((r[0], v) for r, v in zip(usable, whole, strict=True) if r[0] is not None)[:entries]
    width = len(whole[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in whole]
    books = [[v[p * width : (p + 1) * width] for _, v in first] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in cut:
                groups.setdefault(nearest(v[p], books[p])[1], []).append(v[p])
            for k, members in groups.items():
                books[p][k] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    found = [[nearest(v[p], books[p]) for p in range(parts)] for v in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for r, e in zip(usable, errors, strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    digest = ",".join(str(x) for book in books for entry in book for x in entry)
    return sorted(
        (
            (r[0], "".join(f"{k:02x}" for _, k in f), e, by_label[r[2]], hashlib.sha256(digest.encode()).hexdigest())
            for r, f, e in zip(usable, found, errors, strict=True)
        ),
        key=repr,
    )


def vectors(n=600, width=8):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1, (20, width))
    rows = []
    for i in range(n):
        v = (centres[i % 20] + rng.normal(0, 0.1, width)).astype("f4").tolist()
        rows.append(((i * 7919) % n, v, [None, 1, 2, 2][i % 4], "x", i))
    same = rows[5][1]
    odd = [
        (7000, None, 1, None, None), (7001, [None] + same[1:], 1, "", 1), (7002, [float("nan")] + same[1:], 2, "", 1),
        (7003, [float("inf")] + same[1:], 2, "", 1), (None, same, None, "", 1), (7004, [0.0] * width, 9, "", 1),
    ]
    return rows + odd + [(8000 + i, same, 3, "copy", 1) for i in range(200)] + [rows[0]] * 5


def query_rows(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.op13_slice_intersect_codes(spark, str(tmp_path))
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_codes_equal_brute_force(spark, tmp_path):
    rows = vectors()
    assert query_rows(spark, rows, tmp_path) == brute_force(rows)


def test_ties_and_few_vectors(spark, tmp_path):
    # Equal entries: the lower index wins. Fewer vectors than entries: a smaller codebook.
    rows = [(i, [float(i // 2)] * 4, None, "", 0) for i in range(10)]
    found = query_rows(spark, rows, tmp_path)
    assert found == brute_force(rows)
    assert [r[1] for r in found[:4]] == ["00000000", "00000000", "02020202", "02020202"]


@pytest.mark.parametrize("rows", [[], [(1, None, 2, "", 0)], [(None, [1.0] * 4, 2, "", 0)]])
def test_nothing_to_code(spark, tmp_path, rows):
    assert query_rows(spark, rows, tmp_path) == []


def test_empty_vectors_and_other_lengths(spark, tmp_path):
    rows = [(1, [], 1, "", 0), (2, [], 1, "", 0)]
    assert [r[:4] for r in query_rows(spark, rows, tmp_path / "a")] == [(1, "0" * 8, 0, 0), (2, "0" * 8, 0, 0)]
    rows = [(1, [1.0] * 4, 1, "", 0), (2, [1.0] * 4, 1, "", 0), (3, [1.0] * 8, 1, "", 0)]
    assert [r[0] for r in query_rows(spark, rows, tmp_path / "b")] == [1, 2]
    with pytest.raises(Exception, match="equal parts"):
        query_rows(spark, [(1, [1.0] * 6, 1, "", 0)], tmp_path / "c")


@pytest.mark.parametrize("count, width, spread", [(1, 3, 5), (64, 1, 4), (65, 2, 3), (256, 16, 900), (200, 5, 1)])
def test_slices_find_the_nearest(count, width, spread):
    rng = np.random.default_rng(count)
    entries = rng.integers(-spread, spread + 1, (count, width))
    points = rng.integers(-2 * spread, 2 * spread + 1, (3000, width))
    best, distance = vector_codes.Slices(entries).nearest(points)
    square = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (best == square.argmin(axis=1)).all() and (distance == square.min(axis=1)).all()


def test_boxes_are_exact():
    rng = np.random.default_rng(0)
    entries, points = rng.integers(-50, 50, (100, 4)), rng.integers(-50, 50, (200, 4))
    radius = rng.integers(0, 60, 200)
    mask = vector_codes.Slices(entries).box(points, radius)
    bits = np.unpackbits(mask.view(np.uint8), axis=1, bitorder="little")[:, :100]
    inside = (np.abs(points[:, None] - entries[None]) <= radius[:, None, None]).all(axis=2)
    assert (bits == inside).all()
