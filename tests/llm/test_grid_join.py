import numpy as np
import pytest

from ledgertag.llm import grid_join
from ledgertag.llm.storage import stage

SCHEMA = "vec_id long, embedding array<float>, node string, weight int"


def vectors():
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 1, 16).astype("f4").tolist()) for i in range(300)]
    for i in range(120):
        rows.append((1000 + i, (np.array(rows[i % 5][1]) + rng.normal(0, 0.07, 16)).astype("f4").tolist()))
    copies = [(2000 + i, rows[3][1]) for i in range(40)]
    odd = [
        (3000, rows[4][1]), (3000, rows[5][1]), (3001, None), (3002, [0.0] * 16), (3003, [float("nan")] + [1.0] * 15),
        (3004, [None] + [1.0] * 15), (3005, [1.0, 2.0]), (3006, [2.0, 4.0]), (None, rows[3][1]), (3007, []),
        (3008, [float("inf")] + [0.0] * 15), (3009, [1e-30] * 16), (3010, [1e30] * 16),
    ]
    return rows + copies + odd


def brute_force(rows, cosine):
    usable = [i for i, (_, e) in enumerate(rows) if e and None not in e and np.isfinite(e).all() and any(e)]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for size in (2, 16):
        own = [i for i in usable if len(rows[i][1]) == size]
        x = np.array([rows[i][1] for i in own], "f4").astype(float)
        x /= np.abs(x).max(axis=1)[:, None]
        x /= np.linalg.norm(x, axis=1)[:, None]
        for a, b in zip(*np.nonzero(x @ x.T >= cosine), strict=True):
            if a != b:
                links[own[a]] += 1
                parent[find(own[a])] = find(own[b])
    lowest = {}
    for i, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            lowest[find(i)] = min(lowest.get(find(i), vec_id), vec_id)
    component = [lowest.get(find(i)) for i in range(len(rows))]
    return [(v, links[i], component[i], v is not None and v == component[i]) for i, (v, _) in enumerate(rows)]


@pytest.mark.parametrize("cosine, leaf_size", [(0.95, 20), (0.95, 4096), (0.6, 33)])
def test_same_as_all_pairs(spark, cosine, leaf_size):
    rows = vectors()
    frame = spark.createDataFrame([(*r, "n", 1) for r in rows], SCHEMA).repartition(3)
    found = [tuple(r) for r in grid_join.linked(frame, cosine, leaf_size).collect()]
    assert sorted(found, key=repr) == sorted(brute_force(rows, cosine), key=repr)


def clustered(count, groups, size, spread):
    rng = np.random.default_rng(3)
    centers = rng.normal(0, 1, (groups, size))
    x = centers[rng.integers(0, groups, count)] + rng.normal(0, spread, (count, size))
    return [(i, v) for i, v in enumerate(x.astype("f4").tolist())]


def test_clusters_are_joined_without_most_pairs_of_leaves(spark):
    rows = clustered(3000, 15, 32, 0.12)
    frame = spark.createDataFrame([(*r, "n", 1) for r in rows], SCHEMA)
    classes = frame.selectExpr("vec_id node", "1L weight", "embedding").repartition(2)
    eps = (2 - 2 * 0.95) ** 0.5
    axes = grid_join.principal(classes, 32)
    leaves = stage(grid_join._leaves(classes, axes, eps, 50), "leaves")
    left, count = grid_join.close_leaves(leaves, axes.shape[1] + 1, eps).count(), leaves.count()
    assert left < 0.3 * count * (count + 1) / 2
    found = [tuple(r) for r in grid_join.linked(frame, 0.95, 50).collect()]
    assert sum(r[1] for r in found) > 10_000
    x = np.array([r[1] for r in rows], "f4").astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    assert [r[1] for r in sorted(found)] == ((x @ x.T >= 0.95).sum(axis=1) - 1).tolist()


def test_coordinates_are_no_further_apart_than_vectors():
    rng = np.random.default_rng(5)
    x = grid_join.units(rng.normal(0, 1, (60, 20)))
    axes = np.linalg.qr(rng.normal(0, 1, (20, 4)))[0]
    at = grid_join.located(x, axes)
    near = np.linalg.norm(at[:, None] - at[None], axis=2) - np.linalg.norm(x[:, None] - x[None], axis=2)
    assert near.max() < 1e-12


def test_empty_table_and_wrong_limit(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert grid_join.linked(empty).count() == 0
    with pytest.raises(ValueError):
        grid_join.linked(empty, 0)
