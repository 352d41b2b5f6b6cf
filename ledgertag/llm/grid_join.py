"""Cosine similarity join of vectors by epsilon grid order.

Unit vectors with a cosine of at least t are no further apart than eps = sqrt(2 - 2 t). Vectors are
projected on leading principal dimensions and sorted by their grid cells (side eps) there. The
sorted sequence is cut into leaves, leaves into a tree of intervals, each with a bounding box on the
leading dimensions and the length of what lies outside them. Starting from the top, pairs of
intervals whose boxes are more than eps apart are skipped, the others are replaced by the pairs of
their parts. Pairs of leaves are dealt out as tiles, so that a leaf travels once for several partners.
Inside a pair the same goes on with halves, and only the smallest pieces are multiplied out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgertag.llm.components import components
from ledgertag.llm.storage import column, smallest, stage

COSINE = 0.95
DIMENSIONS = 8
# Vectors in a leaf, which travels as a whole, and in a piece that is multiplied out.
LEAF = 2048
PIECE = 128
FAN = 8
# Leaves on either side of a tile, at most; one side is held by a task at once.
TILE = 4
# Vectors at most that the principal dimensions are fitted on: those with the smallest digest. The
# choice of dimensions decides how much is skipped, not what is found.
FIT_ROWS = 10_000
SLACK = 1e-9


def usable(vector: Column) -> Column:
    """Neither null nor zero, with finite components only."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    wide = vectors.astype(np.float64)
    wide = wide / np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))


def located(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Unit vectors on the leading axes, and the length of what is left of them.

    Lengths of two remainders differ by no more than the remainders are apart, so these coordinates
    are never further apart than the vectors.
    """
    at = x @ axes
    return np.column_stack([at, np.linalg.norm(x - at @ axes.T, axis=1)])


def _matrix(vectors: pa.Array, size: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def principal(classes: DataFrame, size: int) -> np.ndarray:
    """Leading directions of at most FIT_ROWS vectors, as columns."""
    sample = smallest(classes, F.xxhash64("embedding"), ["node"], FIT_ROWS).select("embedding")
    x = units(np.array([row[0] for row in sample.toLocalIterator()]).reshape(-1, size))
    _, directions = np.linalg.eigh(np.cov(x.T) if len(x) > 1 else np.eye(size))
    return np.atleast_2d(directions)[:, ::-1][:, :DIMENSIONS]


def _leaves(classes: DataFrame, axes: np.ndarray, eps: float, leaf_size: int) -> DataFrame:
    """Leaves in grid order: ``part``, ``place``, their vectors, and the box of their coordinates."""
    size, depth = axes.shape
    element = classes.schema["embedding"].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    cells = [f"cell{k}" for k in range(depth)]
    with_cells = T.StructType([
        *classes.schema.fields, *(T.StructField(name, T.LongType()) for name in cells)
    ])

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = units(_matrix(column(batch, "embedding"), size)) @ axes
                cell = np.floor(at / eps).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *(pa.array(cell[:, k]) for k in range(depth))],
                    names=with_cells.names,
                )

    leaf = T.StructType([
        T.StructField("part", T.LongType()),
        T.StructField("place", T.LongType()),
        T.StructField("nodes", T.BinaryType()),
        T.StructField("weights", T.BinaryType()),
        T.StructField("vectors", T.BinaryType()),
        *(T.StructField(f"{end}{k}", T.DoubleType()) for end in ("low", "high") for k in range(depth + 1)),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        kept: list[tuple] = []
        count = 0

        def leaves(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal kept, count, place
            nodes, weights, vectors = (np.concatenate(x) for x in zip(*kept, strict=True))
            end = count if last else count - count % leaf_size
            for low in range(0, end, leaf_size):
                own = slice(low, min(low + leaf_size, end))
                at = located(units(vectors[own]), axes)
                box = [*at.min(axis=0).tolist(), *at.max(axis=0).tolist()]
                data = [x[own].tobytes() for x in (nodes, weights, vectors)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x]) for x in (part, place, *data, *box)], names=leaf.names
                )
                place += 1
            kept = [(nodes[end:], weights[end:], vectors[end:])]
            count -= end

        for batch in batches:
            if batch.num_rows:
                kept.append((
                    column(batch, "node").to_numpy().astype(np.int64),
                    column(batch, "weight").to_numpy().astype(np.int64),
                    _matrix(column(batch, "embedding"), size).astype(kind),
                ))
                count += batch.num_rows
                if count >= leaf_size:
                    yield from leaves(False)
        if count:
            yield from leaves(True)

    placed = classes.mapInArrow(locate, with_cells)
    order = [*cells, "node"]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, leaf)


def _apart(depth: int) -> Column:
    """Squared distance of the boxes of two intervals, with the columns of the second in capitals."""
    total = F.lit(0.0)
    for k in range(depth):
        gap = F.greatest(
            F.lit(0.0),
            F.col(f"LOW_{k}") - F.col(f"high{k}"),
            F.col(f"low{k}") - F.col(f"HIGH_{k}"),
        )
        total = total + gap * gap
    return total


def _second(boxes: DataFrame, depth: int) -> DataFrame:
    names = {"part": "PART_", "place": "PLACE_", "up_part": "UP_PART_", "up_place": "UP_PLACE_"}
    names |= {f"low{k}": f"LOW_{k}" for k in range(depth)}
    names |= {f"high{k}": f"HIGH_{k}" for k in range(depth)}
    return boxes.withColumnsRenamed({a: b for a, b in names.items() if a in boxes.columns})


def close_leaves(leaves: DataFrame, depth: int, eps: float) -> DataFrame:
    """Pairs of leaves that the boxes don't rule out: each once, leaves with themselves, too.

    ``depth`` is the number of coordinates of a box.
    """
    ends = [f"{end}{k}" for end in ("low", "high") for k in range(depth)]
    tightest = [
        *(F.min(f"low{k}").alias(f"low{k}") for k in range(depth)),
        *(F.max(f"high{k}").alias(f"high{k}") for k in range(depth)),
    ]
    level = leaves.select("part", "place", *ends)
    places, parts = level.agg(F.max("place"), F.max("part")).first()
    if places is None:
        return leaves.sparkSession.createDataFrame(
            [], "part long, place long, PART_ long, PLACE_ long"
        )
    levels = []
    while True:
        # First the leaves of one part come together, then the parts.
        within = places > 0
        up_place = F.floor(F.col("place") / FAN) if within else F.lit(0).cast("long")
        up_part = F.col("part") if within else F.floor(F.col("part") / FAN)
        level = level.select("*", up_part.alias("up_part"), up_place.alias("up_place"))
        levels.append(level)
        if not within and parts == 0:
            break
        places, parts = (places // FAN, parts) if within else (0, parts // FAN)
        level = stage(
            level.groupBy("up_part", "up_place")
            .agg(*tightest)
            .select(F.col("up_part").alias("part"), F.col("up_place").alias("place"), *ends),
            "intervals",
        )
    # The topmost level is a single interval, and every further level has at most FAN parts of each.
    pairs = None
    for level in reversed(levels):
        other = _second(level, depth)
        if pairs is None:
            found = level.join(
                other, (F.col("up_part") == F.col("UP_PART_")) & (F.col("up_place") == F.col("UP_PLACE_"))
            )
        else:
            found = (
                pairs.withColumnsRenamed({"part": "up_part", "place": "up_place"})
                .join(level, ["up_part", "up_place"])
                .withColumnsRenamed({"PART_": "UP_PART_", "PLACE_": "UP_PLACE_"})
                .join(other, ["UP_PART_", "UP_PLACE_"])
            )
        ordered = F.struct("part", "place") <= F.struct("PART_", "PLACE_")
        near = _apart(depth) <= eps * eps + SLACK
        pairs = stage(
            found.where(ordered & near).select("part", "place", "PART_", "PLACE_"), "pairs"
        )
    return pairs


def _components(count: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest number that each of 0 to count is linked with, directly or not."""
    label = np.arange(count)
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            return label


def _hits(
    a: np.ndarray, b: np.ndarray, axes: np.ndarray, cosine: float, eps: float, same: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and b with the cosine or more; each pair once if both are the same leaf."""
    at, to = located(a, axes), located(b, axes)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        if same and j_end <= i:
            continue
        one, two = at[i:i_end], to[j:j_end]
        gap = np.maximum(two.min(axis=0) - one.max(axis=0), one.min(axis=0) - two.max(axis=0))
        if (np.maximum(gap, 0) ** 2).sum() > eps * eps + SLACK:
            continue
        if i_end - i > PIECE or j_end - j > PIECE:
            if i_end - i >= j_end - j:
                half = (i + i_end) // 2
                todo += [(i, half, j, j_end), (half, i_end, j, j_end)]
            else:
                half = (j + j_end) // 2
                todo += [(i, i_end, j, half), (i, i_end, half, j_end)]
            continue
        x, y = np.nonzero(a[i:i_end] @ b[j:j_end].T >= cosine)
        x, y = x + i, y + j
        if same:
            x, y = x[x < y], y[x < y]
        found.append((x, y))
    return tuple(np.concatenate(z) for z in zip(*found, strict=True))


def _tiles(pairs: DataFrame, leaves: DataFrame) -> DataFrame:
    """The leaves of each tile, those of the second side first, the others with their partners."""
    first = F.floor(F.col("place") / TILE).alias("row")
    second = F.floor(F.col("PLACE_") / TILE).alias("col")
    dealt = pairs.select("*", F.col("part").alias("row_part"), first, F.col("PART_").alias("col_part"), second)
    tile = ["row_part", "row", "col_part", "col"]
    partner = F.struct(F.col("PART_").alias("part"), F.col("PLACE_").alias("place"))
    left = dealt.groupBy(*tile, "part", "place").agg(F.collect_list(partner).alias("partners"))
    right = dealt.select(*tile, partner.alias("leaf")).distinct().select(*tile, "leaf.*")
    nothing = F.lit(None).cast(left.schema["partners"].dataType)
    wanted = right.withColumn("partners", nothing).unionByName(left)
    data = leaves.select("part", "place", "nodes", "weights", "vectors")
    placed = wanted.join(data, ["part", "place"]).withColumn("side", F.col("partners").isNotNull())
    return placed.repartition(*tile).sortWithinPartitions(*tile, "side")


def _leaf_links(tiles: DataFrame, axes: np.ndarray, cosine: float, eps: float, kind: str) -> DataFrame:
    """For each pair of leaves: how many vectors each node links to, and edges that connect them."""
    schema = T.StructType([
        T.StructField("node", T.LongType()),
        T.StructField("links", T.LongType()),
        T.StructField("root", T.LongType()),
    ])
    size = axes.shape[0]

    def links(one: tuple, two: tuple, same: bool) -> pa.RecordBatch:
        i, j = _hits(one[2], two[2], axes, cosine, eps, same)
        node, weight = one[:2]
        if not same:
            node, weight = np.concatenate([node, two[0]]), np.concatenate([weight, two[1]])
            j = j + len(one[0])
        count = np.zeros(len(node), np.int64)
        np.add.at(count, i, weight[j])
        np.add.at(count, j, weight[i])
        root = node[_components(len(node), i, j)]
        linked = count > 0
        return pa.RecordBatch.from_arrays(
            [pa.array(x[linked]) for x in (node, count, root)], names=schema.names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held = None, {}
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if tile != (own := tuple(row[name] for name in ("row_part", "row", "col_part", "col"))):
                    tile, held = own, {}
                leaf = (
                    np.frombuffer(row["nodes"], np.int64),
                    np.frombuffer(row["weights"], np.int64),
                    units(np.frombuffer(row["vectors"], kind).reshape(-1, size)),
                )
                at = row["part"], row["place"]
                if row["partners"] is None:
                    held[at] = leaf
                for other in row["partners"] or ():
                    to = other["part"], other["place"]
                    yield links(leaf, held[to], at == to)

    return tiles.mapInArrow(run, schema)


def _joined(classes: DataFrame, size: int, cosine: float, leaf_size: int) -> DataFrame:
    """``node``, ``links`` and ``root`` of the linked classes, several rows for a node."""
    eps = math.sqrt(max(2 - 2 * cosine, 0)) + SLACK
    axes = principal(classes, size)
    depth = axes.shape[1]
    leaves = stage(_leaves(classes, axes, eps, leaf_size), "leaves")
    pairs = close_leaves(leaves, depth + 1, eps)
    element = classes.schema["embedding"].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    return _leaf_links(_tiles(pairs, leaves), axes, cosine, eps, kind)


def linked(vectors: DataFrame, cosine: float = COSINE, leaf_size: int = LEAF) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of each row of ``vectors``.

    ``n_links`` counts the other rows with a cosine of ``cosine`` or more; equal vectors are compared
    once and counted as often as they occur. ``component_id`` is the smallest ``vec_id`` that is
    reachable over links, and ``kept`` marks the rows that bear it. Vectors that are null or zero or
    hold null or non-finite components link with nothing; vectors link only with those of the same
    size. A row without id counts for others but names no component. An empty table gives no rows;
    other columns are left out.
    """
    if not 0 < cosine <= 1:
        raise ValueError("the cosine limit must be over 0 and at most 1")
    rows = stage(vectors.select("vec_id", "embedding", usable(F.col("embedding")).alias("usable")), "rows")
    classes = stage(
        rows.where("usable")
        .groupBy("embedding")
        .agg(F.count("*").alias("weight"), F.min("vec_id").alias("smallest"))
        .select("embedding", "weight", "smallest", F.monotonically_increasing_id().alias("node")),
        "classes",
    )
    sizes = [r[0] for r in classes.select(F.size("embedding")).distinct().collect()]
    found = None
    for size in sizes:
        own = classes.where(F.size("embedding") == size).select("node", "weight", "embedding")
        part = stage(_joined(own, size, cosine, leaf_size), "links")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "node long, links long, root long")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = (
        classes.join(roots, "node", "left")
        .join(counts, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    lowest = named.groupBy("component").agg(F.min("smallest").alias("component_id"))
    facts = named.join(lowest, "component").select(
        "embedding",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        "component_id",
    )
    alone = rows.where("not usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    result = rows.where("usable").join(facts, "embedding").select("vec_id", "n_links", "component_id")
    return result.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
