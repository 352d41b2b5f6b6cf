"""A trie over the turns of conversations, built as a burst trie.

Conversations are sequences of turn ids; equal ones are taken once, with their number. All begin in one
container below the root. A container that holds too many turns bursts: it becomes a trie node with a
container for each next turn id, several levels in one pass. What remains fits a task many times over.
Containers are dealt to shards, their suffixes sorted, and each container is swept once: neighbours in the
order tell where paths part, so every node is opened and closed once, with the sums of its subtree.

No row holds more than ``PIECE`` turns. Longer sequences go on in a container below the node that the
piece ends at; where just one sequence is left, the rest is a path and needs no trie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgertag.llm.storage import column, stage
from ledgertag.session import BROADCAST_ROWS

# Turns in one row, turns in one container, levels of a burst that are looked at in one pass.
PIECE = 512
LIMIT = 65_536
LEVELS = 16
CHUNK = 4096  # ids of members that are joined to one text before they meet

ID = "array<struct<a:bigint,b:bigint,size:bigint>>"
TURNS = ["conv_id", "position", "a", "b", "size"]
# What a node passes on from the part of its subtree that lies elsewhere.
BELOW = ["more_children", "more_leaves", "more_saved"]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``position`` from 1 in the order of ``turn``, a 128-bit turn id and ``size``, staged.

    A null turn comes first, a null role or text is empty, and equal turns of a conversation are in the order
    of their ids, so the result doesn't depend on the order of rows. Repeated rows are turns of their own.
    Rows without ``conv_id`` are left out, other columns are ignored. ``size`` counts code points.

    Rows are sorted by range and not by conversation, so a conversation may fill many tasks: each
    numbers its own rows, and only the counts at the borders of tasks are added up.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit(1), text, role).alias("b"),
        F.char_length(text).cast("long").alias("size"),
    )
    keys = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("a"), F.col("b")]
    schema = T.StructType([T.StructField(name, T.LongType()) for name in [*TURNS, "part"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, done = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = column(batch, "conv_id").to_numpy()
            begins = np.flatnonzero(np.diff(conv, prepend=conv[0] - 1))
            length = np.diff(np.append(begins, len(conv)))
            number = np.arange(1, len(conv) + 1) - np.repeat(begins, length)
            if conv[0] == last:
                number[: length[0]] += done
            last, done = conv[-1], int(number[-1])
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "conv_id"),
                    pa.array(number, pa.int64()),
                    *(column(batch, name) for name in ("a", "b", "size")),
                    pa.array(np.full(len(conv), part), pa.int64()),
                ],
                names=schema.names,
            )

    ranges = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    local = stage(ranges.mapInArrow(run, schema), "turns")
    # From here a row for each task that sorted, whatever the corpus holds.
    borders = local.groupBy("part").agg(
        F.min("conv_id").alias("first"),
        F.max("conv_id").alias("last"),
        F.max_by("position", F.struct("conv_id", "position")).alias("n_last"),
    )
    by_part = Window.orderBy("part")
    so_far = F.sum("n_last").over(Window.partitionBy("last").orderBy("part"))
    borders = borders.withColumn("so_far", so_far)
    carried = borders.select(
        "part",
        F.col("first").alias("conv_id"),
        F.lag("last").over(by_part).alias("before"),
        F.lag("so_far").over(by_part).alias("carry"),
    ).where("before = conv_id")
    carried = F.broadcast(stage(carried.select("part", "conv_id", "carry"), "borders"))
    position = (F.col("position") + F.coalesce("carry", F.lit(0))).alias("position")
    return local.join(carried, ["part", "conv_id"], "left").select("conv_id", position, "a", "b", "size")


def _path(depth: Column | int) -> tuple[Column, Column]:
    """128 bits that name the node at a depth of a row's piece; depth 0 is the node it starts from."""
    depth = F.lit(depth) if isinstance(depth, int) else depth
    head = F.slice("ids", 1, F.greatest(depth, F.lit(1)))
    return (
        F.when(depth == 0, F.col("start_a")).otherwise(F.xxhash64("start_a", "start_b", head)),
        F.when(depth == 0, F.col("start_b")).otherwise(F.xxhash64(F.lit(1), "start_a", "start_b", head)),
    )


def _bounded(df: DataFrame) -> DataFrame:
    """Marked for broadcast where it was counted and is small; else hot keys are left to the skew join."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def sequences(
    turns: DataFrame, conversations: DataFrame, piece: int = PIECE
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pieces of the distinct sequences, the sequences, and the sequence of each conversation.

    Pieces: ``conv`` (smallest conversation with the sequence), ``k`` (number of the piece), ``ids``.
    Sequences: ``conv``, ``copies``, ``depth``. Members: ``conv_id``, ``conv``. ``conversations``
    names those without turns, too.
    """
    turn = F.struct("position", "a", "b", "size")
    number = F.floor((F.col("position") - 1) / piece).cast("long").alias("k")
    pieces = turns.groupBy("conv_id", number).agg(F.array_sort(F.collect_list(turn)).alias("ids"))
    bare = F.transform("ids", lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"), x["size"].alias("size")))
    pieces = stage(pieces.select("conv_id", "k", bare.alias("ids")), "pieces")
    # Each piece has its number, so the set of pieces is the sequence and their digests may be combined in
    # any order, also by many tasks for one conversation.
    whole = pieces.groupBy("conv_id").agg(
        F.bit_xor(F.xxhash64("k", "ids")).alias("whole_a"),
        F.bit_xor(F.xxhash64(F.lit(1), "ids", "k")).alias("whole_b"),
        F.sum(F.size("ids").cast("long")).alias("depth"),
    )
    names = ["whole_a", "whole_b", "depth"]
    known = conversations.select("conv_id").distinct().join(whole, "conv_id", "left")
    known = stage(known.fillna(0, names), "wholes")
    classes = stage(
        known.groupBy(*names).agg(F.min("conv_id").alias("conv"), F.count("*").alias("copies")), "classes"
    )
    members = known.join(classes.select(*names, "conv"), names).select("conv_id", "conv")
    classes = classes.select("conv", "copies", "depth")
    kept = pieces.withColumnRenamed("conv_id", "conv").join(classes.where("depth > 0"), "conv")
    return stage(kept, "sequences"), classes, members


class Sweep:
    """The nodes of one container from its suffixes in order."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.stack: list[int] = []
        self.before: tuple[np.ndarray, np.ndarray] | None = None
        self.depth, self.parent, self.copies, self.low, self.children = [], [], [], [], []
        self.leaves, self.saved, self.size, self.ending = [], [], [], []

    def _close(self) -> None:
        node = self.stack.pop()
        self.leaves[node] = self.leaves[node] or 1
        self.saved[node] += (self.copies[node] - 1) * self.size[node]
        if self.stack:
            above = self.stack[-1]
            self.copies[above] += self.copies[node]
            low = self.low[above]
            self.low[above] = self.low[node] if low is None else min(low, self.low[node])
            self.children[above] += 1
            self.leaves[above] += self.leaves[node]
            self.saved[above] += self.saved[node]

    def add(
        self, a: np.ndarray, b: np.ndarray, size: np.ndarray, conv: int, copies: int, ending: int | None,
        below: tuple[int, int, int],
    ) -> None:
        """The next suffix: its turns, how many conversations take this path, and the one that ends here."""
        if self.before is None:
            common = self.top - 1
        else:
            m = min(len(a), len(self.before[0]))
            apart = (a[:m] != self.before[0][:m]) | (b[:m] != self.before[1][:m])
            common = int(apart.argmax()) if apart.any() else m
        while len(self.stack) > common - self.top + 1:
            self._close()
        for d in range(common + 1, len(a) + 1):
            self.parent.append(self.stack[-1] if self.stack else -1)
            self.stack.append(len(self.depth))
            self.depth.append(d)
            self.copies.append(0)
            self.low.append(None)
            self.children.append(0)
            self.leaves.append(0)
            self.saved.append(0)
            self.size.append(int(size[d - 1]))
            self.ending.append(None)
        node = self.stack[-1]
        self.copies[node] += copies
        self.low[node] = conv if self.low[node] is None else min(self.low[node], conv)
        self.ending[node] = ending
        self.children[node] += below[0]
        self.leaves[node] += below[1]
        self.saved[node] += below[2]
        self.before = (a, b)

    def finish(self) -> None:
        while self.stack:
            self._close()


NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, ending long"


def _swept(items: DataFrame, base: int) -> DataFrame:
    """Nodes of all containers. A top also has the head above it (``above_a``, ``above_b``) and an ``item``."""
    schema = T.StructType.fromDDL(f"{NODE}, above_a long, above_b long, item long")
    wanted = ["box_a", "box_b", "ids", "conv", "copies", "ending", *BELOW]
    wanted += ["head_depth", "head_a", "head_b", "head_low"]

    def nodes(sweep: Sweep, above: tuple, item: int) -> pa.RecordBatch:
        sweep.finish()
        low, parent = sweep.low, sweep.parent
        tops = [p < 0 for p in parent]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(x, pa.int64())
                for x in (
                    low,
                    [base + d for d in sweep.depth],
                    [above[3] if p < 0 else low[p] for p in parent],
                    sweep.copies,
                    sweep.children,
                    sweep.leaves,
                    sweep.saved,
                    sweep.ending,
                    [above[1] if top else None for top in tops],
                    [above[2] if top else None for top in tops],
                    [item if top else None for top in tops],
                )
            ],
            names=schema.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep, box, above, item = None, None, None, None
        for batch in batches:
            ids = column(batch, "ids")
            bounds = ids.offsets.to_numpy() - ids.offsets[0].as_py()
            flat = ids.flatten()
            a, b, size = (flat.field(k).to_numpy() for k in range(3))
            lists = {name: column(batch, name).to_pylist() for name in wanted if name != "ids"}
            for i in range(batch.num_rows):
                key = lists["box_a"][i], lists["box_b"][i]
                if key != box:
                    if sweep is not None:
                        yield nodes(sweep, above, item)
                    box, item = key, lists["conv"][i]
                    above = tuple(lists[f"head_{x}"][i] for x in ("depth", "a", "b", "low"))
                    sweep = Sweep(above[0] + 1)
                part = slice(bounds[i], bounds[i + 1])
                below = tuple(lists[name][i] for name in BELOW)
                sweep.add(a[part], b[part], size[part], lists["conv"][i], lists["copies"][i], lists["ending"][i], below)
        if sweep is not None:
            yield nodes(sweep, above, item)

    dealt = items.select(*wanted).repartition("box_a", "box_b")
    return dealt.sortWithinPartitions("box_a", "box_b", "ids").mapInArrow(run, schema)


def _burst(items: DataFrame, limit: int, levels: int) -> tuple[DataFrame | None, DataFrame | None]:
    """Heads, the nodes whose containers are too large, and how far each item lies below heads only.

    Heads: path, ``depth`` in the piece, path of the parent, ``copies``, ``low``, ``size``. Reached:
    ``conv`` and the deepest head above its container. None where nothing bursts.
    """
    heads = reached = None
    active, deep = items.withColumn("from_depth", F.lit(0)), 0
    while True:
        some = active.where(F.size("ids") > deep)
        step = F.explode(F.sequence(F.lit(deep + 1), F.least(F.lit(deep + levels), F.size("ids"))))
        rungs = some.select("conv", "copies", "start_a", "start_b", "ids", step.alias("depth"))
        (a, b), (up_a, up_b) = _path(F.col("depth")), _path(F.col("depth") - 1)
        rungs = rungs.select(
            "conv", "copies", "depth", a.alias("a"), b.alias("b"), up_a.alias("up_a"), up_b.alias("up_b"),
            F.element_at("ids", F.col("depth"))["size"].alias("size"),
            (F.size("ids") - F.col("depth") + 1).cast("long").alias("load"),
        )
        loads = rungs.groupBy("a", "b", "depth").agg(
            F.sum("load").alias("load"),
            F.count("*").alias("suffixes"),
            F.sum("copies").alias("copies"),
            F.min("conv").alias("low"),
            *(F.max(name).alias(name) for name in ("up_a", "up_b", "size")),
        )
        burst = stage(loads.where((F.col("load") > limit) & (F.col("suffixes") > 1)), "heads")
        if burst.isEmpty():
            return heads, reached
        heads = burst if heads is None else heads.unionByName(burst)
        side = _bounded(burst.select("a", "b", "depth", "low"))
        deepest = F.max(F.struct("depth", "a", "b", "low")).alias("head")
        found = rungs.select("conv", "a", "b", "depth").join(side, ["a", "b", "depth"])
        found = stage(found.groupBy("conv").agg(deepest), "reached")
        reached = found if reached is None else reached.unionByName(found)
        deep += levels
        going = found.where(F.col("head.depth") == deep).select("conv")
        active = items.join(going, "conv", "left_semi")


def _stratum(
    items: DataFrame, base: int, limit: int, levels: int
) -> tuple[DataFrame, DataFrame]:
    """All nodes below the starts of the items, and what each start gets from them.

    Items: ``conv``, ``start_a``, ``start_b``, ``start_low``, ``ids``, ``copies``, ``ending`` and ``BELOW``;
    no two have the same start and ids.
    """
    heads, reached = _burst(items, limit, levels)
    start = F.struct(
        F.lit(0).alias("depth"), F.col("start_a").alias("a"), F.col("start_b").alias("b"), F.col("start_low").alias("low")
    )
    if reached is None:
        placed = items.withColumn("head", start)
    else:
        last = reached.groupBy("conv").agg(F.max("head").alias("head"))
        placed = items.join(last, "conv", "left").withColumn("head", F.coalesce("head", start))
    placed = placed.select("*", *(F.col(f"head.{x}").alias(f"head_{x}") for x in ("depth", "a", "b", "low")))
    a, b = _path(F.col("head_depth") + 1)
    inside = placed.where(F.size("ids") > F.col("head_depth"))
    nodes = stage(_swept(inside.withColumns({"box_a": a, "box_b": b}), base), "nodes")
    tops = nodes.where("item is not null")
    sums = [F.sum(name).alias(name) for name in BELOW]
    direct = tops.select(
        F.col("above_a").alias("a"), F.col("above_b").alias("b"), F.lit(1).cast("long").alias("more_children"),
        F.col("n_leaves").alias("more_leaves"), F.col("saved").alias("more_saved"),
    )
    if heads is None:
        return nodes.drop("above_a", "above_b", "item"), direct.groupBy("a", "b").agg(*sums)

    # Some containers have burst: what lies in and below heads is added to all heads above.
    own = (F.col("copies") - 1) * F.col("size")
    no = F.lit(0).cast("long")
    given = (
        tops.select(F.col("item").alias("conv"), F.col("n_leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
        .join(placed.select("conv", "start_a", "start_b", "ids", "head_depth"), "conv")
        .unionByName(
            heads.select(
                F.col("low").alias("conv"), F.col("depth").alias("head_depth"), no.alias("more_leaves"), own.alias("more_saved")
            ).join(items.select("conv", "start_a", "start_b", "ids"), "conv")
        )
        .unionByName(
            placed.where(F.size("ids") == F.col("head_depth")).select(
                "conv", "more_leaves", "more_saved", "start_a", "start_b", "ids", "head_depth"
            )
        )
    )
    rung = F.explode(F.sequence(F.lit(0), F.col("head_depth"))).alias("rung")
    given = given.select("start_a", "start_b", "ids", "more_leaves", "more_saved", rung)
    up_a, up_b = _path(F.col("rung"))
    given = given.select(up_a.alias("a"), up_b.alias("b"), no.alias("more_children"), "more_leaves", "more_saved")
    one = F.lit(1).cast("long").alias("more_children")
    children = direct.select("a", "b", one, no.alias("more_leaves"), no.alias("more_saved")).unionByName(
        heads.select(F.col("up_a").alias("a"), F.col("up_b").alias("b"), one, no.alias("more_leaves"), no.alias("more_saved"))
    )
    ends_here = placed.where(F.size("ids") == F.col("head_depth"))
    also = ends_here.select(
        F.col("head_a").alias("a"), F.col("head_b").alias("b"), "more_children", no.alias("more_leaves"), no.alias("more_saved")
    )
    totals = given.unionByName(children).unionByName(also).groupBy("a", "b").agg(*sums)
    totals = stage(totals, "totals")
    ending = ends_here.select(F.col("head_a").alias("a"), F.col("head_b").alias("b"), "ending")
    lows = heads.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("low").alias("up_low"))
    starts = items.groupBy("start_a", "start_b").agg(F.min("start_low").alias("up_low"))
    lows = lows.unionByName(starts.select(F.col("start_a").alias("up_a"), F.col("start_b").alias("up_b"), "up_low"))
    lows = stage(lows, "lows")
    named = heads.join(_bounded(lows), ["up_a", "up_b"]).join(totals, ["a", "b"]).join(ending, ["a", "b"], "left")
    head_nodes = named.select(
        F.col("low").alias("conv_id"), (F.col("depth") + base).cast("long").alias("depth"), F.col("up_low").alias("parent_conv_id"),
        F.col("copies").alias("n_convs"), F.col("more_children").alias("n_children"),
        F.greatest("more_leaves", F.lit(1)).alias("n_leaves"), F.col("more_saved").alias("saved"), "ending",
    )
    return nodes.drop("above_a", "above_b", "item").unionByName(head_nodes), totals


def _paths(rows: DataFrame, piece: int) -> DataFrame:
    """Nodes of pieces that only one sequence reaches; ``rest`` is the size of all later pieces."""
    schema = T.StructType.fromDDL(NODE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = column(batch, "ids")
            length = np.diff(ids.offsets.to_numpy())
            size = ids.flatten().field(2).to_numpy()
            conv, copies, first, total, rest, above = (
                np.repeat(column(batch, name).to_numpy(), length)
                for name in ("conv", "copies", "k", "depth", "rest", "start_low")
            )
            begins = np.cumsum(length) - length
            number = np.arange(len(size)) - np.repeat(begins, length)
            depth = first * piece + number + 1
            last = depth == total
            before = np.cumsum(size) - size
            of_row = np.bincount(np.repeat(np.arange(len(length)), length), size, len(length)).astype(np.int64)
            after = rest + np.repeat(of_row, length) - (before - np.repeat(before[begins], length))
            parent = np.where(number == 0, above, conv)
            arrays = [conv, depth, parent, copies, ~last, np.ones(len(size)), (copies - 1) * after]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x.astype(np.int64)) for x in arrays), pa.array(conv, pa.int64(), mask=~last)],
                names=schema.names,
            )

    return rows.select("conv", "k", "depth", "copies", "rest", "start_low", "ids").mapInArrow(run, schema)


def trie(
    turns: DataFrame,
    conversations: DataFrame,
    piece: int = PIECE,
    limit: int = LIMIT,
    levels: int = LEVELS,
) -> tuple[DataFrame, DataFrame]:
    """Nodes of the trie, and the members: ``conv_id`` and the smallest conversation with its sequence, ``conv``.

    ``turns`` are numbered without gaps (``numbered_turns``); ``conversations`` names them all, also
    those without turns, which end at the root. A node is named by the smallest conversation that passes it and
    its depth; columns as ``NODE``, where ``saved`` sums (n_convs - 1) times the size of the last turn
    over the subtree and ``ending`` is the smallest conversation that ends here, if any does. The root has no
    parent. Without conversations there is no node.
    """
    pieces, classes, members = sequences(turns, conversations, piece)
    least, count = classes.agg(F.min("conv"), F.sum("copies")).first()
    if least is None:
        return turns.sparkSession.createDataFrame([], NODE), members
    deepest = classes.agg(F.max("depth")).first()[0]
    nothing = [F.lit(0).cast("long").alias(name) for name in BELOW]
    first = pieces.withColumns({
        "start_a": F.lit(0).cast("long"), "start_b": F.lit(0).cast("long"), "start_low": F.lit(least),
    })
    if deepest <= piece:
        items = first.select("conv", "start_a", "start_b", "start_low", "ids", "copies", F.col("conv").alias("ending"), *nothing)
        found, totals = _stratum(items, 0, limit, levels)
    else:
        found, totals = _long(pieces, least, piece, limit, levels)
    turnless = classes.where("depth = 0").select("conv").first()
    at_root = totals.where("a = 0 and b = 0").agg(*(F.coalesce(F.sum(name), F.lit(0)) for name in BELOW))
    children, leaves, saved = at_root.first()
    ending = turnless["conv"] if turnless else None
    root = turns.sparkSession.createDataFrame([(least, 0, None, count, children, max(leaves, 1), saved, ending)], NODE)
    return found.unionByName(root), members


def _long(
    pieces: DataFrame, least: int, piece: int, limit: int, levels: int
) -> tuple[DataFrame, DataFrame]:
    """Sequences of several pieces, the last pieces first.

    Only pieces whose start is shared by several sequences need a trie of their own; the number of rounds
    is how many pieces deep two different sequences go together.
    """
    size = F.aggregate("ids", F.lit(0).cast("long"), lambda done, x: done + x["size"])
    order = Window.partitionBy("conv").orderBy("k")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(1, Window.unboundedFollowing)
    light = pieces.select(
        "conv", "k", F.xxhash64("k", "ids").alias("a"), F.xxhash64(F.lit(1), "ids", "k").alias("b"), size.alias("size")
    )
    zero = F.lit(0).cast("long")
    light = light.select(
        "conv", "k",
        F.coalesce(F.bit_xor("a").over(before), zero).alias("start_a"),
        F.coalesce(F.bit_xor("b").over(before), zero).alias("start_b"),
        F.coalesce(F.sum("size").over(after), zero).alias("rest"),
        F.lead("k").over(order).alias("next"), "a", "b",
    )
    ends = {"end_a": F.col("start_a").bitwiseXOR(F.col("a")), "end_b": F.col("start_b").bitwiseXOR(F.col("b"))}
    light = stage(light.withColumns(ends).drop("a", "b"), "starts")
    # A sequence that ends where a piece starts passes that node, too.
    through = light.select("k", "start_a", "start_b", "conv", F.lit(1).alias("goes_on")).unionByName(
        light.select(
            (F.col("k") + 1).alias("k"), F.col("end_a").alias("start_a"), F.col("end_b").alias("start_b"),
            "conv", F.lit(0).alias("goes_on"),
        )
    )
    starts = through.groupBy("k", "start_a", "start_b").agg(
        F.sum("goes_on").alias("sharers"), F.min("conv").alias("start_low")
    )
    low = F.when(F.col("k") == 0, F.lit(least)).otherwise(F.col("start_low"))  # the root has turnless members, too
    rows = pieces.join(light, ["conv", "k"]).join(starts, ["k", "start_a", "start_b"])
    rows = stage(rows.withColumn("start_low", low), "rows")
    alone = rows.where("k > 0 and sharers = 1")
    found = _paths(alone, piece)
    path_totals = alone.select(
        F.col("start_a").alias("a"), F.col("start_b").alias("b"), F.lit(1).cast("long").alias("more_children"),
        F.lit(1).cast("long").alias("more_leaves"),
        ((F.col("copies") - 1) * (F.col("rest") + size)).alias("more_saved"), F.col("k"),
    )
    shared = rows.where("k = 0 or sharers > 1")
    totals = None
    for k in range(int(shared.agg(F.max("k")).first()[0]), -1, -1):
        below = path_totals.where(F.col("k") == k + 1).drop("k")
        if totals is not None:
            below = below.unionByName(totals)
        own = shared.where(F.col("k") == k)
        same = own.groupBy("end_a", "end_b").agg(
            F.min("conv").alias("conv"), F.sum("copies").alias("copies"),
            F.max(F.when(F.col("next").isNull(), F.col("conv"))).alias("ending"),
        )
        items = same.join(own.select("conv", "start_a", "start_b", "start_low", "ids"), "conv")
        items = items.join(
            below.withColumnsRenamed({"a": "end_a", "b": "end_b"}), ["end_a", "end_b"], "left"
        ).fillna(0, BELOW)
        items = stage(items.drop("end_a", "end_b"), "items")
        nodes, totals = _stratum(items, k * piece, limit, levels)
        found, totals = found.unionByName(nodes), stage(totals, "totals")
    return found, totals


def member_digests(members: DataFrame) -> DataFrame:
    """``conv`` and ``ends_sha256``, a digest of its members' ids in ascending order, joined by commas.

    Ids are joined to longer texts where they lie after a sort by range, so a sequence with very many
    members is spread over tasks; a task that makes a digest reads those texts one after the other.
    """
    chunk = T.StructType.fromDDL("conv long, first long, text string")
    digest = T.StructType.fromDDL("conv long, ends_sha256 string")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, ids = column(batch, "conv").to_numpy(), column(batch, "conv_id").to_numpy()
            if not len(conv):
                continue
            new = np.diff(conv, prepend=conv[0] - 1) != 0
            cuts = np.union1d(np.flatnonzero(new), np.arange(0, len(conv), CHUNK))
            texts = [",".join(map(str, part.tolist())) for part in np.split(ids, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(conv[cuts]), pa.array(ids[cuts]), pa.array(texts, pa.string())], names=chunk.names
            )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            done = []
            for conv, text in zip(column(batch, "conv").to_pylist(), column(batch, "text").to_pylist(), strict=True):
                if conv == current:
                    state.update(b"," + text.encode())
                    continue
                if current is not None:
                    done.append((current, state.hexdigest()))
                current, state = conv, hashlib.sha256(text.encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([c for c, _ in done], pa.int64()), pa.array([d for _, d in done], pa.string())], names=digest.names
            )
        if current is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([current], pa.int64()), pa.array([state.hexdigest()])], names=digest.names
            )

    ranges = members.select("conv", "conv_id").repartitionByRange("conv", "conv_id")
    texts = ranges.sortWithinPartitions("conv", "conv_id").mapInArrow(joined, chunk)
    return texts.repartition("conv").sortWithinPartitions("conv", "first").mapInArrow(digests, digest)
