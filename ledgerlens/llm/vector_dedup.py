"""Near-duplicate vectors by a forest of random-projection trees.

Equal vectors form a class; one of each class is compared. Dense groups come
first: a core is a centre, found on a bounded sample (`SAMPLE` vectors), with all
vectors within half the threshold's angle of it. Two vectors of a core are linked
for certain, so they are counted, not compared. A vector outside that is linked
with one of a core lies within one and a half angles of the centre: such vectors
are compared with the whole core. Nothing of a core is lost, however large it is.

The vectors of no core go through the forest. A tree splits space by random
directions, one per level, at the median of the projections; vectors within SPILL
of the median (as a share of the node), and at least within half the gap that a
pair at the threshold has in a random direction, go down both sides. A node that
such a split would not shrink below MOST of itself lies mostly inside one group
and is left whole. Trees are fitted on the sample; their depth follows the number
of vectors as far as the sample tells, and every vector is sent down every tree. Leaves
that hold more than OVERSIZED vectors then go on as trees of their own, each fitted in a task on LEAF_SAMPLE
of its vectors, round after round, until leaves hold about LEAF vectors or are left whole; that takes
nothing through the driver, however many leaves there are. Vectors are compared within leaves, in blocks: a leaf beyond
BLOCK rows is cut into blocks and every pair of blocks is a group of its own, so
no task holds more than two blocks and none is left out.

A leaf's matrix product gives its pairs with cosine >= the threshold, in double
precision. No pair leaves the task: a pair is counted in the first of the leaves
that hold both its vectors (each vector carries the list of its leaves), each
vector reports its number of links, weighed with the copies behind them, and the
smallest vector it reaches within the group. These few rows are united into
components.

Vectors that are null, zero, of another length, or hold null or non-finite
components link with nothing. Rows with a null id have no component and are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.components import components
from ledgerlens.llm.text import BASE, mix64
from ledgerlens.llm.vectors import classes, lists, matrix, sample_matrix, usable
from ledgerlens.operators.joins import lookup_join
from ledgerlens.sources.scratch import stored

COSINE = 0.9
TREES, SPILL, MOST = 4, 0.1, 0.7  # halves above 0.7 of a node each hold as many pairs as the node
SAMPLE, LEAF, BLOCK = 8192, 768, 1536
OVERSIZED, LEAF_SAMPLE = 4 * LEAF, 256
LEAST = 16  # vectors of the sample that make a core, or a node that is split
MARGIN = 1e-9  # what rounding may do to a cosine
SEED = 20240229


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so squares neither overflow nor vanish."""
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True) if len(rows) else rows
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True)) if len(rows) else rows


def fit_cores(points: np.ndarray, cosine: float) -> np.ndarray:
    """Centres (unit rows) of groups of the sample, each with LEAST or more vectors within half the threshold's angle."""
    within, centres = math.cos(math.acos(cosine) / 2) + MARGIN, []
    free = np.ones(len(points), bool)
    near = np.array([(points @ p >= cosine).sum() for p in points], int)
    for at in np.argsort(-near, kind="stable"):
        if near[at] < LEAST:
            break
        if not free[at]:
            continue
        held = free & (points @ points[at] >= cosine)
        for _ in range(3):
            if held.sum() < LEAST:
                break
            centre = unit(points[held].mean(axis=0, keepdims=True))[0]
            held = free & (points @ centre >= within)
        free[at] = False
        if held.sum() >= LEAST:
            centres.append(centre)
            free &= ~held
    return np.array(centres).reshape(len(centres), points.shape[1])


def fit_forest(
    sample: np.ndarray, n: int, trees: int = TREES, spill: float = SPILL, cosine: float = COSINE, seed: int | list[int] = SEED
) -> list[list[tuple]]:
    """Per tree a list of levels (direction, lower and upper bound of the spill band of each node).

    A node that is left whole has infinite bounds: all of it goes down the left side.
    """
    shrink = -math.log(0.5 + spill)
    depth = max(0, math.ceil(math.log(max(1, n) / LEAF) / shrink))
    depth = min(depth, max(0, math.ceil(math.log(max(1, len(sample)) / LEAST) / shrink)))  # the sample says no more
    rng = np.random.default_rng(seed)
    points = unit(sample)
    forest = []
    for _ in range(trees):
        levels, members = [], [np.arange(len(points))]
        for _ in range(depth):
            direction = rng.normal(size=points.shape[1])
            gap = math.sqrt(max(0.0, 2 - 2 * cosine) / points.shape[1]) * np.linalg.norm(direction)
            below, bounds = [], []
            for rows in members:
                low, high = np.inf, np.inf
                if len(rows) >= LEAST:
                    projected = points[rows] @ direction
                    cut = np.quantile(projected, [0.5 - spill, 0.5, 0.5 + spill])
                    left, right = min(cut[0], cut[1] - gap / 2), max(cut[2], cut[1] + gap / 2)
                    if max((projected <= right).mean(), (projected >= left).mean()) <= MOST:
                        low, high = left, right
                bounds.append((low, high))
                if low < np.inf:
                    below += [rows[projected <= high], rows[projected >= low]]
                else:
                    below += [rows, rows[:0]]
            levels.append((direction, *np.array(bounds).T))
            members = below
        forest.append(levels)
    return forest


def leaves(points: np.ndarray, forest: list[list[tuple]]) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf): all leaves of each row, numbered through all trees."""
    rows_found, leaves_found, first = [], [], 0
    for levels in forest:
        rows, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        for direction, low, high in levels:
            projected = (points @ direction)[rows]
            left, right = projected <= high[node], projected >= low[node]
            rows, node = np.concatenate((rows[left], rows[right])), np.concatenate((2 * node[left], 2 * node[right] + 1))
        rows_found.append(rows)
        leaves_found.append(node + first)
        first += 1 << len(levels)
    return np.concatenate(rows_found), np.concatenate(leaves_found)


def _assign(rows: DataFrame, centres: np.ndarray, cosine: float) -> DataFrame:
    """Add `core`, the core of each vector or -1, and `beside`, the cores with a smaller number or, of none, all cores it may link with.

    A pair from two cores is left to the core with the smaller number.
    """
    shared = rows.sparkSession.sparkContext.broadcast(centres)
    angle = math.acos(cosine)
    within, reach = math.cos(angle / 2) + MARGIN, math.cos(min(1.5 * angle, math.pi)) - MARGIN

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, n = matrix(batch.column(1)), len(shared.value)
            near = unit(points) @ shared.value.T if n and len(points) else np.zeros((len(points), 0))
            core = np.where(near.max(axis=1) >= within, near.argmax(axis=1), -1) if near.size else np.full(len(points), -1)
            row, beside = np.nonzero((near >= reach) & (np.arange(near.shape[1]) < np.where(core < 0, n, core)[:, None]))
            offsets = np.searchsorted(row, np.arange(len(points) + 1)).astype(np.int32)
            lists_ = pa.ListArray.from_arrays(offsets, pa.array(beside.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(core.astype(np.int32)), lists_], ["cls", "vec", "copies", "core", "beside"])

    chosen = rows.select("cls", "vec", "copies")
    return chosen.mapInArrow(assign, "cls bigint, vec array<double>, copies bigint, core int, beside array<int>")


def compare_sides(table: pa.Table, cosine: float) -> pa.Table:
    """(cls, links, reached) of a block of a core and a block of the vectors beside it."""
    names, copies = table.column("cls").to_numpy(), table.column("copies").to_numpy()
    inside = table.column("inside").to_numpy(zero_copy_only=False)
    if inside.all() or not inside.any():
        return pa.table({"cls": names[:0], "links": copies[:0], "reached": names[:0]})
    points = unit(matrix(table.column("vec")))
    a, b = np.flatnonzero(inside), np.flatnonzero(~inside)
    linked = points[a] @ points[b].T >= cosine
    links, reached = np.zeros(len(names), np.int64), names.copy()
    links[a], links[b] = linked @ copies[b], linked.T @ copies[a]
    met = linked.any(axis=0)  # the core is one component: one link into it is enough
    reached[b[met]] = names[a[linked[:, met].argmax(axis=0)]]
    found = links > 0
    return pa.table({"cls": names[found], "links": links[found], "reached": reached[found]})


def _cored(assigned: DataFrame, cosine: float) -> DataFrame:
    """(cls, links, reached) of all pairs with a vector of a core."""
    members = assigned.filter("core >= 0")
    beside = assigned.select("cls", "vec", "copies", F.explode("beside").alias("core"))
    total = members.groupBy("core").agg(F.sum("copies").alias("total"), F.min("cls").alias("first"), F.count("*").alias("n"))
    total = F.broadcast(stored(total))  # at most SAMPLE / LEAST cores
    certain = members.join(total, "core").select("cls", (F.col("total") - F.col("copies")).alias("links"), F.col("first").alias("reached"))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    sizes = beside.groupBy("core").agg(F.count("*").alias("m")).join(total, "core")
    sizes = F.broadcast(stored(sizes.select("core", blocks("n").alias("ins"), blocks("m").alias("outs"))))
    block = lambda n: F.pmod(F.xxhash64(F.lit("block"), "cls"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["core", "i", "j", "inside", "cls", "vec", "copies"]
    inner = members.join(sizes, "core").withColumn("i", block("ins")).withColumn("j", every("outs")).withColumn("inside", F.lit(True))
    outer = beside.join(sizes, "core").withColumn("j", block("outs")).withColumn("i", every("ins")).withColumn("inside", F.lit(False))
    sides = inner.select(columns).union(outer.select(columns)).groupBy("core", "i", "j")
    return certain.union(sides.applyInArrow(lambda table: compare_sides(table, cosine), "cls bigint, links bigint, reached bigint"))


def _route(rows: DataFrame, forest: list[list[tuple]]) -> DataFrame:
    """Add `leaves`, the sorted leaves of each vector."""
    shared = rows.sparkSession.sparkContext.broadcast(forest)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = matrix(batch.column(1))
            row, leaf = leaves(unit(points), shared.value) if len(points) else (np.zeros(0, int), np.zeros(0, int))
            order = np.lexsort((leaf, row))
            offsets = np.searchsorted(row[order], np.arange(len(points) + 1)).astype(np.int32)
            found = pa.ListArray.from_arrays(offsets, pa.array(leaf[order].astype(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], ["cls", "vec", "copies", "leaves"])

    chosen = rows.select("cls", "vec", "copies")
    return chosen.mapInArrow(route, "cls bigint, vec array<double>, copies bigint, leaves array<bigint>")


def _seed(leaf: int) -> list[int]:
    return [SEED, leaf & (1 << 62) - 1]


def fit_leaf(table: pa.Table, cosine: float) -> pa.Table:
    """(leaf, depth, bounds): the tree that an oversized leaf goes on as; its directions follow from the leaf's number."""
    leaf, n = (table.column(c)[0].as_py() for c in ("leaf", "n"))
    (levels,) = fit_forest(matrix(table.column("vec")), n, trees=1, cosine=cosine, seed=_seed(leaf))
    bounds = [np.stack((low, high), axis=1).ravel().tolist() for _, low, high in levels]
    return pa.table(
        {"leaf": pa.array([leaf]), "depth": pa.array([len(levels)], pa.int32()), "bounds": pa.array([sum(bounds, [])], pa.list_(pa.float64()))}
    )


def leaf_levels(leaf: int, depth: int, bounds: np.ndarray, width: int) -> list[tuple]:
    """The levels that `fit_leaf` wrote down."""
    rng, pairs, levels = np.random.default_rng(_seed(leaf)), bounds.reshape(-1, 2), []
    for level in range(depth):
        own = pairs[(1 << level) - 1 : (2 << level) - 1]
        levels.append((rng.normal(size=width), own[:, 0], own[:, 1]))
    return levels


def deeper_leaves(leaf: int, points: np.ndarray, levels: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """(row, new leaf) of the vectors of a leaf; a negative one was left whole and is not split again."""
    whole = np.zeros(1, bool)
    for _, low, _ in levels:
        whole = np.repeat(whole | np.isinf(low), 2)
    row, node = leaves(points, [levels])
    numbers = mix64(np.full(len(node), leaf, np.int64).view(np.uint64) * np.uint64(BASE) + node.astype(np.uint64)) >> np.uint64(2)
    numbers = numbers.astype(np.int64) + 1
    return row, np.where(whole[node] | (len(levels) == 0), -numbers, numbers)


def _sent_deeper(members: DataFrame) -> DataFrame:
    """(cls, leaf) of the vectors of oversized leaves, which come with the tree of their leaf."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            names, points, numbers = batch.column(0).to_numpy(), unit(matrix(batch.column(1))), batch.column(2).to_numpy()
            found = []
            for leaf in np.unique(numbers):
                at = np.flatnonzero(numbers == leaf)
                bounds = batch.column(4)[int(at[0])].values.to_numpy()
                levels = leaf_levels(int(leaf), batch.column(3)[int(at[0])].as_py(), bounds, points.shape[1])
                row, deeper = deeper_leaves(int(leaf), points[at], levels)
                found.append((names[at[row]], deeper))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["cls", "leaf"])

    return members.select("cls", "vec", "leaf", "depth", "bounds").mapInArrow(send, "cls bigint, leaf bigint")


def _refined(routed: DataFrame, cosine: float) -> DataFrame:
    """`routed` with its oversized leaves split further."""
    while True:
        in_leaf = routed.select("cls", "vec", F.explode("leaves").alias("leaf"))
        large = stored(in_leaf.groupBy("leaf").agg(F.count("*").alias("n")).filter((F.col("n") > OVERSIZED) & (F.col("leaf") >= 0)))
        if large.isEmpty():
            return routed
        nth = F.row_number().over(Window.partitionBy("leaf").orderBy(F.xxhash64(F.lit("leaf"), "cls"), "cls"))
        inside = lookup_join(in_leaf, large, ["leaf"], "cls").filter("n IS NOT NULL")
        sampled = inside.withColumn("_nth", nth).filter(F.col("_nth") <= LEAF_SAMPLE).select("leaf", "n", "vec")
        trees = sampled.groupBy("leaf").applyInArrow(lambda table: fit_leaf(table, cosine), "leaf bigint, depth int, bounds array<double>")
        fitted = lookup_join(in_leaf, stored(trees), ["leaf"], "cls")
        deeper = _sent_deeper(fitted.filter("depth IS NOT NULL"))
        kept = fitted.filter("depth IS NULL").select("cls", "leaf")
        found = kept.unionAll(deeper).groupBy("cls").agg(F.sort_array(F.collect_set("leaf")).alias("leaves"))
        routed = stored(routed.drop("leaves").join(found, "cls").select("cls", "vec", "copies", "leaves"))


def smallest_reached(linked: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Smallest name in each row's component of a symmetric link matrix."""
    reached = names.copy()
    while True:
        near = np.where(linked, reached[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
        fresh = np.minimum(reached, near)
        if (fresh == reached).all():
            return reached
        reached = fresh


def compare_leaf(table: pa.Table, cosine: float) -> pa.Table:
    """(cls, links, reached) of one leaf block or pair of blocks; links counts pairs first met here."""
    leaf, i, j = (table.column(c)[0].as_py() for c in ("leaf", "i", "j"))
    names = table.column("cls").to_numpy()
    block, copies = table.column("block").to_numpy(), table.column("copies").to_numpy()
    points = unit(matrix(table.column("vec")))
    linked = points @ points.T >= cosine
    np.fill_diagonal(linked, False)
    if i != j:
        linked &= block[:, None] != block[None, :]
    counted = linked
    if linked.any():
        held = table.column("leaves").combine_chunks()
        owner = np.repeat(np.arange(len(names)), np.diff(held.offsets.to_numpy()))
        codes = held.flatten().to_numpy()
        earlier, number = np.unique(codes[codes < leaf], return_inverse=True)
        member = np.zeros((len(names), len(earlier)), np.float32)
        member[owner[codes < leaf], number] = 1
        counted = linked & ~(member @ member.T > 0)
    links = counted @ copies
    reached = smallest_reached(linked, names)
    found = (links > 0) | (reached != names)
    return pa.table({"cls": names[found], "links": links[found].astype(np.int64), "reached": reached[found]})


def _compared(routed: DataFrame, cosine: float) -> DataFrame:
    """(cls, links, reached) over all leaves."""
    by_leaf = routed.select("cls", "vec", "copies", "leaves", F.explode("leaves").alias("leaf"))
    sizes = by_leaf.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = by_leaf.join(sizes, "leaf").withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "cls"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = placed.withColumn("_other", other).withColumns({"i": F.least("block", "_other"), "j": F.greatest("block", "_other")})
    chosen = paired.select("leaf", "i", "j", "block", "cls", "vec", "copies", "leaves")
    return chosen.groupBy("leaf", "i", "j").applyInArrow(
        lambda table: compare_leaf(table, cosine), "cls bigint, links bigint, reached bigint"
    )


def near_vectors(
    df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", cosine: float = COSINE
) -> DataFrame:
    """One row per input row: id, n_links, component_id (the smallest id reachable by links) and kept."""
    rows = stored(usable(df, id_column, vector_column))
    distinct = stored(classes(rows))
    sample = sample_matrix(distinct, SAMPLE, "forest")
    centres = fit_cores(unit(sample), cosine)
    assigned = stored(_assign(distinct, centres, cosine))
    alone = assigned.filter("core < 0")
    loose = (unit(sample) @ centres.T < math.cos(math.acos(cosine) / 2) + MARGIN).all(axis=1)
    forest = fit_forest(sample[loose], alone.count(), cosine=cosine)
    routed = _refined(stored(_route(alone, forest)), cosine)
    compared = stored(_compared(routed, cosine).union(_cored(assigned, cosine)))
    links = compared.groupBy("cls").agg(F.sum("links").alias("links"))
    found = components(compared.filter("cls <> reached").select(F.col("cls").alias("a"), F.col("reached").alias("b")))
    judged = distinct.select("cls", "copies", F.col("ids")[0].alias("first")).join(links, "cls", "left")
    judged = judged.join(found.withColumnRenamed("node", "cls"), "cls", "left").withColumn("group", F.coalesce("component", "cls"))
    smallest = judged.groupBy("group").agg(F.min("first").alias("component_id"))
    judged = judged.join(smallest, "group").select(
        "cls", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    held = rows.select("id", F.xxhash64("vec").alias("cls")).join(judged, "cls").select("id", "n_links", "component_id")
    every = df.select(F.col(id_column).alias("id")).join(rows.select("id").distinct(), "id", "left_anti")
    apart = every.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return held.union(apart).select(
        F.col("id").alias(id_column), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
