"""Nearest neighbours by multiprobe p-stable hashing, reranked by exact distance.

A table hashes a vector by FUNCTIONS (more for more rows) Gaussian projections,
each cut into cells of equal width. The projection of the step from a query to a
neighbour at distance r is normal with deviation r, so the probability that
the neighbour lies in a given bucket is a product of normal integrals. A query
visits the buckets of a table in falling order of that probability, until the
visited ones add up to what TABLES tables need for the target recall. r is the
distance of the wanted neighbour within a bounded sample (`SAMPLE` vectors), which
is never less than the true one, so the stop errs on the side of visiting more.
A query that finds fewer than it wants is compared with all rows, in blocks, and so is one
whose wanted sum takes more than MOST_PROBES buckets of a table or more than there are (its
neighbours are many cells away): hashing has nothing to save there. Candidates have no cap.

Equal vectors form a class: one is indexed, its `k + 1` smallest ids are put in
after the search. Buckets are cut into blocks of rows and of queries, and each
pair of blocks is one group, so no task holds more than two blocks. A group
returns only its best `k + 1` a query, and only what lies within the distance of
the 2 * (k + 1)-th nearest sample vector: as many rows are at least that near, so
nothing farther can be among the k nearest.

Null, zero, non-finite or differently long vectors and null ids take no part.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.text import mix64
from ledgerlens.llm.vectors import classes, lists, matrix, sample_matrix, usable
from ledgerlens.sources.scratch import stored

TABLES, TARGET = 2, 0.97
SAMPLE = 8192
CELL = 1.6  # width of a cell, in typical neighbour distances
ROWS_BLOCK, QUERIES_BLOCK = 4096, 1024
MOST_PROBES = 20_000  # of a table; a query that needs more meets all rows
SEED = 20240301


class Hashes:
    """The projections of all tables; small, sent along with each task."""

    def __init__(self, width: int, rows: int, radius: float):
        rng = np.random.default_rng(SEED)
        self.functions = max(2, round(math.log2(max(2, rows)) / 2.5))
        self.cell = CELL * radius
        self.directions = rng.normal(size=(TABLES, width, self.functions))
        self.shifts = rng.uniform(0, self.cell, size=(TABLES, self.functions))
        self.step = np.uint64(0xA0761D6478BD642F)

    def places(self, points: np.ndarray, table: int) -> np.ndarray:
        """Projections in units of cells."""
        return (points @ self.directions[table] + self.shifts[table]) / self.cell

    def keys(self, cells: np.ndarray, table: int) -> np.ndarray:
        """One 64-bit key per row of integer cells."""
        keys = np.full(len(cells), table, np.uint64)
        for column in cells.T:
            keys = mix64(keys * self.step + column.astype(np.int64).view(np.uint64))
        return keys.view(np.int64)


def normal_cdf(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.vectorize(math.erf, otypes=[float])(x / math.sqrt(2)))


def probe_cells(place: np.ndarray, spread: float, enough: float, most: int = MOST_PROBES) -> np.ndarray | None:
    """Cells in falling order of the probability that a neighbour `spread` cells away is there, up to `enough` in sum.

    The query's own cell always comes along. None, if that takes more than `most` cells.
    """
    home = np.floor(place).astype(np.int64)
    reach = int(min(64, math.ceil(4 * spread) + 1))
    steps = np.arange(-reach, reach + 1)
    edges = (home[:, None] + np.arange(-reach, reach + 2)[None, :] - place[:, None]) / max(spread, 1e-12)
    chance = np.diff(normal_cdf(edges), axis=1)
    order = np.argsort(-chance, axis=1, kind="stable")
    chance = np.take_along_axis(chance, order, 1)
    options = [steps[o] for o in order]
    width = len(place)
    start = (0,) * width
    # best first over rank vectors; each is reached once, by raising ranks from its last raised place on
    waiting = [(-float(chance[:, 0].prod()), start, 0)]
    found, total = [], 0.0
    while waiting and total < enough:
        if len(found) >= most:
            return None
        minus, ranks, last = heapq.heappop(waiting)
        total -= minus
        found.append([home[f] + options[f][r] for f, r in enumerate(ranks)])
        for f in range(last, width):
            raised = ranks[f] + 1
            if raised < chance.shape[1] and chance[f, raised] > 0:
                better = -minus / chance[f, ranks[f]] * chance[f, raised]
                heapq.heappush(waiting, (-better, ranks[:f] + (raised,) + ranks[f + 1 :], f))
    cells = np.array(found, np.int64)
    return cells if (cells == home).all(axis=1).any() else np.vstack((cells, home))


def _hashed(rows: DataFrame, hashes) -> DataFrame:
    """(bucket, cls, vec) for every table."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = matrix(batch.column(1))
            for table in range(TABLES if len(points) else 0):
                places = hashes.value.places(points, table)
                keys = hashes.value.keys(np.floor(places), table)
                yield pa.RecordBatch.from_arrays([pa.array(keys), *batch.columns], ["bucket", "cls", "vec"])

    return rows.select("cls", "vec").mapInArrow(read, "bucket bigint, cls bigint, vec array<double>")


def _probes(queries: DataFrame, hashes, sample, wanted: int, most: int) -> DataFrame:
    """(bucket, cls, reach) of every bucket that a query visits; what is farther than `reach` can't be wanted.

    A query that would visit more than `most` of a table visits none.
    """
    enough = 1 - (1 - TARGET) ** (1 / TABLES)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker, near = hashes.value, sample.value
        for batch in batches:
            points, names = matrix(batch.column(1)), batch.column(0).to_numpy()
            for at in range(len(points)):
                distances = np.sort(np.sqrt(((near - points[at]) ** 2).sum(axis=1)))
                last = 2 * (wanted + 1)
                reach = distances[last - 1] * (1 + 1e-12) if len(distances) >= last else np.inf
                distances = distances[distances > 0]
                spread = distances[min(wanted, len(distances)) - 1] / maker.cell if len(distances) else 0.0
                cells = [probe_cells(maker.places(points[at : at + 1], table)[0], spread, enough, most) for table in range(TABLES)]
                for table in range(TABLES if all(c is not None for c in cells) else 0):
                    keys = maker.keys(cells[table], table)
                    arrays = [pa.array(keys), pa.array(np.full(len(keys), names[at])), pa.array(np.full(len(keys), reach))]
                    yield pa.RecordBatch.from_arrays(arrays, ["bucket", "cls", "reach"])

    return queries.select("cls", "vec").mapInArrow(read, "bucket bigint, cls bigint, reach double")


def nearest_in_block(table: pa.Table, wanted: int) -> pa.Table:
    """(query, cls, distance): the `wanted` nearest rows of the block within reach of each of its queries."""
    is_query = table.column("is_query").to_numpy()
    reach = table.column("reach").to_numpy()[is_query]
    names, points = table.column("cls").to_numpy(), matrix(table.column("vec"))
    queries, rows, query_names, row_names = points[is_query], points[~is_query], names[is_query], names[~is_query]
    found: list[list] = [[], [], []]
    if len(queries) and len(rows):
        squares = (rows * rows).sum(axis=1)
        for at in range(len(queries)):
            rough = squares - 2 * (rows @ queries[at])
            cut = np.partition(rough, wanted - 1)[wanted - 1] if len(rows) > wanted else np.inf
            slack = 1e-9 * (1 + squares.max() + (queries[at] ** 2).sum())
            near = np.flatnonzero(rough <= cut + slack)
            exact = np.sqrt(((rows[near] - queries[at]) ** 2).sum(axis=1))
            best = min(np.sort(exact)[:wanted][-1], reach[at])
            near, exact = near[exact <= best], exact[exact <= best]  # ties stay
            found[0].append(np.full(len(near), query_names[at]))
            found[1].append(row_names[near])
            found[2].append(exact)
    columns = [np.concatenate(f) if f else np.zeros(0, t) for f, t in zip(found, (np.int64, np.int64, np.float64))]
    return pa.table(dict(zip(("query", "cls", "distance"), columns)))


def _blocks(side: DataFrame, key: str, size: int) -> DataFrame:
    return side.groupBy(key).agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))


def _met(data: DataFrame, queries: DataFrame, wanted: int) -> DataFrame:
    """Nearest rows per query within each bucket; `data` is (bucket, cls, vec), `queries` has `reach` as well."""
    of_data, of_queries = _blocks(data, "bucket", ROWS_BLOCK), _blocks(queries, "bucket", QUERIES_BLOCK)
    both = of_data.withColumnRenamed("blocks", "_rows").join(of_queries.withColumnRenamed("blocks", "_queries"), "bucket")

    def placed(side: DataFrame, own: str, other: str, is_query: bool) -> DataFrame:
        block = F.pmod(F.xxhash64(F.lit("block"), "cls"), F.col(own)).cast("int")
        spread = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        reach = F.col("reach") if is_query else F.lit(float("inf")).alias("reach")
        cut = side.join(both, "bucket").select("bucket", block.alias(own + "_at"), spread.alias(other + "_at"), "cls", "vec", reach)
        return cut.select("bucket", "_rows_at", "_queries_at", "cls", "vec", "reach", F.lit(is_query).alias("is_query"))

    every = placed(data, "_rows", "_queries", False).union(placed(queries, "_queries", "_rows", True))
    return every.groupBy("bucket", "_rows_at", "_queries_at").applyInArrow(
        lambda table: nearest_in_block(table, wanted), "query bigint, cls bigint, distance double"
    )


def nearest(
    df: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """(query_id, rank, id, score): the k nearest rows of `df` found for each row of `queries`, itself left out.

    `queries` are rows of `df`. Equal distances go to the smaller id.
    """
    wanted = k + 1  # classes: the query's own may hold no other row
    rows = stored(usable(df, id_column, vector_column))
    distinct = stored(classes(rows, wanted))
    asked = queries.select(F.col(id_column).alias("id")).distinct().join(rows, "id").withColumn("cls", F.xxhash64("vec"))
    asked = stored(asked.select("id", "cls"))
    asking = stored(distinct.join(asked.select("cls").distinct(), "cls", "left_semi").select("cls", "vec"))
    sample = sample_matrix(distinct, SAMPLE, "search")
    n = distinct.count()
    context = df.sparkSession.sparkContext
    if n:
        head = sample[:64]
        apart = np.sqrt(((head[:, None, :] - sample[None, :, :]) ** 2).sum(axis=2))
        apart.sort(axis=1)
        radius = float(np.median(apart[:, min(wanted, apart.shape[1] - 1)])) or 1.0
    else:
        radius = 1.0
    hashes = context.broadcast(Hashes(sample.shape[1], n, radius))
    index = stored(_hashed(distinct, hashes))
    most = min(MOST_PROBES, index.select("bucket").distinct().limit(MOST_PROBES).count())
    probes = _probes(asking.repartition(max(1, context.defaultParallelism), "cls"), hashes, context.broadcast(sample), k, most)
    probed = stored(probes.join(asking, "cls").select("bucket", "cls", "vec", "reach"))
    found = stored(_met(index, probed, wanted).distinct())
    # queries that found too few meet all rows, cut into blocks by a hash
    short = asking.join(found.groupBy("query").agg(F.count("*").alias("_n")), F.col("cls") == F.col("query"), "left")
    short = stored(short.filter(F.coalesce("_n", F.lit(0)) < min(wanted, n)).select("cls", "vec"))
    blocks = max(1, n // ROWS_BLOCK)
    all_rows = distinct.select(F.pmod("cls", F.lit(blocks)).alias("bucket"), "cls", "vec")
    every_block = F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))
    for_all = short.select(F.explode(every_block).alias("bucket"), "cls", "vec", F.lit(float("inf")).alias("reach"))
    more = _met(all_rows, for_all, wanted)
    found = found.union(more).distinct()
    members = distinct.select("cls", "ids", F.col("ids")[0].alias("first"))
    by_class = Window.partitionBy("query").orderBy("distance", "first")
    best = found.join(members, "cls").withColumn("_nth", F.row_number().over(by_class)).filter(F.col("_nth") <= wanted)
    best = best.select("query", "distance", "ids")
    answers = asked.join(best, asked["cls"] == best["query"]).select(
        F.col("id").alias("query_id"), F.explode("ids").alias("_id"), F.col("distance").alias("score")
    )
    ranked = answers.filter("_id <> query_id").withColumn(
        "rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "_id"))
    )
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", F.col("_id").alias(id_column), "score")
