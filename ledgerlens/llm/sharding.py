"""Shards balanced by vector bin packing: bytes, tokens and rows at once.

Rows with equal texts form a group that stays together. Groups that hold more
than 1/SPLIT of a shard's share (by bytes, tokens or rows) are placed one by
one; the many small ones are first thrown into BUNDLES bundles a shard by the
hash of their text, so a bounded number of items is packed however long the
table is. Items go, largest first, to the shard where the dot product of the
item with what is left of the shard's share is highest; bytes, tokens and rows weigh
the same. The law that holds is `bytes`: a shard takes an item only while it has room for
its bytes, and the smallest items, LAST of all of them, go where most bytes are left. A group of more than a whole shard's share of bytes, tokens or
rows can't stay together under that law; it is cut, by a hash of the row, into the
fewest pieces that fit.

Slots are numbered without one task seeing a shard whole: rows are counted per
shard and cell (a hash of the id), a cell's rows are numbered, and the counts of
the cells before are added.

Null text is empty text, so the two are one group. Rows with null or repeated ids are spread
by their place in the table, which is stored with them. Repeated rows get slots of their own. An empty table has no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.mixing import word_count
from ledgerlens.sources.scratch import stored

SHARDS = 24
BUNDLES = 256  # of small groups, a shard
SPLIT = 64  # a group above 1/SPLIT of a shard's share is an item of its own
CELLS = 256  # a shard, for numbering
ROW_BYTES = 8
DIMENSIONS = ["bytes", "tokens", "rows"]
LAST = 0.25  # share of the items, smallest ones, that level the bytes


def pack(items: list[Row], shards: int) -> list[tuple[int, int]]:
    """(item, shard) by greatest dot product with residual capacity; items are (item, bytes, tokens, rows)."""
    if not items:
        return []
    sizes = np.array([[float(r[d]) for d in DIMENSIONS] for r in items])
    shares = sizes / np.maximum(sizes.sum(axis=0) / shards, 1e-9)
    order = sorted(range(len(items)), key=lambda i: (-float(shares[i].sum()), items[i]["item"]))
    left = np.ones((shards, len(DIMENSIONS)))
    placed = []
    for nth, i in enumerate(order):
        room = left[:, 0] >= shares[i, 0]
        levelling = nth >= (1 - LAST) * len(order) or not room.any()
        shard = int(np.argmax(left[:, 0] if levelling else np.where(room, left @ shares[i], -np.inf)))
        left[shard] -= shares[i]
        placed.append((items[i]["item"], shard))
    return placed


def _sums(*columns) -> list:
    return [F.sum(c).alias(c) for c in columns]


def _items(rows: DataFrame, shards: int) -> DataFrame:
    """`rows` with the item each belongs to.

    Fewer than 3 * SPLIT * shards groups can be large in one of three sums, so
    their table is broadcast.
    """
    total = rows.agg(*_sums(*DIMENSIONS)).first()
    groups = rows.groupBy("group").agg(*_sums(*DIMENSIONS))
    large = " OR ".join(f"{d} * {SPLIT * shards}L > {total[d] or 0}L" for d in DIMENSIONS)
    pieces = F.greatest(*[F.ceil(F.col(d) * shards / F.lit(max(1, total[d] or 0))) for d in DIMENSIONS]).cast("int")
    marked = groups.filter(large).select(F.col("group").alias("_large"), pieces.alias("_pieces"))
    piece = F.pmod(F.xxhash64(F.lit("piece"), "id", "at"), F.col("_pieces"))
    bundle = F.pmod(F.col("group"), F.lit(shards * BUNDLES))
    item = F.when(F.col("_large").isNotNull(), F.xxhash64("_large", piece)).otherwise(bundle)
    return rows.join(F.broadcast(marked), F.col("group") == F.col("_large"), "left").select(
        *rows.columns, item.alias("item")
    )


def assign_shards(
    df: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per input row: id, size, text_crc32, law, shard, slot, grown_shard.

    Only ids, hashes and sizes are stored and shuffled. The driver packs at most
    shards * (BUNDLES + 4 * SPLIT) items.
    """
    spark: SparkSession = df.sparkSession
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = stored(
        df.select(
            F.col(id_column).alias("id"),
            F.xxhash64(text).alias("group"),
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("bytes"),
            word_count(text).alias("tokens"),
            F.lit(1).cast("long").alias("rows"),
            F.crc32(text.cast("binary")).alias("crc"),
            F.monotonically_increasing_id().alias("at"),
        )
    )
    rows = _items(rows, shards)
    items = rows.groupBy("item").agg(*_sums(*DIMENSIONS)).collect()
    placed = spark.createDataFrame(pack(items, shards), "item long, shard int")
    cell = F.pmod(F.xxhash64(F.lit("cell"), "id", "at"), F.lit(CELLS)).cast("int")
    placed = stored(rows.join(F.broadcast(placed), "item").withColumn("cell", cell))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "cell").agg(F.count("*").alias("_n"))
    offsets = counts.select("shard", "cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    in_cell = Window.partitionBy("shard", "cell").orderBy("id", "group", "at")
    numbered = placed.withColumn("_nth", F.row_number().over(in_cell))
    return numbered.join(F.broadcast(offsets), ["shard", "cell"]).select(
        F.col("id").alias(id_column),
        F.col("bytes").alias("size"),
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_before") + F.col("_nth") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
