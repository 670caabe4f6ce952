"""Mix sources to target weights, with SQL functions only.

Sources get targets by weight: a share of all sizes, at most `max_copies` times
the source's own size, the excess shared anew by weight. Every row has a random
but fixed place in its source (a hash of its id). Copy 1, 2, .. of a source is
its rows in that order; whole copies are drawn first, and the last one as far as
the target allows, and one row more if it brings the sum nearer. Running sizes
are added up per block of places first, so only the one block that holds the cut
is ordered row by row.

The drawn blocks are dealt to the output shards by a splitting tree: a node
holds a quota of blocks of each source and half of its shards go to each child.
Level by level, the blocks that go left are drawn from each node's quotas without
replacement, so the left quotas are multivariate hypergeometric and the two children's add up
to the node's. A shard then takes the next blocks of each source's permuted list, as many as its
quota (no block twice), and orders its rows by a hash of its own.

Sizes count words; null texts have size 0. A null source is a source of its own,
last in order. Rows that share an id share its place, so they are drawn alike.
An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.ids import with_dense_id
from ledgerlens.operators.joins import lookup_join
from ledgerlens.sources.scratch import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
PLACE_BITS = 60  # of a row's place in its source
CUT_BITS = 16  # blocks that running sizes are added up by
BLOCK_BITS = 6  # blocks that are dealt to shards
SHARDS = 16  # a power of two
PART_ROWS = 500_000  # of a shard, ordered by one task


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place(id_column, seed: str) -> F.Column:
    """60 random bits that depend on the id and the seed alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, PLACE_BITS // 4), 16, 10).cast("long")


def source_targets(sources: DataFrame, weights=WEIGHTS, numerator: int = 3, denominator: int = 2, max_copies: int = 2) -> DataFrame:
    """Add `target` to one row per source with (_source, _size).

    Sums stay whole numbers until the one division, so any order of adding gives
    the same target. Each round caps the sources above their limit; the driver
    sees two sums a round.
    """
    order = [F.col("_source").isNull(), F.col("_source")]
    numbered = with_dense_id(sources, order, "_number")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("_number") - 1) % len(weights) + 1).cast("int"))
    table = stored(numbered.withColumns({"_weight": weight, "_limit": F.col("_size") * max_copies}))
    goal = (table.agg(F.sum("_size")).first()[0] or 0) * numerator
    level, capped = 0.0, None
    while True:
        free = F.col("_limit") > F.col("_weight") * F.lit(level)
        row = table.agg(
            F.sum(F.when(free, F.col("_weight"))), F.sum(F.when(~free, F.col("_limit"))), F.count(F.when(~free, 1))
        ).first()
        if not row[0] or row[2] == capped:
            break
        capped = row[2]
        level = (goal - denominator * (row[1] or 0)) / (denominator * row[0])
    free = F.col("_limit") > F.col("_weight") * F.lit(level)
    target = F.when(free, F.col("_weight") * F.lit(level)).otherwise(F.col("_limit").cast("double"))
    return table.select("_source", "_key", "_size", target.alias("_target"))


def _cuts(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: `_whole` copies of everything, one more of the rows up to place `_cut` (-1: none) and of place `_extra`."""
    block = F.shiftright("_place", PLACE_BITS - CUT_BITS)
    whole = F.when(F.col("_size") > 0, F.floor(F.col("_target") / F.col("_size"))).otherwise(0).cast("int")
    wanted = targets.withColumn("_whole", whole).withColumn("_rest", F.col("_target") - F.col("_whole") * F.col("_size"))
    wanted = stored(wanted)
    running = Window.partitionBy("_key").orderBy("_block")
    summed = rows.groupBy("_key", block.alias("_block")).agg(F.sum("_words").alias("_words"))
    summed = summed.withColumn("_after", F.sum("_words").over(running))
    # the first block that goes beyond the rest; all blocks before it are drawn whole
    reached = summed.join(wanted.select("_key", "_rest"), "_key").filter(F.col("_after") > F.col("_rest"))
    edge = reached.groupBy("_key", "_rest").agg(F.min(F.struct("_block", (F.col("_after") - F.col("_words")).alias("before"))).alias("_edge"))
    edge = edge.select("_key", "_rest", F.col("_edge._block").alias("_block"), F.col("_edge.before").alias("_before"))
    in_order = Window.partitionBy("_key").orderBy("_place").rangeBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumn("_block", block).join(edge, ["_key", "_block"])
    inside = inside.withColumn("_after", F.col("_before") + F.sum("_words").over(in_order)).filter("_after <= _rest")
    last = inside.groupBy("_key").agg(F.max("_place").alias("_last"), F.max("_after").alias("_drawn"))
    start = F.col("_block") * F.lit(1 << (PLACE_BITS - CUT_BITS)) - 1
    gap = F.col("_rest") - F.coalesce("_drawn", "_before")
    cuts = edge.join(last, "_key", "left").select("_key", F.coalesce("_last", start).alias("_cut"), gap.alias("_gap"))
    cuts = stored(cuts)
    # the one row beyond the cut that fills the gap best
    off = F.abs(F.col("_gap") - F.col("_words"))
    beyond = lookup_join(rows.select("_key", "_place", "_words"), cuts, ["_key"], "_place").filter(F.col("_place") > F.col("_cut"))
    extra = beyond.filter(off < F.col("_gap")).groupBy("_key").agg(F.min(F.struct(off.alias("off"), "_place"))["_place"].alias("_extra"))
    found = wanted.join(cuts, "_key", "left").join(extra, "_key", "left")
    return found.select(
        "_key", "_size", "_target", "_whole", F.coalesce("_cut", F.lit(-1)).alias("_cut"), F.coalesce("_extra", F.lit(-1)).alias("_extra")
    )


def _copies() -> F.Column:
    """How often the row at `_place` is drawn."""
    once_more = (F.col("_place") <= F.col("_cut")) | (F.col("_place") == F.col("_extra"))
    return F.col("_whole") + once_more.cast("int")


def split_quotas(quotas: DataFrame, seed: str) -> DataFrame:
    """One level of the tree: (_node, _key, _quota) of the children 2 * node and 2 * node + 1.

    Every block of a node gets a random place in the node, and the first half goes
    left. Nodes are numbered through together, so no node is ever gathered in one task.
    """
    random = F.xxhash64(F.lit(seed), F.lit("tree"), "_node", "_key", "_unit")
    units = quotas.select("_node", "_key", F.explode(F.sequence(F.lit(1).cast("long"), "_quota")).alias("_unit"))
    placed = with_dense_id(units, [F.col("_node"), random, F.col("_key"), F.col("_unit")], "_rank")
    before = Window.orderBy("_node").rowsBetween(Window.unboundedPreceding, -1)  # a node a shard at most
    nodes = quotas.groupBy("_node").agg(F.sum("_quota").alias("_held"))
    nodes = nodes.select("_node", "_held", F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_before"))
    half = F.shiftright(F.col("_held") + F.col("_node").bitwiseAND(F.lit(1)), 1)
    goes_right = (F.col("_rank") - F.col("_before") > half).cast("long")
    dealt = placed.join(F.broadcast(nodes), "_node").select((F.col("_node") * 2 + goes_right).alias("_node"), "_key")
    return dealt.groupBy("_node", "_key").agg(F.count("*").alias("_quota"))


def shard_quotas(drawn: DataFrame, shards: int, seed: str) -> DataFrame:
    """(_node, _key, _quota): blocks of each source per shard, the leaves of the tree over `drawn` (a row per block, with _key)."""
    quotas = stored(drawn.groupBy(F.lit(0).cast("long").alias("_node"), "_key").agg(F.count("*").alias("_quota")))
    for _ in range(shards.bit_length() - 1):
        quotas = stored(split_quotas(quotas, seed))
    return quotas


def _dealt_blocks(rows: DataFrame, cuts: DataFrame, shards: int, seed: str) -> DataFrame:
    """Per source and block of places: `_shards`, the shard that copy 1, 2, .. of the block goes to.

    Works on numbers of blocks (at most 2 * 2**BLOCK_BITS a source), not on rows.
    """
    block = F.shiftright("_place", PLACE_BITS - BLOCK_BITS).cast("int")
    held = rows.groupBy("_key", block.alias("_block")).agg(F.min("_place").alias("_place")).join(cuts, "_key")
    has_extra = F.shiftright("_extra", PLACE_BITS - BLOCK_BITS) == F.col("_block")
    copies = F.greatest(_copies(), F.col("_whole") + has_extra.cast("int"))
    drawn = held.withColumn("_copies", copies).filter("_copies > 0")
    drawn = drawn.select("_key", "_block", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy"))

    def shuffled(*parts):
        return F.xxhash64(F.lit(seed), *parts)

    permuted = Window.partitionBy("_key").orderBy(shuffled("_key", "_block", "_copy"), "_block", "_copy")
    drawn = stored(drawn.withColumn("_nth", F.row_number().over(permuted)))
    quotas = shard_quotas(drawn, shards, seed)
    before = Window.partitionBy("_key").orderBy("_node").rowsBetween(Window.unboundedPreceding, -1)
    quotas = quotas.withColumn("_before", F.coalesce(F.sum("_quota").over(before), F.lit(0)))
    nth = F.explode(F.sequence((F.col("_before") + 1).cast("int"), (F.col("_before") + F.col("_quota")).cast("int"))).alias("_nth")
    quotas = quotas.select("_key", F.col("_node").cast("int").alias("_shard"), nth)
    by_copy = F.transform(F.array_sort(F.collect_list(F.struct("_copy", "_shard"))), lambda x: x["_shard"])
    return drawn.join(quotas, ["_key", "_nth"]).groupBy("_key", "_block").agg(by_copy.alias("_shards"))


def _keyed(df: DataFrame, id_column: str, source_column: str, seed: str, *columns) -> DataFrame:
    """`columns` of `df` with _source, _key (the source as a text that is never null), _place and _block."""
    source = F.col(source_column).cast("string")
    key = F.coalesce(F.concat(F.lit("="), source), F.lit("null"))
    keyed = df.select(*columns, source.alias("_source"), key.alias("_key"), place(id_column, seed).alias("_place"))
    return keyed.withColumn("_block", F.shiftright("_place", PLACE_BITS - BLOCK_BITS).cast("int"))


def _drawn(rows: DataFrame, cuts: DataFrame, blocks: DataFrame) -> DataFrame:
    """`rows` (keyed) with _size, _target and _shards, the shard of each copy that is taken.

    Both side tables hold a few rows a source; they are broadcast if they are
    small and joined with hot sources spread if not.
    """
    joined = lookup_join(lookup_join(rows, cuts, ["_key"], "_place"), blocks, ["_key", "_block"], "_place")
    taken = F.slice(F.coalesce("_shards", F.array().cast("array<int>")), F.lit(1), _copies())
    return joined.withColumn("_shards", taken)


def _plan(rows: DataFrame, shards: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """What is drawn of each source, and the shards of each block."""
    sources = rows.groupBy("_key", "_source").agg(F.sum("_words").alias("_size"))
    cuts = stored(_cuts(rows, source_targets(sources)))
    return cuts, stored(_dealt_blocks(rows, cuts, shards, seed))


def draw_mix(
    df: DataFrame,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    shards: int = SHARDS,
    seed: str = "mix",
) -> DataFrame:
    """One row per input row: id, size, source_size, target, and `shards`, the shard of each copy that the mix takes.

    Only ids, sources, sizes and places are stored, shuffled and joined, never texts.
    """
    kept = [F.col(id_column).alias("_id"), word_count(F.col(text_column)).alias("_words")]
    rows = stored(_keyed(df, id_column, source_column, seed, *kept))
    return _drawn(rows, *_plan(rows, shards, seed)).select(
        F.col("_id").alias(id_column),
        F.col("_words").alias("size"),
        F.col("_size").alias("source_size"),
        F.col("_target").alias("target"),
        F.col("_shards").alias("shards"),
    )


def mix_sources(
    df: DataFrame,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    shards: int = SHARDS,
    seed: str = "mix",
) -> DataFrame:
    """The mix itself: the rows of `df`, all columns, each as often as it is taken.

    What is drawn depends on the source and the place alone, so texts meet two
    small tables and are shuffled once, to their shards, where a hash of shard,
    place and copy orders them. A shard may span several partitions.
    """
    rows = stored(_keyed(df, id_column, source_column, seed, word_count(F.col(text_column)).alias("_words")))
    whole = _keyed(df, id_column, source_column, seed, F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    drawn = _drawn(whole, *_plan(rows, shards, seed)).select("_row", "_place", F.posexplode("_shards").alias("_copy", "_shard"))
    mixed = drawn.withColumn("_order", F.xxhash64(F.lit(seed), "_shard", "_place", "_copy"))
    parts = max(64, -(-rows.count() // (shards * PART_ROWS)))
    mixed = mixed.repartition("_shard", F.pmod("_order", F.lit(parts))).sortWithinPartitions("_shard", "_order")
    return mixed.select("_row.*")
