"""Near-duplicate documents: fast similarity sketches, banding, exact verification.

A document's set holds the hashes of its distinct word shingles (A-Z folded;
with fewer words than a shingle, the whole sequence is one). Documents with
equal sets form a class, and only one of each class goes on. Its sketch has
BANDS * ROWS coordinates, filled in rounds: in round i every shingle is thrown
by a hash of that round into one coordinate, which keeps the least (round,
hash); from round t on, all shingles go to coordinate i - t, so after 2t rounds
each is full. It ends with the first round after which none is empty, after
about t log t hashes for small sets and one round for large ones. Two sets agree
in a coordinate with a probability of their similarity. Documents that agree in all
ROWS coordinates of a band meet in a bucket; at similarity 0.8 a pair meets
in none of the 24 bands with a probability under 1e-5.

Within a bucket no pairs are listed. Every member is compared with the bucket's
smallest id on the full sets. Members of one bucket that are not connected by
then may still link to each other. Those outside the bucket's largest component
are compared with the others too, but for pairs that two exact bounds rule out
inside the join, so that these are never listed:
- Jaccard distance obeys the triangle inequality, so the distances of a linked
  pair to the smallest id differ by no more than the threshold;
- a parity bitmap has a bit flipped for every element of a set, so two bitmaps
  differ in no more bits than the sets differ in elements.
Nothing is capped.

Empty and null texts have empty sets and link with nothing. Rows that share an
id are one document. Rows with a null id are linked with nothing and kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.batches import map_batches
from ledgerlens.llm.components import components
from ledgerlens.llm.text import LOWER, SMALL_BLOCK, Block, blocks, mix64
from ledgerlens.operators.joins import fits_broadcast
from ledgerlens.sources.scratch import stored

SHINGLE_WORDS = 5
PERCENT = 80  # 100 * intersection >= PERCENT * union
BANDS, ROWS = 24, 4
COORDINATES = BANDS * ROWS
EMPTY = np.uint64(2**64 - 1)
ROUND_SEEDS = mix64(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))
STEP = np.uint64(0xA0761D6478BD642F)
PARITY_BITS = 1024


def shingle_sets(block: Block, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every document of the block."""
    hashes = block.word_hashes(LOWER)
    _, _, offsets = block.words
    rolled = hashes.copy()
    for k in range(1, words):
        rolled[: max(0, len(rolled) - k)] = mix64(rolled[: max(0, len(rolled) - k)] * STEP + hashes[k:])
    found = []
    for i in range(block.n):
        start, end = offsets[i], offsets[i + 1]
        if end - start >= words:
            found.append(np.unique(rolled[start : end - words + 1]))
            continue
        whole = hashes[start : start + 1].copy()
        for k in range(start + 1, end):
            whole = mix64(whole * STEP + hashes[k])
        # a whole short text is no shingle of a longer one
        found.append(mix64(whole + np.uint64(end - start)) if len(whole) else whole)
    return found


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The COORDINATES of one non-empty set."""
    filled = np.full(COORDINATES, EMPTY)
    at = 0
    while at < 2 * COORDINATES:
        last = COORDINATES if at < COORDINATES else 2 * COORDINATES
        rounds = np.arange(at, min(last, at + max(1, 2 * COORDINATES // len(shingles))))
        thrown = mix64(shingles[None, :] ^ ROUND_SEEDS[rounds][:, None])
        if at < COORDINATES:
            bins = ((thrown >> np.uint64(40)) % np.uint64(COORDINATES)).astype(np.int64)
        else:
            bins = np.broadcast_to((rounds - COORDINATES)[:, None], thrown.shape)
        values = (thrown & np.uint64((1 << 40) - 1)) | (rounds.astype(np.uint64) << np.uint64(40))[:, None]
        np.minimum.at(filled, bins.ravel(), values.ravel())
        at = int(rounds[-1]) + 1
        if not (filled == EMPTY).any():
            break
    return filled


def bands(coordinates: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in coordinates.reshape(BANDS, ROWS).T:
        keys = mix64(keys * STEP + column)
    return keys


def parity(shingles: np.ndarray) -> np.ndarray:
    """PARITY_BITS bits, each telling whether an odd number of shingles falls on it."""
    at = (shingles >> np.uint64(64 - PARITY_BITS.bit_length() + 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=PARITY_BITS) & 1).view(np.uint64)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(offsets, pa.array(values.view(np.int64)))


def _read_sets(df: DataFrame, words: int, with_sets: bool) -> DataFrame:
    """Per row (id, n, fp1, fp2, hashes, parity): the set's size, two fingerprints, and its bands or the set and its bitmap."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1), SMALL_BLOCK):
                sets = shingle_sets(block, words)
                size = np.array([len(s) for s in sets], np.int64)
                first = np.array([int(s.sum()) for s in sets], np.uint64).view(np.int64)
                second = np.array([int(mix64(s).sum()) for s in sets], np.uint64).view(np.int64)
                none = np.zeros(0, np.uint64)
                lists = sets if with_sets else [bands(sketch(s)) if len(s) else none for s in sets]
                bitmaps = [parity(s) if with_sets else none for s in sets]
                ids = batch.column(0).slice(block.first, block.n)
                for at in range(0, block.n, 512):
                    part = slice(at, at + 512)
                    arrays = [ids.slice(at, 512), *map(pa.array, (size[part], first[part], second[part]))]
                    arrays += [_lists(lists[part]), _lists(bitmaps[part])]
                    yield pa.RecordBatch.from_arrays(arrays, ["id", "n", "fp1", "fp2", "hashes", "parity"])

    id_type = df.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, n bigint, fp1 bigint, fp2 bigint, hashes array<bigint>, parity array<bigint>"
    return map_batches(df.select("id", "text"), read, schema)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Add `distance` and `linked` to pairs (a, b), from the full sets."""
    left = sets.select(F.col("id").alias("a"), F.col("hashes").alias("_a"))
    right = sets.select(F.col("id").alias("b"), F.col("hashes").alias("_b"))
    shared = F.size(F.array_intersect("_a", "_b")).cast("long")
    # b first: each id is on that side in few pairs, a hot id stands in a
    joined = pairs.join(right, "b").join(left, "a").withColumn("_shared", shared)
    union = F.size("_a") + F.size("_b") - F.col("_shared")
    return joined.select(
        "a", "b", (1 - F.col("_shared") / union).alias("distance"), (100 * F.col("_shared") >= percent * union).alias("linked")
    )


def _links(members: DataFrame, classes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Verified links (a, b) that connect all documents of `members` (bucket, id) whose links meet in a bucket."""
    pairs = members.filter("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    pairs = stored(pairs)
    needed = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    needed = stored(needed.join(classes.select("id", "fp1", "fp2"), "id"))
    wanted = needed.select("id")
    texts = texts.join(F.broadcast(wanted) if fits_broadcast(wanted) else wanted, "id", "left_semi")
    sets = _read_sets(texts, words, True).join(needed, ["id", "fp1", "fp2"]).dropDuplicates(["id", "fp1", "fp2"])
    sets = stored(sets.select("id", "n", "hashes", "parity"))
    near = stored(_verified(pairs, sets, percent))
    stars = near.filter("linked").select("a", "b")
    found = components(stars)
    # In a bucket whose members are not all connected yet, those outside its largest component meet all others.
    placed = members.join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    sizes = placed.groupBy("bucket", "component").agg(F.count("*").alias("held"))
    open_ = sizes.groupBy("bucket").agg(F.max(F.struct("held", "component")).alias("main"), F.count("*").alias("parts"))
    open_ = open_.filter("parts > 1").select("bucket", F.col("main.component").alias("main"))
    distance = near.select(F.col("a").alias("leader"), F.col("b").alias("id"), "distance")
    rest = stored(placed.filter("id <> leader").join(open_, "bucket").join(distance, ["leader", "id"]))
    rest = rest.join(sets.select("id", "n", "parity"), "id").select(
        "bucket", "id", "component", (F.col("component") != F.col("main")).alias("stray"), "distance", "n", "parity"
    )
    left, right = (rest.toDF("bucket", *[f"{side}_{c}" for c in rest.columns[1:]]) for side in "ab")
    # a linked pair differs in at most (n + m) * (100 - percent) / (100 + percent) elements
    differing = " + ".join(f"bit_count(a_parity[{i}] ^ b_parity[{i}])" for i in range(PARITY_BITS // 64))
    possible = f"""a_component <> b_component AND (NOT b_stray OR a_id < b_id)
        AND abs(a_distance - b_distance) <= {1 - percent / 100 + 1e-9}
        AND {100 + percent} * ({differing}) <= {100 - percent} * (a_n + b_n)"""
    more = left.filter("a_stray").join(right, "bucket").filter(possible)
    more = more.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b"))
    more = _verified(stored(more.distinct()), sets, percent).filter("linked").select("a", "b")
    return stars.union(more)


def near_duplicates(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id reachable by links) and kept."""
    texts = df.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    rows = stored(_read_sets(texts, words, False).drop("parity"))
    one = F.min(F.struct("id", "hashes")).alias("one")
    classes = rows.filter("n > 0 AND id IS NOT NULL").groupBy("fp1", "fp2", "n").agg(one)
    classes = stored(classes.select(F.col("one.id").alias("id"), "fp1", "fp2", "n", F.col("one.hashes").alias("hashes")))
    members = classes.select("id", F.explode("hashes").alias("bucket")).distinct()
    leaders = members.groupBy("bucket").agg(F.min("id").alias("leader"), F.max("id").alias("_last")).filter("leader < _last")
    members = stored(members.join(leaders.drop("_last"), "bucket"))
    # ids with several texts: their classes are one document
    same = rows.filter("n > 0 AND id IS NOT NULL").select("id", "fp1", "fp2").join(
        classes.select(F.col("id").alias("rep"), "fp1", "fp2"), ["fp1", "fp2"]
    )
    twice = rows.groupBy("id").agg(F.min("fp1").alias("lo"), F.max("fp1").alias("hi")).filter("lo < hi")
    same = same.join(twice.select("id"), "id", "left_semi").filter("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    links = stored(_links(members, classes, texts, words, percent).union(same))
    found = components(links).withColumnRenamed("component", "_component")
    of_class = classes.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "fp1", "fp2", "n", F.coalesce("_component", "id").alias("_component")
    )
    placed = rows.select("id", "fp1", "fp2", "n").join(of_class, ["fp1", "fp2", "n"], "left")
    component = F.when(F.col("id").isNull(), F.col("id")).otherwise(F.coalesce("_component", "id"))
    return placed.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def without_near_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows of `df`, all columns, of the document with the smallest id of each group."""
    found = near_duplicates(df, id_column, text_column)
    dropped = stored(found.filter("NOT kept").select(F.col(id_column).alias("_dropped")).distinct())
    dropped = F.broadcast(dropped) if fits_broadcast(dropped) else dropped
    return df.join(dropped, F.col(f"`{id_column}`") == F.col("_dropped"), "left_anti")
