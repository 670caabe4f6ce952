"""Repeated lines, also with one word changed, by a deletion-neighbourhood join.

A line is compared by its words. Two lines are alike if at most one word was
inserted, left out or replaced. A line goes if a like line stands earlier
(smaller id, null ids last, then line number); the earliest of its kind stays.
Lines of fewer than `min_words` words stay unless `short_lines` is set. Then
equal ones are repeats like any other, and those of MIN_CHARS characters or more
(blanks not counted), as lines of scripts without blanks are, are compared by
their characters: alike if at most one was inserted, left out or replaced. A line
of `min_words` words and one of a word less are thus compared in different ways,
so never with each other.

Equal lines are counted first, so that one that holds a third of all rows is
one line from there on. Each distinct line then emits the hash of every variant
with one word deleted, and of itself:
- lines that share a variant with the same word deleted differ in that word,
- a line that equals a variant of another lacks one of its words.
So for each variant the earliest line is all that a line must be compared with;
pairs within a variant are never listed. The pair is verified on its words.

Emitting all variants of all lines would multiply the corpus by the words of a
line. Lines within one edit share their first or their last half, so lines
whose halves no other line has are left out before. That is exact too.

Null and empty texts have no lines to lose. Rows that repeat id and text lose the same
lines; equal ids with different texts are different rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.batches import map_batches
from ledgerlens.llm.text import BASE, BASE_INVERSE, IS_SPACE, SMALL_BLOCK, Block, blocks, mix64, powers, slice_hashes
from ledgerlens.sources.scratch import stored

MIN_WORDS = 5
MIN_CHARS = 20  # of a line of fewer words, to be compared by its characters
MAX_SENT_LINES = 1_000_000  # removed line numbers that are broadcast; more are joined by shuffle
MAX_SENT_TEXTS = 200_000  # places of lines to be read that are broadcast; more are joined by shuffle
CHARACTER = np.uint64(0xD6E8FEB86659FD93)
FRONT, BACK = np.uint64(0x8EBC6AF09C88C6E3), np.uint64(0x589965CC75374CC3)


def line_words(block: Block, min_words: int) -> tuple[np.ndarray, ...]:
    """Document, line number, first word and end word of every line of at least `min_words` words."""
    starts, _, word_offsets = block.words
    owner = np.repeat(np.arange(block.n), np.diff(word_offsets))
    passed = np.concatenate(([0], np.cumsum(block.data == 10)))
    number = passed[starts] - passed[block.offsets[owner]]
    new = np.ones(len(starts), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (number[1:] != number[:-1])
    first = np.flatnonzero(new)
    end = np.append(first[1:], len(starts))
    long = end - first >= min_words
    first, end = first[long], end[long]
    return owner[first], number[first], first, end


def characters(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every character that is not blank."""
    leads = np.flatnonzero((block.data & 0xC0) != 0x80)
    ends = np.append(leads[1:], len(block.data))[: len(leads)]
    shown = ~IS_SPACE[block.data[leads]]
    return leads[shown], slice_hashes(block.data, leads[shown], ends[shown]) ^ CHARACTER


def compared_halves(block: Block, first: np.ndarray, end: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) as half_keys gives them, over words or, for lines of fewer than `min_words`, over characters."""
    few = end - first < min_words
    at, keys = half_keys(block.word_hashes(), first[~few], end[~few])
    at = np.flatnonzero(~few)[at]
    if few.any():
        starts, ends, _ = block.words
        places, hashes = characters(block)
        begin, stop = np.searchsorted(places, starts[first]), np.searchsorted(places, ends[end - 1])
        chosen = np.flatnonzero(few & (stop - begin >= MIN_CHARS))
        line, more = half_keys(hashes, begin[chosen], stop[chosen])
        at, keys = np.concatenate((at, chosen[line])), np.concatenate((keys, more))
        order = np.argsort(at, kind="stable")
        at, keys = at[order], keys[order]
    return at, keys


def half_keys(hashes: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, key): the halves that a line within one edit may share, two or four a line."""
    n = end - first
    line = np.arange(len(n))
    sizes = [(line, n // 2), (line[n % 2 == 0], (n // 2 - 1)[n % 2 == 0])]
    at = np.concatenate([a for a, _ in sizes])
    size = np.concatenate([s for _, s in sizes])
    front = slice_hashes(hashes, first[at], first[at] + size) ^ FRONT
    back = slice_hashes(hashes, end[at] - size, end[at]) ^ BACK
    order = np.argsort(np.concatenate((at, at)), kind="stable")
    return np.concatenate((at, at))[order], np.concatenate((front, back))[order]


def deletion_variants(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, deleted word or -1, hash) of all variants; line i has the words offsets[i]:offsets[i + 1]."""
    sizes = np.diff(offsets)
    line = np.repeat(np.arange(len(sizes)), sizes)
    s, e, g = offsets[line], offsets[line + 1], np.arange(len(hashes))
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum((hashes + np.uint64(1)) * powers(BASE, max(1, len(hashes)))[: len(hashes)], out=total[1:])
    back = powers(BASE_INVERSE, len(hashes) + 2)
    raw = (total[g] - total[s]) * back[s] + (total[e] - total[g + 1]) * back[s + 1]
    deleted = mix64(raw + (e - s - 1).astype(np.uint64))
    whole = slice_hashes(hashes, offsets[:-1], offsets[1:])
    lines = np.arange(len(sizes))
    return np.concatenate((line, lines)), np.concatenate((g - s, np.full(len(sizes), -1))), np.concatenate((deleted, whole))


def line_variants(block: Block, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """deletion_variants of a block whose texts are single lines, over their words or, of fewer than `min_words`, their characters."""
    _, _, offsets = block.words
    few = np.diff(offsets) < min_words
    kinds = [(~few, offsets, block.word_hashes())]
    if few.any():
        places, hashes = characters(block)
        kinds.append((few, np.searchsorted(places, block.offsets), hashes))
    found = []
    for chosen, offsets, hashes in kinds:
        if chosen.any():
            sizes = np.diff(offsets)
            line, at, keys = deletion_variants(hashes[np.repeat(chosen, sizes)], np.append(0, np.cumsum(sizes[chosen])))
            found.append((np.flatnonzero(chosen)[line], at, keys))
    return tuple(np.concatenate(x) for x in zip(*found))


def compared_parts(text: str, min_words: int) -> list:
    """Words as bytes or, of a line of fewer than `min_words`, characters as text."""
    words = text.encode().split()
    return words if len(words) >= min_words else list(b"".join(words).decode())


def within_one_edit(a: list, b: list) -> bool:
    """Whether word lists differ by at most one insertion, deletion or replacement."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1:
        return False
    front = 0
    while front < len(b) and a[front] == b[front]:
        front += 1
    skip = front + (len(a) == len(b))
    return front == len(b) or a[front + 1 :] == b[skip:]


def _rows(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.col(text_column).cast("string")
    return df.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _lines(rows: DataFrame, min_words: int, short_lines: bool) -> DataFrame:
    """(id, mark, line, hash, words, halves): one row per line that is compared."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2), SMALL_BLOCK):
                owner, number, first, end = line_words(block, 1 if short_lines else min_words)
                hashes = block.word_hashes()
                owners = pa.array(owner + block.first)
                at, keys = compared_halves(block, first, end, min_words)
                offsets = np.searchsorted(at, np.arange(len(first) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(owners),
                        batch.column(1).take(owners),
                        pa.array(number.astype(np.int32)),
                        pa.array(slice_hashes(hashes, first, end).view(np.int64)),
                        pa.array((end - first).astype(np.int32)),
                        pa.ListArray.from_arrays(offsets, pa.array(keys.view(np.int64))),
                    ],
                    ["id", "mark", "line", "hash", "words", "halves"],
                )

    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, mark bigint, line int, hash bigint, words int, halves array<bigint>"
    return map_batches(rows, read, schema)


def _line_texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(hash, place, text) of the lines in `wanted` (hash, words, place), read from the documents they stand in first."""
    place = F.col("place")
    lists = wanted.groupBy(place["id"].alias("_id"), place["mark"].alias("_mark")).agg(
        F.collect_list(F.struct(place["line"].alias("line"), "hash", "place")).alias("wanted")
    )
    lists = stored(lists)
    size = lists.agg(F.coalesce(F.sum(F.size("wanted")), F.lit(0))).first()[0]
    lists = F.broadcast(lists) if size <= MAX_SENT_TEXTS else lists
    held = rows.join(lists, F.col("id").eqNullSafe(F.col("_id")) & F.col("mark").eqNullSafe(F.col("_mark")))
    held = held.select(F.split("text", "\n").alias("lines"), F.explode("wanted").alias("one"))
    found = held.select("one.hash", "one.place", F.get("lines", F.col("one.line")).alias("text"))
    return found.dropDuplicates(["hash"])  # a row that repeats id and text has its lines twice


def _variants(lines: DataFrame, min_words: int) -> DataFrame:
    """(key, at, hash, place) of every variant of every line."""
    place_type = lines.schema["place"].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2), SMALL_BLOCK):
                line, at, keys = line_variants(block, min_words)
                rows = pa.array(line + block.first)
                for start in range(0, len(line), 20_000):
                    part = slice(start, start + 20_000)
                    taken = rows.slice(start, 20_000)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys[part].view(np.int64)),
                            pa.array(at[part].astype(np.int32)),
                            batch.column(0).take(taken),
                            batch.column(1).take(taken),
                        ],
                        ["key", "at", "hash", "place"],
                    )

    return map_batches(lines.select("hash", "place", "text"), emit, f"key bigint, at int, hash bigint, place {place_type}")


def _verified(pairs: DataFrame, min_words: int) -> DataFrame:
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_pylist() for i in (1, 2))
            alike = [within_one_edit(compared_parts(x, min_words), compared_parts(y, min_words)) for x, y in zip(a, b)]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(alike, pa.bool_()))], ["hash"])

    return map_batches(pairs.select("hash", "text", "other_text"), check, "hash bigint")


def _near_lines(rows: DataFrame, distinct: DataFrame, min_words: int) -> DataFrame:
    """Hashes of lines that have an earlier line within one edit."""
    keys = distinct.select("hash", F.explode("halves").alias("key"))
    shared = keys.groupBy("key").agg(F.min("hash").alias("lo"), F.max("hash").alias("hi")).filter("lo < hi")
    candidates = keys.join(shared.select("key"), "key").select("hash").distinct()
    lines = stored(_line_texts(rows, distinct.join(candidates, "hash").select("hash", "place")))
    variants = stored(_variants(lines, min_words))
    met = variants.groupBy("key").agg(F.min("hash").alias("lo"), F.max("hash").alias("hi")).filter("lo < hi")
    variants = stored(variants.join(met.select("key"), "key"))
    one = F.struct("place", "hash")
    same = variants.groupBy("key", "at").agg(F.min(one).alias("other"))
    whole = variants.groupBy("key").agg(F.min(F.when(F.col("at") < 0, one)).alias("whole"), F.min(F.when(F.col("at") >= 0, one)).alias("shorter"))
    replaced = variants.filter("at >= 0").join(same, ["key", "at"])
    resized = variants.join(whole, "key").withColumn("other", F.when(F.col("at") < 0, F.col("shorter")).otherwise(F.col("whole")))
    pairs = replaced.select("hash", "place", "other").union(resized.select("hash", "place", "other"))
    pairs = pairs.filter(F.col("other.place") < F.col("place")).select("hash", F.col("other.hash").alias("other_hash")).distinct()
    text = lines.select("hash", "text")
    pairs = pairs.join(text, "hash").join(text.select(F.col("hash").alias("other_hash"), F.col("text").alias("other_text")), "other_hash")
    return _verified(pairs, min_words).distinct()


def repeated_lines(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS, short_lines: bool = False
) -> DataFrame:
    """(id, mark, removed): per document that loses lines, the hash of its text and the sorted line numbers (from 0)."""
    rows = _rows(df, id_column, text_column)
    lines = stored(_lines(rows, min_words, short_lines))
    place = F.struct(F.col("id").isNull().alias("null"), "id", "mark", "line")
    distinct = lines.groupBy("hash", "words").agg(
        F.min(place).alias("place"), F.count("*").alias("copies"), F.any_value("halves").alias("halves")
    )
    distinct = stored(distinct)
    near = _near_lines(rows, distinct, min_words).withColumn("near", F.lit(True))
    judged = distinct.drop("halves").join(near, "hash", "left").filter("copies > 1 OR near")
    judged = judged.select("hash", "words", F.col("place").alias("first"), F.coalesce("near", F.lit(False)).alias("near"))
    gone = lines.drop("halves").join(judged, ["hash", "words"]).filter(F.col("near") | (place != F.col("first")))
    return gone.groupBy("id", "mark").agg(F.sort_array(F.collect_set("line")).alias("removed"))


def without_repeated_lines(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS, short_lines: bool = False
) -> DataFrame:
    """(row, text, removed): each row of `df` as a struct, its text without repeated lines, and the line numbers that went."""
    found = stored(repeated_lines(df, id_column, text_column, min_words, short_lines))
    size = found.agg(F.coalesce(F.sum(F.size("removed")), F.lit(0))).first()[0]
    found = F.broadcast(found) if size <= MAX_SENT_LINES else found
    text = F.col(f"`{text_column}`").cast("string")
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(whole.alias("row"), F.col(f"`{id_column}`").alias("_id"), F.xxhash64(text).alias("_mark"), text.alias("_text"))
    joined = rows.join(found, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_mark") == F.col("mark")), "left")
    left = F.filter(F.split("_text", "\n"), lambda line, i: ~F.array_contains(F.col("removed"), i))
    cleaned = F.when(F.col("removed").isNull(), F.col("_text")).otherwise(F.array_join(left, "\n"))
    return joined.select("row", cleaned.alias("text"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))
