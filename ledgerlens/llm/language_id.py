"""Language identification by prediction by partial matching.

Per language, counts of byte n-grams over all training texts form a context
tree of every order up to ORDER. The code length of a byte is that of the
longest context that the language knows: c / (n + q) for a byte seen c times in
a context with n bytes, q of them different, and an escape of q / (n + q) to the
next shorter context for one not seen there. A context never seen costs nothing
to leave; below order 0 all 256 bytes are alike. Statistics are frozen: scoring a text does not
change them. The language with the shortest code for the whole text wins, ties
go to the first by code point.

Counting covers every training text, and totals, different bytes and escapes are
taken from all counts, in Spark. What a language holds fewer than FLOOR times counts as
not seen, n-grams as well as contexts, so the trees grow with the corpus. The
trees are sent to every task; beyond MAX_NODES n-grams over all languages (some
hundred MB) the floor doubles until they fit, and code lengths stay those of the counted
corpus for all that is kept. Languages are scored in groups of GROUP, so there may be any number. Letters A-Z
count as a-z, white space as one space.

Null texts and texts without a letter get `und` and score 0. Without training
rows every text gets `und`. Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.text import IS_SPACE, LOWER, blocks, mix64
from ledgerlens.sources.scratch import stored

ORDER = 4  # longest context, in bytes
FLOOR = 2  # times an n-gram or context must be seen
MAX_NODES = 1 << 22
GROUP = 16  # languages in one table
UNKNOWN = "und"

FOLD = LOWER.copy()
FOLD[IS_SPACE] = 32


def ngrams(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """Per byte the packed n-gram of `order` bytes before it and itself; the start of a text counts as zero bytes."""
    folded = FOLD[data].astype(np.uint64)
    packed = folded.copy()
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    for back in range(1, order + 1):
        earlier = np.zeros_like(folded)
        earlier[back:] = folded[:-back] if back < len(folded) else 0
        earlier[place < back] = 0
        packed |= earlier << np.uint64(8 * back)
    return packed


def suffix(keys: np.ndarray, order: int) -> np.ndarray:
    return keys & np.uint64((1 << 8 * (order + 1)) - 1)


def count_ngrams(df: DataFrame, lang_column: str = "lang", text_column: str = "text", order: int = ORDER) -> DataFrame:
    """(lang, order, gram, n) over all rows: the counts of every tree, added up per task before they are shuffled."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in parts])
        counts = np.concatenate([c for _, c in parts])
        unique, where = np.unique(keys, return_inverse=True)
        return unique, np.bincount(where, counts, len(unique)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in batches:
            for language in pc.unique(batch.column(0)).to_pylist():
                texts = batch.column(1).filter(pc.equal(batch.column(0), language))
                parts = held.setdefault(language, [])
                for block in blocks(texts):
                    parts.append(np.unique(ngrams(block.data, block.offsets, order), return_counts=True))
                    if len(parts) >= 16:
                        parts[:] = [merged(parts)]
        for language, parts in held.items():
            keys, counts = merged(parts) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            for k in range(order, -1, -1):
                keys, counts = merged([(suffix(keys, k), counts)])
                for at in range(0, len(keys), 50_000):
                    part = slice(at, at + 50_000)
                    size = len(keys[part])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([language] * size, pa.string()),
                            pa.array(np.full(size, k, np.int32)),
                            pa.array(keys[part].astype(np.int64)),
                            pa.array(counts[part]),
                        ],
                        ["lang", "order", "gram", "n"],
                    )

    kept = df.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).cast("string").alias("text"))
    kept = kept.filter("lang IS NOT NULL AND text IS NOT NULL")
    counted = kept.mapInArrow(count, "lang string, order int, gram bigint, n bigint")
    return counted.groupBy("lang", "order", "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Lookup:
    """Open-addressed table from a packed key to a row of `values`."""

    keys: np.ndarray
    rows: np.ndarray
    values: np.ndarray
    steps: int

    @staticmethod
    def of(keys: np.ndarray, values: np.ndarray) -> Lookup:
        bits = max(4, int(2 * max(1, len(keys)) - 1).bit_length() + 1)
        size = 1 << bits
        slots, rows = np.full(size, np.uint64(2**64 - 1)), np.full(size, -1, np.int32)
        at, waiting, steps = (mix64(keys) >> np.uint64(64 - bits)).astype(np.int64), np.arange(len(keys)), 0
        while len(waiting):
            free = waiting[rows[at[waiting]] < 0]
            _, winners = np.unique(at[free], return_index=True)
            free = free[winners]
            slots[at[free]], rows[at[free]] = keys[free], free
            waiting = waiting[rows[at[waiting]] != waiting]
            at[waiting] = (at[waiting] + 1) & (size - 1)
            steps += 1
        return Lookup(slots, rows, values, steps)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of `values` per key, -1 where the key is not held."""
        size = len(self.keys)
        at = (mix64(keys) >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)
        found = np.where(self.keys[at] == keys, self.rows[at], -1)
        open_ = np.flatnonzero((found < 0) & (self.rows[at] >= 0))
        for _ in range(self.steps):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & (size - 1)
            hit = self.keys[at[open_]] == keys[open_]
            found[open_[hit]] = self.rows[at[open_[hit]]]
            open_ = open_[~hit & (self.rows[at[open_]] >= 0)]
        return found


@dataclass(frozen=True)
class Trees:
    """Frozen trees of some languages: code lengths by n-gram and escapes by context, a column per language."""

    codes: list[Lookup]
    escapes: list[Lookup]
    width: int

    def code_lengths(self, grams: np.ndarray) -> np.ndarray:
        """Bits of every n-gram's last byte (rows) in every language (columns)."""
        return backed_off(grams, self.codes, self.escapes, self.width, len(self.codes) - 1)


@dataclass(frozen=True)
class Model:
    """The trees of all languages, in groups."""

    languages: list[str]
    groups: list[Trees]
    order: int

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits per document (rows) and language (columns)."""
        grams = ngrams(data, offsets, self.order)
        found = []
        for trees in self.groups:
            ends = np.vstack((np.zeros(trees.width), np.cumsum(trees.code_lengths(grams), axis=0)))
            found.append(ends[offsets[1:]] - ends[offsets[:-1]])
        return np.hstack(found)


def backed_off(grams: np.ndarray, codes: list[Lookup], escapes: list[Lookup], width: int, order: int) -> np.ndarray:
    """Code lengths from the tree of `order` downwards; escapes add up on the way."""
    total, at = np.zeros((len(grams), width)), np.arange(len(grams))
    for k in range(order, -1, -1):
        keys = suffix(grams[at], k)
        row = codes[k].find(keys)
        hit = row >= 0
        total[at[hit]] += codes[k].values[row[hit]]
        at, keys = at[~hit], keys[~hit]
        if not len(at):
            break
        context = escapes[k].find(keys >> np.uint64(8))
        known = context >= 0
        total[at[known]] += escapes[k].values[context[known]]
    total[at] += 8.0
    return total


def build_trees(nodes: pd.DataFrame, escapes: pd.DataFrame, languages: range, order: int) -> Trees:
    """Trees of the languages with these numbers, from (lang, order, gram, bits) and (lang, order, context, bits)."""
    width, codes, escape_tables = len(languages), [], []

    def matrix_of(table: pd.DataFrame, k: int, key: str) -> tuple[np.ndarray, np.ndarray]:
        own = table[(table["order"] == k) & table["lang"].between(languages.start, languages.stop - 1)]
        keys, where = np.unique(own[key].to_numpy().astype(np.uint64), return_inverse=True)
        values = np.full((len(keys), width), np.nan)
        values[where, own["lang"].to_numpy() - languages.start] = own["bits"]
        return keys, values

    for k in range(order + 1):
        contexts, escape = matrix_of(escapes, k, "context")
        escape = np.nan_to_num(escape)  # a context never seen costs nothing to leave
        keys, bits = matrix_of(nodes, k, "gram")
        below = backed_off(suffix(keys, max(k - 1, 0)), codes, escape_tables, width, k - 1)
        leaving = escape[np.searchsorted(contexts, keys >> np.uint64(8))] if len(contexts) else np.zeros_like(bits)
        codes.append(Lookup.of(keys, np.where(np.isnan(bits), leaving + below, bits).astype(np.float32)))
        escape_tables.append(Lookup.of(contexts, escape.astype(np.float32)))
    return Trees(codes, escape_tables, width)


def frozen_nodes(counts: DataFrame, floor: int) -> tuple[DataFrame, DataFrame]:
    """Code lengths (lang, order, gram, bits) and escapes (lang, order, context, bits) of what was seen `floor` times, off all counts."""
    placed = counts.withColumn("context", F.shiftrightunsigned("gram", 8))
    contexts = placed.groupBy("lang", "order", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    contexts = contexts.filter(F.col("total") >= floor)
    all_ = F.col("total") + F.col("kinds")
    nodes = placed.filter(F.col("n") >= floor).join(contexts, ["lang", "order", "context"])
    return (
        nodes.select("lang", F.col("order").cast("tinyint"), "gram", F.log2(all_ / F.col("n")).cast("float").alias("bits")),
        contexts.select("lang", F.col("order").cast("tinyint"), "context", F.log2(all_ / F.col("kinds")).cast("float").alias("bits")),
    )


def train(
    df: DataFrame, lang_column: str = "lang", text_column: str = "text", order: int = ORDER, floor: int = FLOOR, max_nodes: int = MAX_NODES
) -> Model | None:
    """Count every text of `df` that has a language and freeze the trees."""
    counts = stored(count_ngrams(df, lang_column, text_column, order))
    languages = sorted(r["lang"] for r in counts.filter("order = 0").select("lang").distinct().collect())
    if not languages:
        return None
    while counts.filter(F.col("n") >= floor).count() > max_nodes:
        floor *= 2
    numbers = df.sparkSession.createDataFrame(list(zip(languages, range(len(languages)))), "lang string, _lang int")
    numbered = counts.join(F.broadcast(numbers), "lang").select(F.col("_lang").alias("lang"), "order", "gram", "n")
    nodes, escapes = (found.toArrow().to_pandas() for found in frozen_nodes(numbered, floor))  # as Arrow: no objects per row
    firsts = range(0, len(languages), GROUP)
    groups = [build_trees(nodes, escapes, range(a, min(a + GROUP, len(languages))), order) for a in firsts]
    return Model(languages, groups, order)


def predict(df: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: the id, `lang_pred` and `score`, the winner's share of the posterior over languages.

    The posterior is tempered by the text's length in bytes, so that long texts
    do not all score 1.
    """
    model = df.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = model.value
        for batch in batches:
            texts = batch.column(1)
            letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            names, scores = [], []
            if trees is None:
                names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            for block in blocks(texts) if trees is not None else ():
                bits = trees.code_lengths(block.data, block.offsets)
                best = bits.argmin(axis=1)
                excess = (bits - bits.min(axis=1, keepdims=True)) / np.sqrt(np.maximum(np.diff(block.offsets), 1))[:, None]
                certain = 1 / np.exp2(-np.minimum(excess, 60)).sum(axis=1)
                known = letters[block.first : block.first + block.n]
                names += [trees.languages[b] if ok else UNKNOWN for b, ok in zip(best, known)]
                scores += np.where(known, certain, 0.0).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["id", "lang_pred", "score"]
            )

    kept = df.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    found = kept.mapInArrow(score, f"id {kept.schema['id'].dataType.simpleString()}, lang_pred string, score double")
    return found.withColumnRenamed("id", id_column)
