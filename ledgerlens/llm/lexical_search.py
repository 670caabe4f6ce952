"""Ranked lexical search: every document against every item, by matched-term masks.

One pass cuts the documents into terms and keeps, per document, its length and
the counts of terms that some item asks for. Totals and document frequencies are
plain aggregates over that table. The second pass takes it a segment of
documents at a time: each term gets a bitmap of the documents that hold it, an
item's bitmaps are turned into one mask of matched terms per document, and
documents with the same mask form a group. The largest share that a term adds
anywhere in the segment bounds the score of a mask; groups are scored in
descending order of that bound until it is below the tenth best score. What is
left out can't reach the list, so the lists are exact.

Items are taken in blocks of about BLOCK_TERMS (item, term) pairs, or one item
if that has more; each block is one pass. A task keeps `k` rows per item, and
these are ranked in two rounds, so no task gets the lists of all others.

Rows that repeat an item_id are one item with the terms of all of them. A null,
empty or termless text has no terms: such a document counts nowhere, such an
item has no list. Rows that repeat a doc_id are documents of their own. A null
doc_id comes last among equal scores, a null item_id is an item. Terms that
nearly all documents hold may weigh 0. Columns besides those named are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ledgerlens.sources.scratch import stored

# Bytes of UTF-8 text: ASCII letters (lower-cased before) and digits, and all that is not ASCII.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
K = 10
BLOCK_TERMS = 1 << 18
# Bits of presence a segment may hold: documents times terms that occur in it.
SEGMENT_BITS = 1 << 26
# Lists are merged over this many parts before the last round.
PARTS = 64


def terms_of(text: str | None) -> list[bytes]:
    return TERM.findall((text or "").encode().lower())  # bytes.lower() leaves all but A-Z alone


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term) of `items` (item_id, text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(t))) for t in batch.column(1).to_pylist()]
            rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array([t.decode() for f in found for t in f], pa.string())], ["item_id", "term"]
            )

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(cut, f"item_id {kind}, term string").distinct()


def postings(documents: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with terms: its length, and the terms of `vocabulary` in it by number."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    numbers = documents.sparkSession.sparkContext.broadcast({term.encode(): i for i, term in enumerate(vocabulary)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.value
        for batch in batches:
            rows, lengths, sizes, terms, counts = [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                found = terms_of(text.as_py())
                if found:
                    held = [(number[t], c) for t, c in Counter(found).items() if t in number]
                    rows.append(row)
                    lengths.append(len(found))
                    sizes.append(len(held))
                    terms += [t for t, _ in held]
                    counts += [c for _, c in held]
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(values, t)) for values, t in ((terms, pa.int32()), (counts, pa.int64()))]
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(lengths, pa.int64()), *lists], ["doc_id", "n", "terms", "counts"])

    return documents.select("doc_id", "text").mapInArrow(count, f"doc_id {kind}, n long, terms array<int>, counts array<long>")


def term_weights(posted: DataFrame, documents: int, size: int) -> np.ndarray:
    """Weight of each of `size` terms by the number of documents that hold it."""
    n = F.lit(documents)
    weight = F.floor(1000 * F.log((2 * n + 2) / (2 * F.col("df") + 1)))
    held = posted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weights = np.zeros(size, np.int64)  # a term that no document holds adds to no score
    for row in held.select("term", weight.alias("w")).toLocalIterator():
        weights[row["term"]] = row["w"]
    return weights


def length_penalties(lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """100 - 90 + (90 * n * N) div L; in whole numbers of any size where 64 bits would not do."""
    if int(lengths.max(initial=0)) * 90 * documents < 1 << 63:
        return 10 + lengths * (90 * documents) // total
    return np.array([10 + 90 * int(n) * documents // total for n in lengths], np.int64)


class Segment:
    """Some documents with their postings: a bitmap per term, and what each posting adds to a score."""

    def __init__(self, lengths, offsets, terms, counts, weights, documents, total):
        self.n, self.offsets = len(lengths), offsets
        self.held, self.terms = np.unique(terms, return_inverse=True)
        owners = np.repeat(np.arange(self.n), np.diff(offsets))
        penalty = length_penalties(lengths, documents, total)[owners]
        self.adds = weights[terms] * (1_000_000_000 * counts // (1000 * counts + 8 * penalty))
        self.most = np.zeros(len(self.held), np.int64)  # the largest share of each term
        np.maximum.at(self.most, self.terms, self.adds)
        present = np.zeros((len(self.held), self.n), bool)
        present[self.terms, owners] = True
        self.bitmaps = np.packbits(present, axis=1)

    def best(self, asked: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of at least the `k` best for the terms `asked`, but for those below `floor`."""
        places = np.searchsorted(self.held, asked)
        there = places < len(self.held)
        there[there] = self.held[places[there]] == asked[there]
        places = places[there]
        places = places[self.most[places] > 0]
        bitmaps = self.bitmaps[places]
        docs = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(bitmaps, axis=0), count=self.n)) if len(places) else np.zeros(0, int)
        if not len(docs):
            return docs, docs
        # bit j of a document's mask: it holds term j; equal masks are equal byte rows
        bits = np.packbits(np.unpackbits(bitmaps, axis=1, count=self.n)[:, docs], axis=0).T
        padded = np.zeros((len(docs), -(-bits.shape[1] // 8) * 8), np.uint8)
        padded[:, : bits.shape[1]] = bits
        keys = padded.view(np.uint64) if padded.shape[1] == 8 else padded.view(f"V{padded.shape[1]}")
        _, first, group = np.unique(keys.ravel(), return_index=True, return_inverse=True)
        bounds = np.unpackbits(bits[first], axis=1, count=len(places)).astype(np.int64) @ self.most[places]
        order = np.argsort(-bounds[group], kind="stable")
        bounds, docs = bounds[group][order], docs[order]
        wanted = np.zeros(len(self.held), bool)
        wanted[places] = True
        scores, done, step = np.zeros(0, np.int64), 0, 4 * k
        while done < len(docs):
            if len(scores) >= k:
                floor = max(floor, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
            if bounds[done] < floor:
                break
            scores = np.concatenate((scores, self.scores(docs[done : done + step], wanted)))
            done, step = done + step, 2 * step
        return docs[: len(scores)], scores

    def scores(self, docs: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        starts, sizes = self.offsets[docs], self.offsets[docs + 1] - self.offsets[docs]
        before = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        at = np.repeat(starts - before, sizes) + np.arange(sizes.sum())
        return np.add.reduceat(np.where(wanted[self.terms[at]], self.adds[at], 0), before)


def segments(batch: pa.RecordBatch, weights: np.ndarray, documents: int, total: int) -> Iterator[tuple[int, Segment]]:
    """The batch in runs of documents whose bitmaps stay within SEGMENT_BITS, with the first row of each."""
    lengths = batch.column(1).to_numpy()
    offsets = batch.column(2).offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    terms, counts = batch.column(2).flatten().to_numpy(), batch.column(3).flatten().to_numpy()
    rows = max(64, SEGMENT_BITS // max(1, min(len(weights), len(terms))))
    for first in range(0, len(lengths), rows):
        last = min(first + rows, len(lengths))
        own = slice(offsets[first], offsets[last])
        yield first, Segment(lengths[first:last], offsets[first : last + 1] - offsets[first], terms[own], counts[own], weights, documents, total)


def best_of_parts(posted: DataFrame, items: list[tuple], weights: np.ndarray, documents: int, total: int, k: int, item_kind: str) -> DataFrame:
    """(item_id, doc_id, score): the `k` best documents of each item in every task."""
    kind = posted.schema["doc_id"].dataType.simpleString()
    asked = posted.sparkSession.sparkContext.broadcast((items, weights))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = asked.value
        lists: list[list[tuple]] = [[] for _ in items]
        for batch in batches:
            ids = batch.column(0)
            for first, segment in segments(batch, weights, documents, total):
                for i, (_, terms) in enumerate(items):
                    floor = lists[i][-1][0] if len(lists[i]) == k else 1
                    docs, scores = segment.best(terms, k, floor)
                    kept = scores >= floor
                    found = [(int(s), ids[first + int(d)].as_py()) for d, s in zip(docs[kept], scores[kept])]
                    lists[i] = sorted(lists[i] + found, key=lambda r: (-r[0], r[1] is None, r[1]))[:k]
        rows = [(items[i][0], doc, score) for i, found in enumerate(lists) for score, doc in found]
        for first in range(0, len(rows), 10_000):
            columns = zip(*rows[first : first + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, s.type) for c, s in zip(columns, arrow)], names=arrow.names)

    result = StructType.fromDDL(f"item_id {item_kind}, doc_id {kind}, score long")
    arrow = to_arrow_schema(result)
    return posted.mapInArrow(search, result)


def _ranked(rows: DataFrame, by: list, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def rank_documents(documents: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the `k` best documents of `documents` (doc_id, text) for each of `items` (item_id, text)."""
    pairs = stored(item_terms(items))
    blocks = max(1, -(-pairs.count() // block_terms))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    return _ranked(
        _ranked(
            reduce(DataFrame.unionAll, [_search_block(documents, pairs.filter(block == b), k) for b in range(blocks)]),
            ["item_id", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))],
            k,
        ).drop("rank"),
        ["item_id"],
        k,
    ).select("item_id", "rank", "doc_id", "score")


def _search_block(documents: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    asked = pairs.collect()  # about BLOCK_TERMS rows
    vocabulary = sorted({row["term"] for row in asked})
    number = {term: i for i, term in enumerate(vocabulary)}
    items: dict[object, list[int]] = {}
    for row in asked:
        items.setdefault(row["item_id"], []).append(number[row["term"]])
    posted = stored(postings(documents, vocabulary))
    totals = posted.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    weights = term_weights(posted, totals["documents"], len(vocabulary))
    listed = [(item, np.unique(np.array(terms))) for item, terms in items.items()]
    kind = pairs.schema["item_id"].dataType.simpleString()
    return best_of_parts(posted, listed, weights, totals["documents"], totals["total"], k, kind)
