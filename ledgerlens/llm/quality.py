"""Quality classifier: gradient-boosted histogram trees over document statistics.

Statistics are read off the bytes of whole texts, a block of documents at a
time. Trees are fitted on a bounded sample of the labelled rows (`max_rows`,
the first by a hash of the id), each on gradient histograms of binned
statistics, and laid end to end in flat arrays that numpy walks for all
documents of a batch at once.

Null text is scored as empty text. Repeated rows get equal scores; a label table
with repeated ids uses each of its rows. Without a labelled row the score is 1.0
(nothing is known against any document).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.batches import map_batches
from ledgerlens.llm.text import SMALL_BLOCK, Block, blocks, mix64, sums

MAX_ROWS = 20_000  # labelled rows that the trees are fitted on
KEEP_SCORE = 0.7
BINS, TREES, DEPTH, RATE, MIN_ROWS, RIDGE = 64, 80, 4, 0.15, 10, 2.0

CLASSES = {
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "digit": bytes(range(48, 58)),
    "space": b" \t\n\v\f\r",
    "stop": b".!?",
    "mark": b",;:'\"()-",
    "symbol": b"#$%&*+/<=>@[\\]^_`{|}~",
    "wide": bytes(range(128, 256)),
}
STATISTICS = [
    "log_bytes", "log_words", "word_length", "long_words", "line_words", "short_lines", "stops_a_word", "exclamations",
    "bars", *[f"{c}_share" for c in CLASSES], "distinct_words", "distinct_pairs", "repeated_next", "top_word", "upper_words",
]

_CLASS_OF = np.zeros(256, np.int64)
for _number, _members in enumerate(CLASSES.values()):
    _CLASS_OF[list(_members)] = _number + 1


def _distinct_and_top(keys: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of distinct keys and count of the commonest, per document."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n, dtype=np.uint64), np.diff(offsets))
    # equal keys of one document meet in the sort; the mix keeps documents apart
    order = np.sort(mix64(keys + owner * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(24) | owner << np.uint64(40))
    first = np.flatnonzero(np.concatenate(([True], order[1:] != order[:-1]))) if len(order) else np.zeros(0, np.int64)
    runs = np.diff(np.append(first, len(order)))
    holder = (order[first] >> np.uint64(40)).astype(np.int64)
    top = np.zeros(n)
    np.maximum.at(top, holder, runs)
    return np.bincount(holder, minlength=n).astype(float), top


def statistics(block: Block) -> np.ndarray:
    """One row of STATISTICS per document of the block; zeros for an empty text."""
    data, offsets = block.data, block.offsets
    starts, ends, word_offsets = block.words
    size, words = np.diff(offsets).astype(float), np.diff(word_offsets).astype(float)
    per_byte, per_word = np.maximum(size, 1), np.maximum(words, 1)
    lengths = ends - starts
    owner = np.repeat(np.arange(block.n), np.diff(offsets))
    shares = np.bincount(owner * 9 + _CLASS_OF[data], minlength=9 * block.n).reshape(block.n, 9)[:, 1:] / per_byte[:, None]
    breaks = data == 10
    lines = sums(breaks, offsets) + 1.0
    line_of = np.concatenate(([0], np.cumsum(breaks)))
    begins = np.unique(np.concatenate((offsets[:-1], np.flatnonzero(breaks) + 1))) if len(data) else offsets[:-1]
    begins = begins[begins < max(1, len(data))]
    line_size = np.diff(np.append(begins, len(data)))
    line_owner = np.searchsorted(offsets, begins, "right") - 1
    short = np.bincount(line_owner[line_size < 20], minlength=block.n)[: block.n] if len(data) else np.zeros(block.n)
    hashes = block.word_hashes()
    distinct, top = _distinct_and_top(hashes, word_offsets)
    inner = np.ones(len(hashes), bool)
    inner[word_offsets[1:][np.diff(word_offsets) > 0] - 1] = False  # the last word of a document starts no pair
    follower = np.append(hashes[1:], np.uint64(0))
    pairs = mix64(hashes * np.uint64(3) + follower)[inner]
    pair_offsets = np.concatenate(([0], np.cumsum(inner)))[word_offsets]
    distinct_pairs, _ = _distinct_and_top(pairs, pair_offsets)
    same = sums((hashes == follower) & inner, word_offsets)
    upper = np.concatenate(([0], np.cumsum((data >= 65) & (data <= 90))))
    shouted = sums((upper[ends] - upper[starts]) * 2 > lengths, word_offsets)
    del line_of
    columns = [
        np.log1p(size), np.log1p(words), sums(lengths, word_offsets) / per_word, sums(lengths > 20, word_offsets) / per_word,
        np.log1p(words / lines), short / lines, sums(_CLASS_OF[data] == 5, offsets) / per_word,
        sums(data == 33, offsets) / per_word, sums(data == 124, offsets) / per_word, *shares.T, distinct / per_word,
        distinct_pairs / np.maximum(words - 1, 1), same / per_word, top / per_word, shouted / per_word,
    ]
    return np.column_stack(columns)


@dataclass(frozen=True)
class Trees:
    """All trees in flat arrays; a leaf is its own child, so every walk takes `depth` steps."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: float
    depth: int

    def margins(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total += self.value[node]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Logistic loss, Newton leaves, splits on histograms of at most BINS quantile bins."""
    n, width = x.shape
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(cut, c, "left") for cut, c in zip(cuts, x.T)])
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(rate / (1 - rate)))
    margin = np.full(n, start)
    roots, feature, threshold, left, right, value = [], [], [], [], [], []

    def new_node() -> int:
        node = len(feature)
        for column, content in ((feature, 0), (threshold, 0.0), (left, node), (right, node), (value, 0.0)):
            column.append(content)
        return node

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, curvature = y - p, p * (1 - p)
        level = [(new_node(), np.arange(n))]
        roots.append(level[0][0])
        for step in range(depth + 1):
            below = []
            for node, rows in level:
                g, h = gradient[rows], curvature[rows]
                value[node] = RATE * g.sum() / (h.sum() + RIDGE)
                margin_rows = rows
                best = (1e-6, None, None)
                if step < depth and len(rows) >= 2 * MIN_ROWS:
                    whole = g.sum() ** 2 / (h.sum() + RIDGE)
                    flat = (binned[rows] + np.arange(width) * BINS).ravel()
                    hist = [
                        np.bincount(flat, np.repeat(w, width), width * BINS).reshape(width, BINS).cumsum(axis=1)
                        for w in (g, h, np.ones(len(rows)))
                    ]
                    gl, hl, nl = hist
                    gain = gl**2 / (hl + RIDGE) + (g.sum() - gl) ** 2 / (h.sum() - hl + RIDGE) - whole
                    gain[(nl < MIN_ROWS) | (len(rows) - nl < MIN_ROWS)] = 0
                    f, b = np.unravel_index(np.argmax(gain), gain.shape)
                    if gain[f, b] > best[0] and b < len(cuts[f]):
                        best = (gain[f, b], int(f), int(b))
                if best[1] is None:
                    margin[margin_rows] += value[node]
                    continue
                _, f, b = best
                feature[node], threshold[node] = f, float(cuts[f][b])
                left[node], right[node] = new_node(), new_node()
                goes_left = binned[rows, f] <= b
                below += [(left[node], rows[goes_left]), (right[node], rows[~goes_left])]
            level = below
    arrays = [np.array(roots), np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value)]
    return Trees(*arrays, start, depth)


def document_statistics(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """One row per input row: id and `x`, the array of STATISTICS."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(b) for b in blocks(batch.column(1), SMALL_BLOCK)]
            x = np.concatenate(rows) if rows else np.zeros((0, len(STATISTICS)))
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["id", "x"])

    kept = df.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    found = map_batches(kept, read, f"id {kept.schema['id'].dataType.simpleString()}, x array<double>")
    return found.withColumnRenamed("id", id_column)


def train(df: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Trees | None:
    """Fit on `labels` (doc_id, quality) of documents in `df`: a fixed sample of at most `max_rows` of them."""
    order = [F.xxhash64(F.lit("quality"), "_id"), F.col("_id"), F.col("_y")]
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    sample = known.select(F.col("doc_id").alias("_id"), F.col("quality").cast("double").alias("_y"))
    sample = sample.join(df.select(F.col("doc_id").alias("_id")).distinct(), "_id", "left_semi").orderBy(*order).limit(max_rows)
    ids = sample.select("_id").distinct()  # at most max_rows
    texts = df.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id"), "left_semi")
    rows = document_statistics(texts, "doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    found = rows.select("x", "_y", "doc_id").orderBy("doc_id", "_y").limit(2 * max_rows).toPandas()
    if found.empty:
        return None
    return fit_trees(np.stack(found["x"]), found["_y"].to_numpy())


def score_quality(df: DataFrame, trees: Trees | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: the id and `score`, 0 to 1."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.ones(b.n) if trees is None else trees.scores(statistics(b)) for b in blocks(batch.column(1), SMALL_BLOCK)]
            scores = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["id", "score"])

    kept = df.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    found = map_batches(kept, score, f"id {kept.schema['id'].dataType.simpleString()}, score double")
    return found.withColumnRenamed("id", id_column)


def keep_good(df: DataFrame, trees: Trees | None, text_column: str = "text", least: float = KEEP_SCORE) -> DataFrame:
    """Rows of `df`, all columns, whose text scores at least `least`."""
    at = df.columns.index(text_column)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.ones(b.n) if trees is None else trees.scores(statistics(b)) for b in blocks(batch.column(at), SMALL_BLOCK)]
            scores = np.concatenate(found) if found else np.zeros(0)
            yield batch.filter(pa.array(scores >= least))

    return map_batches(df, keep, df.schema)
