"""Spelling variants: words one edit apart, grouped under the commonest form.

Near words are found by dense prefix-suffix tiling. Words are padded code-point
matrices; for a block of rows against a block of rows, the lengths of the common
prefix and the common suffix are counted a column at a time, and two words are
one edit apart where these reach the longer length minus one.

Only blocks that can hold such a pair meet. The longer of two near words is cut
in thirds; the edit lies in one of them, so both words share all that is before
and after it. Words are therefore dealt by (length of the longer, third, text
outside the third), and blocks of the same key are compared. A pair agrees
outside more than one third if it likes, but counts only where its edit is. A
key of more than CELL words is split into cells by a hash of the word, and each
pair of cells is a tile of its own: no task gets a whole hot key. Such a key
costs the square of its words; nothing is capped. Each tile reduces what it
finds to one row per word, so pairs are never written out.

A form is at least RATIO times as frequent as its word, so chains of forms are
short; they are followed by pointer doubling. No form has more words than there
are single edits of it.

A null or empty text has no words. A null doc_id counts as empty in the checksum. Rows
that repeat an id are cut alike and all count. Words of equal frequency: the
smaller in code-point order is the form. Columns besides doc_id and text are not
read. Empty tables give no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.joins import lookup_join
from ledgerlens.sources.scratch import stored

MIN_LENGTH, MIN_COUNT, RATIO, MODULUS = 6, 5, 5, 199
RUN = re.compile("[a-zÀ-ÿ]{%d,}" % MIN_LENGTH)  # of ASCII-lower-cased text; a longer match of a greedy run is the whole run
# Words of one key in one cell, rows of one block, and distinct words a task counts before it passes them on.
CELL, BLOCK, COUNTED = 2048, 256, 200_000
MATRIX_BYTES = 1 << 26


def document_words(doc_id: int | None, text: str | None) -> list[tuple[str, int]]:
    """(word, occurrences) of one document, cut where its checksum says so."""
    lowered = (text or "").encode().lower().decode()  # A-Z only
    found = Counter(RUN.findall(lowered))
    seed = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
    words = []
    for run, n in found.items():
        h = zlib.crc32(run.encode(), seed)
        if h % MODULUS == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= MIN_LENGTH:
            words.append((run, n))
    return words


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def passed_on() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for word, n in document_words(doc_id, text.as_py()):
                counts[word] += n
            if len(counts) >= COUNTED:
                yield passed_on()
                counts.clear()
    if counts:
        yield passed_on()


def word_counts(documents: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of all words with `min_count` occurrences or more; counted per task before they are shuffled."""
    counted = documents.select("doc_id", "text").mapInArrow(_count_words, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def dealt(words: DataFrame, cell: int = CELL) -> DataFrame:
    """Each word under the six keys a near word may share with it, and per key in all tiles of its cell."""
    length = F.char_length("word")
    keys = []
    for more in (0, 1):
        longer = length + more
        cuts = [F.floor(longer * c / 3).cast("int") for c in range(4)]
        for third in range(3):
            after = longer - cuts[third + 1]
            key = F.xxhash64(longer, F.lit(third), F.substring("word", F.lit(1), cuts[third]), F.right("word", after))
            keys.append(F.struct(longer.cast("int").alias("longer"), F.lit(third).alias("third"), key.alias("key")))
    rows = words.select("word", "n", F.inline(F.array(*keys)))
    large = stored(rows.groupBy("key").agg(F.count("*").alias("_rows")).filter(F.col("_rows") > cell))
    cells = F.coalesce(F.ceil(F.col("_rows") / cell), F.lit(1)).cast("int")
    placed = lookup_join(rows, large, ["key"], spread_by="word").withColumn("_cells", cells)
    placed = placed.withColumn("cell", F.pmod(F.xxhash64("word", F.lit("cell")), F.col("_cells")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_cells") - 1))
    pairs = placed.withColumn("_other", other).withColumns({"i": F.least("cell", "_other"), "j": F.greatest("cell", "_other")})
    return pairs.select("longer", "third", "key", "i", "j", "cell", "word", "n")


class Block:
    """Some words as rows of code points, zeros filling the rows up, read from either end."""

    def __init__(self, words: list[str]):
        self.lengths = np.array([len(w) for w in words])
        self.forwards = np.array(words).view(np.uint32).reshape(len(words), -1)
        at = self.lengths[:, None] - 1 - np.arange(self.forwards.shape[1])
        self.backwards = np.where(at >= 0, np.take_along_axis(self.forwards, np.maximum(at, 0), axis=1), 0)


def common_prefix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Equal leading columns of every row of `left` and every row of `right`."""
    same = np.ones((len(left), len(right)), bool)
    length = np.zeros(same.shape, np.int32)
    for column in range(min(left.shape[1], right.shape[1])):
        same &= left[:, column, None] == right[None, :, column]
        if not same.any():
            break
        length += same
    return length


def block_starts(lengths: np.ndarray) -> list[int]:
    """Where blocks of at most BLOCK rows, and of MATRIX_BYTES or one row, start."""
    starts, longest = [0], 0
    for row, length in enumerate(lengths.tolist()):
        longest, rows = max(longest, length), row - starts[-1]
        if rows and (rows == BLOCK or (rows + 1) * longest * 8 > MATRIX_BYTES):
            starts.append(row)
            longest = length
    return starts


def near_pairs(rows: dict[str, np.ndarray], tiles: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of words one edit apart, among rows of the same tile (`tiles` ascending), each found once over all keys."""
    starts = block_starts(np.array([len(w) for w in words]))
    spans = list(zip(starts, [*starts[1:], len(words)]))
    matrices = [Block(words[a:b]) for a, b in spans]
    found = []
    for i, (a, a_end) in enumerate(spans):
        for j in range(i, len(spans)):
            b, b_end = spans[j]
            if tiles[b] > tiles[a_end - 1]:
                break
            left, right = matrices[i], matrices[j]
            shorter = np.minimum(left.lengths[:, None], right.lengths[None, :])
            longer = np.maximum(left.lengths[:, None], right.lengths[None, :])
            prefix = np.minimum(common_prefix(left.forwards, right.forwards), shorter)
            suffix = np.minimum(common_prefix(left.backwards, right.backwards), shorter)
            near = (prefix + suffix >= longer - 1) & (longer - shorter <= 1) & (tiles[a:a_end, None] == tiles[None, b:b_end])
            x, y = np.nonzero(near)
            size, edit = longer[x, y], np.minimum(prefix[x, y], longer[x, y] - 1)
            x, y = x + a, y + b
            # each row pair once, and across cells where the tile is of two
            ours = (x < y) & ((rows["i"][x] == rows["j"][x]) | (rows["cell"][x] != rows["cell"][y]))
            # a pair counts under the length of its longer word and the third that its edit is in
            third = (edit >= size // 3).astype(int) + (edit >= 2 * size // 3)
            ours &= (size == rows["longer"][x]) & (third == rows["third"][x])
            found.append((x[ours], y[ours]))
    return tuple(np.concatenate(side) for side in zip(*found))


def _near_of_tiles(rows: pa.Table) -> pa.RecordBatch | None:
    """One row per word that has near words in these whole tiles: how many, and the most frequent of them."""
    columns = {c: rows.column(c).to_numpy() for c in ("longer", "third", "key", "i", "j", "cell", "n")}
    new = np.zeros(len(rows), bool)
    for c in ("longer", "third", "key", "i", "j"):
        new[1:] |= columns[c][1:] != columns[c][:-1]
    tiles = np.cumsum(new)
    shared = np.bincount(tiles)[tiles] > 1
    if not shared.any():
        return None
    columns = {c: values[shared] for c, values in columns.items()}
    words = rows.column("word").filter(pa.array(shared)).to_pylist()
    x, y = near_pairs(columns, tiles[shared], words)
    word, other = np.concatenate((x, y)), np.concatenate((y, x))
    if not len(word):
        return None
    place = np.empty(len(words), np.int64)
    place[np.array(sorted(range(len(words)), key=words.__getitem__))] = np.arange(len(words))
    order = np.lexsort((place[other], -columns["n"][other], word))
    word, other = word[order], other[order]
    first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    count = np.diff(np.concatenate((first, [len(word)])))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([words[w] for w in word[first]], pa.string()),
            pa.array(count, pa.int64()),
            pa.array(columns["n"][other[first]], pa.int64()),
            pa.array([words[w] for w in other[first]], pa.string()),
        ],
        ["word", "n_near", "best_n", "best"],
    )


def _near_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, a run of whole tiles at a time; the last tile of a batch waits for the next one."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        tile = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(5)])
        last = np.flatnonzero((tile != tile[:, -1:]).any(axis=0))
        cut = int(last[-1]) + 1 if len(last) else 0  # the batch's last tile starts here
        if not cut and waiting and all(waiting[-1].column(c)[-1].as_py() == tile[c, -1] for c in range(5)):
            waiting.append(batch)
            continue
        whole = pa.Table.from_batches([*waiting, batch.slice(0, cut)])
        if len(whole) and (found := _near_of_tiles(whole)):
            yield found
        waiting = [batch.slice(cut)]
    if waiting and (found := _near_of_tiles(pa.Table.from_batches(waiting))):
        yield found


def near_words(words: DataFrame, cell: int = CELL) -> DataFrame:
    """(word, n_near, best_n, best) of words (word, n) that have near words: how many, and the most frequent of them."""
    tile = ["longer", "third", "key", "i", "j"]
    rows = dealt(words, cell).repartition(*[F.col(c) for c in tile]).sortWithinPartitions(*tile)
    parts = rows.mapInArrow(_near_words, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("_best")
    found = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("_best.n")).alias("best_n"), F.col("_best.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word in `forms` (word, form), following forms to the last. Each round doubles the way covered."""
    reached = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        beyond = reached.select(F.col("word").alias("root"), F.col("root").alias("_beyond"))
        further = reached.join(beyond, "root", "left")
        further = stored(further.select("word", F.coalesce("_beyond", "root").alias("root"), F.col("_beyond").isNotNull().alias("_moved")))
        reached = further.select("word", "root")
        if further.filter("_moved").isEmpty():
            return reached


def spelling_variants(documents: DataFrame, cell: int = CELL) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of `documents` (doc_id, text)."""
    words = stored(word_counts(documents))
    near = words.join(near_words(words, cell), "word", "left")
    is_form = F.col("best_n") >= RATIO * F.col("n")
    formed = stored(
        near.select(
            "word",
            F.when(is_form, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("best_n")).alias("form_n"),
        )
    )
    rooted = formed.join(roots(formed.filter("form IS NOT NULL")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
