"""CSV records with line breaks inside quotes, read by many tasks a file.

A file is read as lines, in the byte ranges Spark cuts it into. One pass counts
the quotes of each range; the running parity over the ranges of a file says which of
them start inside quotes. With that, each range is cut into records alone: a
line starts a record if an even number of quotes stands before it. What a range
holds of a record that began in an earlier one, or that ends in a later one, comes out as
a piece, and the pieces of a file (at most two a range) are put together in order.

Quotes inside a field are doubled. A lone quote in a field without quotes joins
lines that do not belong together; such a record has the wrong number of fields and fails the read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.sources.scratch import stored
from ledgerlens.sources.shipping import ship

RECORD, HEAD, TAIL = 0, 1, 2
PIECES = pa.schema([("range", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("text", pa.string())])


class _Range:
    """The lines of one byte range, cut into records as they come."""

    def __init__(self, number: int, at_start: bool, inside: bool):
        self.number, self.first, self.inside, self.in_head = number, at_start, inside, inside
        self.open: list[str] = []

    def rows(self, kinds: list[int], texts: pa.Array) -> pa.RecordBatch:
        first = np.zeros(len(texts), bool)
        if len(texts) and kinds[0] != HEAD:
            first[0], self.first = self.first, False
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(texts), self.number)), pa.array(kinds, pa.int32()), pa.array(first), texts.cast(pa.string())], schema=PIECES
        )

    def closed(self, kind: int) -> pa.RecordBatch:
        """What is open, as one row."""
        text, self.open, self.in_head = "\n".join(self.open), [], False
        return self.rows([kind], pa.array([text]))

    def add(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
        before = (int(self.inside) + np.cumsum(quotes) - quotes) % 2  # quotes open before each line
        self.inside = bool((before[-1] + quotes[-1]) % 2)
        starts = np.flatnonzero(before == 0)
        lead = int(starts[0]) if len(starts) else len(lines)
        self.open += lines.slice(0, lead).to_pylist()
        if not len(starts):
            return
        if self.open:
            yield self.closed(HEAD if self.in_head else RECORD)
        self.in_head = False
        offsets = pa.array(np.concatenate((starts, [len(lines)])), pa.int32())
        records = pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n")
        whole = len(records) - self.inside
        if whole:
            yield self.rows([RECORD] * whole, records.slice(0, whole))
        if self.inside:
            self.open = lines.slice(int(starts[-1])).to_pylist()

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.open:
            yield self.closed(HEAD if self.in_head else TAIL if self.inside else RECORD)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (range, at_start, inside, value) in file order to records and pieces."""
    current: _Range | None = None
    for batch in batches:
        numbers = batch.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1), len(numbers)]
        for a, b in zip(edges[:-1], edges[1:]):
            if a == b:
                continue
            if current is None or current.number != numbers[a]:
                if current:
                    yield from current.end()
                current = _Range(int(numbers[a]), batch.column(1)[a].as_py(), batch.column(2)[a].as_py())
            yield from current.add(batch.column(3).slice(a, b - a))
    if current:
        yield from current.end()


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(text, first): every CSV record of the files under `path` as raw text, and whether it is the first of its file."""
    ship(spark)
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", file.alias("file"), block.alias("block"), F.xxhash64(file, block).alias("range")
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    ranges = stored(lines.groupBy("file", "block", "range").agg((F.sum(quotes) % 2).alias("odd")))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside")
    ranges = stored(ranges.select("range", "file", "block", (F.col("block") == 0).alias("at_start"), inside))
    # a join by shuffle would lose the order of lines in a task; this table has one narrow row per split of the input
    known = lines.select("range", "value").join(F.broadcast(ranges.select("range", "at_start", "inside")), "range", "left")
    changed = F.raise_error(F.lit("the files or the split size changed while they were read"))
    known = known.select("range", F.coalesce("at_start", changed).alias("at_start"), "inside", "value")
    pieces = stored(known.mapInArrow(_cut, "range long, kind int, first boolean, text string"))
    records = pieces.filter(f"kind = {RECORD}").select("text", "first")
    return records.unionAll(_put_together(pieces.filter(f"kind <> {RECORD}"), ranges))


def _put_together(pieces: DataFrame, ranges: DataFrame) -> DataFrame:
    """Records that cross ranges: a tail and the heads that follow it in its file."""
    placed = pieces.join(ranges.select("range", "file", "block"), "range")
    in_order = Window.partitionBy("file").orderBy("block", "kind")
    numbered = placed.withColumn("record", F.count_if(F.col("kind") == TAIL).over(in_order))
    listed = F.array_sort(F.collect_list(F.struct("block", "kind", "text")))
    whole = numbered.groupBy("file", "record").agg(listed.alias("parts"), F.bool_or("first").alias("first"))
    return whole.select(F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"), "first")
