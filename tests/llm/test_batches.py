"""Whole texts reach Python in batches bounded by bytes."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import batches, line_dedup, near_dedup, quality, sentencepiece

LONG = 10_000  # bytes of a text
ROWS = 2_000
VOCABULARY = sentencepiece.Vocabulary(("<unk>", "a"), (0.0, -1.0), "un")
OPERATORS = {
    "quality": lambda df: quality.keep_good(df, None),
    "scores": lambda df: quality.score_quality(df, None),
    "lines": lambda df: line_dedup._lines(line_dedup._rows(df, "doc_id", "text"), 5, False),
    "near_duplicates": lambda df: near_dedup._read_sets(df.withColumnRenamed("doc_id", "id"), 5, False),
    "pieces": lambda df: sentencepiece.encode_texts(df, VOCABULARY),
}


def texts(session):
    return session.range(0, ROWS, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a"), LONG).alias("text"))


def largest(df) -> int:
    def sizes(found):
        for batch in found:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    return max(row["n"] for row in df.mapInArrow(sizes, "n long").collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_an_operator_bounds_its_batches(spark, name):
    session = spark.newSession()
    df = texts(session)
    assert largest(df) > 3 * batches.BATCH_BYTES
    OPERATORS[name](df)
    assert largest(df) < batches.BATCH_BYTES + 2 * LONG


def test_no_row_is_lost_between_batches(spark):
    session = spark.newSession()
    assert quality.keep_good(texts(session), None).agg(F.count("*"), F.sum("doc_id")).first()[:] == (ROWS, ROWS * (ROWS - 1) // 2)


def test_a_limit_of_the_session_is_kept(spark):
    session = spark.newSession()
    session.conf.set(batches.LIMIT, "300000")
    df = texts(session)
    quality.keep_good(df, None)
    assert session.conf.get(batches.LIMIT) == "300000"
    assert largest(df) < 300_000 + 2 * LONG
