"""The corpus pipeline: documents in, encoded training text out.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept. run() writes each result as Parquet to the shared folder and
reads it again for the next stage.

Null and empty texts pass the quality filter by their score, lose no lines,
are nobody's copy, count no words in the mix (they are still drawn) and encode to null or an
empty list. Rows that repeat an id stay or go together. Empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import line_dedup, mixing, near_dedup, quality, sentencepiece
from ledgerlens.llm.shipping import ship
from ledgerlens.llm.workload import quality_trees
from ledgerlens.sources.scratch import run_folder, stored


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. It is fitted on the labelled ones among `docs`."""
    return quality.keep_good(docs, quality_trees(spark, sf_dir, docs))


def line_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier, or differ from such by a word, are cut out.

    A document none of whose words is left goes; `n_chars` follows the text.
    """
    cleaned = line_dedup.without_repeated_lines(docs)
    emptied = (F.size("removed") > 0) & ~F.regexp_like("text", F.lit(mixing.WORD))
    chars = F.when(F.size("removed") > 0, F.length("text").cast("long")).otherwise(F.col("row.n_chars"))
    changed = {"text": F.col("text"), "n_chars": chars}
    return cleaned.filter(~F.coalesce(emptied, F.lit(False))).select(
        *[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    )


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, similarity 0.8) the smallest id stays."""
    return near_dedup.without_near_duplicates(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mix_sources(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document of the mix, and whether they decode to its text."""
    return sentencepiece.encode_texts(docs, sentencepiece.read_vocabulary())


STAGES = [
    ("quality", quality_filter),
    ("lines", line_filter),
    ("near_duplicates", near_duplicate_filter),
    ("mix", source_mix),
    ("pieces", encoded),
]

# Trees, sketches and piece paths are no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run_in_folder(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """All stages over the documents of `sf_dir`, and the folder that holds all they stored.

    Who has written the result deletes the folder with `ledgerlens.sources.scratch.discard`.
    """
    ship(spark)
    with run_folder(spark) as folder:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for _, stage in STAGES[:-1]:
            docs = stored(stage(spark, docs, sf_dir))
        return STAGES[-1][1](spark, docs, sf_dir), folder


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    return run_in_folder(spark, sf_dir)[0]
