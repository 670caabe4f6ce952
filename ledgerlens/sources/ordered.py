"""Sinks that keep an order: numbered part files in sequence, and a manifest of what each holds.

Rows are numbered densely first, so the file of a row is known from its number:
no bounds are sampled, files hold the same count of rows each, and no task
sorts more than one file. Files sort by name into the order. The manifest, a small
Parquet table in `_manifest` below the folder (Spark's readers pass it over), has one row
per file: part, first and last position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.ids import with_dense_id
from ledgerlens.schema import quoted

ROWS_PER_FILE = 1_000_000
POSITION = "_position"


def write_numbered(
    df: DataFrame, position: str, path: str, fmt: str = "parquet", options: dict | None = None, rows_per_file: int = ROWS_PER_FILE, keep: bool = True
) -> str:
    """Write `df`, whose column `position` is dense from 1, in that order; with `keep` false that column is left out."""
    spark = df.sparkSession
    last = df.agg(F.max(position)).first()[0] or 0
    files = max(1, -(-last // rows_per_file))
    part = F.floor((F.col(position) - 1) / rows_per_file).cast("int")
    rows = df.repartitionById(files, part).sortWithinPartitions(position)
    rows = rows if keep else rows.drop(position)
    rows.write.mode("overwrite").format(fmt).options(**(options or {})).save(path)
    first = (F.col("id") * rows_per_file + 1).alias("first_position")
    ends = F.least((F.col("id") + 1) * rows_per_file, F.lit(last)).alias("last_position")
    manifest = spark.range(files).select(F.col("id").cast("int").alias("part"), first, ends)
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{path}/_manifest")
    return path


def write_ordered(
    df: DataFrame, order: list, path: str, fmt: str = "parquet", options: dict | None = None, rows_per_file: int = ROWS_PER_FILE
) -> str:
    """Write `df` sorted by `order`; rows that tie stand in any order."""
    numbered = with_dense_id(df, order, POSITION)
    return write_numbered(numbered, POSITION, path, fmt, options, rows_per_file, keep=False)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("part int, first_position long, last_position long").parquet(f"{path}/_manifest")


def read_ordered(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """Rows of an ordered Parquet sink with their position: the file's first, plus the row's place in its file."""
    rows = spark.read.parquet(path)
    part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("int")
    placed = rows.select(*quoted(rows.columns), part.alias("_part"), F.col("_metadata.row_index").alias("_row"))
    firsts = F.broadcast(read_manifest(spark, path).select(F.col("part").alias("_part"), "first_position"))
    position = (F.col("first_position") + F.col("_row")).alias(position)
    return placed.join(firsts, "_part").select(position, *quoted(rows.columns))
