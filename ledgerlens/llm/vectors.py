"""Embedding columns: which rows take part, their classes of equal vectors, numpy views."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vec) of the rows that take part, components as doubles.

    Left out: null ids, vectors that are null, zero, or hold null or non-finite
    components, and vectors of another length than most (of equally common
    lengths, the largest).
    """
    vec = F.transform(F.col(vector_column), lambda x: x.cast("double") + F.lit(0.0))
    rows = df.select(F.col(id_column).alias("id"), vec.alias("vec")).filter("id IS NOT NULL AND size(vec) > 0")
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(sound & F.exists("vec", lambda x: x != 0))
    width = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).select("n").first()
    return rows.filter(F.size("vec") == (width[0] if width else 0))


def classes(rows: DataFrame, keep: int = 1) -> DataFrame:
    """(cls, vec, ids, copies): one row per distinct vector, with its `keep` smallest ids and its number of rows.

    The ranked window keeps `keep` rows a vector in every task before it
    shuffles, and copies are counted map-side, so a vector that holds a third
    of all rows costs no more than any other.
    """
    marked = rows.withColumn("cls", F.xxhash64("vec"))
    if keep == 1:
        return marked.groupBy("cls", "vec").agg(F.array(F.min("id")).alias("ids"), F.count("*").alias("copies"))
    rank = F.row_number().over(Window.partitionBy("cls", "vec").orderBy("id"))
    first = marked.withColumn("_nth", rank).filter(F.col("_nth") <= keep)
    return first.groupBy("cls", "vec").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.count("*").alias("copies"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def lists(rows: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] if len(rows) else 0)
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(rows).ravel()))


def sample_matrix(rows: DataFrame, size: int, seed: str) -> np.ndarray:
    """At most `size` vectors of a class table, the first by a hash of the vector; read by the driver."""
    found = rows.orderBy(F.xxhash64(F.lit(seed), "cls"), "cls").limit(size).select("vec").toArrow()
    return matrix(found.column(0)) if found.num_rows else np.zeros((0, 0))
