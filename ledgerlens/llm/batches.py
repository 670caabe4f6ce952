"""Whole texts go to Python in batches of a few MB."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 1 << 22


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """`df.mapInArrow(function, schema)`, with batches of about BATCH_BYTES, or one row if that is longer.

    By rows alone a batch holds 10,000 texts, several times over in the executor's buffers and in the
    worker. Spark reads the limit from the session when the frame runs, so it stays set there; one
    that the session already has is kept.
    """
    conf = df.sparkSession.conf
    if conf.get(LIMIT, None) is None:
        conf.set(LIMIT, str(BATCH_BYTES))
    return df.mapInArrow(function, schema)
