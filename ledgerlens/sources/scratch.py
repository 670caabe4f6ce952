"""Where intermediate tables go: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession

CONF = "spark.checkpoint.dir"
_RUN: ContextVar[str | None] = ContextVar("run_folder", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local one only for a local master."""
    named = spark.conf.get(CONF, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CONF} to a folder all executors share")
    return tempfile.mkdtemp(prefix="ledgerlens-")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, or the run folder, so no run overwrites another."""
    ensure_checkpoint_dir(spark)
    return f"{_RUN.get() or spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A fresh folder that takes all that is stored inside the `with`. Whoever opens it calls `discard` in the end."""
    path = scratch_path(spark, "run")
    before = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(before)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a run folder; frames that read from it can't be used any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, observation: Observation | None = None, metrics: dict[str, Column] | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it from there.

    Cuts the lineage of a frame that is used several times. As Parquet, so that
    each later pass reads only the columns it needs. `observation` takes the
    aggregates `metrics` over the rows as they are written; these tasks are the
    last of their job, so one that runs again counts once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    observed = df.observe(observation, *[m.alias(name) for name, m in metrics.items()]) if observation else df
    observed.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
