"""Dense ids 1..n in a global order, without one task seeing all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ledgerlens.sources.scratch import stored

ROW_BITS = 33  # monotonically_increasing_id: partition above, row position below


def with_dense_id(
    df: DataFrame, order: list, name: str, observation: Observation | None = None, metrics: dict[str, Column] | None = None
) -> DataFrame:
    """Sort `df`, then number it partition by partition.

    The sort range-partitions by sampled bounds, so the sorted rows are stored
    with their (partition, position) before anything is counted: a re-run could
    draw other bounds. That is the only write. What `df` shuffles is not shuffled again
    for the sample, only what follows its last shuffle runs twice. The second pass adds each
    partition's offset, a table of one row per partition. `metrics` are taken by `observation` in the write.
    """
    slot = F.col("_slot")
    placed = stored(df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()), observation, metrics)
    placed = placed.withColumns(
        {"_part": F.shiftright(slot, ROW_BITS), "_pos": slot.bitwiseAND(F.lit((1 << ROW_BITS) - 1))}
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg((F.max("_pos") + 1).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + F.col("_pos") + 1).alias(name), *df.columns
    )
