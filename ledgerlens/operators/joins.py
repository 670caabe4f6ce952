"""Left joins that hold whatever the size of the side table and the key skew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.schema import quoted

# A side table up to this many rows is broadcast (narrow rows: some tens of MB).
BROADCAST_ROWS = 200_000
# A key is hot when it holds more than 1/HOT_SHARE of all rows, so there are
# always fewer than HOT_SHARE hot keys, however large the table.
HOT_SHARE = 10_000
SALTS = 1 << 20


def fits_broadcast(side: DataFrame, max_rows: int | None = None) -> bool:
    """Count `side` first, up to `max_rows` + 1: a side of unknown size is never broadcast."""
    most = BROADCAST_ROWS if max_rows is None else max_rows
    return side.limit(most + 1).count() <= most


def hot_rows(profile: DataFrame, weight: str) -> DataFrame:
    """Rows of a per-key profile above the hot share of all its `weight`.

    `weight` counts the rows behind each key, so fewer than HOT_SHARE remain.
    """
    return profile.filter(F.expr(f"{weight} * {HOT_SHARE}") > profile.agg(F.sum(weight)).scalar())


def hot_keys(facts: DataFrame, on: list[str]) -> DataFrame:
    """Keys of `facts` above the hot share: fewer than HOT_SHARE rows."""
    return hot_rows(facts.groupBy(*on).agg(F.count("*").alias("_rows")), "_rows").select(*on)


def _equal(on: list[str], prefix: str, operator: str) -> str:
    return " AND ".join(f"{c} {operator} {prefix}{c}" for c in on)


def spread_left_join(
    facts: DataFrame,
    side: DataFrame,
    hot_side: DataFrame,
    on: list[str],
    spread_by: str,
    null_safe: bool = False,
) -> DataFrame:
    """`facts` LEFT JOIN `side`, with the rows of hot keys kept off the join key.

    `hot_side` has the columns of `side`, one row per hot key and fewer than
    HOT_SHARE keys, so it is broadcast. Rows it marks get a salt from
    `spread_by` and spread over all tasks in the shuffle join, where they match
    nothing; all other rows meet `side` there under salt 0. The salt is a hash
    of the row, so a lost task recomputes the same one.
    """
    payload = [c for c in side.columns if c not in on]
    marks = hot_side.selectExpr(*[f"{c} AS _hot_{c}" for c in side.columns], "true AS _is_hot")
    cold = side.selectExpr(*[f"{c} AS _cold_{c}" for c in side.columns], "0L AS _cold_salt")
    salt = F.expr(f"CASE WHEN _is_hot THEN (xxhash64({spread_by}) & {SALTS - 1}L) + 1 ELSE 0L END")
    on_cold = _equal(on, "_cold_", "<=>" if null_safe else "=") + " AND _salt = _cold_salt"
    return (
        facts.join(F.broadcast(marks), F.expr(_equal(on, "_hot_", "<=>")), "left")
        .withColumn("_salt", salt)
        .join(cold, F.expr(on_cold), "left")
        .selectExpr(*quoted(facts.columns), *[f"coalesce(_hot_{c}, _cold_{c}) AS {c}" for c in payload])
    )


def lookup_join(
    facts: DataFrame,
    side: DataFrame,
    on: list[str],
    spread_by: str = "transaction_id",
    max_rows: int | None = None,
) -> DataFrame:
    """`facts` LEFT JOIN the keyed table `side`: broadcast if small, else spread."""
    if fits_broadcast(side, max_rows):
        return facts.join(F.broadcast(side), on, "left").select(
            *quoted(facts.columns), *[c for c in side.columns if c not in on]
        )
    hot_side = hot_keys(facts, on).join(side, on, "left").select(*side.columns)
    return spread_left_join(facts, side, hot_side, on, spread_by)
