"""Plant known anomalies into a transaction table, for recall tests.

Each operator picks exactly int(rows * rate * share) rows: those with the
smallest salted MD5 of their id. The pick is the same on every run and, once
the cut-off hash is known, a plain row filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.joins import lookup_join

# Share of the anomaly rate each kind gets, the late clock time
# and the range of the factor put on an approval limit.
SHARES = {"duplicates": 0.25, "missing_invoice": 0.20, "out_of_hours": 0.25, "over_limit": 0.30}
LATE_CLOCK = "22:35:00"
FACTOR_LOW, FACTOR_HIGH = 1.05, 2.0
SATURDAY = 5

PREFIX_STEP = 4  # hex digits: 65,536 buckets a level
LAST_LEVEL_ROWS = 100_000


def seed_hash(seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col("transaction_id").cast("string")))


def wanted_rows(total: int, rate: float, kind: str) -> int:
    return int(total * rate * SHARES[kind])


def cut_off(df: DataFrame, seed: str, wanted: int) -> str:
    """The `wanted`-th smallest hash, found bucket by bucket.

    Counting hashes by prefix gives at most 65,536 rows; the bucket the cut
    falls into is refined until a small top-k settles it. Ids must be unique.
    """
    if wanted <= 0:
        return ""
    hashes = df.select(seed_hash(seed).alias("h"))
    prefix = ""
    while True:
        length = len(prefix) + PREFIX_STEP
        bucket = F.substring("h", 1, length)
        running = Window.orderBy("bucket")
        edge = (
            hashes.groupBy(bucket.alias("bucket"))
            .agg(F.count("*").alias("n"))
            .withColumn("upto", F.sum("n").over(running))
            .filter(F.col("upto") >= wanted)
            .orderBy("bucket")
            .first()
        )
        if edge is None:
            return "g"  # fewer rows than wanted: every hex text sorts below
        prefix, wanted = edge["bucket"], wanted - (edge["upto"] - edge["n"])
        hashes = hashes.filter(F.col("h").startswith(prefix))
        if edge["n"] <= LAST_LEVEL_ROWS or length >= 32:
            last = hashes.orderBy("h").limit(wanted)
            return last.agg(F.max("h")).first()[0]


def picked(df: DataFrame, seed: str, rate: float, kind: str, base_rows: int | None = None) -> Column:
    """True on the rows to alter. `base_rows` is the size before any seeding."""
    total = df.count() if base_rows is None else base_rows
    return seed_hash(seed) <= cut_off(df, seed, wanted_rows(total, rate, kind))


def _random_part(seed: str, first: int, digits: int) -> Column:
    """Uniform integer below 16**digits from hex digits the cut-off does not use."""
    return F.conv(F.substring(seed_hash(seed), first, digits), 16, 10).cast("long")


def seed_duplicates(df: DataFrame, new_id: Column, rate: float = 0.03, seed: str = "dup", base_rows=None) -> DataFrame:
    """Append copies of picked rows under `new_id`, in one scan."""
    copies = F.when(picked(df, seed, rate, "duplicates", base_rows), F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    id_type = df.schema["transaction_id"].dataType
    renamed = F.when(F.col("_copy") == 1, new_id.cast(id_type)).otherwise(F.col("transaction_id"))
    return df.withColumn("_copy", F.explode(copies)).withColumn("transaction_id", renamed).drop("_copy")


def seed_missing_invoices(df: DataFrame, rate: float = 0.03, seed: str = "missing", base_rows=None) -> DataFrame:
    hit = picked(df, seed, rate, "missing_invoice", base_rows)
    return df.withColumn("invoice_number", F.when(hit, F.lit("")).otherwise(F.col("invoice_number")))


def seed_out_of_hours(df: DataFrame, rate: float = 0.03, seed: str = "hours", base_rows=None) -> DataFrame:
    """Half of the picked rows move on to Saturday, half to a late clock time."""
    hit = picked(df, seed, rate, "out_of_hours", base_rows)
    to_weekend = _random_part(seed, 32, 1) < 8
    day = F.col("transaction_date")
    saturday = F.date_add(day, F.greatest(F.lit(SATURDAY) - F.weekday(day), F.lit(0)))
    return df.withColumns(
        {
            "transaction_date": F.when(hit & to_weekend, saturday).otherwise(day),
            "transaction_time": F.when(hit & ~to_weekend, F.lit(LATE_CLOCK)).otherwise(F.col("transaction_time")),
        }
    )


def seed_over_limit(
    df: DataFrame, limits: DataFrame, rate: float = 0.03, seed: str = "limit", base_rows=None
) -> DataFrame:
    """Raise picked amounts to 1.05 to 2 times the limit of their vendor.

    Rows are picked among those whose vendor has a limit, so exactly the wanted
    number changes (all such rows, if they are fewer). The factor has four
    decimals, so the product is exact in decimals.
    """
    one_limit = limits.groupBy("vendor_id").agg(F.min("approval_limit").alias("approval_limit"))
    limited = lookup_join(df, one_limit, ["vendor_id"])
    total = df.count() if base_rows is None else base_rows
    hit = picked(limited.filter("approval_limit IS NOT NULL"), seed, rate, "over_limit", total)
    steps = round((FACTOR_HIGH - FACTOR_LOW) * 10_000)
    step = F.floor(_random_part(seed, 25, 8) * F.lit(steps) / F.lit(float(16**8)))
    factor = ((step + round(FACTOR_LOW * 10_000)) / F.lit(10_000)).cast("decimal(6,4)")
    raised = F.round(F.col("approval_limit") * factor, 2).cast("decimal(18,2)")
    amount = F.when(hit, F.coalesce(raised, "amount")).otherwise(F.col("amount"))
    return limited.withColumn("amount", amount).drop("approval_limit")
