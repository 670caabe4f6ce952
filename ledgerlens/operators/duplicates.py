"""Duplicate payments without pairing them, and without sorting a hot group.

Whether a payment is a duplicate depends only on its group (vendor, amount,
currency, invoice) and its date. Most groups hold one payment, which can't be a
duplicate; they are counted off first by the hash of the group, combined
map-side, and only payments of larger groups, the candidates, go on. These lie
together by that hash, and windows over them give every verdict on the row
itself: nothing is joined back.

Groups above a bound of rows are hot: there are few of them, and they are kept
off the group's hash. They are counted per group and date (a hot group shrinks
to one row per day and map task), the same windows run on that profile, and the
verdict is joined back onto the rows.

An audit that asks for several verdicts can store the candidates once, bucketed
by the hash (`store_candidates`). Every rule then reads its buckets without an
exchange.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens import functions as fn
from ledgerlens.operators.joins import fits_broadcast, hot_rows, spread_left_join
from ledgerlens.schema import quoted
from ledgerlens.sources.scratch import scratch_path, stored

GROUP = ["invoice_key", "amount", "vendor_id", "currency"]
GROUP_DAY = [*GROUP, "transaction_date"]
# Where a payment lies: the hash of its group, or of its id if the group is hot.
SLOT = "_slot"
SLOT_GROUP = [SLOT, *GROUP]
# A group is hot above this many payments, if it also has the hot share of all candidates.
HOT_ROWS = 100_000
ROWS_PER_BUCKET = 250_000

Marks = Callable[[DataFrame, list[str]], DataFrame]


@dataclass(frozen=True)
class Candidates:
    """Payments of groups of two or more. Each group of `cold` has one `_slot`; `hot` are those of hot groups, or None."""

    cold: DataFrame
    hot: DataFrame | None = None
    groups: DataFrame | None = None  # hashes of the repeated groups and their payments, if they are stored
    table: str | None = None  # the catalog's name of a bucketed store

    @property
    def rows(self) -> DataFrame:
        return self.cold if self.hot is None else self.cold.unionByName(self.hot)

    def mapped(self, change: Callable[[DataFrame], DataFrame]) -> Candidates:
        return Candidates(change(self.cold), None if self.hot is None else change(self.hot), self.groups, self.table)

    def discard(self) -> None:
        """Forget the table of a store; its files go with the folder they lie in."""
        if self.table:
            self.cold.sparkSession.sql(f"DROP TABLE IF EXISTS {self.table}")


def with_invoice_key(df: DataFrame) -> DataFrame:
    """Missing and blank invoices share one NULL key, which no real number can equal."""
    return df.withColumn("invoice_key", fn.blank_to_null(F.col("invoice_number")))


def with_sql_invoice_key(df: DataFrame) -> DataFrame:
    return df.withColumn("invoice_key", F.coalesce("invoice_number", F.lit("")))


def candidates(keyed: DataFrame) -> Candidates:
    """Rows whose group holds two payments or more, and a few others.

    Groups go by their hash: where two collide, a group of one payment comes
    along, and the windows say that it is no duplicate. The hashes of repeated groups are
    stored; Spark broadcasts them by their size or joins them by shuffle, and
    then its run-time Bloom filter drops other payments before they are shuffled.
    """
    slotted = keyed.withColumn(SLOT, F.xxhash64(*GROUP))
    groups = stored(slotted.groupBy(SLOT).agg(F.count("*").alias("_rows")).filter("_rows > 1"))
    repeated = groups.filter("_rows > 1").select(SLOT)  # a filter the Bloom filter can rest on
    large = groups.filter(F.col("_rows") > HOT_ROWS)
    if large.isEmpty():
        return Candidates(slotted.join(repeated, SLOT, "left_semi"), groups=groups)
    hot = F.broadcast(hot_rows(groups, "_rows").filter(F.col("_rows") > HOT_ROWS).select(SLOT))
    cold = slotted.join(hot, SLOT, "left_anti").join(repeated, SLOT, "left_semi")
    spread = F.xxhash64("transaction_id", F.lit("spread"))
    return Candidates(cold, slotted.join(hot, SLOT, "left_semi").withColumn(SLOT, spread), groups)


def store_candidates(df: DataFrame, buckets: int | None = None) -> Candidates:
    """The candidates of `df`, written once, bucketed by where they lie.

    Serves both invoice rules: payments that share the SQL key share this one.
    The table is external, in the scratch folder; `discard` drops its name.
    """
    spark = df.sparkSession
    found = candidates(with_invoice_key(df))
    marked = found.cold.withColumn("_is_hot", F.lit(False))
    if found.hot is not None:
        marked = marked.unionByName(found.hot.withColumn("_is_hot", F.lit(True)))
    payments = found.groups.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    buckets = buckets or max(1, -(-payments // ROWS_PER_BUCKET))
    name = f"candidates_{uuid.uuid4().hex}"
    writer = marked.repartition(buckets, SLOT).write.format("parquet").option("path", scratch_path(spark, "candidates"))
    writer.bucketBy(buckets, SLOT).sortBy(SLOT, "transaction_date").saveAsTable(name)
    table = spark.table(name)
    cold, hot = (table.filter(f"_is_hot = {is_hot}").drop("_is_hot") for is_hot in ("false", "true"))
    return Candidates(cold, None if found.hot is None else hot, table=name)


def _candidates_of(source: DataFrame | Candidates, key: Callable[[DataFrame], DataFrame]) -> Candidates:
    return source.mapped(key) if isinstance(source, Candidates) else candidates(key(source))


def day_profile(keyed: DataFrame) -> DataFrame:
    """Payments per group and date, with their smallest and largest id."""
    ids = [F.min("transaction_id").alias("_low_id"), F.max("transaction_id").alias("_high_id")]
    return keyed.groupBy(*GROUP_DAY).agg(F.count("*").alias("_payments"), *ids)


def _one_each(rows: DataFrame) -> DataFrame:
    """Rows as a profile of one payment each."""
    return rows.withColumns(
        {"_payments": F.lit(1).cast("long"), "_low_id": F.col("transaction_id"), "_high_id": F.col("transaction_id")}
    )


def chain_marks(profile: DataFrame, by: list[str], window_days: int) -> DataFrame:
    """Add the day gap to what comes before and the duplicate verdict.

    Chaining dates whose gaps stay within the window and keeping chains of two
    or more is the same as asking for a neighbour within the window. A NULL date
    sorts last and counts as gap 0, so it joins the chain before it.
    """
    w = Window.partitionBy(*by).orderBy(F.col("transaction_date").asc_nulls_last())
    before, after = F.lag("transaction_date").over(w), F.lead("transaction_date").over(w)
    has_before, has_after = F.lag("_payments").over(w).isNotNull(), F.lead("_payments").over(w).isNotNull()
    gap_before = fn.day_gap(F.col("transaction_date"), before)
    gap_after = fn.day_gap(after, F.col("transaction_date"))
    return profile.withColumns(
        {
            "_gap": gap_before,
            "_is_duplicate": (F.col("_payments") > 1)
            | (has_before & (F.coalesce(gap_before, F.lit(0)) <= window_days))
            | (has_after & (F.coalesce(gap_after, F.lit(0)) <= window_days)),
        }
    )


def cluster_profile(profile: DataFrame, by: list[str], window_days: int) -> DataFrame:
    """Number the chains of each group from 0 and count the payments in each."""
    w = Window.partitionBy(*by).orderBy(F.col("transaction_date").asc_nulls_last())
    new_chain = F.when(F.col("_gap") > window_days, 1).otherwise(0)
    return (
        chain_marks(profile, by, window_days)
        .withColumn("_cluster", F.sum(new_chain).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("_cluster_size", F.sum("_payments").over(Window.partitionBy(*by, "_cluster")))
    )


def partner_marks(profile: DataFrame, by: list[str], window_days: int) -> DataFrame:
    """Add whether two different ids lie within the window (dates are not NULL here).

    A date qualifies when smallest and largest id within +-window differ: then
    each of its rows has a partner with another id. No pairs are formed.
    """
    near = Window.partitionBy(*by).orderBy(F.unix_date("transaction_date")).rangeBetween(-window_days, window_days)
    return profile.withColumn("_has_partner", F.min("_low_id").over(near) != F.max("_high_id").over(near))


def _onto_rows(rows: DataFrame, days: DataFrame, *payload: str) -> DataFrame:
    """`rows` with payload columns of their (group, date) in `days` (stored, with `_payments`), NULL where it is not there."""
    days, hot = (d.select(*GROUP_DAY, *payload) for d in (days, hot_rows(days, "_payments")))
    if not fits_broadcast(days):
        return spread_left_join(rows, days, hot, GROUP_DAY, "transaction_id", null_safe=True)
    side = days.selectExpr(*[f"{c} AS _day_{c}" for c in GROUP_DAY], *payload)
    same = " AND ".join(f"{c} <=> _day_{c}" for c in GROUP_DAY)
    return rows.join(F.broadcast(side), F.expr(same), "left").select(*quoted(rows.columns), *payload)


def _marked(found: Candidates, marks: Marks, *payload: str) -> DataFrame:
    """Candidates that `marks` keeps, with its `payload`: on the rows themselves, on the profile where groups are hot."""
    columns = [c for c in found.cold.columns if c not in (SLOT, "invoice_key")]
    rows = marks(_one_each(found.cold), SLOT_GROUP).select(*quoted(columns), *payload)
    if found.hot is None:
        return rows
    days = stored(marks(day_profile(found.hot), GROUP).withColumn("_kept", F.lit(True)))
    hot = _onto_rows(found.hot, days, *payload, "_kept").filter("_kept")
    return rows.unionAll(hot.select(*quoted(columns), *payload))


def duplicate_rows(payments: DataFrame | Candidates, window_days: int = 7) -> DataFrame:
    """Payments that are duplicates; groups are null-safe."""
    marks = lambda profile, by: chain_marks(profile, by, window_days).filter("_is_duplicate")
    return _marked(_candidates_of(payments, with_invoice_key), marks)


def day_gaps(df: DataFrame) -> DataFrame:
    """Days since the previous payment of the group, in (date, id) order.

    The days that say something (not the only payment of a group) are profiled
    once; all other rows have no gap.
    """
    keyed = with_invoice_key(df)
    rows = candidates(keyed.select(*GROUP_DAY, "transaction_id")).rows
    days = stored(chain_marks(day_profile(rows), GROUP, 0).filter("_payments > 1 OR _gap IS NOT NULL"))
    first_of_day = F.col("transaction_id") == F.col("_low_id")
    same_day = F.col("_low_id").isNotNull() & F.col("transaction_date").isNotNull()
    gap = F.when(first_of_day, F.col("_gap")).when(same_day, 0)
    return _onto_rows(keyed, days, "_gap", "_low_id").withColumn("day_gap", gap).drop("invoice_key", "_gap", "_low_id")


def duplicate_clusters(payments: DataFrame | Candidates, window_days: int = 7, min_size: int = 2) -> DataFrame:
    """Payments in chains of `min_size` (2 at least) or more, with chain number and size."""
    large = F.col("_cluster_size") >= max(2, min_size)
    marks = lambda profile, by: cluster_profile(profile, by, window_days).filter(large)
    found = _marked(_candidates_of(payments, with_invoice_key), marks, "_cluster", "_cluster_size")
    return found.withColumnsRenamed({"_cluster": "cluster", "_cluster_size": "cluster_size"})


def cluster_sizes(df: DataFrame, window_days: int = 7) -> DataFrame:
    """One row per chain: its group, first and last date and size."""
    chains = cluster_profile(day_profile(with_invoice_key(df)), GROUP, window_days)
    return chains.groupBy(*GROUP, F.col("_cluster").alias("cluster")).agg(
        F.min("transaction_date").alias("first_date"),
        F.max("transaction_date").alias("last_date"),
        F.sum("_payments").alias("cluster_size"),
    )


def _sql_keyed(df: DataFrame) -> DataFrame:
    """The SQL rule compares with `=`, so NULL keys, dates and ids never match."""
    return with_sql_invoice_key(df).dropna(
        subset=["transaction_id", "transaction_date", "vendor_id", "amount", "currency"]
    )


def semi_join_duplicates(payments: DataFrame | Candidates, window_days: int = 7) -> DataFrame:
    """Payments with another of the same key within the window (SQL rule)."""
    marks = lambda profile, by: partner_marks(profile, by, window_days).filter("_has_partner")
    return _marked(_candidates_of(payments, _sql_keyed), marks)


def count_semi_join_duplicates(df: DataFrame, window_days: int = 7) -> DataFrame:
    """How many payments the SQL rule flags, summed off rows and profiles: no join back."""
    found = candidates(_sql_keyed(df).select(*GROUP_DAY, "transaction_id"))
    flagged = partner_marks(_one_each(found.cold), SLOT_GROUP, window_days)
    kept = ["_has_partner", "_payments"]
    if found.hot is not None:
        flagged = flagged.select(*kept).unionAll(partner_marks(day_profile(found.hot), GROUP, window_days).select(*kept))
    count = F.coalesce(F.sum("_payments"), F.lit(0).cast("long")).alias("exception_count")
    return flagged.filter("_has_partner").agg(count)

