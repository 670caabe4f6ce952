"""Grouped counts over the register and data quality of the transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens import functions as fn
from ledgerlens.operators.checks import sql_out_of_hours_test
from ledgerlens.operators.duplicates import count_semi_join_duplicates
from ledgerlens.operators.joins import lookup_join
from ledgerlens.schema import DUPLICATE, MISSING_INVOICE, OUT_OF_HOURS, OVER_LIMIT


def unpivot_row(one_row: DataFrame, key: str, entries: dict[str, list[Column]], names: list[str]) -> DataFrame:
    """Turn one aggregate row into one row per entry of `entries`."""
    structs = [
        F.struct(F.lit(label).alias(key), *[c.alias(n) for c, n in zip(cols, names)]) for label, cols in entries.items()
    ]
    return one_row.select(F.inline(F.array(*structs)))


def summarise_by_type(register: DataFrame) -> DataFrame:
    return (
        register.groupBy("exception_type", "severity")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "exception_type")
    )


def vendor_order() -> list[Column]:
    """Order of the summary by vendor."""
    return [F.desc("count"), F.asc_nulls_last("vendor_id"), F.asc_nulls_last("vendor_name")]


def summarise_by_vendor(register: DataFrame) -> DataFrame:
    return register.groupBy("vendor_id", "vendor_name").agg(F.count("*").alias("count")).orderBy(*vendor_order())


def data_quality(cleaned: DataFrame) -> DataFrame:
    """Missing values per field in one aggregate; blank invoices count as missing."""
    missing = {
        "invoice_number": F.col("is_missing_invoice"),
        "amount": F.col("is_missing_amount"),
        "transaction_date": F.col("is_missing_date"),
        "transaction_time": F.col("transaction_time").isNull(),
    }
    counts = cleaned.agg(
        F.count("*").alias("total"), *[F.count_if(test).alias(f"n_{field}") for field, test in missing.items()]
    )
    total = F.col("total")
    return unpivot_row(
        counts,
        "field",
        {f: [total, F.col(f"n_{f}"), fn.percent(F.col(f"n_{f}"), total)] for f in missing},
        ["total_records", "missing_count", "missing_pct"],
    )


def sql_exception_counts(tx: DataFrame, limits: DataFrame) -> DataFrame:
    """Flagged rows of each SQL check: (exception_type, exception_count).

    The row-local tests and the limit test share one aggregate. A vendor with several limits
    repeats its payments there; the row-local tests count the first repeat only.
    """
    nth = Window.partitionBy("vendor_id").orderBy("approval_limit")
    known = limits.filter("vendor_id IS NOT NULL").select("vendor_id", "approval_limit", F.row_number().over(nth).alias("_nth"))
    once = F.coalesce(F.col("_nth"), F.lit(1)) == 1
    counts = lookup_join(tx, known, ["vendor_id"]).agg(
        F.count_if(once & fn.is_blank(F.col("invoice_number"))).alias("missing"),
        F.count_if(once & sql_out_of_hours_test()).alias("hours"),
        F.count_if(F.col("amount") > F.col("approval_limit")).alias("over"),
    )
    rows = {MISSING_INVOICE: [F.col("missing")], OUT_OF_HOURS: [F.col("hours")], OVER_LIMIT: [F.col("over")]}
    duplicates = count_semi_join_duplicates(tx).select(F.lit(DUPLICATE).alias("exception_type"), "exception_count")
    return duplicates.unionAll(unpivot_row(counts, "exception_type", rows, ["exception_count"]))


def observed_row_counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Row counts that were taken while the tables were written: (name, row_count)."""
    return spark.createDataFrame(list(counts.items()), "name string, row_count long")


def row_counts(transactions: DataFrame, limits: DataFrame, register: DataFrame, checks) -> DataFrame:
    """Rows of both inputs and of every check, checks without a hit included."""
    found = register.agg(*[F.count_if(F.col("detected_by") == c).alias(c) for c in checks])
    per_check = unpivot_row(found, "name", {c: [F.col(c)] for c in checks}, ["row_count"])
    sized = lambda df, name: df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("name"), "row_count")
    return sized(transactions, "transactions").unionAll(sized(limits, "vendors")).unionAll(per_check)
