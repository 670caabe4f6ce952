"""Integrity checks Spark does not enforce, pre-aggregated before any join."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import functions as fn
from ledgerlens.operators.joins import lookup_join
from ledgerlens.operators.summaries import unpivot_row
from ledgerlens.schema import (
    CURRENCY_MISMATCH,
    INVALID_AMOUNT,
    INVALID_DATE,
    MISSING_INVOICE_COUNT,
    ORPHANED_VENDOR,
    require_columns,
)

EARLIEST_DATE = dt.date(2020, 1, 1)


def invalid_amount() -> Column:
    return F.col("amount").isNull() | (F.col("amount") <= 0)


def invalid_date(earliest: dt.date = EARLIEST_DATE) -> Column:
    return F.col("transaction_date").isNull() | (F.col("transaction_date") < F.lit(earliest))


def too_fine(raw_amount: Column) -> Column:
    """Amount text with more decimals than DECIMAL(18,2) keeps."""
    return fn.strip(raw_amount).rlike(r"^[+-]?\d*\.\d{2}\d*[1-9]")


def _report(one_row: DataFrame, *checks: str) -> DataFrame:
    return unpivot_row(one_row, "validation_check", {c: [F.col(c)] for c in checks}, ["failure_count"])


def vendor_profile(tx: DataFrame, *extra) -> DataFrame:
    """Transactions per vendor and currency: all a vendor join needs to see."""
    return tx.groupBy("vendor_id", "currency").agg(F.count("*").alias("rows"), *extra)


def _total(df: DataFrame, check: str) -> DataFrame:
    return df.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias(check))


def _orphans(profile: DataFrame, vendors: DataFrame) -> DataFrame:
    return profile.join(vendors.select("vendor_id"), "vendor_id", "left_anti")


def _mismatches(profile: DataFrame, vendors: DataFrame) -> DataFrame:
    theirs = vendors.select("vendor_id", F.col("currency").alias("vendor_currency"))
    return profile.join(theirs, "vendor_id").filter(F.col("currency") != F.col("vendor_currency"))


def orphaned_vendor(tx: DataFrame, vendors: DataFrame) -> DataFrame:
    return _report(_total(_orphans(vendor_profile(tx), vendors), ORPHANED_VENDOR), ORPHANED_VENDOR)


def currency_mismatch(tx: DataFrame, vendors: DataFrame) -> DataFrame:
    return _report(_total(_mismatches(vendor_profile(tx), vendors), CURRENCY_MISMATCH), CURRENCY_MISMATCH)


def missing_invoice(tx: DataFrame) -> DataFrame:
    found = tx.agg(F.count_if(fn.is_blank(F.col("invoice_number"))).alias(MISSING_INVOICE_COUNT))
    return _report(found, MISSING_INVOICE_COUNT)


def invalid_amounts(tx: DataFrame) -> DataFrame:
    return _report(tx.agg(F.count_if(invalid_amount()).alias(INVALID_AMOUNT)), INVALID_AMOUNT)


def invalid_dates(tx: DataFrame, earliest: dt.date = EARLIEST_DATE) -> DataFrame:
    return _report(tx.agg(F.count_if(invalid_date(earliest)).alias(INVALID_DATE)), INVALID_DATE)


def validation_report(tx: DataFrame, vendors: DataFrame, earliest: dt.date = EARLIEST_DATE) -> DataFrame:
    """The five checks side by side, all off one vendor and currency profile."""
    row_checks = {
        MISSING_INVOICE_COUNT: fn.is_blank(F.col("invoice_number")),
        INVALID_AMOUNT: invalid_amount(),
        INVALID_DATE: invalid_date(earliest),
    }
    profile = vendor_profile(tx, *[F.count_if(test).alias(name) for name, test in row_checks.items()])
    row_totals = profile.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in row_checks])
    return (
        _report(_total(_orphans(profile, vendors), ORPHANED_VENDOR), ORPHANED_VENDOR)
        .unionAll(_report(row_totals, *row_checks))
        .unionAll(_report(_total(_mismatches(profile, vendors), CURRENCY_MISMATCH), CURRENCY_MISMATCH))
    )


def invalid_amount_detail(raw: DataFrame) -> DataFrame:
    """Raw rows whose amount is no number, not positive, or finer than a cent."""
    parsed = fn.parse_money(fn.strip(F.col("amount")))
    issue = (
        F.when(parsed.isNull(), "not a number").when(parsed <= 0, "not positive").when(too_fine(F.col("amount")), "sub-cent")
    )
    return raw.select("transaction_id", "amount", issue.alias("issue")).filter("issue is not null")


def lost_values(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column of `schema`, the values of `df` that do not fit its type: `staging.conform` makes them NULL."""
    require_columns(df, schema.fieldNames())
    unfit = {f.name: F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull() for f in schema.fields}
    one_row = df.agg(*[F.count_if(test).alias(name) for name, test in unfit.items()])
    return unpivot_row(one_row, "field", {name: [F.col(name)] for name in unfit}, ["lost_count"])


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Primary-key violations: key values held by more than one row."""
    return df.groupBy(*key).agg(F.count("*").alias("copies")).filter("copies > 1")


def orphan_rows(tx: DataFrame, vendors: DataFrame) -> DataFrame:
    """Foreign-key violations as rows."""
    known = vendors.select("vendor_id").distinct().withColumn("_known", F.lit(True))
    return lookup_join(tx, known, ["vendor_id"]).filter("_known is null").drop("_known")


def null_counts(df: DataFrame, schema: T.StructType) -> DataFrame:
    """NULLs in every NOT NULL column of `schema`, one pass."""
    columns = [f.name for f in schema.fields if not f.nullable]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return unpivot_row(counts, "column_name", {c: [F.col(c)] for c in columns}, ["null_count"])
