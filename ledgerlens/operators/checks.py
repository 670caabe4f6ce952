"""The four audit checks, as row rules (register form) and as the SQL variants."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import functions as fn
from ledgerlens import schema as texts
from ledgerlens.operators.cleaning import base_view
from ledgerlens.operators.duplicates import duplicate_rows, semi_join_duplicates
from ledgerlens.operators.joins import lookup_join
from ledgerlens.schema import (
    CHECKS,
    DUPLICATE,
    MISSING_INVOICE,
    OUT_OF_HOURS,
    OVER_LIMIT,
    AuditSettings,
    require_columns,
)


@dataclass(frozen=True)
class Rule:
    """One check over a prepared row: when it fires and what it says.

    Duplicates have no row-local test; their rows are found first.
    """

    check: str
    exception_type: str
    fires: Column
    reason: Column


def merge_with_vendor_limits(transactions: DataFrame, limits: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Transactions LEFT JOIN (vendor_id, approval_limit)."""
    return lookup_join(transactions, limits.select("vendor_id", "approval_limit"), ["vendor_id"], max_rows=max_rows)


def duplicate_rule(s: AuditSettings) -> Rule:
    return Rule(CHECKS[0], DUPLICATE, F.lit(True), F.lit(texts.DUPLICATE_REASON.format(days=s.dup_window_days)))


def missing_invoice_rule(s: AuditSettings) -> Rule:
    return Rule(CHECKS[1], MISSING_INVOICE, F.col("is_missing_invoice"), F.lit(texts.MISSING_REASON))


def out_of_hours_rule(s: AuditSettings) -> Rule:
    """A missing hour or day counts as outside; a non-business day names the reason."""
    hour = F.col("hour_of_day")
    outside = hour.isNull() | (hour < s.start_hour) | (hour >= s.end_hour)
    off_day = ~F.coalesce(F.col("day_of_week").isin(*s.business_days), F.lit(False))
    hours = texts.HOURS_REASON.format(start=s.start_hour, end=s.end_hour)
    reason = F.when(off_day, F.lit(texts.OFF_DAY_REASON)).otherwise(F.lit(hours))
    return Rule(CHECKS[2], OUT_OF_HOURS, outside | off_day, reason)


def over_limit_rule(s: AuditSettings) -> Rule:
    """Compares in whatever currency; the validation suite reports mismatches."""
    amount, limit = F.col("amount"), F.col("approval_limit")
    paid, exceeds = texts.LIMIT_REASON
    reason = F.concat(F.lit(paid), fn.money_text(amount), F.lit(exceeds), fn.money_text(limit))
    return Rule(CHECKS[3], OVER_LIMIT, limit.isNotNull() & (amount > limit), reason)


def audit_rules(settings: AuditSettings = AuditSettings()) -> list[Rule]:
    """The four rules in register order."""
    return [
        duplicate_rule(settings),
        missing_invoice_rule(settings),
        out_of_hours_rule(settings),
        over_limit_rule(settings),
    ]


def _flag(df: DataFrame, rule: Rule) -> DataFrame:
    return df.filter(rule.fires).transform(
        base_view, F.lit(rule.exception_type).alias("exception_type"), rule.reason.alias("reason")
    )


def check_duplicate_payments(df: DataFrame, dup_window_days: int = 7) -> DataFrame:
    rule = duplicate_rule(AuditSettings(dup_window_days=dup_window_days))
    return _flag(duplicate_rows(df, dup_window_days), rule)


def check_missing_invoice_numbers(df: DataFrame) -> DataFrame:
    return _flag(df, missing_invoice_rule(AuditSettings()))


def check_out_of_hours_transactions(
    df: DataFrame, start_hour: int = 9, end_hour: int = 18, business_days: tuple[int, ...] | None = None
) -> DataFrame:
    days = AuditSettings.business_days if business_days is None else tuple(business_days)
    return _flag(df, out_of_hours_rule(AuditSettings(start_hour=start_hour, end_hour=end_hour, business_days=days)))


def check_exceeding_approval_limits(df: DataFrame) -> DataFrame:
    require_columns(df, ["approval_limit"])
    return _flag(df, over_limit_rule(AuditSettings()))


def run_all_checks(df: DataFrame, settings: AuditSettings = AuditSettings()) -> dict[str, DataFrame]:
    """One lazy frame per check over prepared, limit-merged transactions."""
    require_columns(df, ["approval_limit"])
    dup, missing, hours, limit = audit_rules(settings)
    return {
        dup.check: check_duplicate_payments(df, settings.dup_window_days),
        missing.check: _flag(df, missing),
        hours.check: _flag(df, hours),
        limit.check: _flag(df, limit),
    }


# The SQL variants: NULLs never match, blank means spaces only.

SQL_COLUMNS = [
    "transaction_id", "transaction_date", "vendor_id", "vendor_name", "amount", "currency", "invoice_number",
]


def sql_duplicate_payments(tx: DataFrame, window_days: int = 7) -> DataFrame:
    return semi_join_duplicates(tx, window_days).select(*SQL_COLUMNS, F.lit(DUPLICATE).alias("exception_type"))


def sql_missing_invoices(tx: DataFrame) -> DataFrame:
    return tx.filter(fn.is_blank(F.col("invoice_number"))).select(
        *SQL_COLUMNS, F.lit(MISSING_INVOICE).alias("exception_type")
    )


def sql_out_of_hours_test(opens: str = "09:00:00", closes: str = "18:00:00") -> Column:
    """Clock texts are zero-padded, so they compare as text and push to the scan."""
    clock = F.col("transaction_time")
    return fn.is_weekend(F.col("transaction_date")) | (clock < opens) | (clock >= closes)


def sql_out_of_hours(tx: DataFrame) -> DataFrame:
    weekend = fn.is_weekend(F.col("transaction_date"))
    reason = F.when(weekend, texts.SQL_WEEKEND_REASON).otherwise(texts.SQL_HOURS_REASON)
    return tx.filter(sql_out_of_hours_test()).select(
        *SQL_COLUMNS, "transaction_time", F.lit(OUT_OF_HOURS).alias("exception_type"), reason.alias("reason")
    )


def sql_over_limit(tx: DataFrame, limits: DataFrame) -> DataFrame:
    """Inner join: a row without a limit has NULL there and fails the comparison."""
    excess = (F.col("amount") - F.col("approval_limit")).cast("decimal(19,2)")
    return (
        merge_with_vendor_limits(tx, limits)
        .filter(F.col("amount") > F.col("approval_limit"))
        .select(*SQL_COLUMNS, F.lit(OVER_LIMIT).alias("exception_type"), "approval_limit", excess.alias("excess_amount"))
    )


def report_order(exception_type: str) -> list:
    """How the report of one SQL list sorts it; ids break ties."""
    order = {
        DUPLICATE: ["vendor_id", "transaction_date"],
        MISSING_INVOICE: ["transaction_date"],
        OUT_OF_HOURS: ["transaction_date"],
        OVER_LIMIT: [F.desc("excess_amount")],
    }[exception_type]
    return [*order, "transaction_id"]


def in_report_order(flagged: DataFrame, exception_type: str) -> DataFrame:
    """Sort one SQL list the way its report shows it."""
    return flagged.orderBy(*report_order(exception_type))
