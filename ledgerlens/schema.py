"""Column sets, staging types and the fixed values of the four audit checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# Staging tables. Spark keeps nullability as metadata only; NOT NULL columns,
# primary keys and the vendor foreign key are checked by operators.validation.
TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("transaction_date", T.DateType(), False),
        T.StructField("transaction_time", T.StringType(), False),
        T.StructField("vendor_id", T.StringType(), False),
        T.StructField("vendor_name", T.StringType(), True),
        T.StructField("amount", MONEY, False),
        T.StructField("currency", T.StringType(), False),
        T.StructField("invoice_number", T.StringType(), True),
        T.StructField("payment_method", T.StringType(), True),
        T.StructField("status", T.StringType(), True),
    ]
)

VENDOR_SCHEMA = T.StructType(
    [
        T.StructField("vendor_id", T.StringType(), False),
        T.StructField("vendor_name", T.StringType(), False),
        T.StructField("currency", T.StringType(), False),
        T.StructField("approval_limit", MONEY, False),
    ]
)

BASE_COLUMNS = TRANSACTION_SCHEMA.fieldNames()
VENDOR_COLUMNS = VENDOR_SCHEMA.fieldNames()
SEVERITY_RANK = {"High": 1, "Medium": 2, "Low": 3}
REGISTER_COLUMNS = ["exception_id", *BASE_COLUMNS, "exception_type", "reason", "severity", "detected_by"]

# Exception types, severities and check names of the register.
DUPLICATE = "Duplicate Payment"
MISSING_INVOICE = "Missing Invoice Number"
OUT_OF_HOURS = "Out-of-Hours Transaction"
OVER_LIMIT = "Exceeds Approval Limit"
CHECKS = ("duplicate_payments", "missing_invoice_numbers", "out_of_hours", "exceeds_approval_limit")
SEVERITY = {DUPLICATE: "High", MISSING_INVOICE: "Medium", OVER_LIMIT: "High", OUT_OF_HOURS: "Low"}
DEFAULT_SEVERITY = "Medium"

# Reason texts of the register and of the SQL list.
DUPLICATE_REASON = "Multiple payments with identical vendor, amount, currency and invoice within {days} days"
MISSING_REASON = "Invoice number is missing or blank"
OFF_DAY_REASON = "Transaction on a non-business day"
HOURS_REASON = "Transaction outside business hours ({start:02d}:00-{end:02d}:00)"
LIMIT_REASON = ("Payment amount ", " exceeds approval limit ")
SQL_WEEKEND_REASON = "Weekend"
SQL_HOURS_REASON = "Outside business hours"

# Names of the validation checks.
ORPHANED_VENDOR = "Orphaned_Vendor"
MISSING_INVOICE_COUNT = "Missing_Invoice"
INVALID_AMOUNT = "Invalid_Amount"
INVALID_DATE = "Invalid_Date"
CURRENCY_MISMATCH = "Currency_Mismatch"


@dataclass(frozen=True)
class AuditSettings:
    """What a user may tune; the defaults are the published rules."""

    dup_window_days: int = 7
    start_hour: int = 9
    end_hour: int = 18
    business_days: tuple[int, ...] = (0, 1, 2, 3, 4)  # 0 = Monday


def quoted(columns) -> list[str]:
    """Column names safe to select by, whatever characters a file header holds."""
    return ["`" + c.replace("`", "``") + "`" for c in columns]


def require_columns(df, columns) -> None:
    """Raise ValueError naming every column of `columns` that `df` lacks."""
    present = set(df.columns)
    if absent := [c for c in columns if c not in present]:
        raise ValueError("Missing required columns: " + ", ".join(absent))
