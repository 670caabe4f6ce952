"""Raw text columns to typed, flagged transactions. Every step is row-local."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import functions as fn
from ledgerlens.schema import BASE_COLUMNS, quoted


def normalise_strings(df: DataFrame) -> DataFrame:
    """Strip every text column; NULL stays NULL."""
    columns = zip(quoted(df.columns), df.schema.fields)
    return df.select(
        *[fn.strip(F.col(c)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(c) for c, f in columns]
    )


def parse_dates_times(df: DataFrame, dates_with_time: bool = False) -> DataFrame:
    return df.withColumns(
        {
            "transaction_date": fn.parse_day(F.col("transaction_date"), dates_with_time),
            "transaction_time": fn.parse_clock(F.col("transaction_time")),
        }
    )


def parse_numeric(df: DataFrame) -> DataFrame:
    return df.withColumns({"amount": fn.parse_money(F.col("amount")), "currency": F.upper("currency")})


def flag_missing_values(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_missing_invoice": fn.is_missing_text(F.col("invoice_number")),
            "is_missing_amount": F.col("amount").isNull(),
            "is_missing_date": F.col("transaction_date").isNull(),
        }
    )


def derive_features(df: DataFrame) -> DataFrame:
    """Hour (0-23), weekday (0 = Monday) and the combined timestamp."""
    return df.withColumns(
        {
            "hour_of_day": fn.hour_of_clock(F.col("transaction_time")),
            "day_of_week": F.weekday("transaction_date"),
            "combined_datetime": fn.combine_date_time(F.col("transaction_date"), F.col("transaction_time")),
        }
    )


def prepare(typed: DataFrame) -> DataFrame:
    """Flags and features for transactions that already carry staging types."""
    return typed.transform(flag_missing_values).transform(derive_features)


def clean_transactions(raw: DataFrame, dates_with_time: bool = False) -> DataFrame:
    """The whole cleaning of a raw text table: one projection over the scan."""
    parsed = raw.transform(normalise_strings).transform(parse_dates_times, dates_with_time)
    return parsed.transform(parse_numeric).transform(prepare)


def clean_vendor_limits(raw: DataFrame) -> DataFrame:
    return raw.transform(normalise_strings).withColumns(
        {"currency": F.upper("currency"), "approval_limit": F.col("approval_limit").try_cast("decimal(18,2)")}
    )


def base_view(df: DataFrame, *extra) -> DataFrame:
    return df.select(*BASE_COLUMNS, *extra)
