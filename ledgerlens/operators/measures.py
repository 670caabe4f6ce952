"""Dimensions and measures of the reporting model over the register."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import functions as fn
from ledgerlens.operators.joins import lookup_join
from ledgerlens.schema import DUPLICATE, MISSING_INVOICE, OUT_OF_HOURS, OVER_LIMIT, SEVERITY_RANK


def calendar_bounds(register: DataFrame) -> DataFrame:
    return register.agg(F.min("transaction_date").alias("first_date"), F.max("transaction_date").alias("last_date"))


def calendar(register: DataFrame) -> DataFrame:
    """Every day between the register's first and last date."""
    day = F.col("date")
    return calendar_bounds(register).select(F.explode(F.sequence("first_date", "last_date")).alias("date")).select(
        "date",
        F.year(day).alias("year"),
        F.date_format(day, "yyyy-MM").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.concat(F.lit("Q"), F.quarter(day)).alias("quarter"),
        F.date_format(day, "EEEE").alias("weekday"),
    )


def vendor_dimension(register: DataFrame) -> DataFrame:
    return register.select("vendor_id", "vendor_name").distinct()


def severity_rank(severity: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for pair in SEVERITY_RANK.items() for x in pair])
    return ranks[severity]


def severity_dimension(register: DataFrame) -> DataFrame:
    return register.select("severity").distinct().withColumn("severity_rank", severity_rank(F.col("severity")))


def star_join(register: DataFrame, dates: DataFrame, vendors: DataFrame, severities: DataFrame) -> DataFrame:
    """Fact rows with the attributes of their dimensions.

    Dates and severities are small by nature (a row per calendar day, three
    severities) and are broadcast. Vendors are counted: few are broadcast, and of
    many the hot ones are split off the shuffle join.
    """
    named = vendors.groupBy("vendor_id").agg(F.min("vendor_name").alias("dim_vendor_name"))
    days = dates.withColumnRenamed("date", "transaction_date")
    return (
        lookup_join(register, named, ["vendor_id"])
        .join(F.broadcast(days), "transaction_date", "left")
        .join(F.broadcast(severities), "severity", "left")
    )


def _kpis() -> list[Column]:
    of_type = lambda t: F.count_if(F.col("exception_type") == t)
    high = F.count_if(F.col("severity") == "High")
    return [
        F.count("*").alias("total_exceptions"),
        high.alias("high_severity_exceptions"),
        F.sum("amount").cast("decimal(28,2)").alias("exception_amount"),
        fn.ratio_or_zero(high, F.count("*")).alias("pct_high_severity"),
        of_type(DUPLICATE).alias("duplicate_payments"),
        of_type(MISSING_INVOICE).alias("missing_invoices"),
        of_type(OUT_OF_HOURS).alias("out_of_hours"),
        of_type(OVER_LIMIT).alias("over_limit"),
    ]


def _listed(wanted) -> list:
    return list(wanted) if isinstance(wanted, (list, tuple, set)) else [wanted]


def in_context(
    register: DataFrame,
    severity: str | list[str] | None = None,
    exception_type: str | list[str] | None = None,
    month: str | list[str] | None = None,
    vendor_id=None,
) -> DataFrame:
    """Apply the report's slicers, each a value or a list of them; a slicer left out does not filter."""
    tests = {
        "severity": severity,
        "exception_type": exception_type,
        "vendor_id": vendor_id,
    }
    for column, wanted in tests.items():
        if wanted is not None:
            register = register.filter(F.col(column).isin(_listed(wanted)))
    if month is not None:
        firsts = [F.to_date(F.lit(f"{m}-01")) for m in _listed(month)]
        inside = [(F.col("transaction_date") >= d) & (F.col("transaction_date") < F.add_months(d, 1)) for d in firsts]
        register = register.filter(reduce(or_, inside, F.lit(False)))
    return register


def kpi(register: DataFrame, **context) -> DataFrame:
    """All card measures in one aggregate, under an optional slicer context."""
    return in_context(register, **context).agg(*_kpis())


def by_severity(register: DataFrame) -> DataFrame:
    return register.groupBy("severity").agg(F.count("*").alias("total_exceptions"))


def by_type(register: DataFrame) -> DataFrame:
    return register.groupBy("exception_type").agg(F.count("*").alias("total_exceptions"))


def by_month(register: DataFrame) -> DataFrame:
    """Exceptions per calendar month, counted per day before the calendar join.

    Undated exceptions have a NULL month, so the months add up to the total.
    """
    daily = register.groupBy("transaction_date").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
    days = calendar(daily).select("date", "month")
    return (
        daily.join(days, F.col("transaction_date") == F.col("date"), "left")
        .groupBy("month")
        .agg(F.sum("n").alias("total_exceptions"), F.sum("amount").cast("decimal(28,2)").alias("exception_amount"))
    )


def vendor_risk(register: DataFrame) -> DataFrame:
    return register.groupBy("vendor_name").agg(
        F.sum("amount").cast("decimal(28,2)").alias("exception_amount"), F.count("*").alias("total_exceptions")
    )


def top_risky_vendors(register: DataFrame, n: int = 10) -> DataFrame:
    """The n vendors with the largest exception amount: a top-k, no full sort."""
    order = [F.desc_nulls_last("exception_amount"), F.desc("total_exceptions"), F.asc_nulls_last("vendor_name")]
    return vendor_risk(register).orderBy(*order).limit(n)


def high_severity_first(register: DataFrame) -> DataFrame:
    """Register in risk tiers, High first."""
    return register.orderBy(severity_rank(F.col("severity")).asc_nulls_last(), "exception_id")


def drill_through(register: DataFrame, transactions: DataFrame, **context) -> DataFrame:
    """From a cell of a report to its exceptions and their transactions."""
    detail = in_context(register, **context).select("transaction_id", "exception_type", "severity", "reason")
    return detail.join(transactions, "transaction_id")
