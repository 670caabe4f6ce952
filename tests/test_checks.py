"""Edge rows of the row-local checks and of the register."""

import datetime as dt
from decimal import Decimal

import helpers as h
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import checks, measures, register, summaries
from ledgerlens.schema import AuditSettings

SATURDAY = dt.date(2024, 1, 6)
HOURS = "Transaction outside business hours (09:00-18:00)"
OFF_DAY = "Transaction on a non-business day"


def reasons(flagged):
    return {r.transaction_id: r.reason for r in flagged.select("transaction_id", "reason").collect()}


def test_business_hours_edges(spark):
    clocks = ["08:59:59", "09:00:00", "17:59:59", "18:00:00", None]
    df = h.prepared(spark, [h.payment(n, transaction_time=c) for n, c in enumerate(clocks)])
    assert reasons(checks.check_out_of_hours_transactions(df)) == {"T00000": HOURS, "T00003": HOURS, "T00004": HOURS}
    assert h.ids(checks.sql_out_of_hours(df)) == ["T00000", "T00003"]


def test_business_day_edges(spark):
    rows = [
        h.payment(0, transaction_date=SATURDAY, transaction_time="22:00:00"),
        h.payment(1, transaction_date=None),
        h.payment(2, transaction_date=None, transaction_time="07:00:00"),
        h.payment(3),
    ]
    df = h.prepared(spark, rows)
    assert reasons(checks.check_out_of_hours_transactions(df)) == dict.fromkeys(["T00000", "T00001", "T00002"], OFF_DAY)
    sql = reasons(checks.sql_out_of_hours(df))
    assert sql == {"T00000": "Weekend", "T00002": "Outside business hours"}


def test_business_hours_are_parameters(spark):
    rows = [h.payment(0, transaction_time="07:30:00"), h.payment(1, transaction_date=SATURDAY)]
    df = h.prepared(spark, rows)
    flagged = checks.check_out_of_hours_transactions(df, 8, 17, (0, 1, 2, 3, 4, 5))
    assert reasons(flagged) == {"T00000": "Transaction outside business hours (08:00-17:00)"}
    assert checks.check_out_of_hours_transactions(df, 7, 20, (0, 1, 2, 3, 4, 5)).count() == 0


def test_missing_invoice_edges(spark):
    invoices = ["nan", "None", "   ", "\t", " ", "", None, "NaN", "INV"]
    df = h.prepared(spark, [h.payment(n, invoice_number=i) for n, i in enumerate(invoices)])
    assert h.ids(checks.check_missing_invoice_numbers(df)) == [f"T0000{n}" for n in range(7)]
    assert h.ids(checks.sql_missing_invoices(df)) == ["T00002", "T00005", "T00006"]


def with_limit(df, limit):
    return df.withColumn("approval_limit", F.lit(limit).cast("decimal(18,2)"))


def test_limit_edges(spark):
    amounts = ["100.00", "100.01", None]
    df = h.prepared(spark, [h.payment(n, amount=a and Decimal(a)) for n, a in enumerate(amounts)])
    flagged = checks.check_exceeding_approval_limits(with_limit(df, 100))
    assert reasons(flagged) == {"T00001": "Payment amount 100.01 exceeds approval limit 100.00"}
    assert checks.check_exceeding_approval_limits(with_limit(df, None)).count() == 0


def test_limit_check_needs_limits(spark):
    df = h.prepared(spark, [h.payment(0)])
    for run in (checks.check_exceeding_approval_limits, checks.run_all_checks):
        with pytest.raises(ValueError, match="approval_limit"):
            run(df)


def test_limit_compares_across_currencies(spark):
    df = with_limit(h.prepared(spark, [h.payment(0, currency="USD", amount=Decimal(500))]), 100)
    assert checks.check_exceeding_approval_limits(df).count() == 1


def test_report_orders(spark):
    rows = [
        h.payment(0, amount=Decimal(150), transaction_date=SATURDAY),
        h.payment(1, amount=Decimal(900), transaction_date=SATURDAY - dt.timedelta(days=6)),
    ]
    tx, limits = h.prepared(spark, rows), h.vendors(spark, [("V1", "Vendor 1", "GBP", Decimal(100))])
    over = checks.in_report_order(checks.sql_over_limit(tx, limits), "Exceeds Approval Limit")
    assert [r.excess_amount for r in over.collect()] == [Decimal(800), Decimal(50)]
    late = checks.in_report_order(checks.sql_out_of_hours(tx), "Out-of-Hours Transaction")
    assert [r.transaction_id for r in late.collect()] == ["T00001", "T00000"]


def test_unknown_type_gets_the_default_severity(spark):
    df = spark.createDataFrame([("Other",), ("Duplicate Payment",), (None,)], "exception_type string")
    assert [r.severity for r in register.assign_severity(df).collect()] == ["Medium", "High", "Medium"]


def test_random_register(spark):
    payments = h.random_payments(21, 500, with_nulls=True)
    df = with_limit(h.prepared(spark, payments), 15)
    one, other = register.exception_register(df), register.build_register(checks.run_all_checks(df))
    key = lambda r: r.exception_id
    rows = sorted(one.collect(), key=key)
    assert rows == sorted(other.collect(), key=key)
    assert [r.exception_id for r in rows] == list(range(1, len(rows) + 1))
    order = {"duplicate_payments": 0, "missing_invoice_numbers": 1, "out_of_hours": 2, "exceeds_approval_limit": 3}
    ranks = [order[r.detected_by] for r in rows]
    assert ranks == sorted(ranks)
    dates = [r.transaction_date or dt.date.max for r in rows if r.detected_by == "duplicate_payments"]
    assert dates == sorted(dates)


def test_empty_input(spark):
    df = with_limit(h.prepared(spark, []), 15)
    found = register.exception_register(df)
    assert found.count() == 0 and found.columns[0] == "exception_id"
    assert register.build_register(checks.run_all_checks(df)).count() == 0
    assert summaries.summarise_by_type(found).count() == 0
    assert summaries.summarise_by_vendor(found).count() == 0
    assert [r.missing_pct for r in summaries.data_quality(df).collect()] == [0.0] * 4
    assert measures.calendar(found).count() == 0
    assert measures.kpi(found).first().pct_high_severity == 0.0


def test_register_of_one_check(spark):
    """A check without hits adds nothing; the others keep their names."""
    df = with_limit(h.prepared(spark, [h.payment(0, invoice_number=None)]), 1000)
    assert [r.detected_by for r in register.exception_register(df).collect()] == ["missing_invoice_numbers"]


def test_settings_reach_the_register(spark):
    rows = [h.payment(n, invoice_number="A", transaction_date=h.MONDAY + dt.timedelta(days=10 * n)) for n in range(2)]
    df = with_limit(h.prepared(spark, rows), 1000)
    wide = AuditSettings(dup_window_days=10, start_hour=11, end_hour=12, business_days=(0, 3))
    found = {(r.transaction_id, r.detected_by) for r in register.exception_register(df, wide).collect()}
    assert found == {(t, c) for t in ("T00000", "T00001") for c in ("duplicate_payments", "out_of_hours")}


def test_slicers_and_drill_through(spark):
    rows = [
        h.payment(0, transaction_date=SATURDAY, invoice_number=None),
        h.payment(1, transaction_date=dt.date(2024, 2, 3), vendor_id="V2"),
    ]
    df = with_limit(h.prepared(spark, rows), 1000)
    found = register.exception_register(df)
    total = lambda **context: measures.kpi(found, **context).first().total_exceptions
    assert total() == 3
    assert total(severity="Low") == 2
    assert total(month="2024-01") == 2
    assert total(month="2024-02", vendor_id="V2") == 1
    assert total(exception_type="Missing Invoice Number", month="2024-02") == 0
    detail = measures.drill_through(found, df.select("transaction_id", "status"), severity="Medium").collect()
    assert [(r.transaction_id, r.status) for r in detail] == [("T00000", "posted")]
    tiers = [r.severity for r in measures.high_severity_first(found).collect()]
    assert tiers == ["Medium", "Low", "Low"]


def test_calendar(spark):
    dates = spark.createDataFrame([(dt.date(2024, 2, 28),), (dt.date(2024, 3, 1),)], "transaction_date date")
    rows = [tuple(r) for r in measures.calendar(dates).orderBy("date").collect()]
    assert [r[0].isoformat() for r in rows] == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert rows[1][1:] == (2024, "2024-02", "February", "Q1", "Thursday")


def test_a_vendor_with_two_limits(spark):
    """The merge repeats its payments, in the register and its duplicates too; the SQL counts repeat them for the limit alone."""
    limits = h.vendors(spark, [("V1", "Vendor 1", "GBP", Decimal(10)), ("V1", "Vendor 1", "GBP", Decimal(20)), (None, "x", "GBP", Decimal(1))])
    rows = [h.payment(1, amount=Decimal("15.00"), invoice_number=None), h.payment(2, amount=Decimal("25.00"), invoice_number="A")]
    tx = h.prepared(spark, rows)
    entries = register.audited_entries(tx, limits)
    merged = register.exception_entries(checks.merge_with_vendor_limits(tx, limits))
    count = lambda df: sorted(map(str, df.select("transaction_id", "detected_by").collect()))
    assert count(entries) == count(merged) and entries.filter("detected_by = 'duplicate_payments'").count() == 4
    counts = {r.exception_type: r.exception_count for r in summaries.sql_exception_counts(tx, limits).collect()}
    assert counts["Missing Invoice Number"] == 1 and counts["Exceeds Approval Limit"] == 3 and counts["Duplicate Payment"] == 0
    once = limits.limit(1)
    assert register.audited_entries(tx, once).filter("detected_by = 'duplicate_payments'").count() == 0
