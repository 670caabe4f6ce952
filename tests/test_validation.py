"""Integrity checks on rows that break them."""

import datetime as dt
from decimal import Decimal

import helpers as h

from ledgerlens.operators import joins, validation
from ledgerlens.schema import TRANSACTION_SCHEMA

VENDORS = [("V1", "Vendor 1", "GBP", Decimal(100)), ("V2", "Vendor 2", "EUR", Decimal(100))]
ROWS = [
    h.payment(0),
    h.payment(1, vendor_id="V9"),
    h.payment(2, vendor_id=None, currency=None),
    h.payment(3, vendor_id="V2"),
    h.payment(4, amount=None, invoice_number=None),
    h.payment(5, amount=Decimal(0), invoice_number="  "),
    h.payment(6, amount=Decimal(-5), transaction_date=dt.date(2019, 12, 31)),
    h.payment(7, transaction_date=None, transaction_time=None),
    h.payment(8, transaction_date=dt.date(2020, 1, 1), currency=None),
]


def report(df):
    return {r[0]: r[1] for r in df.collect()}


EXPECTED = {
    "Orphaned_Vendor": 2, "Missing_Invoice": 2, "Invalid_Amount": 3, "Invalid_Date": 2, "Currency_Mismatch": 1,
}


def test_report_and_single_checks(spark):
    tx, vendors = h.typed(spark, ROWS), h.vendors(spark, VENDORS)
    assert report(validation.validation_report(tx, vendors)) == EXPECTED
    single = [
        validation.orphaned_vendor(tx, vendors),
        validation.missing_invoice(tx),
        validation.invalid_amounts(tx),
        validation.invalid_dates(tx),
        validation.currency_mismatch(tx, vendors),
    ]
    assert {k: v for df in single for k, v in report(df).items()} == EXPECTED


def test_date_threshold_is_a_parameter(spark):
    tx = h.typed(spark, ROWS)
    assert report(validation.invalid_dates(tx, dt.date(2020, 1, 2))) == {"Invalid_Date": 3}


def test_repeated_vendors_multiply_only_what_a_join_multiplies(spark):
    twice = h.vendors(spark, VENDORS + [("V2", "Vendor 2", "USD", Decimal(1))])
    found = report(validation.validation_report(h.typed(spark, ROWS), twice))
    assert found == {**EXPECTED, "Currency_Mismatch": 2}


def test_empty_tables(spark):
    found = report(validation.validation_report(h.typed(spark, []), h.vendors(spark, [])))
    assert found == dict.fromkeys(EXPECTED, 0)


def test_keys(spark):
    tx = h.typed(spark, [*ROWS, h.payment(3), h.payment(3)])
    assert [tuple(r) for r in validation.repeated_keys(tx, ["transaction_id"]).collect()] == [("T00003", 3)]
    orphans = validation.orphan_rows(tx, h.vendors(spark, VENDORS))
    assert h.ids(orphans) == ["T00001", "T00002"] and orphans.columns == tx.columns


def test_orphans_of_a_large_vendor_table(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins, "HOT_SHARE", 3)
    payments = h.random_payments(3, 300, with_nulls=True)
    expected = sorted(p["transaction_id"] for p in payments if p["vendor_id"] not in ("V1", "V2"))
    assert h.ids(validation.orphan_rows(h.typed(spark, payments), h.vendors(spark, VENDORS))) == expected


def test_not_null_columns(spark):
    found = report(validation.null_counts(h.typed(spark, ROWS), TRANSACTION_SCHEMA))
    assert found == {
        "transaction_id": 0, "transaction_date": 1, "transaction_time": 1, "vendor_id": 1, "amount": 1, "currency": 2,
    }


def test_amount_detail(spark):
    texts = ["10.00", " 10.5", "10.001", "10.100", "10.1001", "x", None, "0", "-3.00"]
    raw = spark.createDataFrame([(str(n), t) for n, t in enumerate(texts)], "transaction_id string, amount string")
    found = {int(r.transaction_id): r.issue for r in validation.invalid_amount_detail(raw).collect()}
    assert found == {
        2: "sub-cent", 4: "sub-cent", 5: "not a number", 6: "not a number", 7: "not positive", 8: "not positive",
    }
