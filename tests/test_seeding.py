"""Seeded anomalies: exact numbers, and every one is found again."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import checks, cleaning, seeding
from ledgerlens.schema import BASE_COLUMNS

import helpers as h

ROWS = 20_000
RATE = 0.03


@pytest.fixture(scope="module")
def clean_table(spark):
    """Business-hour payments below every limit, each with its own invoice."""
    return spark.range(ROWS).selectExpr(
        "concat('T', lpad(id, 6, '0')) AS transaction_id",
        "date_add(date'2024-01-01', cast(id % 52 AS int) * 7 + cast(id % 5 AS int)) AS transaction_date",
        "'11:30:00' AS transaction_time",
        "concat('V', id % 10) AS vendor_id",
        "concat('Vendor ', id % 10) AS vendor_name",
        "cast(10 + id % 50 AS decimal(18,2)) AS amount",
        "'GBP' AS currency",
        "concat('INV-', id) AS invoice_number",
        "'BACS' AS payment_method",
        "'posted' AS status",
    )


@pytest.fixture(scope="module")
def limits(spark):
    return h.vendors(spark, [(f"V{n}", f"Vendor {n}", "GBP", Decimal(1000 + n)) for n in range(9)])


def changed(before, after):
    return after.select(*BASE_COLUMNS).exceptAll(before.select(*BASE_COLUMNS))


def test_wanted_rows():
    assert [seeding.wanted_rows(100_000, 0.03, k) for k in ("duplicates", "out_of_hours")] == [750, 750]
    assert seeding.wanted_rows(10, 0.03, "duplicates") == 0


def test_cut_off_is_exact(spark, clean_table, monkeypatch):
    hashes = sorted(r[0] for r in clean_table.select(seeding.seed_hash("s")).collect())
    for wanted in (1, 2, 150, ROWS - 1, ROWS):
        assert seeding.cut_off(clean_table, "s", wanted) == hashes[wanted - 1]
    monkeypatch.setattr(seeding, "LAST_LEVEL_ROWS", 0)
    monkeypatch.setattr(seeding, "PREFIX_STEP", 1)
    assert seeding.cut_off(clean_table, "s", 777) == hashes[776]
    assert seeding.cut_off(clean_table, "s", 0) < hashes[0]
    assert seeding.cut_off(clean_table, "s", ROWS + 1) > hashes[-1]


def test_duplicates(spark, clean_table):
    seeded = seeding.seed_duplicates(clean_table, F.concat(F.lit("D"), "transaction_id"), RATE)
    added = changed(clean_table, seeded)
    assert seeded.count() == ROWS + 150 and added.count() == 150
    found = checks.check_duplicate_payments(cleaning.prepare(seeded))
    assert found.count() == 300
    assert added.join(found, "transaction_id", "left_anti").count() == 0
    assert checks.check_duplicate_payments(cleaning.prepare(clean_table)).count() == 0


def test_missing_invoices(spark, clean_table):
    seeded = seeding.seed_missing_invoices(clean_table, RATE)
    assert seeded.count() == ROWS and changed(clean_table, seeded).count() == 120
    assert checks.check_missing_invoice_numbers(cleaning.prepare(seeded)).count() == 120


def test_out_of_hours(spark, clean_table):
    seeded = seeding.seed_out_of_hours(clean_table, RATE)
    rows = changed(clean_table, seeded).collect()
    moved = [r for r in rows if r.transaction_time == "11:30:00"]
    assert len(rows) == 150 and 40 < len(moved) < 110
    assert {r.transaction_date.weekday() for r in moved} == {5}
    assert {r.transaction_time for r in rows} == {"11:30:00", "22:35:00"}
    assert checks.check_out_of_hours_transactions(cleaning.prepare(seeded)).count() == 150


def test_weekend_rows_stay_on_their_day(spark, clean_table):
    sunday = clean_table.withColumn("transaction_date", F.lit(dt.date(2024, 1, 7)))
    seeded = seeding.seed_out_of_hours(sunday, RATE)
    assert {r[0] for r in seeded.select("transaction_date").distinct().collect()} == {dt.date(2024, 1, 7)}


def test_over_limit(spark, clean_table, limits):
    seeded = seeding.seed_over_limit(clean_table, limits, RATE)
    assert seeded.count() == ROWS and seeded.columns == clean_table.columns
    rows = changed(clean_table, seeded).collect()
    assert len(rows) == 180  # V9 has no limit, its rows are not drawn
    for r in rows:
        factor = r.amount / (1000 + int(r.vendor_id[1:]))
        assert Decimal("1.049") < factor < Decimal("2.001")
    merged = checks.merge_with_vendor_limits(cleaning.prepare(seeded), limits)
    assert checks.check_exceeding_approval_limits(merged).count() == len(rows)


def test_over_limit_with_few_limited_rows(spark, clean_table, limits):
    """Fewer rows with a limit than wanted: all of them change, no other does."""
    few = clean_table.withColumn("vendor_id", F.expr("if(transaction_id < 'T000100', 'V1', 'V9')"))
    rows = changed(few, seeding.seed_over_limit(few, limits, RATE)).collect()
    assert len(rows) == 100 and {r.vendor_id for r in rows} == {"V1"}


def test_all_kinds_in_turn_use_the_size_before_seeding(spark, clean_table, limits):
    seeded = seeding.seed_duplicates(clean_table, F.concat(F.lit("D"), "transaction_id"), RATE, base_rows=ROWS)
    seeded = seeding.seed_missing_invoices(seeded, RATE, base_rows=ROWS)
    seeded = seeding.seed_out_of_hours(seeded, RATE, base_rows=ROWS)
    seeded = seeding.seed_over_limit(seeded, limits, RATE, base_rows=ROWS)
    assert seeded.count() == ROWS + 150
    df = cleaning.prepare(seeded)
    assert checks.check_missing_invoice_numbers(df).count() == 120
    assert checks.check_out_of_hours_transactions(df).count() == 150
