"""Duplicate rules against Python restatements, including hot keys and NULLs."""

import datetime as dt
from decimal import Decimal

import helpers as h
import pytest

from ledgerlens.operators import checks, duplicates


def days(*offsets):
    return [None if o is None else h.MONDAY + dt.timedelta(days=o) for o in offsets]


def same_key(spark, *offsets, **values):
    rows = [
        h.payment(n, transaction_date=d, **{"invoice_number": "INV-1", **values})
        for n, d in enumerate(days(*offsets))
    ]
    return h.prepared(spark, rows)


@pytest.mark.parametrize(
    "offsets, chained, paired",
    [
        ((0, 7, 14), 3, 3),
        ((0, 8), 0, 0),
        ((0, 8, 15), 2, 2),
        ((0, 0, 30), 2, 2),
        ((0, None), 2, 0),
        ((0, 20, None), 2, 0),
        ((None, None), 2, 0),
        ((None,), 0, 0),
    ],
)
def test_window_edges(spark, offsets, chained, paired):
    df = same_key(spark, *offsets)
    assert checks.check_duplicate_payments(df).count() == chained
    assert checks.sql_duplicate_payments(df).count() == paired


def test_window_is_a_parameter(spark):
    df = same_key(spark, 0, 10)
    assert checks.check_duplicate_payments(df, 9).count() == 0
    found = checks.check_duplicate_payments(df, 10)
    assert found.count() == 2 and found.first().reason.endswith("within 10 days")


def test_null_amounts_group_only_in_the_register_rule(spark):
    df = same_key(spark, 0, 1, amount=None)
    assert checks.check_duplicate_payments(df).count() == 2
    assert checks.sql_duplicate_payments(df).count() == 0


def test_blank_and_null_invoices_match_but_no_real_number(spark):
    invoices = ["", None, "  ", "NO_INVOICE"]
    df = h.prepared(spark, [h.payment(n, invoice_number=i) for n, i in enumerate(invoices)])
    assert h.ids(checks.check_duplicate_payments(df)) == ["T00000", "T00001", "T00002"]
    # the SQL rule does not trim the key
    assert h.ids(checks.sql_duplicate_payments(df)) == ["T00000", "T00001"]


def test_repeated_id_is_no_partner_in_sql(spark):
    twice = h.payment(1, invoice_number="X")
    df = h.prepared(spark, [twice, twice])
    assert checks.check_duplicate_payments(df).count() == 2
    assert checks.sql_duplicate_payments(df).count() == 0


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("hot_rows", [5, duplicates.HOT_ROWS])
def test_random_groups(spark, monkeypatch, seed, hot_rows):
    """Groups of more than five payments are hot, then none is."""
    monkeypatch.setattr(duplicates, "HOT_ROWS", hot_rows)
    payments = h.random_payments(seed, 400, with_nulls=seed % 2 == 1)
    df = h.prepared(spark, payments)
    clusters = h.chain_clusters(payments)
    expected = sorted(t for t, (_, _, size) in clusters.items() if size >= 2)
    assert h.ids(checks.check_duplicate_payments(df)) == expected
    assert h.ids(checks.sql_duplicate_payments(df)) == h.paired_duplicates(payments)
    counted = duplicates.count_semi_join_duplicates(df).first()[0]
    assert counted == len(h.paired_duplicates(payments))
    found = {r.transaction_id: (r.cluster, r.cluster_size) for r in duplicates.duplicate_clusters(df).collect()}
    assert found == {t: (n, size) for t, (_, n, size) in clusters.items() if size >= 2}
    store = duplicates.store_candidates(df, buckets=3)
    assert (store.hot is None) == (hot_rows > 400)
    assert h.ids(duplicates.duplicate_rows(store)) == expected
    assert h.ids(duplicates.semi_join_duplicates(store)) == h.paired_duplicates(payments)
    found = {r.transaction_id: (r.cluster, r.cluster_size) for r in duplicates.duplicate_clusters(store).collect()}
    assert found == {t: (n, size) for t, (_, n, size) in clusters.items() if size >= 2}
    store.discard()


def test_chain_rule_equals_pair_rule_without_nulls(spark):
    payments = [p for p in h.random_payments(11, 500) if p["invoice_number"] in ("A", "B")]
    df = h.prepared(spark, payments)
    assert h.ids(checks.check_duplicate_payments(df)) == h.ids(checks.sql_duplicate_payments(df))


@pytest.mark.parametrize("hot_rows", [2, duplicates.HOT_ROWS])
def test_day_gaps(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(duplicates, "HOT_ROWS", hot_rows)
    df = same_key(spark, 3, 0, 3, 10, None)
    gaps = {r.transaction_id: r.day_gap for r in duplicates.day_gaps(df).collect()}
    assert gaps == {"T00001": None, "T00000": 3, "T00002": 0, "T00003": 7, "T00004": None}


def test_one_group_holding_every_row(spark):
    """A single group of many rows on few days: flagged without pairing them."""
    rows = spark.range(200_000).selectExpr(
        "concat('T', id) AS transaction_id",
        "date_add(date'2024-01-01', cast(id % 20 AS int) * 8) AS transaction_date",
        "'10:00:00' AS transaction_time", "'V1' AS vendor_id", "'Vendor 1' AS vendor_name",
        "cast(5 AS decimal(18,2)) AS amount", "'GBP' AS currency", "cast(null AS string) AS invoice_number",
        "'BACS' AS payment_method", "'posted' AS status",
    )
    hot = duplicates.candidates(duplicates.with_invoice_key(rows))
    assert hot.hot.count() == 200_000 and hot.cold.count() == 0
    assert duplicates.duplicate_rows(rows).count() == 200_000
    assert duplicates.semi_join_duplicates(rows).count() == 200_000
    sizes = duplicates.cluster_sizes(rows).collect()
    assert len(sizes) == 20 and {r.cluster_size for r in sizes} == {10_000}
    assert Decimal("5.00") == sizes[0].amount
