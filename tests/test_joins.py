"""Both ways of the limit join give the same rows."""

from decimal import Decimal

import helpers as h
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import checks, joins, validation

LIMITS = [(f"V{n}", f"Vendor {n}", "GBP", Decimal(n * 10)) for n in range(1, 6)]


@pytest.fixture
def payments():
    return h.random_payments(5, 600, with_nulls=True)


def expected_limits(payments):
    known = {v[0]: v[3] for v in LIMITS}
    return sorted((p["transaction_id"], known.get(p["vendor_id"])) for p in payments)


@pytest.mark.parametrize("max_rows, hot_share", [(None, joins.HOT_SHARE), (0, 2), (0, 4), (0, joins.HOT_SHARE)])
def test_limit_join(spark, monkeypatch, payments, max_rows, hot_share):
    """Broadcast; then shuffled with no, one (V1) or all vendors hot."""
    monkeypatch.setattr(joins, "HOT_SHARE", hot_share)
    merged = checks.merge_with_vendor_limits(h.typed(spark, payments), h.vendors(spark, LIMITS), max_rows)
    rows = [(r.transaction_id, r.approval_limit) for r in merged.select("transaction_id", "approval_limit").collect()]
    assert sorted(rows, key=lambda r: r[0]) == expected_limits(payments)


def test_hot_keys_are_few(spark, monkeypatch, payments):
    monkeypatch.setattr(joins, "HOT_SHARE", 4)
    assert [r.vendor_id for r in joins.hot_keys(h.typed(spark, payments), ["vendor_id"]).collect()] == ["V1"]


def test_hot_rows_leave_the_join_key(spark, monkeypatch):
    """All rows of one vendor spread over the tasks of the shuffle join."""
    monkeypatch.setattr(joins, "HOT_SHARE", 2)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(20_000).selectExpr("id AS transaction_id", "'V1' AS vendor_id")
        side = h.vendors(spark, LIMITS).select("vendor_id", "approval_limit")
        joined = joins.lookup_join(facts, side, ["vendor_id"], max_rows=0)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20_000 and len(sizes) > 1 and max(sizes) < 2 * 20_000 / len(sizes)
        assert joined.filter("approval_limit = 10").count() == 20_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repeated_limit_rows_fan_out(spark):
    """As a plain left join does; the key check reports them."""
    twice = LIMITS + [("V1", "Vendor 1", "GBP", Decimal(99))]
    tx = h.typed(spark, [h.payment(1)])
    for max_rows in (None, 0):
        assert checks.merge_with_vendor_limits(tx, h.vendors(spark, twice), max_rows).count() == 2
    assert [tuple(r) for r in validation.repeated_keys(h.vendors(spark, twice), ["vendor_id"]).collect()] == [("V1", 2)]
