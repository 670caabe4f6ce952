"""Every registered query against its SQL on the smallest tables, and the plans behind them."""

import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from ledgerlens.operators import cleaning, duplicates
from ledgerlens.plans import tables, workload

sys.path.insert(0, str(Path(contract.__file__).parent / "tools"))

import compare  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.open_tables(SF_DIR)


@pytest.mark.parametrize("name", workload.QUERIES)
def test_query_matches_sql(spark, con, name):
    problem, rows = compare.differences(spark, con, name, SF_DIR)
    assert problem is None
    assert rows > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 993


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_queries_and_sql_have_the_same_names():
    assert set(workload.QUERIES) == set(workload.ORACLE)


def test_scans_read_only_what_is_used(spark):
    tx = tables.transactions(spark, SF_DIR)
    profile = plan_of(duplicates.day_profile(duplicates.with_invoice_key(tx)))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in profile
    flags = plan_of(cleaning.prepare(tx).select("is_missing_invoice"))
    assert "ReadSchema: struct<event_id:bigint>" in flags


@pytest.mark.parametrize("name", ["exception_register_single_pass", "duplicate_semi_join", "validation_report", "star_join"])
def test_no_pairs_no_python(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "InPandas"):
        assert operator not in plan


def test_row_local_checks_do_not_shuffle(spark):
    for name in ("missing_invoice", "out_of_hours", "over_limit"):
        assert "Exchange hashpartitioning" not in plan_of(contract.queries()[name](spark, SF_DIR))


def stored_plans(monkeypatch):
    """Plans of all that the duplicate rules store from here on."""
    plans, real = [], duplicates.stored
    monkeypatch.setattr(duplicates, "stored", lambda df: plans.append(plan_of(df)) or real(df))
    return plans


@pytest.mark.parametrize("name", ["duplicate_window", "duplicate_semi_join", "duplicate_clusters"])
def test_duplicate_plans_shuffle_only_hashes_of_all_payments(spark, monkeypatch, name):
    """One scan and shuffle counts group hashes; one more scan finds the candidates, and only these are shuffled."""
    plans = stored_plans(monkeypatch)
    verdict = plan_of(workload.QUERIES[name](spark, SF_DIR))
    (counted,) = plans
    assert counted.count("events.parquet") == 1 and counted.count("Exchange hashpartitioning(_slot") == 1
    assert verdict.count("events.parquet") == 1
    assert verdict.count("Exchange hashpartitioning") == 1  # above the semi join, below the windows
    assert verdict.index("Window") < verdict.index("Exchange hashpartitioning") < verdict.index("LeftSemi")


def test_day_gap_profiles_only_candidates(spark, monkeypatch):
    plans = stored_plans(monkeypatch)
    verdict = plan_of(workload.QUERIES["day_gap"](spark, SF_DIR))
    assert "Window" not in plans[0] + verdict and "LeftSemi" in plans[1]
    assert sum(p.count("events.parquet") for p in [*plans, verdict]) == 3


def test_stored_candidates_need_no_exchange(spark):
    found = duplicates.store_candidates(tables.transactions(spark, SF_DIR), buckets=4)
    try:
        for rule in (duplicates.duplicate_rows, duplicates.semi_join_duplicates, duplicates.duplicate_clusters):
            plan = plan_of(rule(found))
            assert "Window" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    finally:
        found.discard()
    assert not spark.catalog.tableExists(found.table)


def test_large_groups_of_hashes_filter_payments_before_their_shuffle(spark):
    """Where the hashes are too many to broadcast, the semi join gets a run-time Bloom filter."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1b",
    }
    before = {key: spark.conf.get(key) for key in settings}
    tx = tables.transactions(spark, SF_DIR)
    expected = duplicates.duplicate_rows(tx).count()
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        found = duplicates.duplicate_rows(tx)
        plan = plan_of(found)
        assert "might_contain" in plan and "bloom_filter_agg" in plan
        # the windows take the order of the join as it is: its two sides, and the filter itself, are all that is exchanged
        assert plan.count("Exchange hashpartitioning") == 2
        assert found.count() == expected
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_the_register_is_written_once(spark, monkeypatch):
    from ledgerlens.operators import ids

    plans, real = [], ids.stored
    monkeypatch.setattr(ids, "stored", lambda df, *observed: plans.append(plan_of(df)) or real(df, *observed))
    workload.QUERIES["exception_register_single_pass"](spark, SF_DIR)
    (written,) = plans
    assert "Exchange rangepartitioning" in written
    duplicate_branch = written[: written.index("Generate explode")]
    assert "supplier.parquet" not in duplicate_branch.split("Union")[1].split("Generate")[0]


def test_sql_counts_scan_the_limits_once(spark, monkeypatch):
    plans = stored_plans(monkeypatch)
    counts = plan_of(workload.QUERIES["exception_counts"](spark, SF_DIR))
    assert counts.count("supplier.parquet") == 1
    assert sum(p.count("events.parquet") for p in [*plans, counts]) == 3  # hashes, candidates, row tests
