"""Published results on the thirty-row sample, from CSV to CSV."""

import re
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import checks, cleaning, duplicates, joins, measures, register, summaries, validation
from ledgerlens.plans.audit import audit, run_audit
from ledgerlens.sources import scratch
from ledgerlens.schema import BASE_COLUMNS, CHECKS, REGISTER_COLUMNS, TRANSACTION_SCHEMA
from ledgerlens.sources import csv

DATA = Path(__file__).parent / "data"


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    # fixed values: the sample tables whose published results are checked here
    return str(DATA / "transactions.csv"), str(DATA / "limits.csv"), str(tmp_path_factory.mktemp("sample") / "out")


@pytest.fixture(scope="module")
def audited(spark, paths):
    return run_audit(spark, *paths)


@pytest.fixture(scope="module")
def merged(spark, paths):
    tx = cleaning.clean_transactions(csv.load_transactions(spark, paths[0]))
    limits = cleaning.clean_vendor_limits(csv.load_vendor_limits(spark, paths[1]))
    return checks.merge_with_vendor_limits(tx, limits)


def numbers(df):
    return sorted(int(r[0][1:]) - 1000 for r in df.select("transaction_id").collect())


DUPLICATES = [1, 2, 6, 7, 13, 15, 16, 19]
OVER = [4, 8, 11, 12, 13, 17, 19, 20, 21, 23, 26, 27, 28, 30]


def test_checks(merged):
    found = {name: numbers(df) for name, df in checks.run_all_checks(merged).items()}
    assert found == {
        "duplicate_payments": DUPLICATES,
        "missing_invoice_numbers": [4, 12, 30],
        "out_of_hours": [5, 9, 10, 13, 17, 19, 23, 26, 30],
        "exceeds_approval_limit": OVER,
    }


def test_out_of_hours_reasons(merged):
    flagged = checks.check_out_of_hours_transactions(merged)
    weekend = flagged.filter("reason = 'Transaction on a non-business day'")
    evening = flagged.filter("reason = 'Transaction outside business hours (09:00-18:00)'")
    assert numbers(weekend) == [5, 13, 19, 23, 30]
    assert numbers(evening) == [9, 10, 17, 26]


def test_over_limit_reason(merged):
    reasons = {r.transaction_id: r.reason for r in checks.check_exceeding_approval_limits(merged).collect()}
    assert reasons["T1008"] == "Payment amount 16,000.00 exceeds approval limit 15,000.00"


def test_sql_checks(merged):
    limits = merged.select("vendor_id", "approval_limit").distinct()
    assert numbers(checks.sql_duplicate_payments(merged)) == DUPLICATES
    assert numbers(checks.sql_missing_invoices(merged)) == [4, 12, 30]
    assert numbers(checks.sql_out_of_hours(merged)) == [5, 9, 10, 13, 17, 19, 23, 26, 30]
    over = checks.sql_over_limit(merged.drop("approval_limit"), limits)
    assert numbers(over) == OVER
    assert over.agg(F.sum("excess_amount")).first()[0] == Decimal("8700.00")


def test_register(audited):
    rows = audited.register.orderBy("exception_id").collect()
    assert audited.register.columns == REGISTER_COLUMNS
    assert [r.exception_id for r in rows] == list(range(1, 35))
    assert len({r.transaction_id for r in rows}) == 23
    # duplicates by date, the rest in transaction order
    assert [r.transaction_id for r in rows[:8]] == ["T1001", "T1002", "T1006", "T1007", "T1013", "T1019", "T1015", "T1016"]
    assert [r.transaction_id for r in rows[8:11]] == ["T1004", "T1012", "T1030"]


def test_both_register_forms_agree(merged, audited):
    union_form = register.build_register(checks.run_all_checks(merged))
    assert sorted(union_form.collect()) == sorted(audited.register.collect())


def test_vendor_table_too_large_to_broadcast(spark, paths, audited, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    tx = cleaning.clean_transactions(csv.load_transactions(spark, paths[0]))
    limits = cleaning.clean_vendor_limits(csv.load_vendor_limits(spark, paths[1]))
    assert sorted(audit(tx, limits).register.collect()) == sorted(audited.register.collect())


def test_summaries(audited):
    assert [tuple(r) for r in audited.by_type.collect()] == [
        ("Exceeds Approval Limit", "High", 14),
        ("Out-of-Hours Transaction", "Low", 9),
        ("Duplicate Payment", "High", 8),
        ("Missing Invoice Number", "Medium", 3),
    ]
    by_vendor = [(r.vendor_id, r["count"]) for r in audited.by_vendor.collect()]
    assert by_vendor == [
        ("V002", 6), ("V001", 5), ("V007", 5), ("V003", 4), ("V010", 4), ("V006", 3),
        ("V004", 2), ("V005", 2), ("V009", 2), ("V008", 1),
    ]


def test_checks_per_transaction(audited):
    flagged = {r.transaction_id: r.check_count for r in register.checks_per_transaction(audited.register).collect()}
    assert sorted(t for t, n in flagged.items() if n == 3) == ["T1013", "T1019", "T1030"]
    assert sorted(t for t, n in flagged.items() if n == 2) == ["T1004", "T1012", "T1017", "T1023", "T1026"]


def test_measures(audited):
    kpi = measures.kpi(audited.register).first()
    assert (kpi.total_exceptions, kpi.high_severity_exceptions) == (34, 22)
    assert kpi.exception_amount == Decimal("285301.00")
    assert kpi.pct_high_severity == 22 / 34
    assert (kpi.duplicate_payments, kpi.missing_invoices, kpi.out_of_hours, kpi.over_limit) == (8, 3, 9, 14)
    months = {r.month: (r.total_exceptions, r.exception_amount) for r in measures.by_month(audited.register).collect()}
    assert months == {
        "2024-01": (24, Decimal("171301.00")),
        "2024-02": (7, Decimal("76500.00")),
        "2024-03": (3, Decimal("37500.00")),
    }
    top = [int(r.exception_amount) for r in measures.top_risky_vendors(audited.register, 3).collect()]
    assert top == [66000, 58000, 47000]
    severities = {r.severity: r.total_exceptions for r in measures.by_severity(audited.register).collect()}
    assert severities == {"High": 22, "Low": 9, "Medium": 3}


def test_data_quality(audited):
    quality = {r.field: (r.total_records, r.missing_count, r.missing_pct) for r in audited.data_quality.collect()}
    assert quality == {
        "invoice_number": (30, 3, 10.0),
        "amount": (30, 0, 0.0),
        "transaction_date": (30, 0, 0.0),
        "transaction_time": (30, 0, 0.0),
    }


def test_row_counts(audited):
    assert [tuple(r) for r in audited.row_counts.collect()] == [
        ("transactions", 30),
        ("vendors", 10),
        ("duplicate_payments", 8),
        ("missing_invoice_numbers", 3),
        ("out_of_hours", 9),
        ("exceeds_approval_limit", 14),
    ]


def test_validation(spark, paths, merged):
    limits = cleaning.clean_vendor_limits(csv.load_vendor_limits(spark, paths[1]))
    report = {r.validation_check: r.failure_count for r in validation.validation_report(merged, limits).collect()}
    assert report == {
        "Orphaned_Vendor": 0, "Missing_Invoice": 3, "Invalid_Amount": 0, "Invalid_Date": 0, "Currency_Mismatch": 0,
    }
    counts = {r[0]: r[1] for r in summaries.sql_exception_counts(merged.drop("approval_limit"), limits).collect()}
    assert list(counts.values()) == [8, 3, 9, 14]


def test_written_tables(spark, paths, audited):
    out = paths[2]
    written = spark.read.option("header", True).csv(f"{out}/exceptions_master.csv")
    assert written.columns == REGISTER_COLUMNS and written.count() == 34
    assert spark.read.option("header", True).csv(f"{out}/summary_by_type.csv").count() == 4
    assert spark.read.option("header", True).csv(f"{out}/summary_by_vendor.csv").count() == 10
    assert spark.read.option("header", True).csv(f"{out}/data_quality_summary.csv").columns == [
        "field", "total_records", "missing_count", "missing_pct",
    ]


def test_months_add_up_with_undated_exceptions(merged):
    undated = merged.withColumn("transaction_date", F.when(F.col("transaction_id") > "T1010", F.col("transaction_date")))
    entries = register.exception_entries(undated)
    total = measures.kpi(entries).first()
    months = measures.by_month(entries).collect()
    assert any(r["month"] is None for r in months)
    assert sum(r["total_exceptions"] for r in months) == total["total_exceptions"]
    assert sum(r["exception_amount"] for r in months) == total["exception_amount"]


def test_slicers_take_lists(audited):
    def count(**context):
        return measures.in_context(audited.register, **context).count()

    assert count(severity=["High", "Low"]) == count(severity="High") + count(severity="Low")
    assert count(month=["2024-01", "2024-03"]) == count(month="2024-01") + count(month="2024-03")
    assert count(vendor_id=[]) == 0


@pytest.mark.parametrize(
    "row", ["T1,2024-01-04,09:15:00,V001,Acme, Inc,1200.50,GBP,I-1,BACS,posted", "T1,2024-01-04,09:15:00,V001"]
)
def test_rows_of_another_length_fail_the_audit(spark, paths, tmp_path, row):
    path = tmp_path / "bad.csv"
    path.write_text((DATA / "transactions.csv").read_text() + row + "\n")
    assert [r[csv.CORRUPT] for r in csv.malformed_rows(spark, str(path)).collect()] == [row]
    assert csv.malformed_rows(spark, str(path)).count() == 1
    with pytest.raises(Exception, match="(?i)malformed"):
        run_audit(spark, str(path), paths[1], str(tmp_path / "out"))


def test_line_breaks_in_quotes(spark, paths, tmp_path):
    path = tmp_path / "quoted.csv"
    row = 'T1,2024-01-04,09:15:00,V001,"Acme\nSupplies",1200.50,GBP,I-1,BACS,posted'
    path.write_text((DATA / "transactions.csv").read_text() + row + "\n")
    found = run_audit(spark, str(path), paths[1], str(tmp_path / "out"), multiline=True)
    assert found.transactions.count() == 31


def test_dates_that_carry_a_time(spark, paths, tmp_path, audited):
    path = tmp_path / "timed.csv"
    text = (DATA / "transactions.csv").read_text()
    path.write_text(re.sub(r"(,\d{4}-\d\d-\d\d),", r"\1 00:00:00,", text))
    raw = csv.load_transactions(spark, str(path))
    assert cleaning.clean_transactions(raw).filter("is_missing_date").count() == 30
    found = run_audit(spark, str(path), paths[1], str(tmp_path / "out"), dates_with_time=True)
    assert found.register.count() == audited.register.count() == 34


def test_values_that_fit_no_staging_type_are_counted(spark):
    rows = [("2024-13-01", "1,200.50"), ("2024-01-04", "abc"), (None, "3"), ("x", None)]
    raw = spark.createDataFrame(rows, "transaction_date string, amount string")
    raw = raw.selectExpr(*[c if c in raw.columns else f"'a' AS {c}" for c in BASE_COLUMNS])
    lost = {r["field"]: r["lost_count"] for r in validation.lost_values(raw, TRANSACTION_SCHEMA).collect()}
    assert lost == {c: 2 if c in ("transaction_date", "amount") else 0 for c in BASE_COLUMNS}


def test_audit_leaves_only_its_outputs(spark, paths, tmp_path):
    """All that a run stores lies in its folder, which goes with `discard`."""
    scratch.ensure_checkpoint_dir(spark)
    shared = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = set(shared.iterdir())
    result = run_audit(spark, paths[0], paths[1], str(tmp_path / "out"))
    assert [p.name for p in set(shared.iterdir()) - before] == [Path(result.run_folder).name]
    result.discard()
    assert set(shared.iterdir()) == before
    assert spark.read.option("header", True).csv(f"{tmp_path}/out/summary_by_type.csv").count() == 4


def test_rows_are_counted_as_they_are_written(spark, audited):
    """The counts of a run are a small local table: nothing is read again for them."""
    plan = audited.row_counts._jdf.queryExecution().executedPlan().toString()
    assert "parquet" not in plan and "Exchange" not in plan
    counts = {r["name"]: r["row_count"] for r in audited.row_counts.collect()}
    assert counts["transactions"] == 30 and counts["vendors"] == 10 and len(counts) == 6
    lazy = summaries.row_counts(audited.transactions, audited.transactions.limit(10), audited.register, CHECKS)
    assert {r["name"]: r["row_count"] for r in lazy.collect()} == counts


def test_the_register_file_is_in_order(spark, audited, paths):
    folder = Path(paths[2]) / "exceptions_master.csv"
    ids = [int(line.split(",")[0]) for p in sorted(folder.glob("part-*")) for line in p.read_text().splitlines()[1:]]
    assert ids == list(range(1, 35))


def test_an_audit_offers_its_stored_candidates(audited):
    """Other duplicate rules read the buckets that the register was built from."""
    rows = audited.candidates.rows
    assert numbers(duplicates.duplicate_rows(audited.candidates)) == DUPLICATES
    clusters = duplicates.duplicate_clusters(audited.candidates)
    assert sorted({r.cluster_size for r in clusters.collect()}) == [2]
    assert numbers(duplicates.semi_join_duplicates(audited.candidates)) == DUPLICATES and rows.count() >= len(DUPLICATES)


@pytest.mark.parametrize("multiline", [False, True])
def test_no_transactions(spark, paths, tmp_path, multiline):
    """A header alone: no exceptions, all counts there."""
    header = (DATA / "transactions.csv").read_text().splitlines()[0]
    (tmp_path / "tx.csv").write_text(header + "\n")
    result = run_audit(spark, str(tmp_path / "tx.csv"), paths[1], str(tmp_path / "out"), multiline=multiline)
    counts = {r["name"]: r["row_count"] for r in result.row_counts.collect()}
    assert counts == {"transactions": 0, "vendors": 10, **dict.fromkeys(CHECKS, 0)}
    assert result.register.count() == 0 and result.by_vendor.count() == 0
    result.discard()
