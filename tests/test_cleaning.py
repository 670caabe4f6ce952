"""Coercion rules of the cleaning steps and of the CSV scan."""

import datetime as dt
from decimal import Decimal

import pytest

from ledgerlens import functions as fn
from ledgerlens.operators import checks, cleaning, summaries
from ledgerlens.schema import BASE_COLUMNS, TRANSACTION_SCHEMA, VENDOR_COLUMNS, VENDOR_SCHEMA
from ledgerlens.sources import csv, scratch, staging

HEADER = ",".join(BASE_COLUMNS)


def one_column(spark, values, apply):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(apply(F.col("v"))).collect()]


def test_strip_takes_unicode_white_space_and_keeps_null(spark):
    padded = ["  a b ", "\ta\n", " é ", "\x1fa\x85", "", "　", None]
    assert one_column(spark, padded, fn.strip) == ["a b", "a", "é", "a", "", "", None]


@pytest.mark.parametrize(
    "text, day",
    [
        ("2024-01-04", dt.date(2024, 1, 4)),
        ("2024-1-4", dt.date(2024, 1, 4)),
        ("2024-02-29", dt.date(2024, 2, 29)),
        ("2023-02-29", None),
        ("2024-13-01", None),
        ("2024/01/04", None),
        ("20240104", None),
        ("2024-01-04 10:00:00", None),
        ("12024-01-04", None),
        ("", None),
        (None, None),
    ],
)
def test_dates(spark, text, day):
    assert one_column(spark, [text], fn.parse_day) == [day]


@pytest.mark.parametrize(
    "text, valid",
    [
        ("2024-01-04", True),
        ("2024-01-04 00:00:00", True),
        ("2024-1-4T9:05", True),
        ("2024-01-04T23:59:59.125", True),
        ("2024-01-04 25:00:00", False),
        ("2024-01-04 noon", False),
        ("2024-13-01 00:00:00", False),
        ("2024-01", False),
        (None, False),
    ],
)
def test_dates_with_time(spark, text, valid):
    expected = dt.date(2024, 1, 4) if valid else None
    assert one_column(spark, [text], lambda c: fn.parse_day(c, with_time=True)) == [expected]


@pytest.mark.parametrize(
    "text, clock",
    [
        ("09:15:00", "09:15:00"),
        ("9:5:0", "09:05:00"),
        ("23:59:59", "23:59:59"),
        ("00:00:00", "00:00:00"),
        ("25:00:00", None),
        ("09:60:00", None),
        ("09:15", None),
        ("009:15:00", None),
        ("nan", None),
        (None, None),
    ],
)
def test_clocks(spark, text, clock):
    assert one_column(spark, [text], fn.parse_clock) == [clock]


@pytest.mark.parametrize(
    "text, amount",
    [
        ("1200.5", Decimal("1200.50")),
        ("1e3", Decimal("1000.00")),
        (" 12 ", Decimal("12.00")),
        ("-5", Decimal("-5.00")),
        ("10.005", Decimal("10.01")),
        ("1,200.50", None),
        ("abc", None),
        ("inf", None),
        ("", None),
        (None, None),
    ],
)
def test_amounts(spark, text, amount):
    assert one_column(spark, [text], fn.parse_money) == [amount]


def read(spark, folder, *lines, header=HEADER):
    path = folder / "tx.csv"
    path.write_text("\n".join([header, *lines]) + "\n")
    return csv.load_transactions(spark, str(path))


def test_clean_pipeline_on_dirty_rows(spark, tmp_path):
    raw = read(
        spark,
        tmp_path,
        " T1 ,2024-01-06, 09:15:00 , V1 ,\" Vendor, \"\"One\"\" \",1200.50,gbp , INV-1 ,BACS,posted",
        "T2,2024-13-01,25:00:00,V1,Vendor,\"1,200.50\",GBP,NA,BACS,posted",
        "T3,,10:00:00,V1,Vendor,,GBP,,BACS,N/A",
        "T4,2024-01-08,,V1,Vendor,5,GBP,   ,BACS,posted",
    )
    clean = cleaning.clean_transactions(raw)
    assert dict(clean.dtypes) | dict(
        transaction_date="date", amount="decimal(18,2)", hour_of_day="int", combined_datetime="timestamp_ntz"
    ) == dict(clean.dtypes)
    one, two, three, four = clean.orderBy("transaction_id").collect()
    assert one.asDict() == {
        "transaction_id": "T1", "transaction_date": dt.date(2024, 1, 6), "transaction_time": "09:15:00",
        "vendor_id": "V1", "vendor_name": 'Vendor, "One"', "amount": Decimal("1200.50"), "currency": "GBP",
        "invoice_number": "INV-1", "payment_method": "BACS", "status": "posted", "is_missing_invoice": False,
        "is_missing_amount": False, "is_missing_date": False, "hour_of_day": 9, "day_of_week": 5,
        "combined_datetime": dt.datetime(2024, 1, 6, 9, 15),
    }
    assert (two.transaction_date, two.transaction_time, two.amount, two.invoice_number) == (None,) * 4
    assert two.is_missing_invoice and two.is_missing_amount and two.is_missing_date and two.hour_of_day is None
    assert three.status is None and three.invoice_number is None and three.combined_datetime is None
    assert four.invoice_number == "" and four.is_missing_invoice and four.combined_datetime is None
    quality = {r.field: (r.missing_count, r.missing_pct) for r in summaries.data_quality(clean).collect()}
    assert quality == {
        "invoice_number": (3, 75.0), "amount": (2, 50.0), "transaction_date": (2, 50.0), "transaction_time": (2, 50.0),
    }


def test_columns_are_found_by_name(spark, tmp_path):
    names = ["side note. no 1", *reversed(BASE_COLUMNS)]
    df = read(spark, tmp_path, "x,posted,BACS,INV,GBP,5,Vendor,V1,10:00:00,2024-01-08,T1", header=",".join(names))
    row = df.first()
    assert (row.transaction_id, row.amount, row["side note. no 1"]) == ("T1", "5", "x")
    limits = spark.createDataFrame([("V1", Decimal(1))], "vendor_id string, approval_limit decimal(18,2)")
    for max_rows in (None, 0):
        merged = checks.merge_with_vendor_limits(cleaning.clean_transactions(df), limits, max_rows)
        assert merged.columns[0] == "side note. no 1"
        assert [t.count() for t in checks.run_all_checks(merged).values()] == [0, 0, 0, 1]
        assert checks.sql_duplicate_payments(merged).count() == 0


def test_missing_columns_are_named(spark, tmp_path):
    with pytest.raises(ValueError, match="currency.*status"):
        read(spark, tmp_path, header=",".join(c for c in BASE_COLUMNS if c not in ("currency", "status")))
    path = tmp_path / "limits.csv"
    path.write_text("vendor_id,vendor_name,currency\nV1,Vendor,GBP\n")
    with pytest.raises(ValueError, match="approval_limit"):
        csv.load_vendor_limits(spark, str(path))
    with pytest.raises(ValueError, match="vendor_name"):
        staging.conform(spark.range(1).withColumnRenamed("id", "vendor_id"), VENDOR_SCHEMA)


def test_limits_are_normalised_like_transactions(spark, tmp_path):
    path = tmp_path / "limits.csv"
    path.write_text(",".join(VENDOR_COLUMNS) + "\n V1 ,Vendor,gbp,5000\nV2,Vendor,GBP,none\n")
    rows = cleaning.clean_vendor_limits(csv.load_vendor_limits(spark, str(path))).collect()
    assert [tuple(r) for r in rows] == [("V1", "Vendor", "GBP", Decimal("5000.00")), ("V2", "Vendor", "GBP", None)]


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = tmp_path / "tx.csv"
    path.write_text(HEADER + '\nT1,2024-01-08,10:00:00,V1,"Two\nlines",5,GBP,I,BACS,posted\n')
    df = csv.load_transactions(spark, str(path), multiline=True)
    assert [r.vendor_name for r in df.collect()] == ["Two\nlines"]


def test_csv_round_trip_keeps_texts(spark, tmp_path):
    texts = ["a,b", 'say "hi"', " padded ", "back\\slash", "   "]
    df = spark.createDataFrame([(str(n), t) for n, t in enumerate(texts)], "n string, t string")
    path = csv.write_table(df, str(tmp_path / "out"))
    back = csv.read_text_table(spark, path, ["n", "t"]).orderBy("n").collect()
    assert [r.t for r in back] == texts


def test_parquet_sink_and_staging_scan(spark, tmp_path):
    raw = read(spark, tmp_path, "T1,2024-01-08,10:00:00,V1,Vendor,5,GBP,I,BACS,posted")
    path = csv.write_table(cleaning.base_view(cleaning.clean_transactions(raw)), str(tmp_path / "pq"), "parquet")
    df = staging.read_staging_transactions(spark, path)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in TRANSACTION_SCHEMA]
    limits = spark.createDataFrame([("V1", "Vendor", "GBP", Decimal(3))], VENDOR_SCHEMA)
    vendors = staging.read_staging_vendors(spark, csv.write_table(limits, str(tmp_path / "lim"), "parquet"))
    staging.register_views(df, vendors)
    over = spark.sql(
        "SELECT t.transaction_id FROM staging_transactions t JOIN vendors v ON t.vendor_id = v.vendor_id "
        "WHERE t.amount > v.approval_limit"
    )
    assert [r.transaction_id for r in over.collect()] == ["T1"]


def test_scratch_paths_are_fresh_and_shared(spark):
    one, other = scratch.scratch_path(spark, "x"), scratch.scratch_path(spark, "x")
    assert one != other and one.startswith(spark.sparkContext.getCheckpointDir())
