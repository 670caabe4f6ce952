"""Ordered sinks: files in sequence, a manifest, positions on reading."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.sources import csv, ordered


@pytest.mark.parametrize("rows, per_file, files", [(0, 10, 1), (1, 10, 1), (10, 10, 1), (11, 10, 2), (95, 10, 10)])
def test_files_hold_the_order(spark, tmp_path, rows, per_file, files):
    df = spark.range(rows).select((F.col("id") * 37 % 101).alias("key"), "id")
    path = ordered.write_ordered(df, [F.desc("key")], str(tmp_path / "out"), rows_per_file=per_file)
    expected = sorted(((i * 37 % 101) for i in range(rows)), reverse=True)
    found = ordered.read_ordered(spark, path).orderBy("position").collect()
    assert [(r.position, r.key) for r in found] == list(enumerate(expected, 1))
    parts = sorted((tmp_path / "out").glob("part-*.parquet"))
    assert len(parts) == files and [k for p in parts for k in spark.read.parquet(str(p)).toPandas()["key"]] == expected
    manifest = [tuple(r) for r in ordered.read_manifest(spark, path).orderBy("part").collect()]
    assert manifest == [(n, n * per_file + 1, min((n + 1) * per_file, rows)) for n in range(files)]


def test_csv_parts_read_in_name_order(spark, tmp_path):
    df = spark.range(1, 58).select(F.col("id").alias("n"), F.concat(F.lit("row "), "id").alias("text"))
    path = ordered.write_numbered(df.orderBy(F.rand(3)), "n", str(tmp_path / "out"), "csv", csv.CSV_OPTIONS, rows_per_file=10)
    lines = [line for p in sorted((tmp_path / "out").glob("part-*.csv")) for line in p.read_text().splitlines()[1:]]
    assert lines == [f"{n},row {n}" for n in range(1, 58)]
    assert spark.read.options(**csv.CSV_OPTIONS).csv(path).count() == 57  # the manifest is passed over


def test_no_task_sorts_more_than_a_file(spark, tmp_path):
    df = spark.range(1, 1001).select(F.col("id").alias("n"))
    ordered.write_numbered(df, "n", str(tmp_path / "out"), rows_per_file=100)
    sizes = [spark.read.parquet(str(p)).count() for p in (tmp_path / "out").glob("part-*.parquet")]
    assert sizes == [100] * 10
