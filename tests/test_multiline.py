"""Line breaks inside quotes, read in byte ranges, against Spark's own reader of one task a file."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlens import functions as fn
from ledgerlens.sources import csv, multiline

HEADER = "id,name,note"
TEXTS = ["plain", "two\nlines", 'a "quoted" word', "\n", "ends\n", "a,b", "", "x\r\ny", '"', '""\n""', "é\nü", "long " * 40 + "\nend"]


def field(text):
    return '"' + text.replace('"', '""') + '"' if set(text) & set('",\n\r') or not text else text


def write(folder, rows, files=1, line_end="\n", header=HEADER):
    folder.mkdir()
    for n in range(files):
        lines = [header, *[",".join(field(v) for v in row) for row in rows[n::files]]]
        (folder / f"t{n}.csv").write_text(line_end.join(lines) + line_end, newline="")
    return str(folder)


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few hundred bytes, each a task of its own."""
    settings = {"spark.sql.files.maxPartitionBytes": "300b", "spark.sql.files.openCostInBytes": "300b"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def rows_of(seed, n):
    rng = random.Random(seed)
    return [(str(i), rng.choice(TEXTS), rng.choice(TEXTS)) for i in range(n)]


@pytest.mark.parametrize("files", [1, 3])
@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_same_rows_as_one_task_a_file(spark, small_ranges, tmp_path, files, line_end):
    rows = rows_of(files, 120)
    path = write(tmp_path / "t", rows, files, line_end)
    found = csv.read_text_table(spark, path, ["id"], multiline=True)
    # as written, but for what means no value
    written = spark.createDataFrame(rows, "id string, name string, note string")
    written = written.select(*[fn.null_tokens(F.col(c)).alias(c) for c in written.columns])
    assert sorted(map(str, found.collect())) == sorted(map(str, written.collect()))
    if line_end == "\n":  # with other ends, Spark's reader changes the breaks inside quotes
        whole = spark.read.options(**csv.CSV_OPTIONS, multiLine=True).csv(path)
        whole = whole.select(*[fn.null_tokens(F.col(c)).alias(c) for c in whole.columns])
        assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))


def test_a_file_is_cut_into_ranges_and_read_by_several_tasks(spark, small_ranges, tmp_path):
    rows = rows_of(5, 200)
    path = write(tmp_path / "t", rows)
    lines = spark.read.option("lineSep", "\n").text(path)
    ranges = lines.select("_metadata.file_block_start").distinct().count()
    assert ranges > 10 and lines.rdd.getNumPartitions() > 10
    assert multiline.quoted_records(spark, path).count() == 201


def test_a_field_longer_than_many_ranges(spark, small_ranges, tmp_path):
    rows = [("1", "a\n" * 2000, "x"), ("2", "plain", "y"), ("3", '""\n' * 500, "z\n" * 300)]
    found = csv.read_text_table(spark, write(tmp_path / "t", rows), ["id"], multiline=True)
    assert sorted((r.id, r.name, r.note) for r in found.collect()) == rows


@pytest.mark.parametrize("size", range(20, 60, 3))
def test_every_border(size):
    """The cutter alone: the same bytes in ranges of any size give the same records."""
    text = "\n".join([HEADER, *[",".join(field(v) for v in row) for row in rows_of(size, 30)]])
    lines, ranges, start = text.split("\n"), [], 0
    for line in lines:  # a line belongs to the range that it starts in
        ranges.append(start // size)
        start += len(line.encode()) + 1
    opens, seen = {}, 0
    for number, line in zip(ranges, lines):
        opens.setdefault(number, seen % 2 == 1)
        seen += line.count('"')
    batch = pa.RecordBatch.from_arrays(
        [pa.array(ranges, pa.int64()), pa.array([r == 0 for r in ranges]), pa.array([opens[r] for r in ranges]), pa.array(lines)],
        ["range", "at_start", "inside", "value"],
    )
    for cut in (1, 7, len(lines)):
        whole = []
        for piece in pa.Table.from_batches(multiline._cut(batch.slice(i, cut) for i in range(0, len(lines), cut))).to_pylist():
            if piece["kind"] == multiline.HEAD:
                whole[-1] += "\n" + piece["text"]
            else:
                whole.append(piece["text"])
        assert "\n".join(whole) == text and len(whole) == 31 and all(w.count('"') % 2 == 0 for w in whole)


def test_bad_rows_fail_and_are_listed(spark, small_ranges, tmp_path):
    folder = tmp_path / "t"
    path = write(folder, rows_of(9, 60))
    with open(folder / "t0.csv", "a", newline="") as file:
        file.write('61,"a\nb"\n62,"c\nd",x,y\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        csv.read_text_table(spark, path, ["id"], multiline=True).collect()
    bad = csv.malformed_rows(spark, path, multiline=True).collect()
    assert sorted(r[csv.CORRUPT] for r in bad) == ['61,"a\nb"', '62,"c\nd",x,y']


def test_another_header_fails(spark, tmp_path):
    path = write(tmp_path / "t", rows_of(1, 5))
    (tmp_path / "t" / "t9.csv").write_text("id,note,name\n1,2,3\n")
    with pytest.raises(ValueError, match="header"):
        csv.read_text_table(spark, path, ["id"], multiline=True).collect()


def test_header_alone(spark, tmp_path):
    assert csv.read_text_table(spark, write(tmp_path / "t", []), ["id"], multiline=True).count() == 0
