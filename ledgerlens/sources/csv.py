"""CSV scans (by column name, all text) and CSV or Parquet sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import functions as fn
from ledgerlens.operators.summaries import vendor_order
from ledgerlens.schema import BASE_COLUMNS, VENDOR_COLUMNS, quoted, require_columns
from ledgerlens.sources.multiline import quoted_records
from ledgerlens.sources.ordered import ROWS_PER_FILE, write_numbered, write_ordered
from ledgerlens.sources.scratch import stored

# Quotes are doubled inside quoted fields and white space is data, both ways.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
CORRUPT = "_malformed_row"


def read_text_table(spark: SparkSession, path: str, required: list[str], multiline: bool = False) -> DataFrame:
    """Header CSV as text columns; texts that mean "no value" become NULL.

    Only the header is read up front. `enforceSchema=False` makes a file whose
    header differs from the first one fail instead of shifting columns.
    `multiline` allows line breaks inside quotes; its files are cut into ranges as well, at the price
    of one more pass that counts quotes and of storing the records.
    A row with more or fewer fields than the header fails the read, whichever
    columns are asked for; `malformed_rows` lists such rows.
    """
    # without pruning every row is parsed whole, so that no field is lost unseen
    options = {**CSV_OPTIONS, "enforceSchema": False, "multiLine": multiline, "mode": "FAILFAST", "columnPruning": False}
    df = spark.read.options(**options).csv(path)
    if multiline:
        df = _parsed_records(spark, path, df.columns, "FAILFAST")
    require_columns(df, required)
    return df.select(*[fn.null_tokens(F.col(q)).alias(c) for q, c in zip(quoted(df.columns), df.columns)])


def _text_options(**more) -> dict[str, str]:
    return {k: str(v).lower() if isinstance(v, bool) else v for k, v in {**CSV_OPTIONS, **more}.items() if k != "header"}


def _parsed_records(spark: SparkSession, path: str, header: list[str], mode: str) -> DataFrame:
    """The fields of every record below a header; with mode PERMISSIVE also the raw text of those of another length.

    Records of blanks alone are no records, as in Spark's own reader.
    """
    records = quoted_records(spark, path).select("first", F.regexp_replace("text", "\r$", "").alias("text"))
    records = records.filter(F.trim("text") != "")
    fields = T.StructType([T.StructField(c, T.StringType()) for c in header])
    names = records.filter("first").select(F.from_csv("text", fields.toDDL(), _text_options(multiLine=True)).alias("row"))
    expected = F.struct(*[F.lit(c).alias(c) for c in header])
    if not names.filter(F.col("row") != expected).isEmpty():
        raise ValueError(f"a file under {path} has another header than {', '.join(header)}")
    schema = fields if mode == "FAILFAST" else fields.add(CORRUPT, "string")
    parsed = F.from_csv("text", schema.toDDL(), _text_options(multiLine=True, mode=mode, columnNameOfCorruptRecord=CORRUPT))
    return records.filter("NOT first").select(parsed.alias("row")).select("row.*")


def malformed_rows(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Rows that `read_text_table` would fail on: the fields as far as they were read, and the raw text.

    They are stored, because Spark does not let a query over the file itself ask for the raw text alone.
    """
    options = {**CSV_OPTIONS, "multiLine": multiline, "columnPruning": False}
    header = spark.read.options(**options).csv(path).schema
    if multiline:
        rows = _parsed_records(spark, path, header.names, "PERMISSIVE")
    else:
        permissive = {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        rows = spark.read.schema(header.add(CORRUPT, "string")).options(**permissive).csv(path)
    return stored(rows.filter(F.col(CORRUPT).isNotNull()))


def load_transactions(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return read_text_table(spark, path, BASE_COLUMNS, multiline)


def load_vendor_limits(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return read_text_table(spark, path, VENDOR_COLUMNS, multiline)


def write_table(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """One directory of part files, written by all tasks; returns its path."""
    options = CSV_OPTIONS if fmt == "csv" else {}
    df.write.mode("overwrite").format(fmt).options(**options).save(path)
    return path


def export_exception_register(register: DataFrame, out_dir: str, fmt: str = "csv", rows_per_file: int = ROWS_PER_FILE) -> str:
    """Part files in the order of exception_id, which is dense, with a manifest."""
    options = CSV_OPTIONS if fmt == "csv" else {}
    return write_numbered(register, "exception_id", f"{out_dir}/exceptions_master.{fmt}", fmt, options, rows_per_file)


def export_summaries(
    by_type: DataFrame, by_vendor: DataFrame, quality: DataFrame, out_dir: str, fmt: str = "csv"
) -> dict[str, str]:
    """Three tables. The two of a handful of rows are single files; the vendor one may be long, its files are in order."""
    options = CSV_OPTIONS if fmt == "csv" else {}
    vendor_path = f"{out_dir}/summary_by_vendor.{fmt}"
    return {
        "summary_by_type": write_table(by_type.coalesce(1), f"{out_dir}/summary_by_type.{fmt}", fmt),
        "summary_by_vendor": write_ordered(by_vendor, vendor_order(), vendor_path, fmt, options),
        "data_quality_summary": write_table(quality.coalesce(1), f"{out_dir}/data_quality_summary.{fmt}", fmt),
    }
