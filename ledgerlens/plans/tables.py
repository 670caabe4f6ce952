"""The audited tables, derived from `events` and `supplier`, in Spark and in SQL.

Every event is a payment and some are paid twice, up to ten days apart; suppliers
are the vendors that have a limit, so part of the payments is orphaned. The
modulo terms shape values only: all rows of both tables take part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.schema import BASE_COLUMNS

COPY_ID_STEP = 1_000_000_000

# Declared, so that reading starts without a pass over the files for their schema.
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
SUPPLIER = "s_suppkey bigint, s_name string"


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, ts = F.col("event_id"), F.col("ts")
    every = lambda n: event % n == 0
    payments = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet").select(
        event,
        ts.cast("date").alias("paid_on"),
        F.date_format(ts, "HH:mm:ss").alias("transaction_time"),
        F.col("user_id").alias("vendor_id"),
        F.concat(F.lit("Supplier#"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("vendor_name"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        F.when(every(50), "EUR").otherwise("GBP").alias("currency"),
        F.when(every(41), None)
        .when(every(43), "")
        .when(every(47), "   ")
        .otherwise(F.concat(F.lit("INV-"), event))
        .alias("invoice_number"),
        F.col("event_type").alias("payment_method"),
        F.when(F.col("event_type") == "error", "rejected").otherwise("posted").alias("status"),
        F.explode(F.when(every(67), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return payments.withColumns(
        {
            "transaction_id": event + F.col("copy") * F.lit(COPY_ID_STEP).cast("long"),
            "transaction_date": F.date_add("paid_on", (F.col("copy") * (event % 11)).cast("int")),
        }
    ).select(*BASE_COLUMNS)


def limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return spark.read.schema(SUPPLIER).parquet(f"{sf_dir}/supplier.parquet").select(
        key.alias("vendor_id"),
        F.col("s_name").alias("vendor_name"),
        F.lit("GBP").alias("currency"),
        (F.lit(20) + key % 10 * 15).cast("decimal(18,2)").alias("approval_limit"),
    )


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payments as untidy text: padding, lower case, old dates, values that do not parse."""
    tx = transactions(spark, sf_dir)
    number = F.col("transaction_id")
    every = lambda n: number % n == 0
    return tx.select(
        F.concat(F.lit(" "), number, F.lit("\t")).alias("transaction_id"),
        F.when(every(13), "2024-13-01")
        .when(every(29), None)
        .when(every(37), "2019-07-01")
        .otherwise(F.concat(F.col("transaction_date").cast("string"), F.lit(" ")))
        .alias("transaction_date"),
        F.when(every(17), "25:00:00").when(every(31), "nan").otherwise(F.col("transaction_time")).alias("transaction_time"),
        F.concat(F.col("vendor_id"), F.lit("  ")).alias("vendor_id"),
        F.concat(F.lit("\u00a0"), F.col("vendor_name")).alias("vendor_name"),
        F.when(every(19), "1,200.50")
        .when(every(23), "abc")
        .when(every(59), "10.005")
        .otherwise(F.concat(F.lit(" "), F.col("amount").cast("string")))
        .alias("amount"),
        F.lower("currency").alias("currency"),
        F.when(every(53), " None ").otherwise(F.col("invoice_number")).alias("invoice_number"),
        "payment_method",
        "status",
    )


# The same tables as common table expressions.

BASE_SQL = ", ".join(BASE_COLUMNS)

TX_SQL = f"""
base AS (
  SELECT event_id, CAST(ts AS DATE) AS paid_on, strftime(ts, '%H:%M:%S') AS transaction_time,
         user_id AS vendor_id, 'Supplier#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS vendor_name,
         CAST(value AS DECIMAL(18,2)) AS amount,
         CASE WHEN event_id % 50 = 0 THEN 'EUR' ELSE 'GBP' END AS currency,
         CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 43 = 0 THEN ''
              WHEN event_id % 47 = 0 THEN '   ' ELSE 'INV-' || event_id END AS invoice_number,
         event_type AS payment_method,
         CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'posted' END AS status,
         unnest(CASE WHEN event_id % 67 = 0 THEN [0, 1] ELSE [0] END) AS copy
  FROM events),
tx AS (
  SELECT CAST(event_id + copy * {COPY_ID_STEP} AS BIGINT) AS transaction_id,
         paid_on + CAST(copy * (event_id % 11) AS INTEGER) AS transaction_date,
         transaction_time, vendor_id, vendor_name, amount, currency, invoice_number, payment_method, status
  FROM base),
limits AS (
  SELECT s_suppkey AS vendor_id, s_name AS vendor_name, 'GBP' AS currency,
         CAST(20 + (s_suppkey % 10) * 15 AS DECIMAL(18,2)) AS approval_limit
  FROM supplier)"""

RAW_SQL = f"""{TX_SQL},
raw AS (
  SELECT ' ' || transaction_id || chr(9) AS transaction_id,
         CASE WHEN transaction_id % 13 = 0 THEN '2024-13-01' WHEN transaction_id % 29 = 0 THEN NULL
              WHEN transaction_id % 37 = 0 THEN '2019-07-01' ELSE CAST(transaction_date AS VARCHAR) || ' ' END AS transaction_date,
         CASE WHEN transaction_id % 17 = 0 THEN '25:00:00' WHEN transaction_id % 31 = 0 THEN 'nan'
              ELSE transaction_time END AS transaction_time,
         vendor_id || '  ' AS vendor_id, chr(160) || vendor_name AS vendor_name,
         CASE WHEN transaction_id % 19 = 0 THEN '1,200.50' WHEN transaction_id % 23 = 0 THEN 'abc'
              WHEN transaction_id % 59 = 0 THEN '10.005' ELSE ' ' || CAST(amount AS VARCHAR) END AS amount,
         lower(currency) AS currency,
         CASE WHEN transaction_id % 53 = 0 THEN ' None ' ELSE invoice_number END AS invoice_number,
         payment_method, status
  FROM tx),
stripped AS (
  SELECT trim(transaction_id, ' ' || chr(9)) AS transaction_id, trim(transaction_date) AS transaction_date,
         trim(transaction_time) AS transaction_time, trim(vendor_id) AS vendor_id,
         trim(vendor_name, ' ' || chr(160)) AS vendor_name, trim(amount) AS amount, trim(currency) AS currency,
         trim(invoice_number) AS invoice_number, payment_method, status
  FROM raw)"""

CLEAN_SQL = f"""{RAW_SQL},
typed AS (
  SELECT transaction_id, CAST(try_strptime(transaction_date, '%Y-%m-%d') AS DATE) AS transaction_date,
         strftime(try_strptime(transaction_time, '%H:%M:%S'), '%H:%M:%S') AS transaction_time, vendor_id, vendor_name,
         TRY_CAST(amount AS DECIMAL(18,2)) AS amount, upper(currency) AS currency, invoice_number, payment_method, status
  FROM stripped),
clean AS (
  SELECT *, invoice_number IS NULL OR trim(invoice_number) IN ('', 'nan', 'None') AS is_missing_invoice,
         amount IS NULL AS is_missing_amount, transaction_date IS NULL AS is_missing_date,
         CAST(substr(transaction_time, 1, 2) AS INTEGER) AS hour_of_day,
         CAST(isodow(transaction_date) - 1 AS INTEGER) AS day_of_week,
         CAST(CAST(transaction_date AS VARCHAR) || ' ' || transaction_time AS TIMESTAMP) AS combined_datetime
  FROM typed)"""

# Prepared and limit-merged payments, as the checks take them.
MERGED_SQL = f"""{TX_SQL},
merged AS (
  SELECT tx.*, limits.approval_limit,
         invoice_number IS NULL OR trim(invoice_number) IN ('', 'nan', 'None') AS is_missing_invoice,
         CAST(substr(transaction_time, 1, 2) AS INTEGER) AS hour_of_day,
         CAST(isodow(transaction_date) - 1 AS INTEGER) AS day_of_week
  FROM tx LEFT JOIN limits ON tx.vendor_id = limits.vendor_id)"""


def neighbours_sql(table: str) -> str:
    """Row by row: gaps to the previous and next payment of the null-safe group."""
    return f"""
neighbours AS (
  SELECT *, lag(transaction_id) OVER w IS NOT NULL AS has_before, lead(transaction_id) OVER w IS NOT NULL AS has_after,
         date_diff('day', lag(transaction_date) OVER w, transaction_date) AS gap_before,
         date_diff('day', transaction_date, lead(transaction_date) OVER w) AS gap_after
  FROM {table}
  WINDOW w AS (PARTITION BY vendor_id, amount, currency, nullif(trim(invoice_number), '')
               ORDER BY transaction_date ASC NULLS LAST, transaction_id))"""


CHAINED = (
    "((has_before AND coalesce(gap_before, 0) <= 7) OR (has_after AND coalesce(gap_after, 0) <= 7))"
)
DUPLICATE_REASON = "'Multiple payments with identical vendor, amount, currency and invoice within 7 days'"
OUTSIDE = "(hour_of_day IS NULL OR hour_of_day < 9 OR hour_of_day >= 18)"
OFF_DAY = "(day_of_week IS NULL OR day_of_week NOT IN (0, 1, 2, 3, 4))"
HOURS_REASON = (
    f"CASE WHEN {OFF_DAY} THEN 'Transaction on a non-business day' "
    "ELSE 'Transaction outside business hours (09:00-18:00)' END"
)
LIMIT_REASON = (
    "'Payment amount ' || format('{:,.2f}', CAST(amount AS DOUBLE)) || "
    "' exceeds approval limit ' || format('{:,.2f}', CAST(approval_limit AS DOUBLE))"
)

# Rows of the register before numbering, and the numbered register, over `merged`.
FOUND_SQL = f"""{neighbours_sql("merged")},
entries AS (
  SELECT {BASE_SQL}, 'Duplicate Payment' AS exception_type, {DUPLICATE_REASON} AS reason, 'High' AS severity,
         'duplicate_payments' AS detected_by, 0 AS check_rank
  FROM neighbours WHERE {CHAINED}
  UNION ALL
  SELECT {BASE_SQL}, 'Missing Invoice Number', 'Invoice number is missing or blank', 'Medium',
         'missing_invoice_numbers', 1
  FROM merged WHERE is_missing_invoice
  UNION ALL
  SELECT {BASE_SQL}, 'Out-of-Hours Transaction', {HOURS_REASON}, 'Low', 'out_of_hours', 2
  FROM merged WHERE {OUTSIDE} OR {OFF_DAY}
  UNION ALL
  SELECT {BASE_SQL}, 'Exceeds Approval Limit', {LIMIT_REASON}, 'High', 'exceeds_approval_limit', 3
  FROM merged WHERE approval_limit IS NOT NULL AND amount > approval_limit)"""

NUMBERED_SQL = f"""
register AS (
  SELECT row_number() OVER (ORDER BY check_rank, CASE WHEN check_rank = 0 THEN transaction_date END ASC NULLS LAST,
                                     transaction_id) AS exception_id,
         {BASE_SQL}, exception_type, reason, severity, detected_by
  FROM entries)"""

ENTRIES_SQL = f"{MERGED_SQL}, {FOUND_SQL}"
REGISTER_SQL = f"{ENTRIES_SQL}, {NUMBERED_SQL}"

# The same over the cleaned text, where dates, times and amounts may be missing.
UNTIDY_ENTRIES_SQL = f"""{CLEAN_SQL},
merged AS (
  SELECT clean.*, limits.approval_limit
  FROM clean LEFT JOIN limits ON clean.vendor_id = CAST(limits.vendor_id AS VARCHAR)),
{FOUND_SQL}"""
UNTIDY_REGISTER_SQL = f"{UNTIDY_ENTRIES_SQL}, {NUMBERED_SQL}"
