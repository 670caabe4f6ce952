"""Every operator as a named query with its SQL counterpart.

`@query(sql)` registers a function of (spark, sf_dir); `sql` computes the same
result on the same tables in another engine.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import functions as fn
from ledgerlens.operators import (
    checks,
    cleaning,
    duplicates,
    measures,
    register,
    seeding,
    summaries,
    validation,
)
from ledgerlens.plans import tables as t
from ledgerlens.schema import (
    BASE_COLUMNS,
    CHECKS,
    REGISTER_COLUMNS,
    TRANSACTION_SCHEMA,
    VENDOR_SCHEMA,
)
from ledgerlens.sources import csv, ordered, staging
from ledgerlens.sources.scratch import scratch_path, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        ORACLE[run.__name__] = sql
        return run

    return add


def prepared(spark, sf_dir) -> DataFrame:
    return cleaning.prepare(t.transactions(spark, sf_dir))


def merged(spark, sf_dir) -> DataFrame:
    return checks.merge_with_vendor_limits(prepared(spark, sf_dir), t.limits(spark, sf_dir))


def untidy_merged(spark, sf_dir) -> DataFrame:
    """Cleaned text with limits; vendor ids are texts there."""
    limits = t.limits(spark, sf_dir).withColumn("vendor_id", F.col("vendor_id").cast("string"))
    return checks.merge_with_vendor_limits(cleaning.clean_transactions(t.raw_text(spark, sf_dir)), limits)


def untidy_entries(spark, sf_dir) -> DataFrame:
    return register.exception_entries(untidy_merged(spark, sf_dir)).drop(register.RANK)


def ranked_entries(spark, sf_dir) -> DataFrame:
    return register.audited_entries(prepared(spark, sf_dir), t.limits(spark, sf_dir))


def entries(spark, sf_dir) -> DataFrame:
    """Register rows without ids, which no summary needs."""
    return ranked_entries(spark, sf_dir).drop(register.RANK)


def counted(sql_column: str) -> str:
    return f"CAST({sql_column} AS BIGINT)"


def flagged_sql(where: str, exception_type: str, reason: str) -> str:
    return (
        f"WITH {t.MERGED_SQL} SELECT {t.BASE_SQL}, '{exception_type}' AS exception_type, {reason} AS reason "
        f"FROM merged WHERE {where}"
    )


# Scans and cleaning


@query(
    f"""WITH {t.TX_SQL} SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, transaction_date, transaction_time,
    CAST(vendor_id AS VARCHAR) AS vendor_id, vendor_name, amount, currency, invoice_number, payment_method, status
    FROM tx"""
)
def staging_transactions(spark, sf_dir):
    return staging.conform(t.transactions(spark, sf_dir), TRANSACTION_SCHEMA)


@query(
    f"""WITH {t.TX_SQL} SELECT CAST(vendor_id AS VARCHAR) AS vendor_id, vendor_name, currency, approval_limit
    FROM limits"""
)
def staging_vendors(spark, sf_dir):
    return staging.conform(t.limits(spark, sf_dir), VENDOR_SCHEMA)


@query(
    f"""WITH {t.TX_SQL} SELECT CAST(transaction_id AS VARCHAR) AS transaction_id,
    CAST(transaction_date AS VARCHAR) AS transaction_date, transaction_time, CAST(vendor_id AS VARCHAR) AS vendor_id,
    vendor_name, CAST(amount AS VARCHAR) AS amount, currency, nullif(invoice_number, '') AS invoice_number,
    payment_method, status FROM tx"""
)
def csv_transactions(spark, sf_dir):
    path = csv.write_table(t.transactions(spark, sf_dir), scratch_path(spark, "transactions"))
    return csv.load_transactions(spark, path)


@query(
    f"""WITH {t.TX_SQL} SELECT CAST(vendor_id AS VARCHAR) AS vendor_id, vendor_name, currency,
    CAST(approval_limit AS VARCHAR) AS approval_limit FROM limits"""
)
def csv_limits(spark, sf_dir):
    path = csv.write_table(t.limits(spark, sf_dir), scratch_path(spark, "limits"))
    return csv.load_vendor_limits(spark, path)


CSV_LINE_SQL = """concat_ws(',', transaction_id, transaction_date, transaction_time, vendor_id, vendor_name, amount,
    currency, coalesce(invoice_number, ''), payment_method) || CASE WHEN transaction_id % 7 = 0 THEN ',' || status || ',late'
    WHEN transaction_id % 11 = 0 THEN '' ELSE ',' || status END"""


@query(
    f"""WITH {t.TX_SQL}, lines AS (SELECT {CSV_LINE_SQL} AS line FROM tx)
    SELECT line AS malformed_row FROM lines WHERE length(line) - length(replace(line, ',', '')) <> {len(BASE_COLUMNS) - 1}"""
)
def csv_rejects(spark, sf_dir):
    """A CSV with rows of one field too many and one too few."""
    tx, number = t.transactions(spark, sf_dir), F.col("transaction_id")
    fields = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in BASE_COLUMNS[:-1]])
    last = F.when(number % 7 == 0, F.concat(F.lit(","), "status", F.lit(",late"))).when(number % 11 == 0, "")
    lines = tx.select(F.concat(fields, last.otherwise(F.concat(F.lit(","), "status"))).alias(",".join(BASE_COLUMNS)))
    path = scratch_path(spark, "lines")
    lines.write.options(header=True, sep="\u0001").csv(path)
    return csv.malformed_rows(spark, path).select(F.col(csv.CORRUPT).alias("malformed_row"))


@query(
    f"""WITH {t.RAW_SQL}, lost AS (SELECT
    count(*) FILTER (TRY_CAST(trim(transaction_date) AS DATE) IS NULL AND transaction_date IS NOT NULL) AS days,
    count(*) FILTER (TRY_CAST(trim(amount) AS DECIMAL(18,2)) IS NULL AND amount IS NOT NULL) AS amounts FROM raw)
    SELECT field, CASE field WHEN 'transaction_date' THEN days WHEN 'amount' THEN amounts ELSE 0 END AS lost_count
    FROM lost, (SELECT unnest({BASE_COLUMNS}) AS field)"""
)
def staging_losses(spark, sf_dir):
    return validation.lost_values(t.raw_text(spark, sf_dir), TRANSACTION_SCHEMA)


@query(f"WITH {t.RAW_SQL} SELECT * FROM stripped")
def clean_strings(spark, sf_dir):
    return cleaning.normalise_strings(t.raw_text(spark, sf_dir))


@query(
    f"""WITH {t.TX_SQL} SELECT transaction_id, CASE WHEN transaction_id % 13 = 0 OR transaction_id % 17 = 0 THEN NULL
    ELSE transaction_date END AS transaction_date FROM tx"""
)
def clean_dates_with_time(spark, sf_dir):
    """Days with a clock time behind them, some no day and some no time."""
    number = F.col("transaction_id")
    day = F.when(number % 13 == 0, "2024-13-01").otherwise(F.col("transaction_date").cast("string"))
    clock = F.when(number % 17 == 0, "25:00:00").otherwise(F.col("transaction_time"))
    text = F.concat(day, F.when(number % 2 == 0, "T").otherwise(" "), clock)
    return t.transactions(spark, sf_dir).select("transaction_id", fn.parse_day(text, with_time=True).alias("transaction_date"))


@query(f"WITH {t.CLEAN_SQL} SELECT transaction_id, transaction_date, transaction_time FROM clean")
def clean_dates_times(spark, sf_dir):
    raw = t.raw_text(spark, sf_dir).transform(cleaning.normalise_strings)
    return cleaning.parse_dates_times(raw).select("transaction_id", "transaction_date", "transaction_time")


@query(f"WITH {t.CLEAN_SQL} SELECT transaction_id, amount, currency FROM clean")
def clean_numeric(spark, sf_dir):
    raw = t.raw_text(spark, sf_dir).transform(cleaning.normalise_strings)
    return cleaning.parse_numeric(raw).select("transaction_id", "amount", "currency")


@query(
    f"WITH {t.CLEAN_SQL} SELECT transaction_id, is_missing_invoice, is_missing_amount, is_missing_date FROM clean"
)
def missing_flags(spark, sf_dir):
    clean = cleaning.clean_transactions(t.raw_text(spark, sf_dir))
    return clean.select("transaction_id", "is_missing_invoice", "is_missing_amount", "is_missing_date")


# Missing hours and days are shown as -1 so that the columns stay whole numbers.
FEATURES_SQL = "coalesce(hour_of_day, -1) AS hour_of_day, coalesce(day_of_week, -1) AS day_of_week"


def shown_features(clean: DataFrame) -> DataFrame:
    shown = {c: F.coalesce(c, F.lit(-1)) for c in ("hour_of_day", "day_of_week")}
    return clean.withColumns(shown)


@query(f"WITH {t.CLEAN_SQL} SELECT transaction_id, {FEATURES_SQL}, combined_datetime FROM clean")
def derived_features(spark, sf_dir):
    clean = cleaning.clean_transactions(t.raw_text(spark, sf_dir)).transform(shown_features)
    return clean.select("transaction_id", "hour_of_day", "day_of_week", "combined_datetime")


@query(
    f"""WITH {t.CLEAN_SQL} SELECT {t.BASE_SQL}, is_missing_invoice, is_missing_amount, is_missing_date,
    {FEATURES_SQL}, combined_datetime FROM clean"""
)
def clean_transactions(spark, sf_dir):
    return cleaning.clean_transactions(t.raw_text(spark, sf_dir)).transform(shown_features)


@query(f"WITH {t.CLEAN_SQL} SELECT {t.BASE_SQL} FROM clean")
def base_view(spark, sf_dir):
    return cleaning.base_view(cleaning.clean_transactions(t.raw_text(spark, sf_dir)))


@query(f"WITH {t.MERGED_SQL} SELECT {t.BASE_SQL}, approval_limit FROM merged")
def join_left_limits(spark, sf_dir):
    return cleaning.base_view(merged(spark, sf_dir), "approval_limit")


# The four checks


@query(flagged_sql("amount > approval_limit", "Exceeds Approval Limit", t.LIMIT_REASON))
def over_limit(spark, sf_dir):
    return checks.check_exceeding_approval_limits(merged(spark, sf_dir))


SQL_LIST = "transaction_id, transaction_date, vendor_id, vendor_name, amount, currency, invoice_number"


@query(
    f"""WITH {t.TX_SQL} SELECT t.transaction_id, t.transaction_date, t.vendor_id, t.vendor_name, t.amount, t.currency,
    t.invoice_number, 'Exceeds Approval Limit' AS exception_type, v.approval_limit,
    CAST(t.amount - v.approval_limit AS DECIMAL(19,2)) AS excess_amount
    FROM tx t JOIN limits v ON t.vendor_id = v.vendor_id WHERE t.amount > v.approval_limit"""
)
def over_limit_sql(spark, sf_dir):
    found = checks.sql_over_limit(t.transactions(spark, sf_dir), t.limits(spark, sf_dir))
    return checks.in_report_order(found, "Exceeds Approval Limit")


@query(flagged_sql("is_missing_invoice", "Missing Invoice Number", "'Invoice number is missing or blank'"))
def missing_invoice(spark, sf_dir):
    return checks.check_missing_invoice_numbers(prepared(spark, sf_dir))


@query(
    f"""WITH {t.TX_SQL} SELECT {SQL_LIST}, 'Missing Invoice Number' AS exception_type FROM tx
    WHERE invoice_number IS NULL OR ltrim(rtrim(invoice_number)) = ''"""
)
def missing_invoice_sql(spark, sf_dir):
    found = checks.sql_missing_invoices(t.transactions(spark, sf_dir))
    return checks.in_report_order(found, "Missing Invoice Number")


@query(flagged_sql(f"{t.OUTSIDE} OR {t.OFF_DAY}", "Out-of-Hours Transaction", t.HOURS_REASON))
def out_of_hours(spark, sf_dir):
    return checks.check_out_of_hours_transactions(prepared(spark, sf_dir))


@query(
    f"""WITH {t.CLEAN_SQL} SELECT {t.BASE_SQL}, 'Out-of-Hours Transaction' AS exception_type, {t.HOURS_REASON} AS reason
    FROM clean WHERE {t.OUTSIDE} OR {t.OFF_DAY}"""
)
def out_of_hours_untidy(spark, sf_dir):
    """A missing date or time counts as out of hours."""
    return checks.check_out_of_hours_transactions(cleaning.clean_transactions(t.raw_text(spark, sf_dir)))


@query(
    f"""WITH {t.TX_SQL} SELECT {SQL_LIST}, transaction_time, 'Out-of-Hours Transaction' AS exception_type,
    CASE WHEN dayofweek(transaction_date) IN (0, 6) THEN 'Weekend' ELSE 'Outside business hours' END AS reason
    FROM tx WHERE dayofweek(transaction_date) IN (0, 6)
    OR transaction_time < '09:00:00' OR transaction_time >= '18:00:00'"""
)
def out_of_hours_sql(spark, sf_dir):
    found = checks.sql_out_of_hours(t.transactions(spark, sf_dir))
    return checks.in_report_order(found, "Out-of-Hours Transaction")


@query(
    f"""WITH {t.TX_SQL}, {t.neighbours_sql("tx")} SELECT {t.BASE_SQL}, 'Duplicate Payment' AS exception_type,
    {t.DUPLICATE_REASON} AS reason FROM neighbours WHERE {t.CHAINED}"""
)
def duplicate_window(spark, sf_dir):
    return checks.check_duplicate_payments(prepared(spark, sf_dir))


@query(
    f"""WITH {t.CLEAN_SQL}, {t.neighbours_sql("clean")} SELECT {t.BASE_SQL}, 'Duplicate Payment' AS exception_type,
    {t.DUPLICATE_REASON} AS reason FROM neighbours WHERE {t.CHAINED}"""
)
def duplicate_window_untidy(spark, sf_dir):
    """The same over text with missing dates and amounts, which still group."""
    return checks.check_duplicate_payments(cleaning.clean_transactions(t.raw_text(spark, sf_dir)))


EXISTS_SQL = """EXISTS (SELECT 1 FROM tx d WHERE d.vendor_id = t.vendor_id AND d.amount = t.amount
    AND d.currency = t.currency AND coalesce(d.invoice_number, '') = coalesce(t.invoice_number, '')
    AND d.transaction_id <> t.transaction_id
    AND abs(date_diff('day', d.transaction_date, t.transaction_date)) <= 7)"""


@query(f"WITH {t.TX_SQL} SELECT {SQL_LIST}, 'Duplicate Payment' AS exception_type FROM tx t WHERE {EXISTS_SQL}")
def duplicate_semi_join(spark, sf_dir):
    found = checks.sql_duplicate_payments(t.transactions(spark, sf_dir))
    return checks.in_report_order(found, "Duplicate Payment")


CLUSTER_SQL = f"""{t.TX_SQL}, {t.neighbours_sql("tx")},
chained AS (
  SELECT *, nullif(trim(invoice_number), '') AS invoice_key, CAST(sum(CASE WHEN gap_before > 7 THEN 1 ELSE 0 END) OVER (
    PARTITION BY vendor_id, amount, currency, nullif(trim(invoice_number), '')
    ORDER BY transaction_date ASC NULLS LAST, transaction_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cluster
  FROM neighbours),
sized AS (
  SELECT *, count(*) OVER (PARTITION BY vendor_id, amount, currency, invoice_key, cluster) AS cluster_size
  FROM chained)"""


@query(
    f"""WITH {CLUSTER_SQL} SELECT transaction_id, vendor_id, transaction_date, cluster, cluster_size FROM sized
    WHERE cluster_size >= 2"""
)
def duplicate_clusters(spark, sf_dir):
    found = duplicates.duplicate_clusters(t.transactions(spark, sf_dir))
    return found.select("transaction_id", "vendor_id", "transaction_date", "cluster", "cluster_size")


@query(
    f"""WITH {CLUSTER_SQL} SELECT vendor_id, amount, currency, coalesce(invoice_key, '') AS invoice_key, cluster,
    min(transaction_date) AS first_date, max(transaction_date) AS last_date, count(*) AS cluster_size
    FROM sized GROUP BY ALL"""
)
def cluster_size(spark, sf_dir):
    sizes = duplicates.cluster_sizes(t.transactions(spark, sf_dir))
    return sizes.withColumn("invoice_key", F.coalesce("invoice_key", F.lit("")))


@query(
    f"""WITH {CLUSTER_SQL}
    SELECT 'chained' AS rule, transaction_id, -1 AS cluster, -1 AS cluster_size FROM neighbours WHERE {t.CHAINED}
    UNION ALL SELECT 'paired', transaction_id, -1, -1 FROM tx t WHERE {EXISTS_SQL}
    UNION ALL SELECT 'clustered', transaction_id, cluster, cluster_size FROM sized WHERE cluster_size >= 3"""
)
def duplicate_rules_stored(spark, sf_dir):
    """Three duplicate rules over candidates that are stored once, bucketed by group."""
    found = duplicates.store_candidates(t.transactions(spark, sf_dir))
    none = F.lit(-1).cast("long")
    plain = {"chained": duplicates.duplicate_rows(found), "paired": duplicates.semi_join_duplicates(found)}
    rows = [df.select(F.lit(r).alias("rule"), "transaction_id", none.alias("cluster"), none.alias("cluster_size")) for r, df in plain.items()]
    clusters = duplicates.duplicate_clusters(found, min_size=3)
    rows.append(clusters.select(F.lit("clustered").alias("rule"), "transaction_id", "cluster", "cluster_size"))
    return rows[0].unionAll(rows[1]).unionAll(rows[2])


@query(
    f"""WITH {t.TX_SQL}, {t.neighbours_sql("tx")} SELECT transaction_id, vendor_id, transaction_date,
    CAST(coalesce(gap_before, -1) AS INTEGER) AS day_gap FROM neighbours"""
)
def day_gap(spark, sf_dir):
    gaps = duplicates.day_gaps(t.transactions(spark, sf_dir))
    return gaps.select(
        "transaction_id", "vendor_id", "transaction_date", F.coalesce("day_gap", F.lit(-1)).alias("day_gap")
    )


# Register


@query(f"WITH {t.ENTRIES_SQL} SELECT detected_by AS check_name, {t.BASE_SQL}, exception_type, reason FROM entries")
def run_all_checks(spark, sf_dir):
    results = checks.run_all_checks(merged(spark, sf_dir))
    stacked = register.union_entries(results).withColumnRenamed("detected_by", "check_name")
    return stacked.select("check_name", *BASE_COLUMNS, "exception_type", "reason")


@query(f"WITH {t.REGISTER_SQL} SELECT * FROM register")
def exception_register(spark, sf_dir):
    return register.build_register(checks.run_all_checks(merged(spark, sf_dir)))


@query(f"WITH {t.REGISTER_SQL} SELECT * FROM register")
def exception_register_single_pass(spark, sf_dir):
    return register.number_exceptions(ranked_entries(spark, sf_dir))


@query(f"WITH {t.UNTIDY_REGISTER_SQL} SELECT * FROM register")
def exception_register_untidy(spark, sf_dir):
    return register.exception_register(untidy_merged(spark, sf_dir))


@query(
    f"""WITH {t.ENTRIES_SQL} SELECT transaction_id, string_agg(detected_by, ',' ORDER BY detected_by) AS checks,
    count(*) AS check_count FROM entries GROUP BY transaction_id"""
)
def checks_per_transaction(spark, sf_dir):
    found = register.checks_per_transaction(entries(spark, sf_dir))
    return found.withColumn("checks", F.array_join("checks", ","))


# Summaries


@query(
    f"""WITH {t.ENTRIES_SQL} SELECT exception_type, severity, count(*) AS "count" FROM entries
    GROUP BY exception_type, severity"""
)
def summary_by_type(spark, sf_dir):
    return summaries.summarise_by_type(entries(spark, sf_dir))


@query(
    f"""WITH {t.ENTRIES_SQL} SELECT vendor_id, vendor_name, count(*) AS "count" FROM entries
    GROUP BY vendor_id, vendor_name"""
)
def summary_by_vendor(spark, sf_dir):
    return summaries.summarise_by_vendor(entries(spark, sf_dir))


def quality_sql(field: str, missing: str) -> str:
    return f"""SELECT '{field}' AS field, count(*) AS total_records, {counted(f"count(*) FILTER ({missing})")}
    AS missing_count, round_even(CAST(count(*) FILTER ({missing}) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100, 2)
    AS missing_pct FROM clean"""


@query(
    f"WITH {t.CLEAN_SQL} "
    + " UNION ALL ".join(
        quality_sql(field, missing)
        for field, missing in {
            "invoice_number": "is_missing_invoice",
            "amount": "amount IS NULL",
            "transaction_date": "transaction_date IS NULL",
            "transaction_time": "transaction_time IS NULL",
        }.items()
    )
)
def data_quality(spark, sf_dir):
    return summaries.data_quality(cleaning.clean_transactions(t.raw_text(spark, sf_dir)))


@query(
    f"""WITH {t.TX_SQL}
    SELECT 'Duplicate Payment' AS exception_type, count(*) AS exception_count FROM tx t WHERE {EXISTS_SQL}
    UNION ALL SELECT 'Missing Invoice Number', count(*) FROM tx
    WHERE invoice_number IS NULL OR ltrim(rtrim(invoice_number)) = ''
    UNION ALL SELECT 'Out-of-Hours Transaction', count(*) FROM tx WHERE dayofweek(transaction_date) IN (0, 6)
    OR transaction_time < '09:00:00' OR transaction_time >= '18:00:00'
    UNION ALL SELECT 'Exceeds Approval Limit', count(*) FROM tx t JOIN limits v ON t.vendor_id = v.vendor_id
    WHERE t.amount > v.approval_limit"""
)
def exception_counts(spark, sf_dir):
    return summaries.sql_exception_counts(t.transactions(spark, sf_dir), t.limits(spark, sf_dir))


@query(
    f"""WITH {t.ENTRIES_SQL} SELECT 'transactions' AS name, count(*) AS row_count FROM tx
    UNION ALL SELECT 'vendors', count(*) FROM limits
    UNION ALL SELECT c.name, count(e.detected_by) FROM (VALUES {", ".join(f"('{c}')" for c in CHECKS)}) c(name)
    LEFT JOIN entries e ON e.detected_by = c.name GROUP BY c.name"""
)
def check_row_counts(spark, sf_dir):
    found = entries(spark, sf_dir)
    return summaries.row_counts(t.transactions(spark, sf_dir), t.limits(spark, sf_dir), found, CHECKS)


# Validation


def validation_sql(check: str, rest: str) -> str:
    return f"SELECT '{check}' AS validation_check, count(*) AS failure_count {rest}"


ORPHANED = validation_sql(
    "Orphaned_Vendor", "FROM tx t LEFT JOIN limits v ON t.vendor_id = v.vendor_id WHERE v.vendor_id IS NULL"
)
MISSING = validation_sql("Missing_Invoice", "FROM tx WHERE invoice_number IS NULL OR ltrim(rtrim(invoice_number)) = ''")
BAD_AMOUNT = validation_sql("Invalid_Amount", "FROM tx WHERE amount IS NULL OR amount <= 0")
BAD_DATE = validation_sql("Invalid_Date", "FROM tx WHERE transaction_date IS NULL OR transaction_date < '2020-01-01'")
MISMATCH = validation_sql(
    "Currency_Mismatch", "FROM tx t JOIN limits v ON t.vendor_id = v.vendor_id WHERE t.currency <> v.currency"
)


@query(f"WITH {t.TX_SQL} {ORPHANED}")
def v_orphaned_vendor(spark, sf_dir):
    return validation.orphaned_vendor(t.transactions(spark, sf_dir), t.limits(spark, sf_dir))


@query(f"WITH {t.TX_SQL} {MISSING}")
def v_missing_invoice(spark, sf_dir):
    return validation.missing_invoice(t.transactions(spark, sf_dir))


@query(f"WITH {t.CLEAN_SQL} {BAD_AMOUNT.replace('FROM tx', 'FROM clean')}")
def v_invalid_amount(spark, sf_dir):
    return validation.invalid_amounts(cleaning.clean_transactions(t.raw_text(spark, sf_dir)))


@query(f"WITH {t.CLEAN_SQL} {BAD_DATE.replace('FROM tx', 'FROM clean')}")
def v_invalid_date(spark, sf_dir):
    return validation.invalid_dates(cleaning.clean_transactions(t.raw_text(spark, sf_dir)))


@query(
    f"""WITH {t.RAW_SQL} SELECT transaction_id, amount, CASE WHEN TRY_CAST(trim(amount) AS DECIMAL(18,2)) IS NULL
    THEN 'not a number' WHEN TRY_CAST(trim(amount) AS DECIMAL(18,2)) <= 0 THEN 'not positive' ELSE 'sub-cent' END AS issue
    FROM raw WHERE TRY_CAST(trim(amount) AS DECIMAL(18,2)) IS NULL OR TRY_CAST(trim(amount) AS DECIMAL(18,2)) <= 0
    OR TRY_CAST(trim(amount) AS DECIMAL(30,10)) <> TRY_CAST(trim(amount) AS DECIMAL(18,2))"""
)
def v_invalid_amount_detail(spark, sf_dir):
    return validation.invalid_amount_detail(t.raw_text(spark, sf_dir))


@query(f"WITH {t.TX_SQL} {MISMATCH}")
def v_currency_mismatch(spark, sf_dir):
    return validation.currency_mismatch(t.transactions(spark, sf_dir), t.limits(spark, sf_dir))


@query(
    f"""WITH {t.TX_SQL} SELECT 'transactions' AS table_name, CAST(transaction_id AS VARCHAR) AS key, count(*) AS copies
    FROM tx GROUP BY transaction_id HAVING count(*) > 1
    UNION ALL SELECT 'vendors', CAST(vendor_id AS VARCHAR), count(*) FROM limits GROUP BY vendor_id HAVING count(*) > 1
    UNION ALL SELECT 'lineitem', l_orderkey || '/' || l_linenumber, count(*) FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
)
def v_pk(spark, sf_dir):
    """Both audited tables hold their key; lineitem does not."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    named = lambda name, key, found: found.select(F.lit(name).alias("table_name"), key.alias("key"), "copies")
    tx = validation.repeated_keys(t.transactions(spark, sf_dir), ["transaction_id"])
    vendors = validation.repeated_keys(t.limits(spark, sf_dir), ["vendor_id"])
    lineitem = validation.repeated_keys(lines, ["l_orderkey", "l_linenumber"])
    return (
        named("transactions", F.col("transaction_id").cast("string"), tx)
        .unionAll(named("vendors", F.col("vendor_id").cast("string"), vendors))
        .unionAll(named("lineitem", F.concat_ws("/", "l_orderkey", "l_linenumber"), lineitem))
    )


@query(
    f"""WITH {t.TX_SQL} SELECT transaction_id, vendor_id FROM tx
    WHERE NOT EXISTS (SELECT 1 FROM limits v WHERE v.vendor_id = tx.vendor_id)"""
)
def v_fk(spark, sf_dir):
    orphans = validation.orphan_rows(t.transactions(spark, sf_dir), t.limits(spark, sf_dir))
    return orphans.select("transaction_id", "vendor_id")


NOT_NULL = [f.name for f in TRANSACTION_SCHEMA.fields if not f.nullable]


@query(
    f"WITH {t.CLEAN_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM clean" for c in NOT_NULL
    )
)
def v_not_null(spark, sf_dir):
    clean = cleaning.clean_transactions(t.raw_text(spark, sf_dir))
    return validation.null_counts(clean, TRANSACTION_SCHEMA)


@query(f"WITH {t.TX_SQL} " + " UNION ALL ".join([ORPHANED, MISSING, BAD_AMOUNT, BAD_DATE, MISMATCH]))
def validation_report(spark, sf_dir):
    return validation.validation_report(t.transactions(spark, sf_dir), t.limits(spark, sf_dir))


# Dimensions and measures

CALENDAR_CTE = """
calendar AS (
  SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, strftime(d, '%Y-%m') AS month,
         strftime(d, '%B') AS month_name, 'Q' || quarter(d) AS quarter, strftime(d, '%A') AS weekday
  FROM (SELECT unnest(generate_series(min(transaction_date), max(transaction_date), INTERVAL 1 DAY)) AS d
        FROM entries))"""
CALENDAR_SQL = f"{t.ENTRIES_SQL}, {CALENDAR_CTE}"


@query(f"WITH {t.ENTRIES_SQL} SELECT min(transaction_date) AS first_date, max(transaction_date) AS last_date FROM entries")
def calendar_bounds(spark, sf_dir):
    return measures.calendar_bounds(entries(spark, sf_dir))


@query(f"WITH {CALENDAR_SQL} SELECT * FROM calendar")
def calendar(spark, sf_dir):
    return measures.calendar(entries(spark, sf_dir))


@query(f"WITH {t.ENTRIES_SQL} SELECT DISTINCT vendor_id, vendor_name FROM entries")
def dim_vendor(spark, sf_dir):
    return measures.vendor_dimension(entries(spark, sf_dir))


SEVERITY_RANK_SQL = "CAST(CASE severity WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END AS INTEGER)"


@query(f"WITH {t.ENTRIES_SQL} SELECT DISTINCT severity, {SEVERITY_RANK_SQL} AS severity_rank FROM entries")
def dim_severity(spark, sf_dir):
    return measures.severity_dimension(entries(spark, sf_dir))


@query(
    f"""WITH {CALENDAR_SQL} SELECT transaction_id, detected_by, year, month, quarter, weekday, dim_vendor_name,
    {SEVERITY_RANK_SQL} AS severity_rank FROM entries
    JOIN calendar ON transaction_date = date
    JOIN (SELECT vendor_id, min(vendor_name) AS dim_vendor_name FROM entries GROUP BY vendor_id) USING (vendor_id)"""
)
def star_join(spark, sf_dir):
    facts = stored(entries(spark, sf_dir))
    star = measures.star_join(
        facts, measures.calendar(facts), measures.vendor_dimension(facts), measures.severity_dimension(facts)
    )
    return star.select(
        "transaction_id", "detected_by", "year", "month", "quarter", "weekday", "dim_vendor_name", "severity_rank"
    )


@query(
    f"""WITH {t.UNTIDY_ENTRIES_SQL}, {CALENDAR_CTE} SELECT transaction_id, detected_by, coalesce(year, -1) AS year, month,
    quarter, weekday, dim_vendor_name, {SEVERITY_RANK_SQL} AS severity_rank FROM entries
    LEFT JOIN calendar ON transaction_date = date
    JOIN (SELECT vendor_id, min(vendor_name) AS dim_vendor_name FROM entries GROUP BY vendor_id) USING (vendor_id)"""
)
def star_join_untidy(spark, sf_dir):
    """Undated exceptions stay, without attributes of a day (year -1)."""
    facts = stored(untidy_entries(spark, sf_dir))
    star = measures.star_join(
        facts, measures.calendar(facts), measures.vendor_dimension(facts), measures.severity_dimension(facts)
    ).withColumn("year", F.coalesce("year", F.lit(-1)))
    return star.select(
        "transaction_id", "detected_by", "year", "month", "quarter", "weekday", "dim_vendor_name", "severity_rank"
    )


KPI_SQL = """SELECT count(*) AS total_exceptions,
    count(*) FILTER (severity = 'High') AS high_severity_exceptions,
    CAST(sum(amount) AS DECIMAL(28,2)) AS exception_amount,
    coalesce(CAST(count(*) FILTER (severity = 'High') AS DOUBLE) / nullif(CAST(count(*) AS DOUBLE), 0), 0.0)
      AS pct_high_severity,
    count(*) FILTER (exception_type = 'Duplicate Payment') AS duplicate_payments,
    count(*) FILTER (exception_type = 'Missing Invoice Number') AS missing_invoices,
    count(*) FILTER (exception_type = 'Out-of-Hours Transaction') AS out_of_hours,
    count(*) FILTER (exception_type = 'Exceeds Approval Limit') AS over_limit FROM entries"""


@query(f"WITH {t.ENTRIES_SQL} {KPI_SQL}")
def kpi(spark, sf_dir):
    return measures.kpi(entries(spark, sf_dir))


@query(
    f"""WITH {t.ENTRIES_SQL} {KPI_SQL} WHERE severity = 'High' AND transaction_date >= DATE '2024-01-01'
    AND transaction_date < DATE '2024-02-01'"""
)
def sliced_kpi(spark, sf_dir):
    return measures.kpi(entries(spark, sf_dir), severity="High", month="2024-01")


@query(
    f"""WITH {t.ENTRIES_SQL} {KPI_SQL} WHERE severity IN ('High', 'Low') AND (strftime(transaction_date, '%Y-%m') IN
    ('2024-01', '2024-02'))"""
)
def sliced_kpi_multi(spark, sf_dir):
    return measures.kpi(entries(spark, sf_dir), severity=["High", "Low"], month=["2024-01", "2024-02"])


@query(f"WITH {t.ENTRIES_SQL} SELECT severity, count(*) AS total_exceptions FROM entries GROUP BY severity")
def by_severity(spark, sf_dir):
    return measures.by_severity(entries(spark, sf_dir))


@query(f"WITH {t.ENTRIES_SQL} SELECT exception_type, count(*) AS total_exceptions FROM entries GROUP BY exception_type")
def by_type(spark, sf_dir):
    return measures.by_type(entries(spark, sf_dir))


@query(
    f"""WITH {t.ENTRIES_SQL} SELECT strftime(transaction_date, '%Y-%m') AS month, count(*) AS total_exceptions,
    CAST(sum(amount) AS DECIMAL(28,2)) AS exception_amount FROM entries GROUP BY 1"""
)
def by_month(spark, sf_dir):
    return measures.by_month(entries(spark, sf_dir))


@query(
    f"""WITH {t.UNTIDY_ENTRIES_SQL} SELECT strftime(transaction_date, '%Y-%m') AS month, count(*) AS total_exceptions,
    CAST(sum(amount) AS DECIMAL(28,2)) AS exception_amount FROM entries GROUP BY 1"""
)
def by_month_untidy(spark, sf_dir):
    return measures.by_month(untidy_entries(spark, sf_dir))


@query(
    f"""WITH {t.ENTRIES_SQL} SELECT vendor_name, CAST(sum(amount) AS DECIMAL(28,2)) AS exception_amount,
    count(*) AS total_exceptions FROM entries GROUP BY vendor_name
    ORDER BY exception_amount DESC, total_exceptions DESC, vendor_name LIMIT 10"""
)
def top_risky_vendors(spark, sf_dir):
    return measures.top_risky_vendors(entries(spark, sf_dir), 10)


@query(f"WITH {t.REGISTER_SQL} SELECT * FROM register")
def high_severity_first(spark, sf_dir):
    return measures.high_severity_first(register.exception_register(merged(spark, sf_dir)))


@query(
    f"""WITH {t.ENTRIES_SQL} SELECT transaction_id, exception_type, severity, reason, transaction_date, amount, status
    FROM entries WHERE exception_type = 'Exceeds Approval Limit'"""
)
def drill_through(spark, sf_dir):
    tx = t.transactions(spark, sf_dir).select("transaction_id", "transaction_date", "amount", "status")
    return measures.drill_through(entries(spark, sf_dir), tx, exception_type="Exceeds Approval Limit")


# Scalar functions


@query(
    f"""WITH {t.RAW_SQL} SELECT trim(r.transaction_id, ' ' || chr(9)) AS transaction_id, s.vendor_name AS stripped,
    trim(r.transaction_id) AS spaces_only, upper(r.currency) AS upper_case,
    coalesce(CAST(TRY_CAST(s.amount AS DECIMAL(18,2)) AS VARCHAR), 'none') AS as_text,
    s.vendor_id || ' ' || r.status AS joined,
    coalesce(format('{{:,.2f}}', CAST(TRY_CAST(s.amount AS DECIMAL(18,2)) AS DOUBLE)), 'none') AS money,
    lpad(CAST(coalesce(TRY_CAST(substr(r.transaction_time, 1, 2) AS INTEGER), 0) AS VARCHAR), 2, '0') AS two_digits
    FROM raw r JOIN stripped s ON trim(r.transaction_id, ' ' || chr(9)) = s.transaction_id"""
)
def scalar_strings(spark, sf_dir):
    col = F.col
    amount = fn.parse_money(fn.strip(col("amount")))
    return t.raw_text(spark, sf_dir).select(
        fn.strip(col("transaction_id")).alias("transaction_id"),
        fn.strip(col("vendor_name")).alias("stripped"),
        F.trim("transaction_id").alias("spaces_only"),
        F.upper("currency").alias("upper_case"),
        F.coalesce(amount.cast("string"), F.lit("none")).alias("as_text"),
        F.concat(fn.strip(col("vendor_id")), F.lit(" "), col("status")).alias("joined"),
        F.coalesce(fn.money_text(amount), F.lit("none")).alias("money"),
        F.lpad(F.coalesce(fn.hour_of_clock(col("transaction_time")), F.lit(0)).cast("string"), 2, "0").alias("two_digits"),
    )


@query(
    f"""WITH {t.TX_SQL} SELECT transaction_id, invoice_number IS NULL AS is_null, invoice_number IS NOT NULL AS not_null,
    coalesce(invoice_number, 'NO_INVOICE') AS filled, coalesce(invoice_number, '') AS sql_filled,
    coalesce(invoice_number, '?') IN ('', '   ', '?') AS member,
    CASE payment_method WHEN 'error' THEN 'High' WHEN 'purchase' THEN 'Low' ELSE 'Medium' END AS mapped FROM tx"""
)
def scalar_nulls(spark, sf_dir):
    invoice = F.col("invoice_number")
    levels = F.create_map(F.lit("error"), F.lit("High"), F.lit("purchase"), F.lit("Low"))
    return t.transactions(spark, sf_dir).select(
        "transaction_id",
        invoice.isNull().alias("is_null"),
        invoice.isNotNull().alias("not_null"),
        F.coalesce(invoice, F.lit("NO_INVOICE")).alias("filled"),
        F.coalesce(invoice, F.lit("")).alias("sql_filled"),
        F.coalesce(invoice, F.lit("?")).isin("", "   ", "?").alias("member"),
        F.coalesce(levels[F.col("payment_method")], F.lit("Medium")).alias("mapped"),
    )


@query(
    f"""WITH {t.TX_SQL} SELECT transaction_id,
    CAST(strptime(CAST(transaction_date AS VARCHAR), '%Y-%m-%d') AS DATE) AS parsed,
    CAST(hour(CAST(transaction_time AS TIME)) AS INTEGER) AS hour,
    CAST(isodow(transaction_date) - 1 AS INTEGER) AS monday_first,
    CAST(dayofweek(transaction_date) + 1 AS INTEGER) AS sunday_first,
    CAST(date_diff('day', DATE '2024-01-15', transaction_date) AS INTEGER) AS days,
    CAST(abs(date_diff('day', DATE '2024-01-15', transaction_date)) AS INTEGER) AS distance,
    CAST(year(transaction_date) AS INTEGER) AS year, CAST(quarter(transaction_date) AS INTEGER) AS quarter,
    strftime(transaction_date, '%B') AS month_name,
    CAST(epoch(CAST(transaction_time AS TIME)) AS INTEGER) AS seconds FROM tx"""
)
def scalar_dates(spark, sf_dir):
    day, clock, pivot = F.col("transaction_date"), F.col("transaction_time"), F.to_date(F.lit("2024-01-15"))
    return t.transactions(spark, sf_dir).select(
        "transaction_id",
        fn.parse_day(day.cast("string")).alias("parsed"),
        fn.hour_of_clock(fn.parse_clock(clock)).alias("hour"),
        F.weekday(day).alias("monday_first"),
        F.dayofweek(day).alias("sunday_first"),
        fn.day_gap(day, pivot).alias("days"),
        F.abs(fn.day_gap(day, pivot)).alias("distance"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.date_format(day, "MMMM").alias("month_name"),
        fn.clock_seconds(clock).alias("seconds"),
    )


@query(
    f"""WITH {t.MERGED_SQL} SELECT transaction_id, TRY_CAST(CAST(amount AS VARCHAR) AS DECIMAL(18,2)) AS parsed,
    amount > 50 AS above, amount >= 50 AS at_least, amount < 50 AS below,
    CASE WHEN amount > 100 THEN 'large' WHEN amount > 10 THEN 'medium' ELSE 'small' END AS size,
    round_even(CAST(amount AS DOUBLE) / 7.0::DOUBLE, 2) AS seventh,
    CAST(amount - coalesce(approval_limit, 0) AS DECIMAL(19,2)) AS excess,
    coalesce(CAST(amount AS DOUBLE) / nullif(CAST(coalesce(approval_limit, 0) AS DOUBLE), 0), 0.0) AS used FROM merged"""
)
def scalar_math(spark, sf_dir):
    amount = F.col("amount")
    limit = F.coalesce("approval_limit", F.lit(0).cast("decimal(18,2)"))
    return merged(spark, sf_dir).select(
        "transaction_id",
        fn.parse_money(amount.cast("string")).alias("parsed"),
        (amount > 50).alias("above"),
        (amount >= 50).alias("at_least"),
        (amount < 50).alias("below"),
        F.when(amount > 100, "large").when(amount > 10, "medium").otherwise("small").alias("size"),
        F.bround(amount.cast("double") / 7, 2).alias("seventh"),
        (amount - limit).cast("decimal(19,2)").alias("excess"),
        fn.ratio_or_zero(amount, limit).alias("used"),
    )


# Sinks, read back


@query(
    f"""WITH {t.REGISTER_SQL} SELECT {", ".join(
        "nullif(invoice_number, '') AS invoice_number" if c == "invoice_number" else f"CAST({c} AS VARCHAR) AS {c}"
        for c in REGISTER_COLUMNS)} FROM register"""
)
def register_roundtrip(spark, sf_dir):
    found = register.number_exceptions(ranked_entries(spark, sf_dir))
    path = csv.export_exception_register(found, scratch_path(spark, "register"))
    return csv.read_text_table(spark, path, REGISTER_COLUMNS)


def listed_sql(rows: str, name: str, order: str) -> str:
    return f"""SELECT '{name}' AS list, row_number() OVER (ORDER BY {order}, transaction_id) AS position, transaction_id
    FROM (SELECT * FROM tx t {rows})"""


@query(
    f"WITH {t.TX_SQL} "
    + " UNION ALL ".join(
        [
            listed_sql(f"WHERE {EXISTS_SQL}", "Duplicate Payment", "vendor_id NULLS FIRST, transaction_date"),
            listed_sql("WHERE invoice_number IS NULL OR ltrim(rtrim(invoice_number)) = ''", "Missing Invoice Number", "transaction_date NULLS FIRST"),
            listed_sql(
                "WHERE dayofweek(transaction_date) IN (0, 6) OR transaction_time < '09:00:00' OR transaction_time >= '18:00:00'",
                "Out-of-Hours Transaction",
                "transaction_date NULLS FIRST",
            ),
            listed_sql(
                "JOIN (SELECT vendor_id AS v, approval_limit FROM limits) ON vendor_id = v WHERE amount > approval_limit",
                "Exceeds Approval Limit",
                "amount - approval_limit DESC",
            ),
        ]
    )
)
def ordered_lists(spark, sf_dir):
    """The four SQL lists in report order, written and read back with the position their files give them."""
    tx, limits = t.transactions(spark, sf_dir), t.limits(spark, sf_dir)
    lists = {
        "Duplicate Payment": checks.sql_duplicate_payments(tx),
        "Missing Invoice Number": checks.sql_missing_invoices(tx),
        "Out-of-Hours Transaction": checks.sql_out_of_hours(tx),
        "Exceeds Approval Limit": checks.sql_over_limit(tx, limits),
    }
    read = []
    for name, flagged in lists.items():
        path = ordered.write_ordered(flagged, checks.report_order(name), scratch_path(spark, "list"))
        read.append(ordered.read_ordered(spark, path).select(F.lit(name).alias("list"), "position", "transaction_id"))
    return reduce(DataFrame.unionAll, read)


@query(
    f"""WITH {t.ENTRIES_SQL}, by_vendor AS (SELECT vendor_id, vendor_name, count(*) AS "count" FROM entries GROUP BY ALL),
    by_type AS (SELECT exception_type, severity, count(*) AS "count" FROM entries GROUP BY ALL)
    SELECT 'vendor' AS summary, row_number() OVER (ORDER BY "count" DESC, vendor_id NULLS LAST, vendor_name NULLS LAST) AS position,
    vendor_name AS item, "count" FROM by_vendor
    UNION ALL SELECT 'type', row_number() OVER (ORDER BY "count" DESC, exception_type), exception_type, "count" FROM by_type"""
)
def ordered_summaries(spark, sf_dir):
    """Both summaries in their order, written and read back with the position their files give them."""
    found = stored(entries(spark, sf_dir))
    by_vendor, by_type = summaries.summarise_by_vendor(found), summaries.summarise_by_type(found)
    paths = [
        ordered.write_ordered(by_vendor, summaries.vendor_order(), scratch_path(spark, "by_vendor")),
        ordered.write_ordered(by_type, [F.desc("count"), "exception_type"], scratch_path(spark, "by_type")),
    ]
    vendors, types = (ordered.read_ordered(spark, path) for path in paths)
    vendors = vendors.select(F.lit("vendor").alias("summary"), "position", F.col("vendor_name").alias("item"), "count")
    return vendors.unionAll(types.select(F.lit("type").alias("summary"), "position", F.col("exception_type").alias("item"), "count"))


@query(
    f"""WITH {t.ENTRIES_SQL}
    SELECT 'summary_by_type' AS summary, exception_type || '/' || severity AS item, CAST(count(*) AS VARCHAR) AS value
    FROM entries GROUP BY exception_type, severity
    UNION ALL SELECT 'summary_by_vendor', vendor_id || '/' || vendor_name, CAST(count(*) AS VARCHAR) FROM entries
    GROUP BY vendor_id, vendor_name
    UNION ALL SELECT 'data_quality_summary', 'invoice_number', CAST(count(*) FILTER (is_missing_invoice) AS VARCHAR)
    FROM merged
    UNION ALL SELECT 'data_quality_summary', unnest(['amount', 'transaction_date', 'transaction_time']), '0'"""
)
def summaries_roundtrip(spark, sf_dir):
    found = stored(entries(spark, sf_dir))
    paths = csv.export_summaries(
        summaries.summarise_by_type(found),
        summaries.summarise_by_vendor(found),
        summaries.data_quality(prepared(spark, sf_dir)),
        scratch_path(spark, "summaries"),
    )
    items = {
        "summary_by_type": (["exception_type", "severity"], "count"),
        "summary_by_vendor": (["vendor_id", "vendor_name"], "count"),
        "data_quality_summary": (["field"], "missing_count"),
    }
    read = [
        csv.read_text_table(spark, paths[name], [*keys, value]).select(
            F.lit(name).alias("summary"), F.concat_ws("/", *keys).alias("item"), F.col(value).alias("value")
        )
        for name, (keys, value) in items.items()
    ]
    return read[0].unionAll(read[1]).unionAll(read[2])


# Anomaly seeding


def picked_sql(seed: str, kind: str) -> str:
    """Rows in the order of their salted hash, with the number to pick."""
    return f"""{t.TX_SQL},
hashed AS (SELECT *, md5('{seed}:' || transaction_id) AS h FROM tx),
picks AS (
  SELECT *, row_number() OVER (ORDER BY h) <=
         floor(CAST(count(*) OVER () AS DOUBLE) * 0.03::DOUBLE * {seeding.SHARES[kind]}::DOUBLE) AS hit
  FROM hashed)"""


SEED_ID_STEP = 2_000_000_000_000
REST_SQL = "vendor_id, vendor_name, amount, currency, invoice_number, payment_method, status"


@query(
    f"""WITH {picked_sql("dup", "duplicates")} SELECT {t.BASE_SQL} FROM picks
    UNION ALL SELECT CAST(transaction_id + {SEED_ID_STEP} AS BIGINT), transaction_date, transaction_time, {REST_SQL}
    FROM picks WHERE hit"""
)
def seed_duplicates(spark, sf_dir):
    return seeding.seed_duplicates(t.transactions(spark, sf_dir), F.col("transaction_id") + SEED_ID_STEP)


@query(
    f"""WITH {picked_sql("missing", "missing_invoice")} SELECT * EXCLUDE (h, hit)
    REPLACE (CASE WHEN hit THEN '' ELSE invoice_number END AS invoice_number) FROM picks"""
)
def seed_missing_invoice(spark, sf_dir):
    return seeding.seed_missing_invoices(t.transactions(spark, sf_dir))


@query(
    f"""WITH {picked_sql("hours", "out_of_hours")}, halves AS (
    SELECT *, substr(h, 32, 1) IN ('0', '1', '2', '3', '4', '5', '6', '7') AS to_weekend FROM picks)
    SELECT transaction_id, CASE WHEN hit AND to_weekend
    THEN transaction_date + CAST(greatest(6 - isodow(transaction_date), 0) AS INTEGER) ELSE transaction_date END
    AS transaction_date, CASE WHEN hit AND NOT to_weekend THEN '22:35:00' ELSE transaction_time END AS transaction_time,
    {REST_SQL} FROM halves"""
)
def seed_out_of_hours(spark, sf_dir):
    return seeding.seed_out_of_hours(t.transactions(spark, sf_dir))


@query(
    f"""WITH {t.TX_SQL},
hashed AS (
  SELECT tx.*, l.approval_limit, md5('limit:' || transaction_id) AS h
  FROM tx LEFT JOIN limits l ON tx.vendor_id = l.vendor_id),
picks AS (  -- the wanted number of all rows, drawn among those that have a limit
  SELECT *, approval_limit IS NOT NULL AND row_number() OVER (PARTITION BY approval_limit IS NOT NULL ORDER BY h) <=
         floor(CAST(count(*) OVER () AS DOUBLE) * 0.03::DOUBLE * {seeding.SHARES["over_limit"]}::DOUBLE) AS hit
  FROM hashed),
factors AS (
  SELECT *, CAST((floor(CAST(CAST('0x' || substr(h, 25, 8) AS BIGINT) * 9500 AS DOUBLE)
         / 4294967296.0::DOUBLE) + 10500) / 10000.0::DOUBLE AS DECIMAL(6,4)) AS factor
  FROM picks)
    SELECT transaction_id, transaction_date, transaction_time, vendor_id, vendor_name,
    CASE WHEN hit THEN CAST(approval_limit * factor AS DECIMAL(18,2)) ELSE amount END
    AS amount, currency, invoice_number, payment_method, status FROM factors"""
)
def seed_over_limit(spark, sf_dir):
    return seeding.seed_over_limit(t.transactions(spark, sf_dir), t.limits(spark, sf_dir))
