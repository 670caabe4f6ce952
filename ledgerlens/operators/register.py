"""The exception register: one row per (transaction, check) with severity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlens.operators.checks import audit_rules, merge_with_vendor_limits
from ledgerlens.operators.duplicates import Candidates, duplicate_rows
from ledgerlens.operators.ids import with_dense_id
from ledgerlens.schema import (
    BASE_COLUMNS,
    CHECKS,
    DEFAULT_SEVERITY,
    DUPLICATE,
    REGISTER_COLUMNS,
    SEVERITY,
    AuditSettings,
)

ENTRY_COLUMNS = [c for c in REGISTER_COLUMNS if c != "exception_id"]
RANK = "check_rank"
DUPLICATE_CHECK = CHECKS[0]


def severity_of(exception_type: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in SEVERITY.items() for x in pair])
    return F.coalesce(known[exception_type], F.lit(DEFAULT_SEVERITY))


def assign_severity(flagged: DataFrame) -> DataFrame:
    return flagged.withColumn("severity", severity_of(F.col("exception_type")))


def register_order() -> list[Column]:
    """Check by check; duplicates by date, the others in transaction order."""
    dated = F.when(F.col("exception_type") == DUPLICATE, F.col("transaction_date"))
    return [F.col(RANK), dated.asc_nulls_last(), F.col("transaction_id")]


def found_per_check() -> dict[str, Column]:
    """Register rows of each check, as metrics of the write that numbers them."""
    return {check: F.count_if(F.col("detected_by") == check) for check in CHECKS}


def number_exceptions(entries: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Number the register, stored once; `observation` takes the rows of each check in that write."""
    numbered = with_dense_id(entries, register_order(), "exception_id", observation, found_per_check())
    return numbered.select(*REGISTER_COLUMNS)


def union_entries(results: dict[str, DataFrame]) -> DataFrame:
    """Stack check results by column name, tagged with the check that found them.

    An empty result adds nothing and keeps the schema.
    """
    tagged = [
        df.withColumn("detected_by", F.lit(check)).withColumn(RANK, F.lit(rank))
        for rank, (check, df) in enumerate(results.items())
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    kept = [c for c in ENTRY_COLUMNS if c in stacked.columns or c == "severity"]
    return assign_severity(stacked).select(*kept, RANK)


def build_register(results: dict[str, DataFrame]) -> DataFrame:
    """Register out of separate check results, numbered 1..n."""
    return number_exceptions(union_entries(results))


def exception_entries(
    merged: DataFrame, settings: AuditSettings = AuditSettings(), payments: DataFrame | Candidates | None = None
) -> DataFrame:
    """Register rows, still unnumbered.

    The three row-local rules share one scan and no shuffle: each row explodes
    into the ranks of the rules it breaks. Type, reason and severity are looked
    up after that, so a summary that needs none of them computes none of them.
    Only duplicates need other rows, and only their candidates are shuffled.

    Duplicates are sought in `payments`, the rows without limits or their stored
    candidates. Without them it is the merged rows: where a vendor has several limits, the
    merge repeats its payments, and these repeats count as duplicates of each other.
    """
    rules = audit_rules(settings)
    rank = F.col(RANK)
    local = [F.when(r.fires, F.lit(i)) for i, r in enumerate(rules) if r.check != DUPLICATE_CHECK]
    broken = merged.withColumn(RANK, F.explode(F.array_compact(F.array(*local))))
    source = merged if payments is None else payments
    duplicated = duplicate_rows(source, settings.dup_window_days).withColumn(RANK, F.lit(0))
    by_rank = lambda texts: F.element_at(F.array(*[F.lit(t) for t in texts]), rank + 1)
    texts = {
        "exception_type": by_rank([r.exception_type for r in rules]),
        "reason": F.coalesce(*[F.when(rank == i, r.reason) for i, r in enumerate(rules)]),
        "detected_by": by_rank([r.check for r in rules]),
    }
    return (
        duplicated.unionByName(broken, allowMissingColumns=True)
        .withColumns(texts)
        .transform(assign_severity)
        .select(*BASE_COLUMNS, "exception_type", "reason", "severity", "detected_by", RANK)
    )


def audited_entries(transactions: DataFrame, limits: DataFrame, settings: AuditSettings = AuditSettings()) -> DataFrame:
    """Register rows of prepared transactions against limits; duplicates do without the limit join, unless a vendor has several."""
    repeated = limits.groupBy("vendor_id").count().filter("count > 1 AND vendor_id IS NOT NULL")
    merged = merge_with_vendor_limits(transactions, limits)
    return exception_entries(merged, settings, transactions if repeated.isEmpty() else None)


def exception_register(
    merged: DataFrame,
    settings: AuditSettings = AuditSettings(),
    payments: DataFrame | Candidates | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """Numbered register over prepared, limit-merged transactions; see `exception_entries`."""
    return number_exceptions(exception_entries(merged, settings, payments), observation)


def checks_per_transaction(register: DataFrame) -> DataFrame:
    """Which checks flagged each transaction: at most four names a row."""
    checks = register.groupBy("transaction_id").agg(F.array_sort(F.collect_set("detected_by")).alias("checks"))
    return checks.withColumn("check_count", F.size("checks").cast("long"))
