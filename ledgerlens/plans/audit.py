"""The whole audit: files in, register and summaries out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import cleaning, register, summaries
from ledgerlens.operators.checks import merge_with_vendor_limits
from ledgerlens.operators.duplicates import Candidates, store_candidates
from ledgerlens.operators.joins import fits_broadcast
from ledgerlens.schema import CHECKS, AuditSettings
from ledgerlens.sources import csv
from ledgerlens.sources.scratch import discard, run_folder, stored


@dataclass(frozen=True)
class AuditResult:
    transactions: DataFrame
    register: DataFrame
    by_type: DataFrame
    by_vendor: DataFrame
    data_quality: DataFrame
    row_counts: DataFrame
    candidates: Candidates | None = None  # bucketed by group, for more duplicate rules; None if the merge repeats payments
    run_folder: str | None = None  # holds the intermediate tables of run_audit

    def discard(self) -> None:
        """Delete the intermediate tables; the frames can't be read after that, the written results can."""
        if self.candidates:
            self.candidates.discard()
        if self.run_folder:
            discard(self.transactions.sparkSession, self.run_folder)


def audit(
    transactions: DataFrame,
    limits: DataFrame,
    settings: AuditSettings = AuditSettings(),
    known_counts: Callable[[], dict[str, int]] | None = None,
) -> AuditResult:
    """Audit cleaned transactions against cleaned vendor limits.

    Numbering the register stores it, so the summaries read the stored register
    instead of running the checks again. Where the limits are too many to
    broadcast, the merged table is stored too: it is shuffled once, not per check.
    The duplicate candidates are stored bucketed by group, for the register and for any other duplicate rule.
    `known_counts` gives the rows of both inputs, if they were counted as they were written; the rows
    of each check are counted in the write of the register.
    """
    merged = merge_with_vendor_limits(transactions, limits)
    repeated = limits.groupBy("vendor_id").count().filter("count > 1 AND vendor_id IS NOT NULL")
    candidates = store_candidates(transactions) if repeated.isEmpty() else None
    if not fits_broadcast(limits):
        merged = stored(merged)
    per_check = Observation()
    found = register.exception_register(merged, settings, candidates, per_check)
    if known_counts:
        spark, counts = transactions.sparkSession, known_counts() | per_check.get
        row_counts = summaries.observed_row_counts(spark, counts)
    else:
        row_counts = summaries.row_counts(transactions, limits, found, CHECKS)
    return AuditResult(
        transactions=transactions,
        register=found,
        by_type=summaries.summarise_by_type(found),
        by_vendor=summaries.summarise_by_vendor(found),
        data_quality=summaries.data_quality(transactions),
        row_counts=row_counts,
        candidates=candidates,
    )


def run_audit(
    spark: SparkSession,
    transactions_path: str,
    limits_path: str,
    out_dir: str,
    settings: AuditSettings = AuditSettings(),
    fmt: str = "csv",
    multiline: bool = False,
    dates_with_time: bool = False,
) -> AuditResult:
    """Read both CSV tables, audit them and write the four result tables to `out_dir`.

    The cleaned transactions are stored once: the checks read them several times,
    each time other columns, and text would be parsed anew. Rows are counted
    as they are written, so no job only counts. The frames of the
    result read intermediate tables, which the caller deletes by `discard()`.
    """
    with run_folder(spark) as folder:
        raw = csv.load_transactions(spark, transactions_path, multiline)
        counted = {name: Observation() for name in ("transactions", "vendors")}
        rows = {"rows": F.count("*")}
        transactions = stored(cleaning.clean_transactions(raw, dates_with_time), counted["transactions"], rows)
        raw_limits = csv.load_vendor_limits(spark, limits_path, multiline)
        limits = stored(cleaning.clean_vendor_limits(raw_limits), counted["vendors"], rows)
        counts = lambda: {name: seen.get["rows"] for name, seen in counted.items()}
        result = replace(audit(transactions, limits, settings, counts), run_folder=folder)
        csv.export_exception_register(result.register, out_dir, fmt)
        csv.export_summaries(result.by_type, result.by_vendor, result.data_quality, out_dir, fmt)
    return result
