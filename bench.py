"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; print one JSON line.

Every query runs once to warm up, then RUNS times into a no-op sink with plan
building and eager steps included; the best run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerlens.plans import workload  # noqa: E402
from ledgerlens.plans.session import local_session  # noqa: E402

RUNS = 2
HEADLINE = [
    "clean_transactions",
    "join_left_limits",
    "missing_invoice",
    "out_of_hours",
    "over_limit",
    "duplicate_window",
    "duplicate_semi_join",
    "run_all_checks",
    "exception_register_single_pass",
    "summary_by_type",
    "summary_by_vendor",
    "data_quality",
    "exception_counts",
    "validation_report",
    "v_pk",
    "kpi",
    "star_join",
    "seed_over_limit",
    "day_gap",
    "duplicate_clusters",
    "exception_register",
    "register_roundtrip",
]


def timed(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    workload.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    for name in names:
        timed(spark, sf_dir, name)
    seconds = {name: round(min(timed(spark, sf_dir, name) for _ in range(RUNS)), 3) for name in names}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
