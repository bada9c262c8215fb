"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local cores. Every query is
computed in full through the no-op sink; the time covers planning, intermediate tables and execution.
"""

from __future__ import annotations

import json
import os
import time

from tidemark.checks.queries import QUERIES, RUN
from tidemark.plans.migration import migrate
from tidemark.session import local_session, scratch_path
from tidemark.sources import bank_views

HEADLINE = (
    "pr1_lineage_transaction",
    "pr5_vf4_staging_transaction",
    "rj07_12_pr8_quarantine_account",
    "rj13_20_pr8_quarantine_transaction",
    "rj21_25_pr8_quarantine_daily_balance",
    "gt1_ag7_staging_gate_transaction",
    "jn9_st3_rp3_rejected_amount",
    "jn10_rp4_compare_by_type",
    "jn8_transactions_missing_either_account",
    "ag8_duplicate_line_keys",
    "ag12_double_entry_rollup",
    "wn2_roll_forward_failures",
    "ck_all_constraints",
    "rp1_source_profile",
    "rp2_fn15_reconcile_transactions",
    "rp5_reconcile_financials",
    "io2_io4_landing_manifest_transaction",
    "dd1_latest_version",
    "dd2_changes_between_batches",
    "sh1_account_status_history",
    "in1_incremental_slices",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cores, shuffle_partitions=int(cores), app="tidemark-bench")
    spark.read.parquet(f"{folder}/nation.parquet").count()  # start the executor before the clock runs

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    started = time.perf_counter()
    migrate(bank_views.bank(spark, folder).settled("transaction", "daily_balance"), RUN, scratch_path(spark, "migration"))
    seconds["migrate"] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
