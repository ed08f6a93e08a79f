"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data (default sf0.1), ``BENCH_CPUS`` the local cores.
Every result is computed in full (a ``noop`` write), after one untimed warm-up.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from checks.compare import local_session
from checks.queries import queries

HEADLINE = (
    "scan_csv_infer",
    "bronze_ingest",
    "record_hash",
    "name_standardize",
    "dedupe_record_hash",
    "dq_report",
    "condition_summary",
    "billing_summary",
    "patient_demographics",
    "mode_ties_all",
    "top1_insurer_total",
    "sink_partitioned_pruned",
    "upsert_single_key",
    "upsert_composite_key",
    "upsert_partitioned",
    "compact_rows_preserved",
    "cluster_zorder_two_cols",
    "medallion_end_to_end",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, **{"spark.sql.shuffle.partitions": cores})
    every = queries()
    every["condition_summary"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        every[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "headline queries, total seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
