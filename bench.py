"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from meterlake.session import clear_scratch, local_session
from meterlake.workload.registry import QUERIES

HEADLINE = [
    "nem12_daily_kwh",
    "nem12_parse",
    "nem12_multi_block",
    "nem12_file_scan",
    "nem13_readings",
    "split_multiday",
    "regrid_up",
    "regrid_down",
    "channel_pivot",
    "interval_unpivot",
    "demand_unpivot",
    "billing_unpivot",
    "wide_unpivot",
    "resolve_mapping",
    "file_outcomes",
    "lww_dedupe",
    "upsert_result",
    "lake_upsert_table",
    "offcadence_preview",
    "offcadence_clean",
    "audit_samples",
    "status_or_numeric",
    "ingest_mixed",
    "reingest_window",
    "site_import",
    "lake_csv_rejects",
    "nem13_ingest_days",
    "stream_upsert",
    "billing_snapshot",
    "billing_currency",
    "site_diff",
    "points_to_create",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    spark.read.parquet(f"{sf}/events.parquet").count()
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        began = time.perf_counter()
        QUERIES[name][0](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
        clear_scratch(spark)
    scale = re.search(r"sf([0-9.]+)", sf)
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
