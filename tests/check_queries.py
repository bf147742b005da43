"""Command line: compare all (or named) queries with their SQL, with timings.

    python tests/check_queries.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from pyspark.sql import SparkSession  # noqa: E402

from oracle import compare, connect  # noqa: E402

from meterlake.session import local_session  # noqa: E402
from meterlake.workload.registry import QUERIES  # noqa: E402


def main() -> int:
    sf, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    con, bad = connect(sf), 0
    if os.environ.get("METERLAKE_PLAIN"):
        # A session without our settings, as another caller may bring it.
        spark = SparkSession.builder.master("local[8]").config("spark.driver.memory", "8g").getOrCreate()
        spark.sparkContext.setLogLevel("OFF")
    else:
        spark = local_session(8)
    for name in names:
        query, sql = QUERIES[name]
        began = time.time()
        try:
            df = query(spark, sf)
            problem = compare(df, con, sql) if sql else (None if df.count() else "no rows")
            count = df.count() if len(names) < 4 else ""
        except Exception:
            problem, count = "failed " + traceback.format_exc()[-600:], ""
        bad += problem is not None
        print(f"{name:32s} {time.time() - began:6.2f}s {count} {'ok' if problem is None else problem}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
