"""Lake table and identifier map to the monthly billing report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterlake.operators import billing
from meterlake.session import staged
from meterlake.sources.mapping import billing_reverse
from meterlake.sources.tables import read_lake


def run(spark: SparkSession, lake_path: str, mapping: DataFrame, out: str, start: str = billing.START) -> DataFrame:
    """Writes the report and returns its statistics. An empty map or report raises and keeps the old file."""
    reverse = billing_reverse(mapping)
    if reverse.isEmpty():
        raise billing.EmptySnapshot("the map has no billing keys")
    rows = read_lake(spark, lake_path, reverse.select("sensor_id"), start)
    wide = staged(billing.snapshot(rows, reverse, start), "snapshot")
    billing.write_snapshot(wide, out)
    return billing.snapshot_stats(wide)
