"""A run's writes as one: staged beside the lake, marked, applied, and finished by whoever comes next if that breaks off.

A run writes its rows, audit documents and outcomes to a folder of its own below ``<lake>_runs`` and then a marker. From
the marker on the run counts: what is missing of it is applied from the folder, as often as needed, since an upsert and the
overwrite of a batch give the same when repeated. A folder without a marker is of a run that failed earlier, and goes.
One writer at a time, as for the lake itself.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from meterlake.operators import lake, outcome
from meterlake.session import staged

MARKER = "marked.json"


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _folder(lake_path: str) -> str:
    return f"{lake_path.rstrip('/')}_runs"


def pending(spark: SparkSession, lake_path: str) -> dict[str, bool]:
    """Runs that are not finished, in order of their names, and whether they were marked."""
    fs, folder = _fs(spark, _folder(lake_path))
    if not fs.exists(folder):
        return {}
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory())
    return {name: fs.exists(_fs(spark, f"{_folder(lake_path)}/{name}/{MARKER}")[1]) for name in names}


def _mark(spark: SparkSession, folder: str, facts: dict) -> None:
    fs, target = _fs(spark, f"{folder}/{MARKER}")
    out = fs.create(target, True)
    try:
        out.write(bytearray(json.dumps(facts).encode()))
    finally:
        out.close()


def _facts(spark: SparkSession, folder: str) -> dict:
    return json.loads(spark.read.text(f"{folder}/{MARKER}", wholetext=True).first()[0])


def _drop(spark: SparkSession, folder: str) -> None:
    fs, target = _fs(spark, folder)
    fs.delete(target, True)


def _apply(spark: SparkSession, lake_path: str, batch: str) -> None:
    folder = f"{_folder(lake_path)}/{batch}"
    audit_path = _facts(spark, folder)["audit"]
    lake.upsert_readings(spark, lake_path, spark.read.parquet(f"{folder}/rows"))
    if audit_path:
        outcome.write_audit(spark.read.parquet(f"{folder}/audit"), audit_path, batch)
    _drop(spark, folder)


def recover(spark: SparkSession, lake_path: str) -> dict[str, bool]:
    """Finish marked runs, drop unmarked ones; which there were, and whether they were marked."""
    found = pending(spark, lake_path)
    for batch, marked in found.items():
        if marked:
            _apply(spark, lake_path, batch)
        else:
            _drop(spark, f"{_folder(lake_path)}/{batch}")
    return found


def commit(
    spark: SparkSession, lake_path: str, batch: str, rows: DataFrame, audit: DataFrame | None, outcomes: DataFrame, audit_path: str | None
) -> DataFrame:
    """Write a run; returns its outcomes, staged."""
    recover(spark, lake_path)
    folder = f"{_folder(lake_path)}/{batch}"
    rows.write.mode("overwrite").parquet(f"{folder}/rows")
    if audit is not None:
        audit.write.mode("overwrite").parquet(f"{folder}/audit")
    kept = staged(outcomes, "outcomes")
    _mark(spark, folder, {"audit": audit_path})
    _apply(spark, lake_path, batch)
    return kept
