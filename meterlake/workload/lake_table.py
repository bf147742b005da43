"""Queries on the reading table: newest row, upsert, delete, cadence, scans, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake.functions.stamps import floor_minutes
from meterlake.operators import cadence, lake
from meterlake.operators.dedupe import last_write_wins
from meterlake.session import scratch_dir
from meterlake.sources.tables import read_lake, read_lake_csv
from meterlake.streaming import ingest as streaming
from meterlake.workload.feeds import (
    LAKE_SQL,
    MAP_SQL,
    METER_SQL,
    lake_rows,
    meter_map,
    nem12_blocks,
)

COLUMNS = ["sensorId", "ts", "val", "quality"]


def daily_lake(spark, sf):
    """Lake rows stamped to the day, so that keys repeat; event_id is the order of arrival."""
    rows = lake_rows(spark, sf).withColumn("ts", floor_minutes(F.col("ts"), 1440))
    return rows.withColumn("its", F.col("ts"))


DAILY_SQL = f"""{LAKE_SQL},
daily AS (SELECT sensorId, date_trunc('day', ts)::TIMESTAMP AS ts, val, quality, event_id FROM lake)
"""


def _newest(rows: str, where: str = "TRUE") -> str:
    return f"""(SELECT sensorId, ts, val, quality FROM {rows} WHERE {where}
      QUALIFY row_number() OVER (PARTITION BY sensorId, ts ORDER BY event_id DESC) = 1)"""


def lww_dedupe(spark, sf):
    return last_write_wins(daily_lake(spark, sf), order=["event_id"]).select(*COLUMNS)


LWW_SQL = f"WITH {DAILY_SQL} SELECT * FROM {_newest('daily')}"


def _halves(spark, sf):
    rows = daily_lake(spark, sf)
    stored = last_write_wins(rows.filter(F.col("event_id") % 3 != 0), order=["event_id"])
    batch = last_write_wins(rows.filter(F.col("event_id") % 3 == 0), order=["event_id"])
    return stored.select(*COLUMNS), batch.select(*COLUMNS)


def upsert_result(spark, sf):
    return lake.merged(*_halves(spark, sf))


UPSERT_SQL = f"""WITH {DAILY_SQL},
b AS {_newest('daily', 'event_id % 3 = 0')}, s AS {_newest('daily', 'event_id % 3 <> 0')}
SELECT * FROM b UNION ALL SELECT s.* FROM s ANTI JOIN b USING (sensorId, ts)"""


def delete_result(spark, sf):
    return lake.without(*_halves(spark, sf))


DELETE_SQL = f"""WITH {DAILY_SQL},
b AS {_newest('daily', 'event_id % 3 = 0')}, s AS {_newest('daily', 'event_id % 3 <> 0')}
SELECT s.* FROM s ANTI JOIN b USING (sensorId, ts)"""


def _table(spark, sf, name):
    """The table after two upserts, the second one run twice."""
    path = scratch_dir(spark, name)
    rows = daily_lake(spark, sf).withColumn("ats", F.col("event_id"))
    columns = ["sensorId", "ts", "val", "unit", "its", "quality", "ats"]
    first = rows.filter(F.col("event_id") % 3 != 0).select(*columns)
    second = rows.filter(F.col("event_id") % 3 == 0).select(*columns)
    for batch in (first, second, second):
        lake.upsert_readings(spark, path, batch)
    return path


def lake_upsert_table(spark, sf):
    return spark.read.parquet(_table(spark, sf, "upsert")).select(*COLUMNS, "its_year", "its_month")


UPSERT_TABLE_SQL = f"""SELECT *, CAST(year(ts) AS INTEGER) AS its_year, CAST(month(ts) AS INTEGER) AS its_month FROM ({UPSERT_SQL})"""


def lake_delete_table(spark, sf):
    path = _table(spark, sf, "delete")
    gone = spark.read.parquet(path).filter(F.col("quality") == "E52")
    lake.delete(spark, path, gone)
    return spark.read.parquet(path).select(*COLUMNS)


DELETE_TABLE_SQL = f"SELECT * FROM ({UPSERT_SQL}) WHERE quality IS DISTINCT FROM 'E52'"


def lake_scan(spark, sf):
    """Rows of mapped sensors from a date on, from the partitioned table."""
    path = _table(spark, sf, "scan")
    return read_lake(spark, path, meter_map(spark, sf).select("sensor_id"), "2024-01-15").select(*COLUMNS)


SCAN_SQL = f"""WITH {MAP_SQL}, u AS ({UPSERT_SQL})
SELECT u.* FROM u SEMI JOIN mm ON mm.sensor_id = u.sensorId WHERE ts >= TIMESTAMP '2024-01-15'"""


def lake_csv_roundtrip(spark, sf):
    """Lake-source CSV written and scanned with its fixed schema."""
    path = scratch_dir(spark, "lake-csv")
    lake.write_lake_csv(lake_rows(spark, sf), path)
    rows = read_lake_csv(spark, path)
    return rows.filter(F.col("ats").isNotNull()).select(*COLUMNS, "unit", F.col("its").cast("timestamp_ntz").alias("its"))


CSV_SQL = f"WITH {LAKE_SQL} SELECT sensorId, ts, val, quality, unit, ts AS its FROM lake"

# ---- cadence ------------------------------------------------------------------

YEARS = [2023, 2024]
BOUNDS = {"start": "2024-01-03 00:00:00", "end": "2024-01-25 00:00:00"}
OFF_SQL = """
off AS (
  SELECT lake.* FROM lake SEMI JOIN mm ON mm.sensor_id = lake.sensorId
  WHERE its_year IN (2023, 2024) AND minute(ts) NOT IN (0, 30)
    AND ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-25')
"""


def _lake(spark, sf):
    return lake.with_partitions(lake_rows(spark, sf))


def _off(spark, sf):
    return cadence.off_cadence(_lake(spark, sf), meter_map(spark, sf).select("sensor_id"), YEARS, **BOUNDS)


def offcadence_preview(spark, sf):
    return cadence.preview(_off(spark, sf))


PREVIEW_SQL = f"""WITH {LAKE_SQL}, {MAP_SQL}, {OFF_SQL}
SELECT its_year, CAST(minute(ts) AS INTEGER) AS off_minute, count(*) AS rows, count(DISTINCT sensorId) AS sensors,
  min(ts) AS first_ts, max(ts) AS last_ts FROM off GROUP BY 1, 2"""


def offcadence_clean(spark, sf):
    return lake.without(_lake(spark, sf), _off(spark, sf)).select(*COLUMNS)


CLEAN_SQL = f"""WITH {LAKE_SQL}, {MAP_SQL}, {OFF_SQL}
SELECT sensorId, ts, val, quality FROM lake ANTI JOIN off USING (sensorId, ts)"""


def cadence_profile(spark, sf):
    return cadence.profile(lake_rows(spark, sf))


PROFILE_SQL = f"WITH {LAKE_SQL} SELECT CAST(minute(ts) AS INTEGER) AS minute, count(*) AS rows FROM lake GROUP BY 1"


def offcadence_purge_table(spark, sf):
    """Dry run, then the purge, on a written table."""
    path = scratch_dir(spark, "purge")
    lake.upsert_readings(spark, path, lake_rows(spark, sf).withColumn("ats", F.col("event_id")))
    sensors = meter_map(spark, sf).select("sensor_id")
    cadence.purge(spark, path, sensors, YEARS, dry_run=True, **BOUNDS)
    cadence.purge(spark, path, sensors, YEARS, dry_run=False, **BOUNDS)
    return spark.read.parquet(path).select(*COLUMNS)


PURGE_SQL = f"""WITH {LAKE_SQL}, {MAP_SQL}, {OFF_SQL}, l AS {_newest('lake')}
SELECT * FROM l ANTI JOIN off USING (sensorId, ts)"""

# ---- streams ------------------------------------------------------------------


def stream_upsert(spark, sf):
    """Lake CSV files through the stream in small micro-batches, twice; the second run finds nothing new."""
    base = scratch_dir(spark, "stream")
    rows = last_write_wins(lake_rows(spark, sf), order=["event_id"])
    for part in range(3):
        lake.write_lake_csv(rows.filter(F.pmod("event_id", F.lit(3)) == part), f"{base}/in")
    for _ in range(2):
        streaming.lake_rows(spark, f"{base}/in", f"{base}/lake", f"{base}/checkpoint", max_files=8).awaitTermination()
    return spark.read.parquet(f"{base}/lake").select(*COLUMNS)


STREAM_SQL = f"WITH {LAKE_SQL} SELECT * FROM {_newest('lake')}"


def stream_ingest_once(spark, sf):
    """Meter files through the stream into the lake; a second run reads no file again."""
    base = scratch_dir(spark, "arrivals")
    nem12_blocks(spark, sf).select("text").write.text(f"{base}/in")
    for _ in range(2):
        streaming.source_files(
            spark, f"{base}/in", meter_map(spark, sf), f"{base}/lake", f"{base}/checkpoint", max_files=400
        ).awaitTermination()
    return spark.read.parquet(f"{base}/lake").select("sensorId", "ts", "val", "unit")


ONCE_SQL = f"""WITH {METER_SQL}, {MAP_SQL}
SELECT sensor_id AS sensorId, t_start AS ts, val, unit FROM slots JOIN mm ON lookup_key = nmi || '-' || suffix
WHERE suffix <> 'X9'"""

QUERIES = {
    "lww_dedupe": (lww_dedupe, LWW_SQL),
    "upsert_result": (upsert_result, UPSERT_SQL),
    "delete_result": (delete_result, DELETE_SQL),
    "lake_upsert_table": (lake_upsert_table, UPSERT_TABLE_SQL),
    "lake_delete_table": (lake_delete_table, DELETE_TABLE_SQL),
    "lake_scan": (lake_scan, SCAN_SQL),
    "lake_csv_roundtrip": (lake_csv_roundtrip, CSV_SQL),
    "offcadence_preview": (offcadence_preview, PREVIEW_SQL),
    "offcadence_clean": (offcadence_clean, CLEAN_SQL),
    "cadence_profile": (cadence_profile, PROFILE_SQL),
    "offcadence_purge_table": (offcadence_purge_table, PURGE_SQL),
    "stream_upsert": (stream_upsert, STREAM_SQL),
    "stream_ingest_once": (stream_ingest_once, ONCE_SQL),
}
