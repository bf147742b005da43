"""Queries on data that changes: corrected files, windows delivered again, batch totals, site imports, and small sources."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from meterlake.functions.stamps import floor_minutes
from meterlake.operators import lake, outcome, resolve, series, sites
from meterlake.operators.dedupe import last_write_wins
from meterlake.plans import ingest
from meterlake.schemas import LAKE_CSV
from meterlake.session import scratch_dir, staged
from meterlake.sources import tables
from meterlake.sources.mapping import read_whitelist
from meterlake.streaming import arrivals, totals
from meterlake.streaming import ingest as streaming
from meterlake.workload import reports
from meterlake.workload import vendor_files as vf
from meterlake.workload.accounting import OUTCOME_SQL
from meterlake.workload.feeds import LAKE_SQL, MAP_SQL, METER_SQL, lake_rows, meter_map, nem12_blocks, nem12_lines, table
from meterlake.workload.lake_table import COLUMNS
from meterlake.workload.meter_files import OVERLAY_SQL, register_lines

# ---- a window delivered again ---------------------------------------------------

WINDOW = ("2024-01-08 00:00:00", "2024-01-20 00:00:00")


def _days(spark, sf):
    rows = lake_rows(spark, sf).withColumn("ts", floor_minutes(F.col("ts"), 1440)).withColumn("its", F.col("ts"))
    return rows.withColumn("ats", F.col("event_id"))


def reingest_window(spark, sf):
    """Every second user's readings of a window come again, some changed, some new, some withdrawn."""
    path, rows = scratch_dir(spark, "window"), _days(spark, sf)
    keep = [*COLUMNS, "unit", "its", "ats"]
    lake.upsert_readings(spark, path, rows.filter("event_id % 3 <> 0").select(*keep))
    again = rows.filter("user_id % 2 = 0 and event_id % 4 <> 1").withColumn("val", F.col("val") + 1).select(*keep)
    for _ in range(2):
        lake.replace_window(spark, path, again, *WINDOW)
    return spark.read.parquet(path).select(*COLUMNS)


REINGEST_SQL = f"""WITH {LAKE_SQL},
d AS (SELECT sensorId, date_trunc('day', ts)::TIMESTAMP AS ts, val, quality, event_id, user_id FROM lake),
held AS (SELECT * FROM d WHERE event_id % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY sensorId, ts ORDER BY event_id DESC) = 1),
again AS (SELECT * FROM d WHERE user_id % 2 = 0 AND event_id % 4 <> 1 AND ts >= TIMESTAMP '{WINDOW[0]}' AND ts < TIMESTAMP '{WINDOW[1]}'
  QUALIFY row_number() OVER (PARTITION BY sensorId, ts ORDER BY event_id DESC) = 1)
SELECT sensorId, ts, val + 1 AS val, quality FROM again
UNION ALL SELECT sensorId, ts, val, quality FROM held
WHERE NOT (ts >= TIMESTAMP '{WINDOW[0]}' AND ts < TIMESTAMP '{WINDOW[1]}' AND sensorId IN (SELECT sensorId FROM again))"""

# ---- a file written again at its path ---------------------------------------------


def _put(spark, text, path):
    """Write a text column as one file at a path that may have one already."""
    parts = scratch_dir(spark, "put")
    text.coalesce(1).write.text(parts)
    made = next(r["path"] for r in tables.manifest(spark, parts).filter("path like '%part-%'").select("path").collect())
    jvm = spark._jvm.org.apache.hadoop.fs
    fs, target = jvm.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), jvm.Path(path)
    fs.mkdirs(target.getParent())
    fs.delete(target, False)
    fs.rename(jvm.Path(made), target)


def put_files(spark, text, folder, prefix):
    """Write a text column as files ``<prefix>-<n>.csv``, one for every task that writes, in place of those that are there."""
    parts = scratch_dir(spark, "put")
    text.write.text(parts)
    made = [r["path"] for r in tables.manifest(spark, parts).filter("path like '%/part-%' and size > 0").select("path").orderBy("path").collect()]
    jvm = spark._jvm.org.apache.hadoop.fs
    target = jvm.Path(folder)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    for old in fs.globStatus(jvm.Path(f"{folder}/{prefix}-*.csv")):
        fs.delete(old.getPath(), False)
    for n, path in enumerate(made):
        fs.rename(jvm.Path(path), jvm.Path(f"{folder}/{prefix}-{n:05d}.csv"))


def redelivered_file(spark, sf):
    """Meter files of four parts; those of one are written again with other qualities, then all are polled once more unchanged."""
    base = scratch_dir(spark, "redelivered")
    by_part = nem12_blocks(spark, sf).withColumn("part", F.regexp_extract("nmi", "([0-9]+)$", 1).cast("int") % 4).select("part", "text")
    by_part.write.partitionBy("part").parquet(f"{base}/blocks")
    blocks = spark.read.schema(by_part.schema).parquet(f"{base}/blocks")

    def drain():
        arrivals.source_files(spark, f"{base}/in", meter_map(spark, sf), f"{base}/lake", base).awaitTermination()

    for part in range(4):
        put_files(spark, blocks.filter(F.col("part") == part).select("text"), f"{base}/in", f"part-{part}")
    drain()
    changed = F.replace("text", F.lit(",A,,,,"), F.lit(",F14,,,,"))
    put_files(spark, blocks.filter("part = 1").select(changed.alias("text")), f"{base}/in", "part-1")
    drain()
    drain()
    return spark.read.parquet(f"{base}/lake").select(*COLUMNS, "unit")


REDELIVERED_SQL = f"""WITH {METER_SQL}, {MAP_SQL},
q AS ({OVERLAY_SQL})
SELECT sensor_id AS sensorId, slots.t_start AS ts, val, CASE WHEN q.quality = 'A' AND user_id % 4 = 1 THEN 'F14' ELSE q.quality END AS quality, unit
FROM slots JOIN mm ON lookup_key = nmi || '-' || suffix JOIN q ON q.nmi = slots.nmi AND q.suffix = slots.suffix AND q.t_start = slots.t_start
WHERE slots.suffix <> 'X9'"""

# ---- lake CSV: lines that do not fit, totals of batches -----------------------------


def _csv_text(rows):
    """Lake rows as CSV cells; every seventh value is no number, every eleventh stamp no stamp."""
    bad = F.when(F.col("event_id") % 7 == 0, F.lit("n/a")).otherwise(F.col("val").cast("string"))
    ts = F.when(F.col("event_id") % 11 == 0, F.lit("soon")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return rows.select("sensorId", ts.alias("ts"), bad.alias("val"), "unit", F.date_format("its", "yyyy-MM-dd HH:mm:ss").alias("its"), "quality")


def lake_csv_rejects(spark, sf):
    path = scratch_dir(spark, "rejects")
    _csv_text(lake_rows(spark, sf)).write.option("header", True).csv(path)
    held = staged(tables.scan_lake_csv(spark, path), "scanned")
    good = held.filter(F.col(tables.CORRUPT).isNull()).groupBy("sensorId").agg(F.count("*").alias("lines"))
    line = F.split("line", ",")
    bad = tables.rejects(held).groupBy(F.get(line, F.lit(0)).alias("sensorId")).agg(F.count("*").alias("lines"))
    return good.withColumn("kept", F.lit(True)).unionByName(bad.withColumn("kept", F.lit(False)))


REJECTS_SQL = f"""WITH {LAKE_SQL}
SELECT sensorId, event_id % 7 <> 0 AND event_id % 11 <> 0 AS kept, count(*) AS lines FROM lake GROUP BY ALL"""


def batch_totals(spark, sf):
    """Three files, one of them with nothing but a header, one batch each; what the listener wrote down."""
    base = scratch_dir(spark, "totals")
    rows = lake_rows(spark, sf)
    for part in (0, 1, 2):
        lines = _csv_text(rows.filter(F.col("event_id") % 3 == part) if part < 2 else rows.limit(0))
        text = lines.select(F.array_join(F.array(*[F.coalesce(c, F.lit("")) for c in lines.columns]), ",").alias("value"))
        header = spark.createDataFrame([(",".join(LAKE_CSV.fieldNames()),)], "value string")
        _put(spark, header.unionByName(text), f"{base}/in/{part}.csv")
    listener = totals.BatchTotals(spark, f"{base}/totals")
    spark.streams.addListener(listener)
    try:
        streaming.lake_rows(spark, f"{base}/in", f"{base}/lake", f"{base}/checkpoint", max_files=1).awaitTermination()
        listener.settle(spark)
    finally:
        spark.streams.removeListener(listener)
    return totals.read_totals(spark, f"{base}/totals").select("batch_id", "rows", "rejected", "without_value")


TOTALS_SQL = f"""WITH {LAKE_SQL}
SELECT b.batch_id, count(*) FILTER (event_id % 7 <> 0 AND event_id % 11 <> 0) AS rows,
  count(*) FILTER (event_id % 7 = 0 OR event_id % 11 = 0) AS rejected, CAST(0 AS BIGINT) AS without_value
FROM (VALUES (0::BIGINT), (1::BIGINT), (2::BIGINT)) b(batch_id) LEFT JOIN lake ON event_id % 3 = b.batch_id AND b.batch_id < 2 GROUP BY 1"""

# ---- sites ------------------------------------------------------------------------


def site_import(spark, sf):
    """The incoming sites into a stored table, not forced and forced: sites as stored then, with what the ledger says of each."""
    incoming, held = reports.incoming_sites(spark, sf), reports.stored_sites(spark, sf)
    out = []
    for force in (False, True):
        path = scratch_dir(spark, "sites")
        lake.upsert(spark, path, held, sites.SITE_KEY, [], sites.COMPARED)
        for _ in range(2):
            ledger = sites.import_sites(spark, path, incoming, "import-1", force)
        said = ledger.select(*sites.SITE_KEY, "decision", F.col("stored.siteName").alias("before"))
        out.append(spark.read.parquet(path).join(said, sites.SITE_KEY, "left").withColumn("force", F.lit(force)))
    return out[0].unionByName(out[1]).select("force", "project", "nmi", "siteIdStr", "siteName", "decision", "before")


SITE_IMPORT_SQL = f"""WITH d AS ({reports.DIFF_SQL}), f(force) AS (VALUES (FALSE), (TRUE))
SELECT force, '{reports.PROJECT}' AS project, nmi, siteIdStr, CASE WHEN state = 'CONFLICT' AND NOT force THEN 'old name' ELSE siteName END AS siteName,
  CASE WHEN state = 'NEW' THEN 'inserted' WHEN state = 'CONFLICT' THEN CASE WHEN force THEN 'replaced' ELSE 'skipped' END END AS decision,
  CASE WHEN state = 'CONFLICT' THEN 'old name' END AS before FROM d, f"""


def usable_sites(spark, sf):
    """Sites with both ids; a country only where one is known."""
    rows = tables.normalise_sites(reports._site_rows(spark, sf))
    known = rows.withColumn("country", F.when(F.length("nmi") % 2 == 0, F.lit("NZ")))
    blank = [F.nullif(F.col(c), F.lit("")).alias(c) for c in ("nmi", "siteIdStr")]
    return sites.usable_sites(known.select(*blank, "siteName", "country")).select("nmi", "siteIdStr", "country")


USABLE_SQL = f"""WITH {reports.SITES_SQL}
SELECT nmi, siteIdStr, CASE WHEN length(nmi) % 2 = 0 THEN 'NZ' ELSE 'AU' END AS country FROM good"""

# ---- ingest -------------------------------------------------------------------------


def nem13_ingest_days(spark, sf):
    """Register reads over weeks through the whole job: readings of each sensor and day that reach the lake."""
    header = table(spark, sf, "lineitem").select(F.concat(F.lit("register-"), F.col("l_suppkey") % 20, F.lit(".csv")).alias("file")).distinct()
    header = header.select("file", F.lit(0).cast("long").alias("split"), F.lit(0).cast("long").alias("pos"), F.lit("100,NEM13,202402010000,MDP1,Retailer1").alias("line"))
    lines = staged(header.unionByName(register_lines(spark, sf)), "register-lines")
    rows = ingest.ingest_lines(lines, meter_map(spark, sf), ["nem13"]).rows()
    return series.daily_totals(rows).select("sensorId", "day", F.round("total", 3).alias("total"), "readings")


NEM13_DAYS_SQL = f"""WITH {MAP_SQL},
r AS (
  SELECT sensor_id, l_shipdate AS a, l_shipdate + to_minutes(CAST(l_quantity AS INTEGER) * 1440 + l_linenumber * 7) AS b, l_quantity AS v
  FROM lineitem JOIN mm ON lookup_key = 'NMI' || l_suppkey || '-' || (['11','E1','B1'])[1 + l_linenumber % 3] WHERE l_linenumber % 3 <> 0),
p AS (
  SELECT *, unnest(CASE WHEN epoch(b) - epoch(a) > 86400 THEN generate_series(CAST(a AS DATE)::TIMESTAMP, b - INTERVAL 1 SECOND, INTERVAL 1 DAY)
    ELSE [CAST(a AS DATE)::TIMESTAMP] END) AS d FROM r)
SELECT sensor_id AS sensorId, CAST(d AS DATE) AS day, count(*) AS readings,
  round(sum(CASE WHEN epoch(b) - epoch(a) > 86400 THEN v * ((epoch(least(b, d + INTERVAL 1 DAY)) - epoch(greatest(a, d))) / (epoch(b) - epoch(a))) ELSE v END), 3) AS total
FROM p GROUP BY ALL"""

LEAD = 1000


def lead_lines(spark, sf):
    """Meter files below a thousand lines of something else."""
    body = nem12_lines(spark, sf).select("file", (F.col("pos") + 2 * LEAD).alias("pos"), "line")
    top = body.select("file").distinct().select("file", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(LEAD - 1).cast("long"))).alias("pos"))
    lines = top.withColumn("line", F.concat(F.lit("Report line "), F.col("pos"))).unionByName(body)
    lines = lines.select("file", F.floor(F.col("pos") / 100_000).cast("long").alias("split"), "pos", "line")
    done = ingest.ingest_lines(staged(lines, "lead-lines"), meter_map(spark, sf), ["nem"])
    return done.outcomes.select("file", "fmt", "status", "candidate_row_count", "rows_written", "unmapped_count", "rows_skipped")


LEAD_SQL = f"""WITH {OUTCOME_SQL}
SELECT file, 'nem' AS fmt, status, candidate_row_count, rows_written, unmapped_count, rows_skipped FROM outcomes"""


def nul_probe(spark, sf):
    """Water files, every third with a NUL beyond its thousandth line but within the probed bytes: those are no water files."""
    top = table(spark, sf, "customer").select(F.concat(F.lit("water-"), F.col("c_custkey"), F.lit(".csv")).alias("file"), "c_custkey")
    n = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(1200).cast("long"))).alias("pos")
    text = F.when(F.col("pos") == 0, F.lit("Serial_No,Interval_Start,Interval_End,Consumption,Consumption Unit"))
    text = text.when((F.col("pos") == 1100) & (F.col("c_custkey") % 3 == 0), F.lit("\x00")).otherwise(F.lit(""))
    # a file of customers that one task reads is many lines: they are dealt out before they are made
    lines = top.repartition("c_custkey").select("file", "c_custkey", n).select("file", F.lit(0).cast("long").alias("split"), "pos", text.alias("line"))
    return vf.classify(vf.heads(lines)).select("name", "fmt")


NUL_SQL = "SELECT 'water-' || c_custkey || '.csv' AS name, CASE WHEN c_custkey % 3 <> 0 THEN 'envizi_water' END AS fmt FROM customer"


def ingest_fallthrough(spark, sf):
    """Files that are an envelope without data, and vendor files whose first column looks like a meter record."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    name = F.concat(F.lit("f-"), F.col("k"), F.lit(".csv"))
    serial = vf.pick([100, 200, 250, 300, 201], F.col("k") % 5)
    water = F.array(F.lit("Serial_No,Date_Time,kL"), F.concat(serial, F.lit(",2024-01-01T01:00:00,3")), F.concat(serial, F.lit(",2024-01-01T02:00:00,4")))
    bare = F.array(F.lit("100,NEM12,202401010000,A,B"), F.lit("900"))
    text = F.when(F.col("k") % 2 == 0, water).otherwise(bare)
    lines = c.select(name.alias("file"), F.posexplode(text).alias("pos", "line")).select("file", F.lit(0).cast("long").alias("split"), F.col("pos").cast("long").alias("pos"), "line")
    done = ingest.ingest_lines(staged(lines, "fallthrough"), meter_map(spark, sf), ["nem", "nem13", "envizi_bulk_water"])
    return done.outcomes.select("file", "fmt", "status", "reason", "unmapped_count")


FALL_SQL = """SELECT 'f-' || c_custkey || '.csv' AS file, CASE WHEN c_custkey % 2 = 0 THEN 'envizi_bulk_water' ELSE 'nem' END AS fmt,
  CASE WHEN c_custkey % 2 = 0 THEN 'unmapped' ELSE 'processed_empty' END AS status, CASE WHEN c_custkey % 2 = 1 THEN 'no_data_sentinel' END AS reason,
  CAST(CASE WHEN c_custkey % 2 = 0 THEN 2 ELSE 0 END AS BIGINT) AS unmapped_count FROM customer"""


def drain_files(spark, sf):
    """More files than a run takes, drained in as many runs as it needs."""
    base = scratch_dir(spark, "drain")
    nem12_blocks(spark, sf).select("file", "text").repartition("file").write.partitionBy("file").text(f"{base}/in")
    files = tables.manifest(spark, f"{base}/in").filter("path like '%part-%'")
    paths = list(ingest.runs(files, 7))
    assert all(len(p) <= 7 for p in paths)
    ingest.drain(spark, f"{base}/in", meter_map(spark, sf), f"{base}/lake", f"{base}/audit", batch_files=7)
    return spark.read.parquet(f"{base}/lake").select(*COLUMNS, "unit")


DRAIN_SQL = f"""WITH {METER_SQL}, {MAP_SQL},
q AS ({OVERLAY_SQL})
SELECT sensor_id AS sensorId, slots.t_start AS ts, val, q.quality, unit
FROM slots JOIN mm ON lookup_key = nmi || '-' || suffix JOIN q ON q.nmi = slots.nmi AND q.suffix = slots.suffix AND q.t_start = slots.t_start
WHERE slots.suffix <> 'X9'"""

# ---- outcomes ------------------------------------------------------------------------


def contradictory_outcomes(spark, sf):
    """Orders as outcomes of files, most of them contradicting themselves: the keys of those that do."""
    status = vf.pick(["processed", "processed_empty", "unmapped", "processed_external", "parse_failed", "lost"], F.col("o_orderkey") % 6)
    n = lambda by, mod: (F.col(by) % mod).cast("long")
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("file"), status.alias("status"),
        F.when(F.col("o_orderkey") % 4 == 0, F.lit("parser_error")).alias("reason"),
        n("o_custkey", 3).alias("rows_written"), n("o_orderkey", 2).alias("unmapped_count"), n("o_custkey", 2).alias("candidate_row_count"), n("o_custkey", 5).alias("rows_skipped"),
        F.map_from_arrays(F.array(F.lit("blank_value"), F.lit("unparseable_value")), F.array(n("o_orderkey", 4), n("o_custkey", 2))).alias("skip_reasons"),
    )
    return outcome.violations(rows).select("file", "status")


CONTRADICTORY_SQL = """WITH o AS (
  SELECT o_orderkey AS file, (['processed','processed_empty','unmapped','processed_external','parse_failed','lost'])[1 + o_orderkey % 6] AS status,
    CASE WHEN o_orderkey % 4 = 0 THEN 'parser_error' END AS reason, o_custkey % 3 AS written, o_orderkey % 2 AS unmapped, o_custkey % 2 AS candidates,
    o_custkey % 5 AS skipped, o_orderkey % 4 + o_custkey % 2 AS skips FROM orders)
SELECT file, status FROM o WHERE NOT coalesce(CASE status WHEN 'processed' THEN written >= 1 WHEN 'processed_empty' THEN written = 0 AND unmapped = 0
    WHEN 'unmapped' THEN written = 0 AND candidates > 0 AND unmapped = candidates WHEN 'processed_external' THEN written = 0 AND candidates = 0
    WHEN 'parse_failed' THEN written = 0 AND reason IN ('parser_error', 'processing_error') ELSE FALSE END, FALSE)
  OR NOT (skips = 0 OR skipped <= skips)"""


def malformed_metrics(spark, sf):
    """Run totals over files with cells that are no numbers."""
    resolved = resolve.resolve(vf.read_layout("interval", vf.interval_lines(spark, sf)), meter_map(spark, sf))
    none = F.lit(None).cast("string")
    files = resolved.select("file").distinct().select("file", F.lit("interval").alias("fmt"), none.alias("status"), none.alias("reason"))
    return outcome.run_metrics(outcome.file_outcomes(outcome.file_counts(resolved), files)).select("status", "files", "candidates", "skipped", "malformed")


MALFORMED_SQL = f"""WITH c AS ({vf.INTERVAL_SQL})
SELECT 'unmapped' AS status, count(DISTINCT file) AS files, count(*) FILTER (skip_reason IS NULL) AS candidates, count(skip_reason) AS skipped,
  count(*) FILTER (skip_reason = 'unparseable_value') AS malformed FROM c"""

# ---- small sources and sinks ------------------------------------------------------------


def whitelist_scan(spark, sf):
    path = scratch_dir(spark, "whitelist")
    ids = meter_map(spark, sf).select("sensor_id")
    text = F.explode(F.array(F.concat(F.lit("  "), "sensor_id"), F.concat(F.lit("# "), "sensor_id"), F.lit("")))
    ids.select(text.alias("value")).write.text(path)
    return read_whitelist(spark, path)


WHITELIST_SQL = f"WITH {MAP_SQL} SELECT DISTINCT sensor_id FROM mm"


def points_scan(spark, sf):
    path = scratch_dir(spark, "points")
    reports.demand_points(spark, sf).write.option("header", True).csv(path)
    return tables.read_points(spark, path).withColumn("meter_vertex_id", F.coalesce("meter_vertex_id", F.lit("")))


def manifest_scan(spark, sf):
    """Files of a folder per meter file: their number, and whether each has a size and a time."""
    path = scratch_dir(spark, "manifest")
    nem12_blocks(spark, sf).select("file", "text").repartition("file").write.partitionBy("file").text(path)
    files = tables.manifest(spark, path).filter("path like '%part-%'")
    return files.select(F.regexp_extract("path", "file=([^/]+)/", 1).alias("file"), (F.col("size") > 0).alias("filled"), F.col("modified").isNotNull().alias("dated"))


MANIFEST_SQL = "SELECT DISTINCT 'meter-' || (user_id % 20) || '.csv' AS file, TRUE AS filled, TRUE AS dated FROM events"


def per_sensor_export(spark, sf):
    """One folder of CSV per sensor, read back."""
    path = scratch_dir(spark, "per-sensor")
    rows = lake_rows(spark, sf).filter("user_id % 10 = 0").select("sensorId", "ts", "val")
    lake.export_per_sensor(rows, path)
    back = spark.read.schema("ts timestamp_ntz, val double").option("header", True).option("basePath", path).csv(f"{path}/*")
    return back.select(F.col("sensorId").cast(StringType()).alias("sensorId"), "ts", "val")


PER_SENSOR_SQL = f"WITH {LAKE_SQL} SELECT sensorId, ts, val FROM lake WHERE user_id % 10 = 0"


def stream_archive(spark, sf):
    """Files that the stream has read move to the archive when it goes on; rows in the lake, once."""
    base = scratch_dir(spark, "archive")
    rows = last_write_wins(lake_rows(spark, sf), order=["event_id"])
    for part in range(2):
        lake.write_lake_csv(rows.filter(F.pmod("event_id", F.lit(2)) == part), f"{base}/in")
        streaming.lake_rows(spark, f"{base}/in", f"{base}/lake", f"{base}/checkpoint", max_files=3, archive=f"{base}/done").awaitTermination()
    moved = tables.manifest(spark, f"{base}/done").count() > 0
    return spark.read.parquet(f"{base}/lake").select(*COLUMNS, F.lit(moved).alias("archived"))


ARCHIVE_SQL = f"""WITH {LAKE_SQL} SELECT sensorId, ts, val, quality, TRUE AS archived FROM lake
QUALIFY row_number() OVER (PARTITION BY sensorId, ts ORDER BY event_id DESC) = 1"""

QUERIES = {
    "reingest_window": (reingest_window, REINGEST_SQL),
    "redelivered_file": (redelivered_file, REDELIVERED_SQL),
    "lake_csv_rejects": (lake_csv_rejects, REJECTS_SQL),
    "batch_totals": (batch_totals, TOTALS_SQL),
    "site_import": (site_import, SITE_IMPORT_SQL),
    "usable_sites": (usable_sites, USABLE_SQL),
    "nem13_ingest_days": (nem13_ingest_days, NEM13_DAYS_SQL),
    "lead_lines": (lead_lines, LEAD_SQL),
    "nul_probe": (nul_probe, NUL_SQL),
    "ingest_fallthrough": (ingest_fallthrough, FALL_SQL),
    "drain_files": (drain_files, DRAIN_SQL),
    "contradictory_outcomes": (contradictory_outcomes, CONTRADICTORY_SQL),
    "malformed_metrics": (malformed_metrics, MALFORMED_SQL),
    "whitelist_scan": (whitelist_scan, WHITELIST_SQL),
    "points_scan": (points_scan, reports.POINTS_SQL),
    "manifest_scan": (manifest_scan, MANIFEST_SQL),
    "per_sensor_export": (per_sensor_export, PER_SENSOR_SQL),
    "stream_archive": (stream_archive, ARCHIVE_SQL),
}
