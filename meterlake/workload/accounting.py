"""Queries on identifier lookup and on what became of each file."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake.functions.identifiers import supported_suffix
from meterlake.operators import outcome, resolve
from meterlake.plans.ingest import ingest_files, ingest_lines
from meterlake.schemas import COUNTED, EACH, FILLED, conform
from meterlake.session import scratch_dir, staged
from meterlake.sources import nem12
from meterlake.sources.mapping import read_mapping, whitelist, write_mapping
from meterlake.workload import vendor_files as vf
from meterlake.workload.feeds import (
    MAP_SQL,
    METER_SQL,
    SUPPORTED_SQL,
    meter_events,
    meter_map,
    nem12_blocks,
    nem12_lines,
    table,
)
from meterlake.workload.meter_files import OVERLAY_SQL


def _event_readings(spark, sf):
    """One candidate per event; every fourth meter is a sensor id already."""
    e = meter_events(spark, sf)
    nmi = F.when(F.col("user_id") % 4 == 0, F.concat(F.lit("p:direct:"), F.col("user_id"))).otherwise(F.col("nmi"))
    rows = e.select("file", F.col("event_id").alias("pos"), nmi.alias("nmi"), "suffix", F.col("value").alias("val"))
    return conform(rows.withColumn("lookup_key", F.concat("nmi", F.lit("-"), "suffix")).withColumn("id_kind", F.lit("nem12_nmi")))


def resolve_mapping(spark, sf):
    out = resolve.resolve(_event_readings(spark, sf), meter_map(spark, sf))
    return out.select(F.col("pos").alias("event_id"), "lookup_key", "sensor_id")


RESOLVE_SQL = f"""WITH {METER_SQL}, {MAP_SQL},
r AS (SELECT event_id, CASE WHEN user_id % 4 = 0 THEN 'p:direct:' || user_id ELSE nmi END AS id, suffix FROM m)
SELECT event_id, id || '-' || suffix AS lookup_key, CASE WHEN id LIKE 'p:%' THEN id ELSE sensor_id END AS sensor_id
FROM r LEFT JOIN mm ON lookup_key = id || '-' || suffix"""


def direct_sensor_bypass(spark, sf):
    out = resolve.written(resolve.resolve(_event_readings(spark, sf), meter_map(spark, sf)))
    direct = F.col("sensor_id") == F.col("nmi")
    return out.groupBy(direct.alias("direct")).agg(F.count("*").alias("rows"), F.count_distinct("sensor_id").alias("sensors"))


BYPASS_SQL = f"""WITH x AS ({RESOLVE_SQL})
SELECT sensor_id LIKE 'p:direct:%' AS direct, count(*) AS rows, count(DISTINCT sensor_id) AS sensors
FROM x WHERE sensor_id IS NOT NULL GROUP BY 1"""


def unmapped_ids(spark, sf):
    return resolve.unmapped_keys(resolve.resolve(_event_readings(spark, sf), meter_map(spark, sf))).select("file", "lookup_key")


UNMAPPED_SQL = f"""WITH x AS ({RESOLVE_SQL}),
d AS (SELECT DISTINCT 'meter-' || (user_id % 20) || '.csv' AS file, lookup_key
  FROM x JOIN events USING (event_id) WHERE sensor_id IS NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY lookup_key) AS n FROM d)
SELECT file, lookup_key FROM n"""


def suffix_support(spark, sf):
    return meter_events(spark, sf).groupBy("suffix").agg(
        F.count(F.when(supported_suffix(F.col("suffix")), 1)).alias("supported"), F.count("*").alias("rows")
    )


SUFFIX_SQL = f"""WITH {METER_SQL}
SELECT suffix, count(*) FILTER ({SUPPORTED_SQL}) AS supported, count(*) AS rows FROM m GROUP BY suffix"""


def _resolved(spark, sf, blanks=EACH):
    return nem12.parse_lines(nem12_lines(spark, sf), meter_map(spark, sf), blanks)


def _outcomes(spark, sf):
    resolved = _resolved(spark, sf, COUNTED)
    files = meter_events(spark, sf).select("file").distinct()
    return outcome.file_outcomes(
        outcome.file_counts(resolved),
        files.select("file", F.lit("nem").alias("fmt"), F.lit(None).cast("string").alias("status"), F.lit(None).cast("string").alias("reason")),
    )


OUTCOME_SQL = f"""{METER_SQL}, {MAP_SQL},
d AS (SELECT file, nmi, suffix, minutes, day, count(*) AS filled FROM slots GROUP BY ALL),
c AS (SELECT file, nmi, suffix, sum(filled) AS filled, sum(1440 // minutes - filled) AS blank FROM d GROUP BY ALL),
o AS (
  SELECT file, CAST(coalesce(sum(filled) FILTER (suffix <> 'X9'), 0) AS BIGINT) AS candidate_row_count,
    CAST(coalesce(sum(filled) FILTER (suffix <> 'X9' AND sensor_id IS NOT NULL), 0) AS BIGINT) AS rows_written,
    CAST(coalesce(sum(filled) FILTER (suffix <> 'X9' AND sensor_id IS NULL), 0) AS BIGINT) AS unmapped_count,
    CAST(coalesce(sum(blank) FILTER (suffix <> 'X9'), 0) AS BIGINT) AS rows_skipped,
    count(*) FILTER (suffix <> 'X9' AND sensor_id IS NOT NULL) AS mapped_points,
    coalesce(max(CASE WHEN suffix = 'X9' THEN 'X9' END), '') AS unsupported
  FROM c LEFT JOIN mm ON lookup_key = nmi || '-' || suffix GROUP BY file),
outcomes AS (
  SELECT *, CASE WHEN rows_written > 0 THEN 'processed' WHEN candidate_row_count > 0 THEN 'unmapped' ELSE 'processed_empty' END AS status
  FROM o)
"""


def file_outcomes(spark, sf):
    return _outcomes(spark, sf).select(
        "file",
        "status",
        "reason",
        "dest",
        "candidate_row_count",
        "rows_written",
        "unmapped_count",
        "rows_skipped",
        "mapped_points",
        F.array_join("unsupported_suffixes", ",").alias("unsupported"),
    )


FILE_OUTCOMES_SQL = f"""WITH {OUTCOME_SQL}
SELECT file, status, CASE WHEN status = 'processed_empty' AND unsupported <> '' THEN 'all_unknown_suffix' END AS reason,
  CASE status WHEN 'unmapped' THEN 'unmapped/' ELSE 'processed/' END AS dest, candidate_row_count, rows_written,
  unmapped_count, rows_skipped, mapped_points, unsupported FROM outcomes"""


def run_metrics(spark, sf):
    return outcome.run_metrics(_outcomes(spark, sf))


METRICS_SQL = f"""WITH {OUTCOME_SQL}
SELECT status, count(*) AS files, CAST(sum(mapped_points) AS BIGINT) AS mapped_points,
  CAST(sum(candidate_row_count) AS BIGINT) AS candidates, CAST(sum(unmapped_count) AS BIGINT) AS unmapped,
  CAST(sum(rows_skipped) AS BIGINT) AS skipped, CAST(0 AS BIGINT) AS malformed,
  count(*) FILTER (unsupported <> '') AS files_with_unsupported FROM outcomes GROUP BY status"""


def file_ratios(spark, sf):
    return outcome.file_ratios(_outcomes(spark, sf)).select(
        "file", "status", F.round("partial_mapped_ratio", 6).alias("partial_mapped_ratio"), F.round("rows_skipped_ratio", 6).alias("rows_skipped_ratio")
    )


RATIOS_SQL = f"""WITH {OUTCOME_SQL}
SELECT file, status, round(100.0 * unmapped_count / nullif(candidate_row_count, 0)::DOUBLE, 6) AS partial_mapped_ratio,
  round(100.0 * rows_skipped / nullif(candidate_row_count + rows_skipped, 0)::DOUBLE, 6) AS rows_skipped_ratio FROM outcomes"""


def outcome_violations(spark, sf):
    """Contradictory outcomes: the count must be zero."""
    return outcome.violations(_outcomes(spark, sf)).agg(F.count("*").alias("violations"))


VIOLATIONS_SQL = "SELECT count(*) AS violations FROM events WHERE event_id IS NULL"


def skip_counts(spark, sf):
    return outcome.skip_counts(vf.read_layout("interval", vf.interval_lines(spark, sf)))


SKIP_COUNTS_SQL = f"""SELECT file, skip_reason, count(*) AS skipped FROM ({vf.INTERVAL_SQL}) WHERE skip_reason IS NOT NULL GROUP BY ALL"""


def audit_samples(spark, sf):
    """Every skipped cell of every file."""
    return outcome.skipped_cells(_resolved(spark, sf)).select("file", "row", F.col("column").alias("channel"), "t_start", "reason")


SAMPLES_SQL = f"""WITH {METER_SQL},
d AS (SELECT DISTINCT file, user_id, s, suffix, uom, minutes, day FROM m),
b AS (
  SELECT d.*, i.slot, ((user_id * 8 + s) * 64 + day(day)) * 512 + 1000 AS row
  FROM d, LATERAL (SELECT unnest(generate_series(0, 1440 // minutes - 1)) AS slot) i WHERE suffix <> 'X9'),
k AS (SELECT b.* FROM b ANTI JOIN m USING (user_id, s, day, slot))
SELECT file, row, suffix || '_' || CASE WHEN uom = '' THEN 'kWh' ELSE uom END AS channel,
  CAST(day AS TIMESTAMP) + to_minutes(slot * minutes) AS t_start, 'blank_value' AS reason FROM k"""


def audit_documents(spark, sf):
    """The audit of each file, read back from its JSON."""
    resolved = _resolved(spark, sf)
    docs = outcome.audit(_outcomes(spark, sf), outcome.skip_samples(resolved), resolve.unmapped_identifiers(resolved))
    shape = "source_file string, outcome struct<status:string,rows_skipped:bigint>, skipped_samples array<struct<truncated:boolean,total_skipped:bigint>>, unmapped_identifiers array<array<string>>"
    doc = docs.select("file", "audit_name", F.from_json("value", shape).alias("d"))
    return doc.select(
        "file",
        "audit_name",
        F.col("d.outcome.status").alias("status"),
        F.size("d.skipped_samples").cast("long").alias("samples"),
        F.array_max("d.skipped_samples.total_skipped").alias("total_skipped"),
        F.size("d.unmapped_identifiers").cast("long").alias("identifiers"),
    )


DOCUMENTS_SQL = f"""WITH {OUTCOME_SQL},
i AS (SELECT file, count(*) AS ids FROM c LEFT JOIN mm ON lookup_key = nmi || '-' || suffix
  WHERE sensor_id IS NULL AND suffix <> 'X9' GROUP BY file)
SELECT file, file || '.skipped.json' AS audit_name, status, least(rows_skipped, 100) + CASE WHEN rows_skipped > 100 THEN 1 ELSE 0 END AS samples,
  CASE WHEN rows_skipped > 100 THEN rows_skipped END AS total_skipped, coalesce(ids, 0) AS identifiers
FROM outcomes LEFT JOIN i USING (file) WHERE rows_skipped > 0 OR unmapped_count > 0 OR unsupported <> ''"""


def unmapped_kinds(spark, sf):
    return outcome.unmapped_kinds(resolve.unmapped_keys(resolve.resolve(_event_readings(spark, sf), meter_map(spark, sf))))


KINDS_SQL = f"""WITH u AS ({UNMAPPED_SQL}) SELECT file, 'nem12_nmi' AS kind, count(*) AS identifiers FROM u GROUP BY file"""


def load_summary(spark, sf):
    return outcome.load_summary(_resolved(spark, sf, FILLED))


SUMMARY_SQL = f"""WITH {METER_SQL}, {MAP_SQL},
c AS (SELECT file, nmi, suffix, count(*) AS n FROM slots WHERE suffix <> 'X9' GROUP BY ALL),
k AS (SELECT file, nmi, bool_and(sensor_id IS NOT NULL) AS ok, count(sensor_id) AS points,
  coalesce(sum(n) FILTER (sensor_id IS NOT NULL), 0) AS n FROM c LEFT JOIN mm ON lookup_key = nmi || '-' || suffix GROUP BY ALL)
SELECT file, count(*) AS nmis_total, count(*) FILTER (ok) AS nmis_mapped, count(*) FILTER (NOT ok) AS nmis_unmapped,
  CAST(sum(points) AS BIGINT) AS monitor_points, CAST(sum(n) AS BIGINT) AS readings_total FROM k GROUP BY file"""

# ---- whole ingest -----------------------------------------------------------


def mixed_map(spark, sf):
    keys = F.array(
        F.concat(F.lit("Optima_"), F.col("c"), F.lit("-E1")),
        F.concat(F.lit("Envizi_"), F.col("c"), F.lit("-E1")),
        F.concat(F.lit("Optima_D"), F.col("c"), F.lit("-demand-kw")),
    )
    rows = table(spark, sf, "customer").filter(F.col("c_custkey") % 3 != 0).select(F.col("c_custkey").alias("c"))
    extra = rows.select(F.explode(keys).alias("lookup_key")).withColumn("sensor_id", F.concat(F.lit("p:x:"), "lookup_key"))
    return meter_map(spark, sf).unionByName(extra)


MIXED_MAP_SQL = f"""{MAP_SQL},
xm AS (SELECT lookup_key FROM mm UNION ALL
  SELECT unnest(['Optima_' || c_custkey || '-E1', 'Envizi_' || c_custkey || '-E1', 'Optima_D' || c_custkey || '-demand-kw'])
  FROM customer WHERE c_custkey % 3 <> 0)
"""


def electricity_lines(spark, sf):
    start = vf.every("event_id", 17, F.lit("?"), vf._iso())
    return vf.tall_lines(
        spark, sf, "Serial_No,Interval_End,kWh,Interval_Start", [F.col("user_id"), vf._iso(15), vf._reading(), start], "elec-"
    )


COUNT_COLUMNS = ["source_row_count", "candidate_row_count", "rows_written", "unmapped_count", "rows_skipped"]


def ingest_mixed(spark, sf):
    """Files of four layouts in one run: outcomes of all of them."""
    lines = nem12_lines(spark, sf)
    for more in (vf.interval_lines(spark, sf), vf.demand_lines(spark, sf), electricity_lines(spark, sf)):
        lines = lines.unionByName(more)
    done = ingest_lines(staged(lines, "mixed-lines"), mixed_map(spark, sf), ["nem", "interval", "demand", "envizi_electricity"])
    return done.outcomes.select("file", "fmt", "status", *COUNT_COLUMNS)


MIXED_SQL = f"""WITH {METER_SQL}, {MIXED_MAP_SQL},
nem AS (SELECT file, nmi || '-' || suffix AS key, count(*) AS n FROM slots WHERE suffix <> 'X9' GROUP BY ALL),
nb AS (SELECT file, sum(1440 // minutes - filled) AS blank
  FROM (SELECT file, nmi, suffix, minutes, day, count(*) AS filled FROM slots WHERE suffix <> 'X9' GROUP BY ALL) GROUP BY file),
i AS ({vf.INTERVAL_SQL}), dd AS ({vf.DEMAND_SQL}), el AS ({vf.ELECTRICITY_SQL}),
cells AS (
  SELECT file, 'nem' AS fmt, key, n, CAST(NULL AS VARCHAR) AS skip_reason FROM nem
  UNION ALL SELECT file, 'nem', NULL, blank, 'blank_value' FROM nb WHERE blank > 0
  UNION ALL SELECT file, 'interval', nmi || '-' || suffix, 1, skip_reason FROM i
  UNION ALL SELECT file, 'demand', lookup_key, 1, skip_reason FROM dd
  UNION ALL SELECT file, 'envizi_electricity', nmi || '-E1', 1, skip_reason FROM el),
srows AS (
  SELECT 'interval-' || (user_id % 20) || '.csv' AS file, count(*) AS n FROM events GROUP BY 1
  UNION ALL SELECT 'elec-' || (user_id % 20) || '.csv', count(*) FROM events GROUP BY 1
  UNION ALL SELECT 'demand profile ' || (o_custkey % 20) || '.csv', count(*) FROM orders GROUP BY 1)
SELECT cells.file, fmt, CASE WHEN count(xm.lookup_key) FILTER (skip_reason IS NULL) > 0 THEN 'processed'
    WHEN count(*) FILTER (skip_reason IS NULL) > 0 THEN 'unmapped' ELSE 'processed_empty' END AS status,
  coalesce(max(srows.n), 0) AS source_row_count,
  CAST(coalesce(sum(cells.n) FILTER (skip_reason IS NULL), 0) AS BIGINT) AS candidate_row_count,
  CAST(coalesce(sum(cells.n) FILTER (skip_reason IS NULL AND xm.lookup_key IS NOT NULL), 0) AS BIGINT) AS rows_written,
  CAST(coalesce(sum(cells.n) FILTER (skip_reason IS NULL AND xm.lookup_key IS NULL), 0) AS BIGINT) AS unmapped_count,
  CAST(coalesce(sum(cells.n) FILTER (skip_reason IS NOT NULL), 0) AS BIGINT) AS rows_skipped
FROM cells LEFT JOIN xm ON xm.lookup_key = cells.key LEFT JOIN srows ON srows.file = cells.file GROUP BY cells.file, fmt"""


def ingest_file_run(spark, sf):
    """Real files on disk through the whole job: rows that reach the lake."""
    folder = scratch_dir(spark, "landing")
    nem12_blocks(spark, sf).select("text").write.text(folder)
    paths = [r["path"] for r in spark.read.format("binaryFile").load(folder).select("path").collect()]
    rows = ingest_files(spark, paths, meter_map(spark, sf)).rows()
    return rows.select("sensorId", "ts", "val", "unit", "quality")


RUN_SQL = f"""WITH {METER_SQL}, {MAP_SQL},
q AS ({OVERLAY_SQL})
SELECT sensor_id AS sensorId, slots.t_start AS ts, val, unit, q.quality
FROM slots JOIN mm ON lookup_key = nmi || '-' || suffix JOIN q ON q.nmi = slots.nmi AND q.suffix = slots.suffix AND q.t_start = slots.t_start
WHERE slots.suffix <> 'X9'"""

# ---- the identifier map -----------------------------------------------------


def mapping_export(spark, sf):
    """The map written as JSON and read back."""
    path = scratch_dir(spark, "map")
    write_mapping(meter_map(spark, sf), path)
    return read_mapping(spark, path).select("lookup_key", "sensor_id")


EXPORT_SQL = f"WITH {MAP_SQL} SELECT lookup_key, sensor_id FROM mm"


def sensor_whitelist(spark, sf):
    return whitelist(meter_map(spark, sf), "^NMI.*-(E1|B1)$", "p:site:")


WHITELIST_SQL = f"WITH {MAP_SQL} SELECT DISTINCT sensor_id FROM mm WHERE regexp_matches(lookup_key, '^NMI.*-(E1|B1)$')"


QUERIES = {
    "resolve_mapping": (resolve_mapping, RESOLVE_SQL),
    "direct_sensor_bypass": (direct_sensor_bypass, BYPASS_SQL),
    "unmapped_ids": (unmapped_ids, UNMAPPED_SQL),
    "unmapped_kinds": (unmapped_kinds, KINDS_SQL),
    "suffix_support": (suffix_support, SUFFIX_SQL),
    "skip_counts": (skip_counts, SKIP_COUNTS_SQL),
    "file_outcomes": (file_outcomes, FILE_OUTCOMES_SQL),
    "run_metrics": (run_metrics, METRICS_SQL),
    "file_ratios": (file_ratios, RATIOS_SQL),
    "outcome_violations": (outcome_violations, VIOLATIONS_SQL),
    "audit_samples": (audit_samples, SAMPLES_SQL),
    "audit_documents": (audit_documents, DOCUMENTS_SQL),
    "load_summary": (load_summary, SUMMARY_SQL),
    "ingest_mixed": (ingest_mixed, MIXED_SQL),
    "ingest_file_run": (ingest_file_run, RUN_SQL),
    "mapping_export": (mapping_export, EXPORT_SQL),
    "sensor_whitelist": (sensor_whitelist, WHITELIST_SQL),
}
