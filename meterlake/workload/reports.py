"""Queries on bills, sites, points, manifests and dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake.functions import stamps
from meterlake.functions.text import base_name, decode_key, safe_file_name
from meterlake.operators import billing, sites
from meterlake.sources.layouts import BILLING_FIELDS
from meterlake.sources.mapping import billing_reverse
from meterlake.sources.tables import archive_counts, in_week, normalise_sites, over_threshold
from meterlake.workload.feeds import pick, table

# ---- billing --------------------------------------------------------------------

START = "1996-01-01"
SUFFIXES = [s for _, s, _ in BILLING_FIELDS]


def _meter(key):
    """Every fourth customer has a New Zealand style identifier."""
    icp = F.concat(F.lpad(F.col(key).cast("string"), 10, "0"), F.lit("UN02B"))
    return F.when(F.col(key) % 4 == 0, icp).otherwise(F.concat(F.lit("NMI"), F.col(key)))


METER_SQL = "CASE WHEN {k} % 4 = 0 THEN lpad(CAST({k} AS VARCHAR), 10, '0') || 'UN02B' ELSE 'NMI' || {k} END"


def bill_map(spark, sf):
    # spread before each row becomes many: a task reads whole row groups
    rows = table(spark, sf, "customer").select("c_custkey").repartition("c_custkey").select("c_custkey", F.explode(F.array(*[F.lit(s) for s in SUFFIXES])).alias("s"))
    return rows.select(
        F.concat(_meter("c_custkey"), F.lit("-"), F.col("s")).alias("lookup_key"),
        F.concat(F.lit("p:bill:"), F.col("c_custkey"), F.lit(":"), F.col("s")).alias("sensor_id"),
    )


def bill_rows(spark, sf):
    """Every order as a bill: three quarters of the fields, the month of the order."""
    fields = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(s).alias("s")) for i, s in enumerate(SUFFIXES)])
    rows = table(spark, sf, "orders").repartition("o_orderkey").select("*", F.explode(fields).alias("f"))
    is_money = F.contains("f.s", F.lit("charge")) | F.contains("f.s", F.lit("spend"))
    currency = F.when(F.col("o_custkey") % 5 == 1, pick(["nzd", "AUD"], F.col("o_orderkey") % 2)).otherwise(
        pick(["aud", "nzd", ""], F.col("o_custkey") % 3)
    )
    return rows.filter((F.col("o_orderkey") + F.col("f.i")) % 4 != 0).select(
        F.concat(F.lit("p:bill:"), F.col("o_custkey"), F.lit(":"), F.col("f.s")).alias("sensorId"),
        F.trunc("o_orderdate", "MM").cast("timestamp_ntz").alias("ts"),
        (F.col("o_totalprice") + F.col("f.i")).alias("val"),
        F.when(is_money, currency).otherwise(F.lit("kwh")).alias("unit"),
    )


_FIELD_ROWS = ", ".join(
    f"({i}, '{s}', '{s.removeprefix('billing-').replace('-', '_')}', {'TRUE' if ('charge' in s or 'spend' in s) else 'FALSE'})"
    for i, s in enumerate(SUFFIXES)
)
BILL_SQL = f"""
f(i, suffix, field, is_money) AS (VALUES {_FIELD_ROWS}),
b AS (
  SELECT {METER_SQL.format(k='o_custkey')} AS nmi, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, field, is_money,
    o_totalprice + i AS val, CASE WHEN NOT is_money THEN 'kwh'
      WHEN o_custkey % 5 = 1 THEN (['nzd','AUD'])[1 + o_orderkey % 2] ELSE (['aud','nzd',''])[1 + o_custkey % 3] END AS unit
  FROM orders, f WHERE (o_orderkey + i) % 4 <> 0 AND date_trunc('month', o_orderdate) >= DATE '{START}'),
l AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY nmi, month, field ORDER BY val DESC, unit DESC) = 1),
cur AS (SELECT nmi, min(lower(unit)) FILTER (is_money AND unit <> '') AS low, max(lower(unit)) FILTER (is_money AND unit <> '') AS high
  FROM l GROUP BY nmi)
"""


def billing_snapshot(spark, sf):
    return billing.snapshot(bill_rows(spark, sf), billing_reverse(bill_map(spark, sf)), START)


_METRIC_SQL = ", ".join(f"max(CASE WHEN field = '{m}' THEN val END) AS {m}" for m in billing.METRICS)
SNAPSHOT_SQL = f"""WITH {BILL_SQL}
SELECT nmi, month, upper(coalesce(any_value(low), 'aud')) AS currency, {_METRIC_SQL}
FROM l JOIN cur USING (nmi) GROUP BY nmi, month"""


def _bill_values(spark, sf):
    return billing.billing_rows(bill_rows(spark, sf), billing_reverse(bill_map(spark, sf)), START)


def billing_currency(spark, sf):
    return billing.currencies(_bill_values(spark, sf))


CURRENCY_SQL = f"""WITH {BILL_SQL}
SELECT nmi, upper(coalesce(low, 'aud')) AS currency, low IS NOT NULL AND low <> high AS conflict, low IS NULL AS unknown,
  low IS NOT NULL AND low = 'aud' AND regexp_matches(nmi, '^[0-9]{{10}}[A-Z0-9]{{5}}$') AS suspect FROM cur"""


def currency_stats(spark, sf):
    return billing.currency_stats(billing.currencies(_bill_values(spark, sf)))


STATS_SQL = f"""SELECT count(*) FILTER (conflict) AS conflict, count(*) FILTER (unknown) AS unknown,
  count(*) FILTER (suspect) AS suspect FROM ({CURRENCY_SQL})"""


def billing_snapshot_stats(spark, sf):
    return billing.snapshot_stats(billing_snapshot(spark, sf))


SNAPSHOT_STATS_SQL = f"""WITH {BILL_SQL}
SELECT count(DISTINCT (nmi, month)) AS rows, count(DISTINCT nmi) AS nmis, count(DISTINCT month) AS months FROM l"""


def billing_report(spark, sf):
    """Formatted text; compared by which cells are empty and by the numbers read back."""
    wide = billing.formatted(billing_snapshot(spark, sf))
    filled = F.size(F.filter(F.array(*[F.col(m) for m in billing.METRICS]), lambda c: c.isNotNull()))
    return wide.select("nmi", "month", filled.cast("long").alias("filled"), F.col("total_spend").cast("double").alias("total_spend"))


REPORT_SQL = f"""WITH {BILL_SQL}
SELECT nmi, month, count(*) AS filled, round(max(CASE WHEN field = 'total_spend' THEN val END), 2) AS total_spend
FROM l GROUP BY nmi, month"""


def billing_reverse_map(spark, sf):
    return billing_reverse(bill_map(spark, sf))


REVERSE_SQL = f"""WITH f(i, suffix, field, is_money) AS (VALUES {_FIELD_ROWS})
SELECT 'p:bill:' || c_custkey || ':' || suffix AS sensor_id, {METER_SQL.format(k='c_custkey')} AS nmi, field FROM customer, f"""

# ---- sites and points -------------------------------------------------------------


def _site_rows(spark, sf):
    c = table(spark, sf, "customer")
    name = F.concat_ws(" ", F.lit("BUN"), pick(["NZ", "AUS", "WA"], F.col("c_custkey") % 3), "c_name")
    bare = F.when(F.col("c_custkey") % 7 == 0, F.lpad(F.col("c_custkey").cast("string"), 15, "0")).otherwise(F.col("c_custkey").cast("string"))
    return c.select(
        "c_custkey",
        F.when(F.col("c_custkey") % 11 == 0, F.lit(" ")).when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("Optima_"), bare)).otherwise(bare).alias("NmiOrIcp"),
        F.when(F.col("c_custkey") % 13 != 0, F.concat(F.lit("S"), F.col("c_custkey"))).alias("SiteIdStr"),
        name.alias("SiteName"),
    )


SITES_SQL = """
sites AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 11 = 0 THEN '' ELSE
      'Optima_' || CASE WHEN c_custkey % 7 = 0 THEN lpad(CAST(c_custkey AS VARCHAR), 15, '0') ELSE CAST(c_custkey AS VARCHAR) END END AS nmi,
    CASE WHEN c_custkey % 13 <> 0 THEN 'S' || c_custkey ELSE '' END AS siteIdStr,
    'BUN ' || (['NZ','AUS','WA'])[1 + c_custkey % 3] || ' ' || c_name AS siteName FROM customer),
good AS (SELECT * FROM sites WHERE nmi <> '' AND siteIdStr <> '')
"""


def site_scan(spark, sf):
    return normalise_sites(_site_rows(spark, sf))


SITE_SCAN_SQL = f"WITH {SITES_SQL} SELECT nmi, siteIdStr, siteName, nmi <> '' AND siteIdStr <> '' AS valid FROM sites"


PROJECT = "retail"


def incoming_sites(spark, sf):
    return normalise_sites(_site_rows(spark, sf)).filter("valid").drop("valid").withColumn("project", F.lit(PROJECT))


def stored_sites(spark, sf):
    """Three quarters of the incoming sites, some under an older name."""
    number = F.regexp_extract("nmi", "([0-9]+)$", 1).cast("long")
    return incoming_sites(spark, sf).filter(number % 4 != 0).select(
        "project",
        "nmi",
        "siteIdStr",
        F.when(number % 5 == 0, F.lit("old name")).otherwise(F.col("siteName")).alias("siteName"),
    )


def _diff(spark, sf):
    return sites.site_diff(incoming_sites(spark, sf), stored_sites(spark, sf))


def site_diff(spark, sf):
    return _diff(spark, sf).select("nmi", "siteIdStr", "siteName", "state", F.array_join("changed", ",").alias("changed"))


DIFF_SQL = f"""WITH {SITES_SQL}
SELECT nmi, siteIdStr, siteName, CASE WHEN k % 4 = 0 THEN 'NEW' WHEN k % 5 = 0 THEN 'CONFLICT' ELSE 'IDENTICAL' END AS state,
  CASE WHEN k % 4 <> 0 AND k % 5 = 0 THEN 'siteName' ELSE '' END AS changed FROM good"""


def site_diff_summary(spark, sf):
    return sites.diff_summary(_diff(spark, sf))


DIFF_SUMMARY_SQL = f"SELECT state, count(*) AS sites FROM ({DIFF_SQL}) GROUP BY state"


def sites_to_import(spark, sf):
    return sites.to_import(_diff(spark, sf), force=True)


IMPORT_SQL = f"SELECT '{PROJECT}' AS project, nmi, siteIdStr, siteName FROM ({DIFF_SQL}) WHERE state <> 'IDENTICAL'"


def country_detect(spark, sf):
    return sites.with_country(normalise_sites(_site_rows(spark, sf))).select("nmi", "siteName", "country")


COUNTRY_SQL = f"""WITH {SITES_SQL}
SELECT nmi, siteName, CASE k % 3 WHEN 0 THEN 'NZ' WHEN 1 THEN 'AU'
  ELSE CASE WHEN length(replace(nmi, 'Optima_', '')) = 15 THEN 'NZ' ELSE 'AU' END END AS country FROM sites"""


def country_summary(spark, sf):
    return sites.country_summary(normalise_sites(_site_rows(spark, sf)))


COUNTRY_SUMMARY_SQL = f"SELECT country, count(*) AS sites FROM ({COUNTRY_SQL}) GROUP BY country"


def _edges(spark, sf):
    """Points and their meters; every other site has an E1 point, every third a B1 point, some two edges."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    nmi = F.concat(F.lit("Optima_"), F.col("k"))
    e1 = c.filter("k % 2 = 0").select(F.concat(nmi, F.lit("-E1")).alias("nem12_id"), F.concat(F.lit("m1-"), F.col("k")).alias("meter_vertex_id"))
    b1 = c.filter("k % 3 = 0").select(F.concat(nmi, F.lit("-B1")).alias("nem12_id"), F.concat(F.lit("m2-"), F.col("k")).alias("meter_vertex_id"))
    more = c.filter("k % 10 = 0").select(F.concat(nmi, F.lit("-E1")).alias("nem12_id"), F.concat(F.lit("m9-"), F.col("k")).alias("meter_vertex_id"))
    return e1.unionByName(b1).unionByName(more)


def _meters(spark, sf):
    site = table(spark, sf, "customer").select(F.concat(F.lit("Optima_"), F.col("c_custkey")).alias("nmi"))
    return sites.meters_of_sites(site, _edges(spark, sf))


def meter_walk(spark, sf):
    return _meters(spark, sf)


WALK_SQL = """
SELECT 'Optima_' || c_custkey AS nmi, CASE WHEN c_custkey % 2 = 0 THEN 'm1-' || c_custkey WHEN c_custkey % 3 = 0 THEN 'm2-' || c_custkey END AS meter_vertex_id,
  CASE WHEN c_custkey % 2 = 0 THEN 'E1' WHEN c_custkey % 3 = 0 THEN 'B1' ELSE 'missing' END AS strategy FROM customer"""


def meter_walk_summary(spark, sf):
    return sites.strategy_summary(_meters(spark, sf))


WALK_SUMMARY_SQL = f"SELECT strategy, count(*) AS sites FROM ({WALK_SQL}) GROUP BY strategy"


def demand_points(spark, sf):
    return sites.demand_points(_meters(spark, sf))


POINTS_SQL = f"""
WITH w AS ({WALK_SQL}), f(field, label) AS (VALUES ('kw', 'Demand kW'), ('kva', 'Demand kVA'), ('pf', 'Demand Power Factor'))
SELECT replace(nmi, 'Optima_', '') AS identifier, field, nmi || '-demand-' || field AS nem12_id,
  replace(nmi, 'Optima_', '') || ' ' || label AS label, 'demand' AS point_category, coalesce(meter_vertex_id, '') AS meter_vertex_id FROM w, f"""


def _existing(spark, sf):
    points = sites.demand_points(_meters(spark, sf))
    return points.filter(F.col("identifier").cast("long") % 4 == 0).select("nem12_id")


def points_to_create(spark, sf):
    return sites.points_to_create(sites.demand_points(_meters(spark, sf)), _existing(spark, sf)).select("nem12_id", "label", "meter_vertex_id")


CREATE_SQL = f"""SELECT nem12_id, label, meter_vertex_id FROM ({POINTS_SQL}) WHERE meter_vertex_id <> '' AND CAST(identifier AS BIGINT) % 4 <> 0"""


def orphan_points(spark, sf):
    return sites.orphans(sites.demand_points(_meters(spark, sf))).select("nem12_id")


ORPHAN_SQL = f"SELECT nem12_id FROM ({POINTS_SQL}) WHERE meter_vertex_id = ''"


def point_summary(spark, sf):
    return sites.point_summary(sites.demand_points(_meters(spark, sf)), _existing(spark, sf))


POINT_SUMMARY_SQL = f"""SELECT count(*) AS points, count(DISTINCT identifier) AS meters, count(*) FILTER (meter_vertex_id = '') AS orphans,
  count(*) FILTER (CAST(identifier AS BIGINT) % 4 = 0) AS existing,
  count(*) FILTER (meter_vertex_id <> '' AND CAST(identifier AS BIGINT) % 4 <> 0) AS to_create FROM ({POINTS_SQL})"""

# ---- manifests, keys and dates ------------------------------------------------------


def _files(spark, sf):
    """Orders as files of four prefixes, some archived already."""
    folder = pick(["processed", "unmapped", "failed", "processed/archived/2024-W01"], F.col("o_orderkey") % 4)
    return table(spark, sf, "orders").select(
        F.concat(folder, F.lit("/f"), F.col("o_orderkey"), F.lit(".csv")).alias("path"),
        F.col("o_totalprice").cast("long").alias("size"),
        F.col("o_orderdate").alias("modified"),
    )


FILES_SQL = """
files AS (SELECT (['processed','unmapped','failed','processed/archived/2024-W01'])[1 + o_orderkey % 4] AS prefix, o_orderkey,
  o_orderdate AS modified, strftime(o_orderdate, '%G-W%V') AS iso_week FROM orders)
"""


def iso_week_manifest(spark, sf):
    return archive_counts(_files(spark, sf))


WEEK_SQL = f"WITH {FILES_SQL} SELECT prefix, iso_week, count(*) AS files FROM files GROUP BY ALL"


def week_files(spark, sf):
    return in_week(_files(spark, sf), "1998-W01").select("path", "modified")


WEEK_FILES_SQL = f"""WITH {FILES_SQL} SELECT prefix || '/f' || o_orderkey || '.csv' AS path, modified FROM files
WHERE iso_week = '1998-W01' AND prefix NOT LIKE '%archived%'"""


def file_threshold(spark, sf):
    return over_threshold(_files(spark, sf), 10)


THRESHOLD_SQL = "SELECT count(*) AS files, count(*) >= 10 AS due FROM orders"


def object_keys(spark, sf):
    """Event keys decoded, base names and safe names."""
    key = F.concat(F.lit("in/a%20b+c/"), F.replace("c_name", F.lit("#"), F.lit("%23")), F.lit(".csv"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        decode_key(key).alias("key"),
        base_name(F.concat(F.lit("x/y+"), F.col("c_custkey"), F.lit("%20z"))).alias("base"),
        safe_file_name(F.concat(F.lit("a/b\\"), F.col("c_custkey"))).alias("safe"),
    )


KEYS_SQL = r"""SELECT c_custkey, 'in/a b c/' || c_name || '.csv' AS key, 'y+' || c_custkey || ' z' AS base, 'a_b_' || c_custkey AS safe FROM customer"""


def date_windows(spark, sf):
    """Re-ingest windows as of each order date."""
    day = F.to_date("o_orderdate")
    pm, rd, mm = stamps.previous_month(day), stamps.rolling_days(day, 3), stamps.past_months(day, 6)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        pm[0].alias("month_start"),
        pm[1].alias("month_end"),
        rd[0].alias("days_start"),
        rd[1].alias("days_end"),
        mm[0].alias("months_start"),
        mm[1].alias("months_end"),
        stamps.within(F.col("o_orderdate") - F.expr("INTERVAL '2' DAY"), rd).alias("inside"),
    )


WINDOWS_SQL = """
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS DATE) AS month_start,
  CAST(date_trunc('month', o_orderdate) - INTERVAL 1 DAY AS DATE) AS month_end,
  CAST(o_orderdate - INTERVAL 3 DAY AS DATE) AS days_start, CAST(o_orderdate - INTERVAL 1 DAY AS DATE) AS days_end,
  CAST(date_trunc('month', o_orderdate) - INTERVAL 5 MONTH AS DATE) AS months_start, last_day(CAST(o_orderdate AS DATE)) AS months_end,
  TRUE AS inside FROM orders"""


def partition_stamps(spark, sf):
    """Partition text, year, minute and month key of each event."""
    return table(spark, sf, "events").select(
        "event_id",
        stamps.its_text(F.col("ts")).alias("its"),
        stamps.year_of(F.col("ts")).alias("its_year"),
        F.minute("ts").alias("minute"),
        stamps.month_key(F.col("ts")).alias("month"),
        stamps.is_iso_week(stamps.iso_week(F.col("ts"))).alias("week_ok"),
    )


STAMPS_SQL = """
SELECT event_id, strftime(ts, '%Y-%m-%d ') || hour(ts) || strftime(ts, ':%M:%S') AS its, CAST(year(ts) AS INTEGER) AS its_year,
  CAST(minute(ts) AS INTEGER) AS minute, strftime(ts, '%Y-%m-%d') AS month, TRUE AS week_ok FROM events"""

QUERIES = {
    "billing_snapshot": (billing_snapshot, SNAPSHOT_SQL),
    "billing_currency": (billing_currency, CURRENCY_SQL),
    "currency_stats": (currency_stats, STATS_SQL),
    "billing_snapshot_stats": (billing_snapshot_stats, SNAPSHOT_STATS_SQL),
    "billing_report": (billing_report, REPORT_SQL),
    "billing_reverse_map": (billing_reverse_map, REVERSE_SQL),
    "site_scan": (site_scan, SITE_SCAN_SQL),
    "site_diff": (site_diff, DIFF_SQL),
    "site_diff_summary": (site_diff_summary, DIFF_SUMMARY_SQL),
    "sites_to_import": (sites_to_import, IMPORT_SQL),
    "country_detect": (country_detect, COUNTRY_SQL),
    "country_summary": (country_summary, COUNTRY_SUMMARY_SQL),
    "meter_walk": (meter_walk, WALK_SQL),
    "meter_walk_summary": (meter_walk_summary, WALK_SUMMARY_SQL),
    "demand_points": (demand_points, POINTS_SQL),
    "points_to_create": (points_to_create, CREATE_SQL),
    "orphan_points": (orphan_points, ORPHAN_SQL),
    "point_summary": (point_summary, POINT_SUMMARY_SQL),
    "iso_week_manifest": (iso_week_manifest, WEEK_SQL),
    "week_files": (week_files, WEEK_FILES_SQL),
    "file_threshold": (file_threshold, THRESHOLD_SQL),
    "object_keys": (object_keys, KEYS_SQL),
    "date_windows": (date_windows, WINDOWS_SQL),
    "partition_stamps": (partition_stamps, STAMPS_SQL),
}
