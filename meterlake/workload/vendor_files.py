"""Queries on vendor layouts. The CSV lines are written by Spark from the tables,
with blank, broken and ragged cells among them, and parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake.functions.coerce import number, skip_reason
from meterlake.functions.stamps import floor_minutes, plus_minutes
from meterlake.sources import layouts
from meterlake.sources.classify import classify, read_layout
from meterlake.sources.lines import heads
from meterlake.workload.feeds import SPLIT, file_name, pick, table, with_preamble


def csv(*parts):
    """Cells to a line; NULL is an empty cell."""
    return F.array_join(F.transform(F.array(*[p.cast("string") for p in parts]), lambda c: F.coalesce(c, F.lit(""))), ",")


def every(key: str, n: int, text, otherwise):
    return F.when(F.col(key) % n == 0, text).otherwise(otherwise)


def counted(readings, *columns):
    return readings.filter(F.coalesce("skip_reason", F.lit("")) != layouts.IGNORED).select(*columns)


def preamble(*lines):
    return F.array(*[F.lit(x) if isinstance(x, str) else x for x in lines])


BASIC = ["file", "nmi", "suffix", "uom", "t_start", "val", "skip_reason"]

# ---- interval usage ---------------------------------------------------------

INTERVAL_HEADER = (
    "BuyerShortName,Country,Commodity,Identifier,IdentifierType,DistributorId,Date,Start Time,Usage,Generation,DemandKva,Reactive"
)


def interval_lines(spark, sf):
    text = F.col("value").cast("string")
    line = csv(
        F.lit('"Buyer, Ltd"'),
        F.lit("AU"),
        F.lit("Electricity"),
        F.col("user_id"),
        F.lit("NMI"),
        F.lit("D1"),
        every("event_id", 17, F.lit("bad"), F.date_format("ts", "dd MMM yyyy")),
        F.date_format("ts", "HH:mm"),
        every("event_id", 11, F.lit(" "), every("event_id", 13, F.lit("abc"), text)),
        every("event_id", 3, F.lit(""), text),
        F.lit(""),
        F.lit(""),
    )
    body = table(spark, sf, "events").select(file_name("interval-").alias("file"), F.col("event_id").alias("pos"), line.alias("line"))
    return with_preamble(body, preamble(INTERVAL_HEADER))


def interval_csv(spark, sf):
    return counted(read_layout("interval", interval_lines(spark, sf)), *BASIC)


INTERVAL_SQL = """
WITH e AS (
  SELECT event_id, 'interval-' || (user_id % 20) || '.csv' AS file, 'Optima_' || user_id AS nmi,
    CASE WHEN event_id % 17 <> 0 THEN date_trunc('minute', ts) END AS t_start,
    event_id % 11 = 0 AS u_blank, event_id % 11 <> 0 AND event_id % 13 = 0 AS u_bad, event_id % 3 = 0 AS g_blank, value
  FROM events),
c AS (
  SELECT *, 'E1' AS suffix, CASE WHEN NOT u_blank AND NOT u_bad THEN value END AS val,
    CASE WHEN t_start IS NULL THEN 'unparseable_timestamp' WHEN u_blank THEN 'blank_value'
      WHEN u_bad THEN 'unparseable_value' END AS skip_reason FROM e
  UNION ALL
  SELECT *, 'B1', CASE WHEN NOT g_blank THEN value END,
    CASE WHEN t_start IS NULL THEN 'ignored'
      WHEN g_blank AND u_blank THEN 'ignored' WHEN g_blank THEN 'blank_value' END FROM e)
SELECT file, nmi, suffix, 'kwh' AS uom, t_start, val, skip_reason FROM c WHERE coalesce(skip_reason, '') <> 'ignored'"""

# ---- demand profile ---------------------------------------------------------

DEMAND_HEADER = "Business Unit,Identifier,Identifier Type,ReadingDateTime,E,kW,kVa,Power Factor,Site Name"
DEMAND_TOP = ["Commodities:,Electricity", "Sites:,All", "Status:,Open", "Country:,AU", "Start:,x", "End:,y", "", "", DEMAND_HEADER]


def demand_lines(spark, sf):
    stamp = plus_minutes(F.col("o_orderdate"), F.col("o_orderkey") % 48 * 30)
    price = F.col("o_totalprice").cast("string")
    cells = csv(
        F.lit("Unit"),
        every("o_orderkey", 19, F.lit(" "), F.concat(F.lit("D"), F.col("o_custkey"))),
        F.lit("NMI"),
        every("o_orderkey", 23, F.lit("soon"), F.date_format(stamp, "dd-MMM-yyyy HH:mm:ss")),
        F.lit("1"),
        every("o_orderkey", 7, F.lit("n/a?"), price),
        every("o_orderkey", 5, F.lit(""), price),
        F.lit("0.8800"),
    )
    line = (
        F.when(F.col("o_orderkey") % 31 == 0, F.substring_index(cells, ",", 6))
        .when(F.col("o_orderkey") % 29 == 0, F.concat(cells, F.lit(",Site,extra")))
        .otherwise(F.concat(cells, F.lit(",Site")))
    )
    body = table(spark, sf, "orders").select(
        file_name("demand profile ", "o_custkey").alias("file"), F.col("o_orderkey").alias("pos"), line.alias("line")
    )
    return with_preamble(body, preamble(*DEMAND_TOP))


def demand_unpivot(spark, sf):
    out = counted(read_layout("demand", demand_lines(spark, sf)), "file", "lookup_key", "column", "uom", "t_start", "raw_val", "val", "skip_reason")
    keep = F.col("skip_reason").isNull() | (F.col("skip_reason") == "unparseable_value")
    return out.select(
        "file",
        F.when(keep, F.col("lookup_key")).alias("lookup_key"),
        F.when(keep, F.col("column")).alias("measure"),
        F.when(keep, F.col("uom")).alias("uom"),
        F.when(keep, F.col("t_start")).alias("t_start"),
        F.when(keep, F.col("raw_val")).alias("raw_val"),
        F.when(keep, F.col("val")).alias("val"),
        "skip_reason",
    )


DEMAND_SQL = """
WITH o AS (
  SELECT 'demand profile ' || (o_custkey % 20) || '.csv' AS file, 'Optima_D' || o_custkey AS id, o_orderkey AS k,
    o_orderdate + to_minutes(CAST(o_orderkey % 48 * 30 AS INTEGER)) AS t, o_totalprice AS p FROM orders),
r AS (SELECT *, CASE WHEN k % 31 = 0 THEN 'row_shape_mismatch' WHEN k % 29 = 0 THEN 'row_shape_mismatch'
    WHEN k % 19 = 0 THEN 'row_anchor_failure' WHEN k % 23 = 0 THEN 'unparseable_timestamp' END AS rr FROM o),
c AS (
  SELECT file, id || '-demand-kw' AS lookup_key, 'kW' AS measure, 'kw' AS uom, t AS t_start,
    CASE WHEN k % 7 = 0 THEN 'n/a?' ELSE CAST(p AS VARCHAR) END AS raw_val, CASE WHEN k % 7 <> 0 THEN p END AS val,
    CASE WHEN k % 7 = 0 THEN 'unparseable_value' END AS skip_reason FROM r WHERE rr IS NULL
  UNION ALL SELECT file, id || '-demand-kva', 'kVa', 'kva', t, CAST(p AS VARCHAR), p, NULL FROM r WHERE rr IS NULL AND k % 5 <> 0
  UNION ALL SELECT file, id || '-demand-pf', 'Power Factor', '', t, '0.8800', 0.88, NULL FROM r WHERE rr IS NULL
  UNION ALL SELECT file, NULL, NULL, NULL, NULL, NULL, NULL, rr FROM r WHERE rr IS NOT NULL)
SELECT * FROM c"""

# ---- usage and spend --------------------------------------------------------


def billing_lines(spark, sf):
    values = [
        F.when((F.col("o_orderkey") + i) % 4 != 0, (F.col("o_totalprice") + i).cast("string"))
        for i in range(len(layouts.BILLING_FIELDS))
    ]
    header = ",".join(["Identifier", "Date", *[c for c, _, _ in layouts.BILLING_FIELDS], "Usage Measurement Unit", "Spend Currency"])
    line = csv(
        F.concat(F.lit("B"), F.col("o_custkey")),
        every("o_orderkey", 37, F.lit("2026"), F.date_format("o_orderdate", "MMM yyyy")),
        *values,
        pick(["kWh", "", "MWh"], F.col("o_custkey") % 3),
        pick(["AUD", "NZD", ""], F.col("o_orderkey") % 3),
    )
    body = table(spark, sf, "orders").select(
        file_name("Bunnings-Usage and Spend Report ", "o_custkey").alias("file"), F.col("o_orderkey").alias("pos"), line.alias("line")
    )
    return with_preamble(body, preamble("a:,1", "b:,2", "c:,3", "d:,4", "e:,5", "", "", header))


def billing_unpivot(spark, sf):
    return (
        # dealt out as lines: a task that reads many orders would sum all of their cells
        counted(read_layout("billing", billing_lines(spark, sf).repartition("file", "pos")), "nmi", "column", "uom", "t_start", "val", "skip_reason")
        .groupBy("nmi", F.col("column").alias("field"), "uom", "t_start", "skip_reason")
        .agg(F.count("*").alias("cells"), F.round(F.sum("val"), 2).alias("total"))
    )


_BILLING_ROWS = ", ".join(
    f"({i}, '{c}', {'TRUE' if ('charge' in s or 'spend' in s) else 'FALSE'})"
    for i, (c, s, _) in enumerate(layouts.BILLING_FIELDS)
)
BILLING_SQL = f"""
WITH f(i, field, is_money) AS (VALUES {_BILLING_ROWS}),
c AS (
  SELECT 'B' || o_custkey AS nmi, field,
    CASE WHEN is_money THEN (['aud','nzd','aud'])[1 + o_orderkey % 3] ELSE (['kwh','kwh','mwh'])[1 + o_custkey % 3] END AS uom,
    CASE WHEN o_orderkey % 37 <> 0 THEN date_trunc('month', o_orderdate)::TIMESTAMP END AS t_start,
    CASE WHEN o_orderkey % 37 = 0 THEN 'unparseable_timestamp' END AS skip_reason,
    CASE WHEN (o_orderkey + i) % 4 <> 0 THEN o_totalprice + i END AS val
  FROM orders, f
  WHERE CASE WHEN o_orderkey % 37 = 0 THEN i = 0 ELSE (o_orderkey + i) % 4 <> 0 END)
SELECT nmi, field, uom, t_start, skip_reason, count(*) AS cells, round(sum(val), 2) AS total FROM c GROUP BY ALL"""

# ---- one meter per row ------------------------------------------------------


def tall_lines(spark, sf, header: str, cells, prefix: str):
    line = csv(*cells)
    body = table(spark, sf, "events").select(file_name(prefix).alias("file"), F.col("event_id").alias("pos"), line.alias("line"))
    return with_preamble(body, preamble(header))


def _reading():
    """The value with some blank and some broken cells."""
    return every("event_id", 11, F.lit(""), every("event_id", 13, F.lit("x1"), every("event_id", 19, F.lit("NaN"), F.col("value").cast("string"))))


def _iso(minutes: int = 0):
    return F.date_format(plus_minutes(floor_minutes(F.col("ts"), 1), F.lit(minutes)), "yyyy-MM-dd'T'HH:mm:ss")


TALL_SQL = """
t AS (
  SELECT event_id, user_id, CASE WHEN event_id % 17 <> 0 THEN date_trunc('minute', ts) END AS t_start,
    CASE WHEN event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 19 <> 0 THEN value END AS val,
    CASE WHEN event_id % 17 = 0 THEN 'unparseable_timestamp' WHEN event_id % 11 = 0 THEN 'blank_value'
      WHEN event_id % 13 = 0 THEN 'unparseable_value' WHEN event_id % 19 = 0 THEN 'blank_value' END AS skip_reason
  FROM events)
"""


def water_lines(spark, sf):
    unit = every("event_id", 10, F.lit("m3"), pick(["kL", "L"], F.col("user_id") % 2))
    start = every("event_id", 17, F.lit("?"), _iso())
    return tall_lines(
        spark, sf, ",".join(layouts.WATER_COLUMNS), [F.col("user_id"), start, _iso(15), _reading(), unit], "water-"
    )


def water_csv(spark, sf):
    return counted(read_layout("envizi_water", water_lines(spark, sf)), "nmi", "uom", "t_start", "t_end", "val", "skip_reason")


WATER_SQL = f"""WITH {TALL_SQL},
u AS (SELECT t.*, lower(CASE WHEN event_id % 10 = 0 THEN 'm3' WHEN user_id % 2 = 0 THEN 'kL' ELSE 'L' END) AS own FROM t),
f AS (SELECT user_id, arg_min(own, event_id) AS first_unit FROM u WHERE skip_reason IS NULL GROUP BY user_id)
SELECT 'Envizi_' || u.user_id AS nmi, coalesce(first_unit, own) AS uom, t_start,
  (SELECT date_trunc('minute', ts) + INTERVAL 15 MINUTE FROM events e WHERE e.event_id = u.event_id) AS t_end, val, skip_reason
FROM u LEFT JOIN f ON f.user_id = u.user_id"""


def units_per_meter(spark, sf):
    rows = layouts.BY_NAME["envizi_water"].rows(water_lines(spark, sf))
    return layouts.first_units(layouts.water_cells(rows))


UNITS_SQL = f"""WITH {TALL_SQL},
u AS (SELECT t.*, lower(CASE WHEN event_id % 10 = 0 THEN 'm3' WHEN user_id % 2 = 0 THEN 'kL' ELSE 'L' END) AS own FROM t
  WHERE skip_reason IS NULL)
SELECT 'water-' || (user_id % 20) || '.csv' AS file, 'Envizi_' || user_id AS nmi, arg_min(own, event_id) AS first_unit,
  count(DISTINCT own) AS units FROM u GROUP BY user_id"""


def electricity_csv(spark, sf):
    start = every("event_id", 17, F.lit("?"), _iso())
    lines = tall_lines(
        spark, sf, "Serial_No,Interval_End,kWh,Interval_Start", [F.col("user_id"), _iso(15), _reading(), start], "elec-"
    )
    return counted(read_layout("envizi_electricity", lines), *BASIC)


ELECTRICITY_SQL = f"""WITH {TALL_SQL}
SELECT 'elec-' || (user_id % 20) || '.csv' AS file, 'Envizi_' || user_id AS nmi, 'E1' AS suffix, 'kwh' AS uom, t_start, val, skip_reason
FROM t"""


def bulk_water_csv(spark, sf):
    start = every("event_id", 17, F.lit("?"), F.date_format("ts", "yyyy-MM-dd HH:mm:00"))
    lines = tall_lines(spark, sf, "Serial_No,Date_Time,kL", [F.col("user_id"), start, _reading()], "bulk-")
    return counted(read_layout("envizi_bulk_water", lines), *BASIC)


BULK_SQL = f"""WITH {TALL_SQL}
SELECT 'bulk-' || (user_id % 20) || '.csv' AS file, 'Envizi_' || user_id AS nmi, 'E1' AS suffix, 'kl' AS uom, t_start, val, skip_reason
FROM t"""


def comx_lines(spark, sf):
    in_wh = F.col("user_id") % 2 == 0
    file = F.concat(F.lit("comx-"), F.col("user_id"), F.lit(".csv"))
    stamp = every("event_id", 17, F.lit("?"), F.date_format("ts", "dd/MM/yyyy HH:mm"))
    events = table(spark, sf, "events")
    body = events.select(file.alias("file"), "user_id", F.col("event_id").alias("pos"), csv(stamp, F.lit("on"), _reading()).alias("line"))
    site = F.concat(F.lit("ComX510_Green_Square,v1,x,y,Site No "), F.col("user_id"))
    energy = F.when(in_wh, F.lit("Active energy (Wh)")).otherwise(F.lit("Active energy (kWh)"))
    head = F.concat(F.lit("Local Time Stamp,State,"), energy)
    top = body.select("file", "user_id").distinct().select(
        "file", F.posexplode(F.array(F.lit("Gateway"), site, *[F.lit("-")] * 4, head)).alias("pos", "line")
    )
    lines = top.unionByName(body.select("file", (F.col("pos") + 1000).alias("pos"), "line"))
    return lines.select("file", F.floor(F.col("pos") / (SPLIT * 5)).cast("long").alias("split"), F.col("pos").cast("long").alias("pos"), "line")


def comx_csv(spark, sf):
    out = counted(read_layout("comx", comx_lines(spark, sf)), *BASIC)
    return out.withColumn("val", F.round("val", 8))


COMX_SQL = f"""WITH {TALL_SQL}
SELECT 'comx-' || user_id || '.csv' AS file, 'GPWComX_SiteNo' || user_id AS nmi, 'E1' AS suffix, 'kwh' AS uom, t_start,
  round(CASE WHEN user_id % 2 = 0 THEN val / 1000 ELSE val END, 8) AS val,
  CASE WHEN event_id % 11 = 0 THEN 'blank_value' WHEN event_id % 13 = 0 THEN 'unparseable_value'
    WHEN event_id % 19 = 0 THEN 'blank_value' WHEN event_id % 17 = 0 THEN 'unparseable_timestamp' END AS skip_reason
FROM t"""


# ---- one meter per column ---------------------------------------------------

METERS_PER_FILE = 50


def _slots(spark, sf):
    """Half-hourly maximum per user; a fifth of all meter days is zero."""
    group = F.floor(F.col("user_id") / METERS_PER_FILE).cast("long")
    return (
        table(spark, sf, "events")
        .select(group.alias("grp"), "user_id", floor_minutes(F.col("ts"), 30).alias("t"), "value", "event_type")
        .groupBy("grp", "user_id", "t")
        .agg(F.max("value").alias("val"), F.max("event_type").alias("kind"))
        .withColumn("val", F.when((F.col("user_id") + F.dayofmonth("t")) % 5 == 0, F.lit(0.0)).otherwise(F.col("val")))
    )


SLOTS_SQL = """
s AS (
  SELECT user_id // 50 AS grp, user_id, time_bucket(INTERVAL 30 MINUTE, ts) AS t, max(event_type) AS kind,
    CASE WHEN (user_id + day(time_bucket(INTERVAL 30 MINUTE, ts))) % 5 = 0 THEN 0.0 ELSE max(value) END AS val
  FROM events GROUP BY user_id, time_bucket(INTERVAL 30 MINUTE, ts))
"""


def _wide(spark, sf, file, cell, stamp, title, top, first):
    """One line per group and half hour with a cell for each meter of the group."""
    slots = _slots(spark, sf)
    meters = slots.groupBy("grp").agg(F.array_sort(F.collect_set("user_id")).alias("users"))
    rows = slots.groupBy("grp", "t").agg(F.map_from_entries(F.collect_list(F.struct("user_id", cell.alias("c")))).alias("m"))
    values = F.transform("users", lambda u: F.coalesce(F.try_element_at("m", u), F.lit("")))
    body = rows.join(meters, "grp").select(
        file.alias("file"),
        (F.datediff(F.to_date("t"), F.lit("2024-01-01").cast("date")) * 1440 + F.hour("t") * 60 + F.minute("t")).alias("pos"),
        F.concat_ws(",", stamp, F.array_join(values, ","), F.lit("9")).alias("line"),
    )
    names = F.array_join(F.transform("users", title), ",")
    heads_of = meters.select(file.alias("file"), F.concat_ws(",", F.lit(first), names, F.lit("Temp C")).alias("h"))
    lead = heads_of.select("file", F.posexplode(F.array(*[F.lit(x) for x in top], F.col("h"))).alias("pos", "line"))
    lines = lead.unionByName(body.select("file", (F.col("pos") + 1000).alias("pos"), "line"))
    return lines.select("file", F.floor(F.col("pos") / 10_000).cast("long").alias("split"), F.col("pos").cast("long").alias("pos"), "line")


def wide_lines(spark, sf):
    cell = F.when(F.col("user_id") % 9 == 8, F.lit("err")).otherwise(F.col("val").cast("string"))
    day = F.when(F.minute("t") + F.hour("t") == 0, F.lit("no date")).otherwise(F.date_format("t", "yyyy-MM-dd"))
    return _wide(
        spark,
        sf,
        F.concat(F.lit("wide-"), F.col("grp"), F.lit(".csv")),
        cell,
        F.concat(day, F.lit(","), F.date_format("t", "HH:mm")),
        lambda u: F.concat(F.lit("M"), u, F.lit(" kWh")),
        ["Report", "junk"],
        "Date,Start Time",
    )


def wide_unpivot(spark, sf):
    """Cells of non-zero days; broken cells; broken rows once each."""
    out = counted(read_layout("wide_kwh", wide_lines(spark, sf)), *BASIC)
    row_level = F.col("skip_reason") == "unparseable_timestamp"
    return out.withColumn("nmi", F.when(row_level, F.lit(None)).otherwise(F.col("nmi"))).withColumn(
        "val", F.when(row_level, F.lit(None)).otherwise(F.col("val"))
    )


WIDE_SQL = f"""WITH {SLOTS_SQL},
c AS (SELECT grp, user_id, t, CASE WHEN user_id % 9 <> 8 THEN val END AS val,
    sum(CASE WHEN user_id % 9 <> 8 THEN val END) OVER (PARTITION BY user_id, CAST(t AS DATE)) AS total FROM s
  WHERE hour(t) + minute(t) > 0)
SELECT 'wide-' || grp || '.csv' AS file, 'Optima_M' || user_id AS nmi, 'E1' AS suffix, 'kwh' AS uom, t AS t_start, val,
  CASE WHEN user_id % 9 = 8 THEN 'unparseable_value' END AS skip_reason
FROM c WHERE user_id % 9 = 8 OR total <> 0
UNION ALL
SELECT 'wide-' || grp || '.csv', NULL, 'E1', 'kwh', CAST(NULL AS TIMESTAMP), CAST(NULL AS DOUBLE), 'unparseable_timestamp'
FROM (SELECT DISTINCT grp, t FROM s WHERE hour(t) + minute(t) = 0)"""


def zero_day_filter(spark, sf):
    """Readings and kept readings per meter."""
    readings = read_layout("wide_kwh", wide_lines(spark, sf)).filter(F.col("val").isNotNull() & F.col("t_start").isNotNull())
    return readings.groupBy("nmi").agg(
        F.count("*").alias("readings"), F.count(F.when(F.col("skip_reason").isNull(), 1)).alias("kept")
    )


ZERO_SQL = f"""WITH {SLOTS_SQL},
c AS (SELECT user_id, val, sum(val) OVER (PARTITION BY user_id, CAST(t AS DATE)) AS total FROM s
  WHERE hour(t) + minute(t) > 0 AND user_id % 9 <> 8)
SELECT 'Optima_M' || user_id AS nmi, count(*) AS readings, count(*) FILTER (total <> 0) AS kept FROM c GROUP BY user_id"""

STATUS_TEXT = {"click": "Standby", "view": "Normal Operation", "error": "Error Exists", "signup": "Off", "purchase": "Unheard Of"}


def solar_lines(spark, sf):
    status = F.lit(None).cast("string")
    for kind, text in STATUS_TEXT.items():
        status = F.when(F.col("kind") == kind, F.lit(text)).otherwise(status)
    broken = (F.col("user_id") + F.hour("t")) % 7 == 0
    cell = F.when(F.col("user_id") % 4 == 3, status).when(broken, F.lit("oops")).otherwise(F.col("val").cast("string"))
    # In every third file one export hour carries another zone, which fails the file.
    zone = F.when((F.col("grp") % 3 == 2) & (F.hour("t") == 5), F.lit(" AEDT")).otherwise(F.lit(" AEST"))
    return _wide(
        spark,
        sf,
        F.concat(F.lit("RACV_Noosa_Solar-"), F.col("grp"), F.lit(".csv")),
        cell,
        F.concat(F.date_format("t", "d-MMM-yy h:mm a"), zone),
        lambda u: F.concat(F.lit("p:site:"), u, F.lit(" (kW-hr)")),
        [],
        "timestamp",
    )


def status_or_numeric(spark, sf):
    return counted(read_layout("solar", solar_lines(spark, sf)), *BASIC)


SOLAR_SQL = f"""WITH {SLOTS_SQL},
k AS (SELECT *, user_id % 4 = 3 AS is_status, (user_id + hour(t)) % 7 = 0 AS broken FROM s),
n AS (SELECT user_id, count(*) FILTER (NOT is_status AND NOT broken) * 2 >= count(*) AS is_numeric FROM k GROUP BY user_id)
SELECT 'RACV_Noosa_Solar-' || grp || '.csv' AS file, 'p:site:' || k.user_id AS nmi, 'E1' AS suffix,
  CASE WHEN is_numeric THEN 'kwh' ELSE 'mode' END AS uom, t AS t_start,
  CASE WHEN is_numeric THEN CASE WHEN NOT broken THEN val END
    ELSE CAST(CASE kind WHEN 'click' THEN 8 WHEN 'view' THEN 4 WHEN 'error' THEN 7 WHEN 'signup' THEN 1 END AS DOUBLE) END AS val,
  CASE WHEN is_numeric AND broken THEN 'unparseable_value' END AS skip_reason
FROM k JOIN n ON n.user_id = k.user_id
WHERE NOT (grp % 3 = 2 AND grp IN (SELECT grp FROM s WHERE hour(t) = 5))
  AND (is_numeric OR (is_status AND kind <> 'purchase'))"""

# ---- classification ---------------------------------------------------------

HEADS = [
    ("f{}.csv", ["100,NEM12,202401010000,A,B", "200,N,E1,1,E1,N1,S,kWh,30,"], "nem", None, None),
    ("Meter_Data_WA (AU)_Electricity_{}.csv", ["Unnamed: 0,NMI,Unnamed: 2", "0,No data,"], "synergy_no_data", "processed_empty", "no_data_sentinel"),
    ("RACV_Noosa_Solar_{}.csv", ["timestamp,p:a", "1-Jan-24 1:00 AM AEST,1"], "solar", None, None),
    ("w{}.csv", ["Serial_No,Interval_Start,Interval_End,Consumption,Consumption Unit", "1,a,b,2,kL"], "envizi_water", None, None),
    ("e{}.csv", ["Serial_No,Interval_Start,Interval_End,kWh", "1,a,b,2"], "envizi_electricity", None, None),
    ("k{}.csv", ["Report", "x", "Date,Start Time,M1 kWh", "2024-01-01,00:30,1"], "wide_kwh", None, None),
    ("RACV-Usage and Spend Report {}.csv", ["anything"], "archived_billing", "processed_external", "external_archive"),
    ("Bunnings-Usage and Spend Report {}.csv", ["?"], "billing", None, None),
    ("Demand_Profile_{}.csv", DEMAND_TOP, "demand", None, None),
    ("i{}.csv", [INTERVAL_HEADER, "a"], "interval", None, None),
    ("b{}.csv", ["Serial_No,Date_Time,kL", "1,2024-01-01 00:00:00,2"], "envizi_bulk_water", None, None),
    ("c{}.csv", ["Gateway", "ComX510_Green_Square,v,x,y,Site", "-", "-", "-", "-", "Local Time Stamp,Active energy (Wh)"], "comx", None, None),
    ("u{}.csv", ["who,knows", "1,2"], None, "parse_failed", "parser_error"),
    ("OptimaGenerationData{}.csv", ["Serial_No,Interval_Start,Interval_End,kWh", "1,a,b,2"], None, "parse_failed", "parser_error"),
    ("n{}.csv", ["Serial_No,Interval_Start,Interval_End,kWh\x00", "1,a,b,2"], None, "parse_failed", "parser_error"),
    ("demand profile {}.csv", [*DEMAND_TOP, "No data found"], "demand", "processed_empty", "no_data_sentinel"),
    ("x{}.csv", ["Gateway", "ComX510_Green_Square,v,x,y,", "-", "-", "-", "-", "Local Time Stamp,Active energy (Wh)"], "comx", "parse_failed", "parser_error"),
]


def classify_files(spark, sf):
    """One file per customer, its layout by key."""
    kind = F.col("c_custkey") % len(HEADS)
    names = F.array(*[F.struct(F.lit(n.split("{}")[0]).alias("a"), F.lit(n.split("{}")[1]).alias("b")) for n, *_ in HEADS])
    texts = F.array(*[F.array(*[F.lit(x) for x in lines]) for _, lines, *_ in HEADS])
    at = (kind + 1).cast("int")
    picked = table(spark, sf, "customer").select("c_custkey", F.element_at(names, at).alias("n"), F.element_at(texts, at).alias("t"))
    lines = picked.select(
        F.concat(F.lit("in/"), F.col("n")["a"], F.col("c_custkey"), F.col("n")["b"]).alias("file"), F.posexplode("t").alias("pos", "line")
    ).select("file", F.lit(0).cast("long").alias("split"), F.col("pos").cast("long").alias("pos"), "line")
    return classify(heads(lines)).select("name", "fmt", "status", "reason")


def _sql_text(x):
    return "NULL" if x is None else f"'{x}'"


CLASSIFY_SQL = (
    "WITH h(k, a, b, fmt, status, reason) AS (VALUES "
    + ", ".join(
        f"({i}, '{n.split('{}')[0]}', '{n.split('{}')[1]}', {_sql_text(f)}, {_sql_text(s)}, {_sql_text(r)})"
        for i, (n, _, f, s, r) in enumerate(HEADS)
    )
    + f") SELECT a || c_custkey || b AS name, fmt, status, reason FROM customer JOIN h ON k = c_custkey % {len(HEADS)}"
)

# ---- cells ------------------------------------------------------------------


def _messy(spark, sf):
    text = F.col("value").cast("string")
    raw = pick(["", " {} ", "abc", "\t", "nan", "{}d", "1_000", "{}"], F.col("event_id") % 8)
    return table(spark, sf, "events").select(
        "event_id",
        "event_type",
        F.when(F.col("event_id") % 9 != 0, F.replace(raw, F.lit("{}"), text)).alias("raw"),
        F.when(F.col("event_id") % 5 != 0, F.col("ts")).alias("t"),
    )


MESSY_SQL = """
x AS (
  SELECT event_id, event_type, event_id % 9 = 0 OR event_id % 8 IN (0, 3) AS blank, event_id % 5 = 0 AS bad_ts,
    event_id % 9 <> 0 AND event_id % 8 IN (1, 7) AS fine, value FROM events)
"""


def coerce_numeric_counts(spark, sf):
    raw = F.col("raw")
    blank = raw.isNull() | (F.trim(raw, F.lit(" \t")) == "")
    return (
        _messy(spark, sf)
        .groupBy("event_type")
        .agg(
            F.count(F.when(blank, 1)).alias("blank"),
            F.count(F.when(~blank & number(raw).isNull(), 1)).alias("unparseable"),
            F.count(number(raw)).alias("numbers"),
            F.round(F.sum(number(raw)), 2).alias("total"),
        )
    )


COERCE_SQL = f"""WITH {MESSY_SQL}
SELECT event_type, count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND NOT fine) AS unparseable,
  count(*) FILTER (fine) AS numbers, round(sum(value) FILTER (fine), 2) AS total FROM x GROUP BY event_type"""


def skip_reason_order(spark, sf):
    return _messy(spark, sf).select("event_id", skip_reason(F.trim(F.col("raw"), F.lit(" \t")), F.col("t")).alias("skip_reason"))


SKIP_SQL = f"""WITH {MESSY_SQL}
SELECT event_id, CASE WHEN blank THEN 'blank_value' WHEN bad_ts THEN 'unparseable_timestamp'
  WHEN NOT fine THEN 'unparseable_value' END AS skip_reason FROM x"""

QUERIES = {
    "interval_unpivot": (interval_csv, INTERVAL_SQL),
    "demand_unpivot": (demand_unpivot, DEMAND_SQL),
    "billing_unpivot": (billing_unpivot, BILLING_SQL),
    "csv_layouts_water": (water_csv, WATER_SQL),
    "csv_layouts_water_units": (units_per_meter, UNITS_SQL),
    "csv_layouts_electricity": (electricity_csv, ELECTRICITY_SQL),
    "csv_layouts_bulk_water": (bulk_water_csv, BULK_SQL),
    "csv_layouts_logger": (comx_csv, COMX_SQL),
    "wide_unpivot": (wide_unpivot, WIDE_SQL),
    "zero_day_filter": (zero_day_filter, ZERO_SQL),
    "status_or_numeric": (status_or_numeric, SOLAR_SQL),
    "classify_files": (classify_files, CLASSIFY_SQL),
    "coerce_numeric_counts": (coerce_numeric_counts, COERCE_SQL),
    "skip_reason_order": (skip_reason_order, SKIP_SQL),
}
