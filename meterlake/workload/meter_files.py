"""Queries on meter-data files: parsing, overlay, splitting, re-gridding, pivots."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake import schemas
from meterlake.functions.identifiers import prefix_nem12_line
from meterlake.functions.stamps import floor_minutes, nem_stamp, plus_minutes, plus_seconds
from meterlake.operators import outcome, resolve, series
from meterlake.session import scratch_dir
from meterlake.sources import nem12, nem13
from meterlake.sources.lines import heads
from meterlake.workload.feeds import (
    MAP_SQL,
    METER_SQL,
    file_name,
    meter_map,
    nem12_blocks,
    nem12_lines,
    pick,
    table,
)

FILLED = ["file", "nmi", "suffix", "uom", "serno", "t_start", "t_end", "val"]
FILLED_SQL = f"""WITH {METER_SQL}
SELECT file, nmi, suffix, unit AS uom, 'SER' || user_id AS serno, t_start, t_end, val FROM slots"""


def nem12_parse(spark, sf):
    return nem12.parse_lines(nem12_lines(spark, sf), blanks=schemas.FILLED).filter(F.col("val").isNotNull()).select(*FILLED)


def block_readings(spark, sf):
    """The shuffle-free reader, on blocks held in a table; no empty cells."""
    blocks = nem12_blocks(spark, sf).select(
        "file",
        F.lit(0).cast("long").alias("split"),
        F.lit(0).cast("long").alias("pos"),
        F.substring_index(F.regexp_replace("text", "^200,", ""), "\n900", 1).alias("block"),
    )
    return nem12.expand_days(nem12.days_from_blocks(blocks), blanks=schemas.FILLED)


def nem12_blocks_parse(spark, sf):
    return block_readings(spark, sf).filter(F.col("val").isNotNull()).select(*FILLED)


def nem12_file_scan(spark, sf):
    """Files written as NEM12 text, read back block by block."""
    folder = scratch_dir(spark, "nem12-files")
    nem12_blocks(spark, sf).select("text").write.text(folder)
    read = nem12.read_nem12(spark, folder).filter(F.col("val").isNotNull())
    return read.select(*[c for c in FILLED if c != "file"])


SCAN_SQL = f"""WITH {METER_SQL}
SELECT nmi, suffix, unit AS uom, 'SER' || user_id AS serno, t_start, t_end, val FROM slots"""


def nem12_slot_counts(spark, sf):
    """All slots, blank ones included, per file and channel."""
    return (
        nem12.parse_lines(nem12_lines(spark, sf), blanks=schemas.COUNTED)
        .groupBy("file", "nmi", "suffix")
        .agg(
            F.sum("cells").alias("slots"),
            F.count("val").alias("filled"),
            F.coalesce(F.sum(F.when(F.col("skip_reason") == "blank_value", F.col("cells"))), F.lit(0).cast("long")).alias("blank"),
            F.min("t_start").alias("first_start"),
            F.max("t_end").alias("last_end"),
        )
    )


SLOT_SQL = f"""WITH {METER_SQL},
d AS (SELECT file, nmi, suffix, minutes, day, count(*) AS filled FROM slots GROUP BY ALL)
SELECT file, nmi, suffix, CAST(sum(1440 // minutes) AS BIGINT) AS slots, CAST(sum(filled) AS BIGINT) AS filled,
  CAST(CASE WHEN suffix = 'X9' THEN 0 ELSE sum(1440 // minutes - filled) END AS BIGINT) AS blank,
  CAST(min(day) AS TIMESTAMP) AS first_start, CAST(max(day) AS TIMESTAMP) + INTERVAL 1 DAY AS last_end
FROM d GROUP BY file, nmi, suffix"""


def nem12_event_overlay(spark, sf):
    return (
        nem12.parse_lines(nem12_lines(spark, sf), blanks=schemas.FILLED)
        .filter(F.col("val").isNotNull())
        .select("nmi", "suffix", "t_start", "quality", "event_code", "event_desc")
    )


OVERLAY_SQL = f"""WITH {METER_SQL},
ev AS (
  SELECT nmi, suffix, day, slot, minutes, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS err
  FROM m WHERE event_type IN ('error', 'signup') GROUP BY ALL),
hit AS (
  SELECT s.nmi, s.suffix, s.t_start, e.err,
    row_number() OVER (PARTITION BY s.nmi, s.suffix, s.t_start ORDER BY e.slot DESC NULLS LAST) AS n
  FROM slots s LEFT JOIN ev e ON s.nmi = e.nmi AND s.suffix = e.suffix AND s.day = e.day
    AND s.slot BETWEEN e.slot AND e.slot + 2)
SELECT nmi, suffix, t_start, CASE err WHEN 1 THEN 'E52' WHEN 0 THEN 'S14' ELSE 'A' END AS quality,
  CASE err WHEN 1 THEN '89' WHEN 0 THEN '32' ELSE '' END AS event_code,
  CASE err WHEN 1 THEN 'Metering, suspect' WHEN 0 THEN 'Estimate' ELSE '' END AS event_desc
FROM hit WHERE n = 1"""


def nem12_daily_kwh(spark, sf):
    """Flagship: blocks to readings to sensors to daily totals."""
    readings = block_readings(spark, sf)
    rows = resolve.to_lake(resolve.resolve(readings, meter_map(spark, sf)))
    daily = series.daily_totals(rows.filter(F.col("unit") == "kwh"))
    return daily.select("sensorId", "day", F.round("total", 4).alias("total"), "readings")


DAILY_SQL = f"""WITH {METER_SQL}, {MAP_SQL}
SELECT sensor_id AS sensorId, day, round(sum(val), 4) AS total, count(*) AS readings
FROM slots JOIN mm ON mm.lookup_key = nmi || '-' || suffix
WHERE unit = 'kwh' AND suffix <> 'X9' GROUP BY sensor_id, day"""


def nem12_split_context(spark, sf):
    """How many days of each file got their meter from an earlier split."""
    lines = nem12_lines(spark, sf)
    days = nem12.days_from_lines(lines)
    return (
        days.groupBy("file")
        .agg(
            F.count("*").alias("days"),
            F.count_distinct("ctx.nmi", "ctx.suffix").alias("channels"),
            F.sum(F.size("events")).cast("long").alias("events"),
        )
    )


CONTEXT_SQL = f"""WITH {METER_SQL},
ev AS (SELECT file, count(*) AS events FROM (
  SELECT DISTINCT file, nmi, suffix, day, slot FROM m WHERE event_type IN ('error', 'signup')) GROUP BY file),
d AS (SELECT file, count(DISTINCT (nmi, suffix, day)) AS days, count(DISTINCT (nmi, suffix)) AS channels
  FROM m GROUP BY file)
SELECT file, days, channels, CAST(coalesce(events, 0) AS BIGINT) AS events FROM d LEFT JOIN ev USING (file)"""


def nem12_prefix_rewrite(spark, sf):
    """Prefixing twice is the same as prefixing once."""
    lines = nem12_lines(spark, sf).select("file", "line")
    once = prefix_nem12_line(F.col("line"))
    out = lines.select("file", once.alias("once"), prefix_nem12_line(once).alias("twice"))
    return out.filter(F.col("once").startswith("200,")).select(
        "file", F.col("once").alias("line"), (F.col("once") == F.col("twice")).alias("stable")
    )


PREFIX_SQL = f"""WITH {METER_SQL}
SELECT DISTINCT file, '200,Optima_' || nmi || ',E1B1Q1K1,1,' || suffix || ',N1,SER' || user_id || ',' || uom || ','
  || minutes || ',20240301' AS line, TRUE AS stable FROM m"""


def nem_file_headers(spark, sf):
    lines = nem12_lines(spark, sf)
    return nem13.file_headers(heads(lines))


HEADERS_SQL = f"""WITH {METER_SQL}
SELECT DISTINCT file, 'NEM12' AS version_header, TIMESTAMP '2024-02-01 00:00:00' AS creation_date,
  'MDP1' AS from_participant, 'Retailer1' AS to_participant, FALSE AS assumed FROM m"""


def nem12_transactions(spark, sf):
    return nem13.transactions(nem12_lines(spark, sf)).select(
        "file", "record", "trans_code", "ret_service_order", "read_datetime", "index_read"
    )


TRANSACTIONS_SQL = f"""WITH {METER_SQL},
o AS (SELECT file, nmi, suffix, day, slot, max(value) AS val,
  max(CASE WHEN event_type = 'purchase' THEN event_id END) AS order_id FROM m GROUP BY ALL)
SELECT file, 500 AS record, 'O' AS trans_code, 'S' || order_id AS ret_service_order,
  CAST(day AS TIMESTAMP) AS read_datetime, CAST(val AS VARCHAR) AS index_read FROM o WHERE order_id IS NOT NULL"""


def register_lines(spark, sf):
    """Line items as NEM13 accumulation records, one register read per item."""
    days = F.col("l_quantity").cast("int")
    end = plus_minutes(F.col("l_shipdate"), days * 1440 + F.col("l_linenumber") * 7)
    line = F.concat_ws(
        ",",
        F.lit("250"),
        F.concat(F.lit("NMI"), F.col("l_suppkey")),
        F.lit("11,1"),
        pick(["11", "E1", "B1"], F.col("l_linenumber") % 3),
        F.lit("N1"),
        F.concat(F.lit("SER"), F.col("l_partkey")),
        F.lit("E"),
        F.col("l_extendedprice").cast("string"),
        F.concat(F.date_format("l_shipdate", "yyyyMMdd"), F.lit("000000")),
        F.lit("A,,"),
        (F.col("l_extendedprice") + F.col("l_quantity")).cast("string"),
        F.date_format(end, "yyyyMMddHHmmss"),
        F.col("l_returnflag"),
        F.lit(","),
        F.col("l_quantity").cast("string"),
        F.lit("kWh"),
        F.lit(",,"),
    )
    return table(spark, sf, "lineitem").select(
        file_name("register-", "l_suppkey").alias("file"),
        F.lit(0).cast("long").alias("split"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"),
        line.alias("line"),
    )


def nem13_readings(spark, sf):
    return nem13.parse_lines(register_lines(spark, sf)).select(
        "file", "nmi", "suffix", "serno", "t_start", "t_end", "val", "val_start", "val_end", "quality", "skip_reason"
    )


NEM13_SQL = """
SELECT 'register-' || (l_suppkey % 20) || '.csv' AS file, 'NMI' || l_suppkey AS nmi,
  (['11','E1','B1'])[1 + l_linenumber % 3] AS suffix, 'SER' || l_partkey AS serno, l_shipdate AS t_start,
  l_shipdate + to_minutes(CAST(l_quantity AS INTEGER) * 1440 + l_linenumber * 7) AS t_end, l_quantity AS val,
  l_extendedprice AS val_start, l_extendedprice + l_quantity AS val_end, l_returnflag AS quality,
  CASE WHEN l_linenumber % 3 = 0 THEN 'ignored' END AS skip_reason
FROM lineitem"""


def long_readings(spark, sf):
    """Events as readings of value hours, starting at the event."""
    start = plus_seconds(floor_minutes(F.col("ts"), 1), F.second("ts"))
    return table(spark, sf, "events").select(
        "event_id",
        F.concat(F.lit("NMI"), F.col("user_id")).alias("nmi"),
        start.alias("t_start"),
        plus_seconds(start, F.greatest(F.floor(F.col("value") * 3600), F.lit(60))).alias("t_end"),
        F.col("value").alias("val"),
        F.col("value").alias("val_start"),
        F.col("value").alias("val_end"),
    )


def split_multiday(spark, sf):
    pieces = series.split_days(long_readings(spark, sf))
    return pieces.select("event_id", "t_start", "t_end", F.round("val", 6).alias("val"), "val_start")


SPLIT_SQL = """
WITH r AS (
  SELECT event_id, date_trunc('second', ts) AS a,
    date_trunc('second', ts) + to_seconds(CAST(greatest(floor(value * 3600), 60) AS BIGINT)) AS b, value
  FROM events),
p AS (
  SELECT event_id, a, b, value, epoch(b) - epoch(a) AS secs,
    unnest(CASE WHEN epoch(b) - epoch(a) > 86400
      THEN generate_series(CAST(a AS DATE)::TIMESTAMP, b - INTERVAL 1 SECOND, INTERVAL 1 DAY)
      ELSE [CAST(a AS DATE)::TIMESTAMP] END) AS d
  FROM r)
SELECT event_id, CASE WHEN secs > 86400 THEN greatest(a, d) ELSE a END AS t_start,
  CASE WHEN secs > 86400 THEN least(b, d + INTERVAL 1 DAY) ELSE b END AS t_end,
  round(CASE WHEN secs > 86400
    THEN value * ((epoch(least(b, d + INTERVAL 1 DAY)) - epoch(greatest(a, d))) / secs) ELSE value END, 6) AS val,
  CASE WHEN secs > 86400 THEN NULL ELSE value END AS val_start
FROM p"""


def grid_readings(spark, sf):
    """Events as short readings; energy, voltage or power by meter, some zero."""
    minutes = pick([5, 15, 30, 25], F.col("event_id") % 4)
    start = floor_minutes(F.col("ts"), 5)
    return table(spark, sf, "events").select(
        F.lit("f").alias("file"),
        "event_id",
        F.concat(F.lit("NMI"), F.col("user_id")).alias("nmi"),
        pick(["E1", "B1", "Q1", "K1", "X9"], F.col("event_id") % 5).alias("suffix"),
        start.alias("t_start"),
        plus_minutes(start, minutes).alias("t_end"),
        F.when(F.col("event_id") % 7 == 0, F.lit(0.0)).otherwise(F.col("value")).alias("val"),
        pick(["kWh", "V", "kW"], F.col("user_id") % 3).alias("uom"),
        F.concat(F.lit("SER"), F.col("user_id")).alias("serno"),
        F.when(F.col("event_type") == "error", F.lit("E52")).otherwise(F.lit("A")).alias("quality"),
        F.when(F.col("event_type") == "error", F.lit("89")).otherwise(F.lit("")).alias("event_code"),
        F.lit("").alias("event_desc"),
    )


GRID_SQL = """
g AS (
  SELECT event_id, 'NMI' || user_id AS nmi, (['E1','B1','Q1','K1','X9'])[1 + event_id % 5] AS suffix,
    time_bucket(INTERVAL 5 MINUTE, ts) AS t_start, ([5,15,30,25])[1 + event_id % 4] AS len,
    CASE WHEN event_id % 7 = 0 THEN 0.0 ELSE value END AS val, (['kWh','V','kW'])[1 + user_id % 3] AS uom,
    'SER' || user_id AS serno, CASE WHEN event_type = 'error' THEN 'E52' ELSE 'A' END AS quality,
    CASE WHEN event_type = 'error' THEN '89' ELSE '' END AS event_code
  FROM events)
"""


def regrid_up(spark, sf):
    """To ten minutes: 30 splits in three, 25 and 15 do not fit, 5 is aggregated."""
    out = series.regrid(grid_readings(spark, sf), 10, ["event_id", "nmi", "suffix"])
    return out.select("event_id", "nmi", "suffix", "t_start", "t_end", F.round("val", 6).alias("val"), "uom", "quality")


REGRID_UP_SQL = f"""WITH {GRID_SQL}
SELECT event_id, nmi, suffix, t_start + to_minutes(i * 10) AS t_start, t_start + to_minutes(i * 10 + 10) AS t_end,
  round(CASE WHEN uom = 'kWh' THEN val / 3 ELSE val END, 6) AS val, uom, quality
FROM g, (SELECT unnest([0, 1, 2]) AS i) WHERE len = 30
UNION ALL
SELECT event_id, nmi, suffix, e - INTERVAL 10 MINUTE, e, val, uom, quality
FROM (SELECT *, time_bucket(INTERVAL 10 MINUTE, t_start + INTERVAL 14 MINUTE) AS e FROM g WHERE len = 5)"""


def regrid_down(spark, sf):
    """To twelve hours per meter: sums, non-zero means, means."""
    out = series.regrid(grid_readings(spark, sf), 720, ["nmi"])
    return out.select(
        "nmi", "t_start", "t_end", F.round("val", 4).alias("val"), "uom", "serno", "quality", "event_code"
    )


REGRID_DOWN_SQL = f"""WITH {GRID_SQL},
e AS (SELECT *, t_start + to_minutes(len) AS t_end,
  time_bucket(INTERVAL 720 MINUTE, t_start + to_minutes(len) + INTERVAL 719 MINUTE) AS ge FROM g),
o AS (SELECT *, row_number() OVER (PARTITION BY nmi, ge ORDER BY t_start, quality, event_code) AS n FROM e)
SELECT nmi, ge - INTERVAL 720 MINUTE AS t_start, ge AS t_end,
  round(CASE any_value(uom) WHEN 'kWh' THEN sum(val)
    WHEN 'V' THEN coalesce(avg(CASE WHEN val <> 0 THEN val END), avg(val)) ELSE avg(val) END, 4) AS val,
  any_value(uom) AS uom, any_value(serno) AS serno,
  CASE WHEN count(DISTINCT quality) = 1 THEN min(quality) ELSE 'V' END AS quality,
  CASE WHEN count(DISTINCT quality) = 1 THEN coalesce(min(nullif(event_code, '')), '')
    ELSE max(CASE WHEN n = 1 THEN event_code END) END AS event_code
FROM o GROUP BY nmi, ge"""


def channel_pivot(spark, sf):
    readings = nem12.parse_lines(nem12_lines(spark, sf), blanks=schemas.FILLED).filter(F.col("val").isNotNull())
    return series.channel_pivot(readings, ["E1", "B1", "Q1", "K1"]).select("nmi", "t_start", "t_end", "E1", "B1", "Q1", "K1")


PIVOT_SQL = f"""WITH {METER_SQL}
SELECT nmi, t_start, t_end, max(CASE WHEN suffix = 'E1' THEN val END) AS "E1",
  max(CASE WHEN suffix = 'B1' THEN val END) AS "B1", max(CASE WHEN suffix = 'Q1' THEN val END) AS "Q1",
  max(CASE WHEN suffix = 'K1' THEN val END) AS "K1"
FROM slots GROUP BY nmi, t_start, t_end"""


def mostly_filled_columns(spark, sf):
    readings = nem12.parse_lines(nem12_lines(spark, sf), blanks=schemas.FILLED).filter(F.col("val").isNotNull())
    wide = series.channel_pivot(readings, ["E1", "B1", "Q1", "K1"])
    out = series.mostly_filled(wide, ["quality_E1", "quality_B1", "quality_Q1", "quality_K1"])
    return out.select("name", F.round("null_share", 6).alias("null_share"), "kept")


FILLED_COLUMNS_SQL = f"""WITH {METER_SQL},
w AS (SELECT nmi, t_start, count(*) FILTER (suffix = 'E1') AS e, count(*) FILTER (suffix = 'B1') AS b,
  count(*) FILTER (suffix = 'Q1') AS q, count(*) FILTER (suffix = 'K1') AS k FROM slots GROUP BY nmi, t_start),
x AS (
  SELECT 1 AS n, 'quality_E1' AS name, avg(CASE WHEN e = 0 THEN 1.0 ELSE 0.0 END) AS null_share FROM w UNION ALL
  SELECT 2, 'quality_B1', avg(CASE WHEN b = 0 THEN 1.0 ELSE 0.0 END) FROM w UNION ALL
  SELECT 3, 'quality_Q1', avg(CASE WHEN q = 0 THEN 1.0 ELSE 0.0 END) FROM w UNION ALL
  SELECT 4, 'quality_K1', avg(CASE WHEN k = 0 THEN 1.0 ELSE 0.0 END) FROM w)
SELECT name, round(null_share, 6) AS null_share,
  coalesce(n = (SELECT min(n) FROM x WHERE null_share < 0.5), FALSE) AS kept FROM x"""


def reading_frame(spark, sf):
    """Every interval of every day, empty ones too, with its quality and event."""
    return series.reading_frame(nem12.parse_lines(nem12_lines(spark, sf)))


FRAME_SQL = f"""WITH {METER_SQL},
g AS (
  SELECT *, CAST(unnest(generate_series(0, 1440 // minutes - 1)) AS INTEGER) AS slot
  FROM (SELECT DISTINCT nmi, user_id, suffix, minutes, day FROM m)),
ev AS (
  SELECT nmi, suffix, day, slot, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS err
  FROM m WHERE event_type IN ('error', 'signup') GROUP BY ALL),
hit AS (
  SELECT nmi, suffix, day, hit_slot AS slot, arg_max(err, ev.slot) AS err
  FROM (SELECT *, unnest([slot, slot + 1, slot + 2]) AS hit_slot FROM ev) AS ev GROUP BY nmi, suffix, day, hit_slot)
SELECT nmi, suffix, 'SER' || g.user_id AS serno, CAST(day AS TIMESTAMP) + to_minutes(slot * g.minutes) AS t_start,
  CAST(day AS TIMESTAMP) + to_minutes((slot + 1) * g.minutes) AS t_end, val AS value,
  CASE err WHEN 1 THEN 'E52' WHEN 0 THEN 'S14' ELSE 'A' END AS quality,
  CASE err WHEN 1 THEN '89' WHEN 0 THEN '32' ELSE '' END AS evt_code,
  CASE err WHEN 1 THEN 'Metering, suspect' WHEN 0 THEN 'Estimate' ELSE '' END AS evt_desc
FROM g LEFT JOIN slots USING (nmi, suffix, day, slot) LEFT JOIN hit USING (nmi, suffix, day, slot)"""


def channels_per_meter(spark, sf):
    readings = nem12.parse_lines(nem12_lines(spark, sf), blanks=schemas.COUNTED)
    return outcome.channels(readings).select("file", "nmi", F.array_join("channels", ",").alias("channels"))


CHANNELS_SQL = f"""WITH {METER_SQL}
SELECT file, nmi, string_agg(suffix, ',' ORDER BY suffix) AS channels
FROM (SELECT DISTINCT file, nmi, suffix FROM m) GROUP BY file, nmi"""


def nem_dates(spark, sf):
    """Stamps of 8, 12 and 14 digits, and some that are none of these."""
    text = F.date_format("ts", "yyyyMMddHHmmss")
    cut = pick([8, 12, 14, 10], F.col("event_id") % 4)
    return table(spark, sf, "events").select(
        "event_id", nem_stamp(F.concat(F.lit(" "), F.substring(text, F.lit(1), cut))).alias("stamp")
    )


DATES_SQL = """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN date_trunc('day', ts) WHEN 1 THEN date_trunc('minute', ts)
  WHEN 2 THEN date_trunc('second', ts) END AS stamp FROM events"""

QUERIES = {
    "nem12_parse": (nem12_parse, FILLED_SQL),
    "nem12_multi_block": (nem12_blocks_parse, FILLED_SQL),
    "nem12_file_scan": (nem12_file_scan, SCAN_SQL),
    "nem12_slot_counts": (nem12_slot_counts, SLOT_SQL),
    "nem12_event_overlay": (nem12_event_overlay, OVERLAY_SQL),
    "nem12_daily_kwh": (nem12_daily_kwh, DAILY_SQL),
    "nem12_split_context": (nem12_split_context, CONTEXT_SQL),
    "nem12_prefix_rewrite": (nem12_prefix_rewrite, PREFIX_SQL),
    "nem_file_headers": (nem_file_headers, HEADERS_SQL),
    "nem12_transactions": (nem12_transactions, TRANSACTIONS_SQL),
    "nem13_readings": (nem13_readings, NEM13_SQL),
    "split_multiday": (split_multiday, SPLIT_SQL),
    "regrid_up": (regrid_up, REGRID_UP_SQL),
    "regrid_down": (regrid_down, REGRID_DOWN_SQL),
    "channel_pivot": (channel_pivot, PIVOT_SQL),
    "mostly_filled_columns": (mostly_filled_columns, FILLED_COLUMNS_SQL),
    "reading_frame": (reading_frame, FRAME_SQL),
    "channels_per_meter": (channels_per_meter, CHANNELS_SQL),
    "nem_dates": (nem_dates, DATES_SQL),
}
