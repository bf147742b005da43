"""Meter data derived from the given tables by Spark: events become readings,
customers become mapped meters, orders become bills. Nothing is made up or
sampled; every feed grows with its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.stamps import floor_minutes

# Channel by event_id % 5; X9 is outside the supported set.
SUFFIXES = ["E1", "B1", "Q1", "K1", "X9"]
UNITS = ["kWh", "kWh", "kVArh", "", "V"]
# Interval length by user_id % 3.
INTERVALS = [5, 15, 30]
FILES = 20
SPLIT = 100_000
FIRST = 1_000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pick(values: list, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def file_name(prefix: str, key="user_id", suffix: str = ".csv"):
    return F.concat(F.lit(prefix), (F.col(key) % FILES).cast("string"), F.lit(suffix))


def meter_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as interval readings: file, meter, channel, slot of the day."""
    minutes = pick(INTERVALS, F.col("user_id") % 3)
    of_day = F.hour("ts") * 60 + F.minute("ts")
    return table(spark, sf, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "ts",
        file_name("meter-").alias("file"),
        F.concat(F.lit("NMI"), F.col("user_id")).alias("nmi"),
        (F.col("event_id") % 5).cast("int").alias("s"),
        pick(SUFFIXES, F.col("event_id") % 5).alias("suffix"),
        pick(UNITS, F.col("event_id") % 5).alias("uom"),
        minutes.alias("minutes"),
        F.to_date("ts").alias("day"),
        F.floor(of_day / minutes).cast("int").alias("slot"),
    )


METER_SQL = """
m AS (
  SELECT event_id, user_id, event_type, value, ts,
    'meter-' || (user_id % 20) || '.csv' AS file, 'NMI' || user_id AS nmi, CAST(event_id % 5 AS INTEGER) AS s,
    (['E1','B1','Q1','K1','X9'])[1 + event_id % 5] AS suffix,
    (['kWh','kWh','kVArh','','V'])[1 + event_id % 5] AS uom,
    (['kwh','kwh','kvarh','kwh','v'])[1 + event_id % 5] AS unit,
    ([5,15,30])[1 + user_id % 3] AS minutes, CAST(ts AS DATE) AS day,
    CAST((hour(ts) * 60 + minute(ts)) // ([5,15,30])[1 + user_id % 3] AS INTEGER) AS slot
  FROM events),
slots AS (
  SELECT file, nmi, user_id, s, suffix, unit, minutes, day, slot, max(value) AS val,
    CAST(day AS TIMESTAMP) + to_minutes(slot * minutes) AS t_start,
    CAST(day AS TIMESTAMP) + to_minutes((slot + 1) * minutes) AS t_end
  FROM m GROUP BY ALL)
"""


def _line(kind, text):
    return F.struct(kind.cast("long").alias("kind"), text.alias("line"))


def nem12_days(spark: SparkSession, sf: str) -> DataFrame:
    """Per meter, channel and day: the 300 record and its 400 and 500 records.

    ``error`` and ``signup`` events become 400 records over three slots.
    """
    per_slot = (
        meter_events(spark, sf)
        .groupBy("file", "user_id", "nmi", "s", "suffix", "uom", "minutes", "day", "slot")
        .agg(
            F.max("value").alias("val"),
            F.max(F.col("event_type").isin("error", "signup")).alias("flagged"),
            F.max(F.col("event_type") == "error").alias("error"),
            F.max(F.when(F.col("event_type") == "purchase", F.col("event_id"))).alias("order_id"),
        )
    )
    days = per_slot.groupBy("file", "user_id", "nmi", "s", "suffix", "uom", "minutes", "day").agg(
        F.array_sort(F.collect_list(F.struct("slot", "val", "flagged", "error", "order_id"))).alias("slots")
    )
    n = F.floor(F.lit(1440) / F.col("minutes")).cast("int")
    # A day has few filled slots: the commas between them are repeated, not joined from one text per slot.
    cells = F.aggregate(
        "slots",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("text")),
        lambda a, e: F.struct(e["slot"].alias("at"), F.concat(a["text"], F.repeat(F.lit(","), e["slot"] - a["at"]), F.coalesce(e["val"].cast("string"), F.lit(""))).alias("text")),
        lambda a: F.concat(a["text"], F.repeat(F.lit(","), n - 1 - a["at"])),
    )
    date = F.date_format("day", "yyyyMMdd")
    day_line = F.concat(F.lit("300,"), date, F.lit(","), cells, F.lit(",A,,,,"))
    event_lines = F.transform(
        F.filter("slots", lambda e: e["flagged"]),
        lambda e: _line(
            e["slot"] + 1,
            F.concat_ws(
                ",",
                F.lit("400"),
                (e["slot"] + 1).cast("string"),
                F.least(e["slot"] + 3, n).cast("string"),
                F.when(e["error"], F.lit('E52,89,"Metering, suspect"')).otherwise(F.lit("S14,32,Estimate")),
            ),
        ),
    )
    order_lines = F.transform(
        F.filter("slots", lambda e: e["order_id"].isNotNull()),
        lambda e: _line(
            F.lit(300) + e["slot"] % 100,
            F.concat_ws(",", F.lit("500"), F.lit("O"), F.concat(F.lit("S"), e["order_id"]), date, e["val"].cast("string")),
        ),
    )
    return days.select(
        "file",
        "user_id",
        "nmi",
        "s",
        "suffix",
        "uom",
        "minutes",
        "day",
        day_line.alias("day_line"),
        event_lines.alias("event_lines"),
        order_lines.alias("order_lines"),
    )


def context_line():
    return F.concat_ws(
        ",",
        F.lit("200"),
        F.col("nmi"),
        F.lit("E1B1Q1K1,1"),
        F.col("suffix"),
        F.lit("N1"),
        F.concat(F.lit("SER"), F.col("user_id")),
        F.col("uom"),
        F.col("minutes").cast("string"),
        F.lit("20240301"),
    )


def nem12_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered NEM12 lines of whole files, cut into splits in the middle of channels."""
    days = nem12_days(spark, sf)
    base = (F.col("user_id") * 8 + F.col("s")) * 64
    body = days.select(
        "file",
        (base + F.dayofmonth("day")).alias("base"),
        F.explode_outer(
            F.concat(F.array(_line(F.lit(0), F.col("day_line"))), F.col("event_lines"), F.col("order_lines"))
        ).alias("x"),
    ).select("file", (F.col("base") * 512 + F.col("x")["kind"] + FIRST).alias("pos"), F.col("x")["line"].alias("line"))
    # from the events, which have the same channels without the days being made again
    channels = meter_events(spark, sf).select("file", "user_id", "nmi", "s", "suffix", "uom", "minutes").distinct()
    opens = channels.select("file", (base * 512 + FIRST).alias("pos"), context_line().alias("line"))
    files = channels.select("file").distinct()
    ends = files.select(
        "file",
        F.explode(
            F.array(
                F.struct(F.lit(0).cast("long").alias("pos"), F.lit("100,NEM12,202402010000,MDP1,Retailer1").alias("line")),
                F.struct(F.lit(1 << 50).alias("pos"), F.lit("900").alias("line")),
            )
        ).alias("x"),
    ).select("file", F.col("x")["pos"].alias("pos"), F.col("x")["line"].alias("line"))
    return (
        body.unionByName(opens)
        .unionByName(ends)
        .select("file", F.floor(F.col("pos") / SPLIT).cast("long").alias("split"), "pos", "line")
    )


def nem12_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """One text per channel and day: a 200 record, its 300 record and what follows it."""
    days = nem12_days(spark, sf)
    events = F.transform("event_lines", lambda e: e["line"])
    orders = F.transform("order_lines", lambda e: e["line"])
    tail = F.array(F.lit("900"), F.concat(F.lit("300,20240101,"), F.lit("9,9,A")))
    text = F.array_join(F.concat(F.array(context_line(), F.col("day_line")), events, orders, tail), "\n")
    return days.select("file", "nmi", "suffix", "day", text.alias("text"))


def meter_map(spark: SparkSession, sf: str) -> DataFrame:
    """Two thirds of the customers are mapped meters, all five channels each."""
    suffix = F.explode(F.array(*[F.lit(s) for s in SUFFIXES])).alias("suffix")
    return (
        table(spark, sf, "customer")
        .filter(F.col("c_custkey") % 3 != 0)
        .select("c_custkey", suffix)
        .select(
            F.concat(F.lit("NMI"), F.col("c_custkey"), F.lit("-"), F.col("suffix")).alias("lookup_key"),
            F.concat(F.lit("p:site:"), F.col("c_custkey"), F.lit("-"), F.col("suffix")).alias("sensor_id"),
        )
    )


MAP_SQL = """
mm AS (
  SELECT 'NMI' || c_custkey || '-' || suffix AS lookup_key, 'p:site:' || c_custkey || '-' || suffix AS sensor_id
  FROM customer, (SELECT unnest(['E1','B1','Q1','K1','X9']) AS suffix) WHERE c_custkey % 3 <> 0)
"""

SUPPORTED_SQL = "regexp_matches(suffix, '^[ABCDEFJKLPQRSTUGHYMWVZ][1-9A-Z]$')"


def with_preamble(body: DataFrame, preamble) -> DataFrame:
    """Per file the preamble lines, then the body ``(file, pos, line)``."""
    top = body.select("file").distinct().select("file", F.posexplode(preamble).alias("pos", "line"))
    lines = top.select("file", F.col("pos").cast("long").alias("pos"), "line").unionByName(
        body.select("file", (F.col("pos") + FIRST).cast("long").alias("pos"), "line")
    )
    return lines.select("file", F.floor(F.col("pos") / (SPLIT * 5)).cast("long").alias("split"), "pos", "line")


def lake_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Events as lake rows: sensor per user and channel, stamped to the minute."""
    return table(spark, sf, "events").select(
        F.concat(F.lit("p:site:"), F.col("user_id"), F.lit("-"), pick(SUFFIXES, F.col("event_id") % 5)).alias("sensorId"),
        floor_minutes(F.col("ts"), 1).alias("ts"),
        F.col("value").alias("val"),
        F.lit("kwh").alias("unit"),
        floor_minutes(F.col("ts"), 1).alias("its"),
        F.when(F.col("event_type") == "error", F.lit("E52")).alias("quality"),
        "event_id",
        "user_id",
    )


LAKE_SQL = """
lake AS (
  SELECT 'p:site:' || user_id || '-' || (['E1','B1','Q1','K1','X9'])[1 + event_id % 5] AS sensorId,
    date_trunc('minute', ts) AS ts, value AS val, 'kwh' AS unit,
    CASE WHEN event_type = 'error' THEN 'E52' END AS quality, event_id, user_id,
    CAST(year(ts) AS INTEGER) AS its_year, CAST(month(ts) AS INTEGER) AS its_month
  FROM events)
"""
