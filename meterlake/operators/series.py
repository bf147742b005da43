"""Time-series transforms on the long reading frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.stamps import day_start, epoch_seconds, plus_minutes, plus_seconds, seconds_between

DAY = 86_400
CHANNEL = ["file", "nmi", "suffix"]
ARRIVAL = ["ats", "file", "split", "pos"]


def reading_frame(readings: DataFrame) -> DataFrame:
    """The flat frame: meter, channel, serial, period, value, quality and event."""
    return readings.filter(F.col("t_start").isNotNull()).select(
        "nmi",
        "suffix",
        "serno",
        "t_start",
        "t_end",
        F.col("val").alias("value"),
        "quality",
        F.col("event_code").alias("evt_code"),
        F.col("event_desc").alias("evt_desc"),
    )


def _days_of(only: Column | None) -> tuple[Column, Column, Column]:
    """Seconds of a reading, whether it is to be split, and the number of midnights in it."""
    total = seconds_between(F.col("t_start"), F.col("t_end"))
    is_long = (total > DAY) if only is None else F.coalesce((total > DAY) & only, F.lit(False))
    return total, is_long, F.datediff(F.to_date(plus_seconds(F.col("t_end"), F.lit(-1))), F.to_date("t_start"))


def pieces(only: Column | None = None) -> Column:
    """The number of rows that ``split_days`` makes of a reading."""
    _, is_long, days = _days_of(only)
    return F.when(is_long, days + 1).otherwise(F.lit(1)).cast("long")


def split_days(readings: DataFrame, only: Column | None = None) -> DataFrame:
    """Readings longer than a day (of those that ``only`` names) become one piece per calendar day, pro rata by seconds.

    Shorter readings take the same path with a single piece, so there is no
    union and no shuffle.
    """
    total, is_long, days = _days_of(only)
    first = day_start(F.col("t_start"))
    pieces = F.when(is_long, F.sequence(F.lit(0), days)).otherwise(F.array(F.lit(0)))
    # The seconds of a piece are counted from the first midnight, so that no piece's stamps are taken apart again.
    from_ = epoch_seconds(F.col("t_start")) - epoch_seconds(first)
    spread = readings.select("*", total.alias("_total"), is_long.alias("_long"), from_.alias("_from"), F.explode_outer(pieces).alias("_piece"))
    begin = plus_minutes(first, F.col("_piece") * 1440)
    start = F.when(F.col("_long"), F.greatest("t_start", begin)).otherwise(F.col("t_start"))
    end = F.when(F.col("_long"), F.least("t_end", plus_minutes(begin, F.lit(1440)))).otherwise(F.col("t_end"))
    until = F.least(F.col("_from") + F.col("_total"), (F.col("_piece") + 1).cast("long") * DAY)
    share = (until - F.greatest(F.col("_from"), F.col("_piece").cast("long") * DAY)) / F.col("_total")
    replaced = {
        "t_start": start,
        "t_end": end,
        "val": F.when(F.col("_long"), F.col("val") * share).otherwise(F.col("val")),
        "val_start": F.when(~F.col("_long"), F.col("val_start")) if "val_start" in readings.columns else None,
        "val_end": F.when(~F.col("_long"), F.col("val_end")) if "val_end" in readings.columns else None,
    }
    return spread.select(*[replaced[c].alias(c) if replaced.get(c) is not None else F.col(c) for c in readings.columns])


def ends_with(uom: Column, letter: str) -> Column:
    return F.coalesce(F.lower(F.right(uom, F.lit(1))) == letter, F.lit(False))


def regrid(readings: DataFrame, minutes: int, keys: list[str] | None = None) -> DataFrame:
    """Readings on a grid of ``minutes``.

    Equal length passes. Longer and divisible splits, dividing energy (units
    ending in h) and repeating everything else; not divisible is dropped.
    Shorter is aggregated: energy adds up, voltage (units ending in v) averages
    its non-zero values, anything else averages. Only the shorter readings are
    shuffled.
    """
    keys = keys or CHANNEL
    length = seconds_between(F.col("t_start"), F.col("t_end"))
    step = minutes * 60
    held = length >= step
    kept = readings.filter(held & (length % step == 0)).select(*keys, *_SERIES, length.alias("_length"))
    parts = F.col("_length") / step
    pieces = kept.select("*", F.explode_outer(F.sequence(F.lit(0), (parts - 1).cast("int"))).alias("_piece"))
    begin = plus_minutes(F.col("t_start"), F.col("_piece") * minutes)
    finer = pieces.select(
        *keys,
        begin.alias("t_start"),
        plus_minutes(begin, F.lit(minutes)).alias("t_end"),
        F.when(ends_with(F.col("uom"), "h"), F.col("val") / parts).otherwise(F.col("val")).alias("val"),
        "uom",
        "serno",
        "quality",
        "event_code",
        "event_desc",
    )
    return finer.unionByName(_coarser(readings.filter(~held), minutes, keys))


_SERIES = ["t_start", "t_end", "val", "uom", "serno", "quality", "event_code", "event_desc"]


def _coarser(readings: DataFrame, minutes: int, keys: list[str]) -> DataFrame:
    end = F.col("t_end")
    of_day = F.hour(end) * 60 + F.minute(end) + F.when(F.second(end) > 0, 1).otherwise(0)
    group_end = plus_minutes(day_start(end), F.ceil(of_day / F.lit(minutes)) * minutes)
    first = F.struct("t_start", "uom", "serno", "quality", "event_code", "event_desc")
    code = F.nullif(F.col("event_code"), F.lit(""))
    desc = F.nullif(F.col("event_desc"), F.lit(""))
    live = F.when(F.col("val") != 0, F.col("val"))
    grouped = (
        readings.withColumn("_end", group_end)
        .groupBy(*keys, "_end")
        .agg(
            F.sum("val").alias("total"),
            F.avg("val").alias("mean"),
            F.avg(live).alias("live_mean"),
            F.min(first).alias("first"),
            F.min(F.coalesce("quality", F.lit(""))).alias("low"),
            F.max(F.coalesce("quality", F.lit(""))).alias("high"),
            F.coalesce(F.min(code), F.lit("")).alias("code"),
            F.coalesce(F.min(desc), F.lit("")).alias("desc"),
        )
    )
    uom = F.col("first")["uom"]
    same = F.col("low") == F.col("high")
    return grouped.select(
        *keys,
        plus_minutes(F.col("_end"), F.lit(-minutes)).alias("t_start"),
        F.col("_end").alias("t_end"),
        F.when(ends_with(uom, "h"), F.col("total"))
        .when(ends_with(uom, "v"), F.coalesce("live_mean", "mean"))
        .otherwise(F.col("mean"))
        .alias("val"),
        uom.alias("uom"),
        F.col("first")["serno"].alias("serno"),
        F.when(same, F.col("first")["quality"]).otherwise(F.lit("V")).alias("quality"),
        F.when(same, F.col("code")).otherwise(F.col("first")["event_code"]).alias("event_code"),
        F.when(same, F.col("desc")).otherwise(F.col("first")["event_desc"]).alias("event_desc"),
    )


def channel_pivot(readings: DataFrame, suffixes: list[str], serno: bool = False) -> DataFrame:
    """One row per meter and interval with a value and a quality column per channel.

    Of several readings of one interval the last one counts: by arrival, where there is an ``ats``, then by file and its
    place in the file, never by a number that a task gave. The channels are named by the caller, so Spark need not run
    the input once more to find them.
    """
    keys = ["nmi", "t_start", "t_end", *(["serno"] if serno else [])]
    wide = (
        readings.filter(F.col("t_start").isNotNull())
        .groupBy(*keys)
        .pivot("suffix", suffixes)
        .agg(
            F.max(F.struct(*[c for c in ARRIVAL if c in readings.columns], "val", "quality", "event_code", "event_desc")).alias("last"),
        )
    )
    return wide.select(
        *keys,
        *[wide[s]["val"].alias(s) for s in suffixes],
        *[wide[s]["quality"].alias(f"quality_{s}") for s in suffixes],
    )


def mostly_filled(wide: DataFrame, columns: list[str]) -> DataFrame:
    """Null share of each column, and whether it is the first below one half."""
    shares = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("null_share")) for c in columns])
    pick = F.try_element_at(F.filter("shares", lambda c: c["null_share"] < 0.5), F.lit(1))["name"]
    return (
        wide.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
        .select(shares.alias("shares"))
        .select(pick.alias("pick"), F.explode("shares").alias("c"))
        .select("c.name", "c.null_share", F.coalesce(F.col("c.name") == F.col("pick"), F.lit(False)).alias("kept"))
    )


def daily_totals(lake: DataFrame) -> DataFrame:
    """Sum per sensor and day."""
    return lake.groupBy("sensorId", F.to_date("ts").alias("day")).agg(
        F.sum("val").alias("total"), F.count("*").alias("readings")
    )


def per_meter(wide: DataFrame, nmi: str) -> DataFrame:
    """The rows of one meter, without its column."""
    return wide.filter(F.col("nmi") == nmi).drop("nmi")
