"""Billing sensors to a wide monthly snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterlake.functions.coerce import money
from meterlake.functions.identifiers import is_money_field, is_nz_icp
from meterlake.functions.stamps import month_key

# Metric columns in the order of the report.
METRICS = [
    "total_usage",
    "total_estimated_usage",
    "peak_usage",
    "estimated_peak_usage",
    "off_peak_usage",
    "estimated_off_peak_usage",
    "shoulder_usage",
    "estimated_shoulder_usage",
    "total_greenpower_usage",
    "total_estimated_greenpower_usage",
    "greenpower_spend",
    "energy_charge",
    "estimated_energy_charge",
    "network_charge",
    "estimated_network_charge",
    "metering_charge",
    "estimated_metering_charge",
    "environmental_charge",
    "estimated_environmental_charge",
    "other_charge",
    "estimated_other_charge",
    "total_spend",
    "total_estimated_spend",
]
COLUMNS = ["nmi", "month", "currency", *METRICS]
DEFAULT_CURRENCY = "AUD"
START = "2025-01-01"


class EmptySnapshot(RuntimeError):
    """There is nothing to publish; the previous snapshot stays."""


def billing_rows(lake: DataFrame, reverse: DataFrame, start: str = START) -> DataFrame:
    """The latest value of each meter, month and field.

    Rows are shuffled by sensor before they are joined, so that Spark chooses the join by what it has counted: before that
    a lake made of wide rows looks far smaller than it is, and would be broadcast. A sensor has at most a reading per
    slot, so none is hot. What is left, a row per sensor and month, is dealt by meter once; the rest of the report follows that.
    """
    rows = lake.filter(F.col("ts") >= F.lit(start).cast("timestamp_ntz")).select("sensorId", month_key(F.col("ts")).alias("month"), "ts", "val", "unit")
    last = F.max(F.struct("ts", "val", "unit")).alias("last")
    newest = rows.repartition("sensorId").groupBy("sensorId", "month").agg(last)
    named = newest.join(reverse.withColumnRenamed("sensor_id", "sensorId"), "sensorId").select("nmi", "month", "field", "last")
    return (
        named.repartition("nmi")
        .groupBy("nmi", "month", "field")
        .agg(F.max("last").alias("last"))
        .select("nmi", "month", "field", F.col("last")["val"].alias("val"), F.col("last")["unit"].alias("unit"))
    )


def pivot(rows: DataFrame) -> DataFrame:
    """One row per meter and month: the metrics, and the range of its money units."""
    unit = F.when(is_money_field(F.col("field")), F.lower(F.nullif(F.col("unit"), F.lit(""))))
    return rows.groupBy("nmi", "month").agg(
        *[F.max(F.when(F.col("field") == m, F.col("val"))).alias(m) for m in METRICS],
        F.min(unit).alias("low_unit"),
        F.max(unit).alias("high_unit"),
    )


def snapshot(lake: DataFrame, reverse: DataFrame, start: str = START) -> DataFrame:
    """The 26 columns of the report, numbers as doubles.

    A meter's currency is the smallest of its money units over all months.
    """
    wide = pivot(billing_rows(lake, reverse, start))
    unit = F.min("low_unit").over(W.partitionBy("nmi"))
    return wide.withColumn("currency", F.upper(F.coalesce(unit, F.lit(DEFAULT_CURRENCY)))).select(*COLUMNS)


def currencies(rows: DataFrame) -> DataFrame:
    """Currency per meter and what is odd about it."""
    per_meter = (
        pivot(rows).groupBy("nmi").agg(F.min("low_unit").alias("low"), F.max("high_unit").alias("high"))
    )
    picked = F.upper(F.coalesce("low", F.lit(DEFAULT_CURRENCY)))
    known = F.col("low").isNotNull()
    return per_meter.select(
        "nmi",
        picked.alias("currency"),
        (known & (F.col("low") != F.col("high"))).alias("conflict"),
        (~known).alias("unknown"),
        (known & (picked == DEFAULT_CURRENCY) & is_nz_icp(F.col("nmi"))).alias("suspect"),
    )


def currency_stats(per_meter: DataFrame) -> DataFrame:
    return per_meter.agg(
        F.count(F.when(F.col("conflict"), 1)).alias("conflict"),
        F.count(F.when(F.col("unknown"), 1)).alias("unknown"),
        F.count(F.when(F.col("suspect"), 1)).alias("suspect"),
    )


def snapshot_stats(wide: DataFrame) -> DataFrame:
    return wide.agg(
        F.count("*").alias("rows"),
        F.count_distinct("nmi").alias("nmis"),
        F.count_distinct("month").alias("months"),
    )


def formatted(wide: DataFrame) -> DataFrame:
    """Report text: two decimals, and an empty cell where there is no bill."""
    return wide.select("nmi", "month", "currency", *[money(F.col(m)).alias(m) for m in METRICS]).orderBy("nmi", "month")


def write_snapshot(wide: DataFrame, path: str) -> None:
    """Ordered CSV parts; raises and writes nothing when there are no rows."""
    if wide.isEmpty():
        raise EmptySnapshot(path)
    formatted(wide).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)
