"""Finding and purging rows off a sensor's cadence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.operators import lake as lake_table
from meterlake.session import staged

LEGIT_MINUTES = (0, 30)


def off_cadence(
    lake: DataFrame,
    sensors: DataFrame,
    years: list[int],
    legit_minutes: tuple[int, ...] = LEGIT_MINUTES,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Rows of listed sensors and years whose minute is not legitimate, in ``[start, end)``.

    A sensor list is always required. Year and time bounds prune partitions
    and row groups; the list joins as a semi join of any size.
    """
    rows = lake.filter(F.col("its_year").isin(list(years)) & ~F.minute("ts").isin(list(legit_minutes)))
    month = F.col("its_year") * 12 + F.col("its_month")
    if start:
        first = F.lit(start).cast("timestamp_ntz")
        rows = rows.filter((F.col("ts") >= first) & (F.col("its_year") >= F.year(first)) & (month >= F.year(first) * 12 + F.month(first)))
    if end:
        last = F.lit(end).cast("timestamp_ntz")
        rows = rows.filter((F.col("ts") < last) & (F.col("its_year") <= F.year(last)) & (month <= F.year(last) * 12 + F.month(last)))
    wanted = sensors.select(F.col(sensors.columns[0]).alias("sensorId"))
    return rows.join(wanted, "sensorId", "left_semi")


def preview(rows: DataFrame) -> DataFrame:
    """Rows, sensors and time range per year and minute.

    Counting per sensor first keeps the distinct count a plain count, and one
    busy sensor is reduced before it is shuffled.
    """
    per_sensor = rows.groupBy("its_year", F.minute("ts").alias("off_minute"), "sensorId").agg(
        F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last")
    )
    return (
        per_sensor.groupBy("its_year", "off_minute")
        .agg(
            F.sum("n").cast("long").alias("rows"),
            F.count("*").alias("sensors"),
            F.min("first").alias("first_ts"),
            F.max("last").alias("last_ts"),
        )
        .orderBy("its_year", "off_minute")
    )


def profile(rows: DataFrame) -> DataFrame:
    """Rows per minute of the hour."""
    return rows.groupBy(F.minute("ts").alias("minute")).agg(F.count("*").alias("rows"))


def purge(spark: SparkSession, path: str, sensors: DataFrame, years: list[int], dry_run: bool = True, **bounds) -> dict:
    """Preview, check and delete. Nothing is changed unless ``dry_run`` is off."""
    doomed = off_cadence(spark.read.parquet(path), sensors, years, **bounds)
    shown = preview(doomed)
    total = shown.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"]
    if dry_run or total == 0:
        return {"matched": total, "deleted": 0, "preview": shown}
    keys = staged(doomed.select("sensorId", "ts", *lake_table.PARTITIONS), "off-cadence")
    found = keys.count()
    if found != total:
        raise RuntimeError(f"preview ({total}) and keys ({found}) differ; nothing deleted")
    return {"matched": total, "deleted": lake_table.delete(spark, path, keys), "preview": shown}
