"""Meter identifiers to sensor ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterlake.functions.identifiers import is_direct

def resolve(readings: DataFrame, mapping: DataFrame) -> DataFrame:
    """Adds ``sensor_id``; NULL where the map has no entry.

    The join carries no hint. Spark broadcasts the map when its size allows;
    beyond that both sides are shuffled by key and adaptive execution splits a
    dominant sensor. Rows without a key get one of their own, so that they
    spread over all partitions instead of meeting in the one for NULL.
    """
    spread = F.concat(F.lit("\x00"), F.col("file"), F.col("pos"))
    keyed = readings.withColumn("_key", F.coalesce("lookup_key", spread))
    lookup = mapping.select(F.col("lookup_key").alias("_key"), F.col("sensor_id").alias("_mapped"))
    return keyed.join(lookup, "_key", "left").select(
        *readings.columns,
        F.when(is_direct(F.col("nmi")), F.col("nmi")).otherwise(F.col("_mapped")).alias("sensor_id"),
    )


def written(resolved: DataFrame) -> DataFrame:
    """Candidate rows with a sensor: what goes into the lake."""
    return resolved.filter(F.col("skip_reason").isNull() & F.col("sensor_id").isNotNull())


def unmapped(resolved: DataFrame) -> DataFrame:
    """Candidate rows without a sensor."""
    return resolved.filter(F.col("skip_reason").isNull() & F.col("sensor_id").isNull())


def unmapped_keys(resolved: DataFrame) -> DataFrame:
    """``file, id_kind, lookup_key``: all distinct unmapped identifiers as rows."""
    return unmapped(resolved).select("file", "id_kind", "lookup_key").distinct()


def unmapped_identifiers(resolved: DataFrame, limit: int | None = None) -> DataFrame:
    """Per file the distinct unmapped identifiers, sorted; the first ``limit`` of them if one is asked for.

    Duplicates go before the shuffle, and a limit also runs in every map task.
    """
    ids = unmapped_keys(resolved)
    if limit is not None:
        order = W.partitionBy("file").orderBy("id_kind", "lookup_key")
        ids = ids.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= limit)
    listed = F.array_sort(F.collect_list(F.struct("id_kind", "lookup_key")))
    return ids.groupBy("file").agg(listed.alias("unmapped_identifiers"))


def to_lake(resolved: DataFrame, arrived=None) -> DataFrame:
    """Lake columns of the written rows. Missing units and qualities are NULL."""
    return written(resolved).select(
        F.col("sensor_id").alias("sensorId"),
        F.col("t_start").alias("ts"),
        "val",
        F.nullif(F.col("uom"), F.lit("")).alias("unit"),
        F.col("t_start").alias("its"),
        F.nullif(F.col("quality"), F.lit("")).alias("quality"),
        (F.current_timestamp().cast("timestamp_ntz") if arrived is None else arrived).alias("ats"),
        "file",
        "split",
        "pos",
    )
