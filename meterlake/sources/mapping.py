"""The identifier map: a JSON object of lookup key to sensor id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.identifiers import billing_key_parts


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """``(lookup_key, sensor_id, age_seconds)`` of a JSON map file.

    The file is one JSON object of about a megabyte; it is read whole by one
    task and exploded there. Of a repeated key the last entry counts.
    """
    text = spark.read.option("wholetext", True).text(path)
    age = F.unix_seconds(F.current_timestamp()) - F.unix_seconds(F.col("_metadata.file_modification_time"))
    return text.select(
        age.alias("age_seconds"), F.posexplode(F.from_json("value", "map<string,string>")).alias("place", "lookup_key", "sensor_id")
    ).groupBy("lookup_key").agg(F.max_by("sensor_id", "place").alias("sensor_id"), F.max("age_seconds").alias("age_seconds"))


def mapping_json(mapping: DataFrame, shards: int | None = None) -> DataFrame:
    """The map as JSON objects, one row each; ``read_mapping`` reads them all back.

    Keys go to objects by hash, as many as the session has shuffle partitions
    unless the caller says otherwise (1 gives the plain object), so an object
    is a task's share of the map and the map is not counted first.
    """
    count = shards or int(mapping.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = F.array_sort(F.collect_list(F.struct("lookup_key", "sensor_id")))
    shard = F.pmod(F.xxhash64("lookup_key"), F.lit(count))
    return mapping.groupBy(shard.alias("shard")).agg(F.to_json(F.map_from_entries(pairs)).alias("value"))


def write_mapping(mapping: DataFrame, path: str, shards: int | None = None) -> None:
    mapping_json(mapping, shards).select("value").write.mode("overwrite").text(path)


def whitelist(mapping: DataFrame, key_pattern: str, sensor_prefix: str) -> DataFrame:
    """Sorted unique sensor ids whose key and id match."""
    return (
        mapping.filter(F.col("lookup_key").rlike(key_pattern) & F.col("sensor_id").startswith(sensor_prefix))
        .select("sensor_id")
        .distinct()
        .orderBy("sensor_id")
    )


def read_whitelist(spark: SparkSession, path: str) -> DataFrame:
    """One sensor id per line; ``#`` starts a comment. An empty list is an error."""
    line = F.trim("value")
    out = spark.read.text(path).select(line.alias("sensor_id"))
    out = out.filter((F.col("sensor_id") != "") & ~F.col("sensor_id").startswith("#")).distinct()
    if out.isEmpty():
        raise ValueError(f"no sensor ids in {path}")
    return out


def billing_reverse(mapping: DataFrame) -> DataFrame:
    """``(sensor_id, nmi, field)`` of every billing key; a repeated sensor keeps its last key.

    Shuffled before it is grouped: hardly a sensor repeats, so a task that reads many keys would only sort them all.
    """
    nmi, field = billing_key_parts(F.col("lookup_key"))
    return (
        mapping.filter(nmi.isNotNull())
        .repartition("sensor_id")
        .groupBy("sensor_id")
        .agg(F.max("lookup_key").alias("lookup_key"))
        .select("sensor_id", nmi.alias("nmi"), field.alias("field"))
    )
