"""Other scans: lake CSV, lake table, site lists, points and file manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions.identifiers import OPTIMA, prefixed
from meterlake.functions.stamps import iso_week
from meterlake.schemas import LAKE_CSV

POINTS = "identifier string, field string, nem12_id string, label string, point_category string, meter_vertex_id string"


CORRUPT = "_corrupt_line"


def lake_csv(reader):
    """A (stream) reader of lake-source CSV: a line that does not fit the schema is kept as text in ``CORRUPT``."""
    reader = reader.schema(T.StructType([*LAKE_CSV.fields, T.StructField(CORRUPT, T.StringType())]))
    return reader.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)


def scan_lake_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All lines of lake-source CSV, with their file and time of arrival; ``CORRUPT`` holds those that do not fit."""
    return lake_csv(spark.read).csv(paths).select("*", F.col("_metadata.file_path").alias("file"), F.current_timestamp().cast("timestamp_ntz").alias("ats"))


def read_lake_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lake-source CSV rows with the time of arrival; lines that do not fit the schema are left to ``lake_csv_rejects``."""
    return scan_lake_csv(spark, paths).filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "file")


def lake_csv_rejects(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``file, line`` of the lake-source CSV lines that do not fit the schema, whatever column is at fault."""
    return rejects(scan_lake_csv(spark, paths))


def rejects(scanned: DataFrame) -> DataFrame:
    return scanned.filter(F.col(CORRUPT).isNotNull()).select("file", F.col(CORRUPT).alias("line"))


def read_lake(spark: SparkSession, path: str, sensors: DataFrame | None = None, start: str | None = None) -> DataFrame:
    """Lake rows from ``start`` on, for the given sensors.

    ``its_year`` and ``its_month`` follow from ``ts``; Spark cannot know that,
    so the bounds are added here and whole partitions are skipped.
    """
    lake = spark.read.parquet(path)
    if start is not None:
        first = F.lit(start).cast("timestamp_ntz")
        ym = F.col("its_year") * 12 + F.col("its_month")
        lake = lake.filter(
            (F.col("its_year") >= F.year(first)) & (ym >= F.year(first) * 12 + F.month(first)) & (F.col("ts") >= first)
        )
    if sensors is not None:
        lake = lake.join(sensors.select(F.col(sensors.columns[0]).alias("sensorId")), "sensorId", "left_semi")
    return lake


def normalise_sites(rows: DataFrame) -> DataFrame:
    """Two header layouts to ``(nmi, siteIdStr, siteName, valid)``; incomplete rows are marked, not lost."""

    def text(name: str):
        return F.coalesce(F.trim(F.col(name)), F.lit("")) if name in exact else F.lit("")

    exact = set(rows.columns)
    if "SiteIdStr" in exact:
        bare = text("NmiOrIcp")
        nmi = F.when(bare == "", bare).otherwise(prefixed(bare, OPTIMA))
        out = rows.select(nmi.alias("nmi"), text("SiteIdStr").alias("siteIdStr"), text("SiteName").alias("siteName"))
    else:
        out = rows.select(
            text("nmi").alias("nmi"), text("siteIdStr").alias("siteIdStr"), text("siteName").alias("siteName")
        )
    return out.withColumn("valid", (F.col("nmi") != "") & (F.col("siteIdStr") != ""))


def read_sites(spark: SparkSession, paths: str | list[str], ddl: str) -> DataFrame:
    """Site CSV; ``ddl`` names the columns of one of the two layouts."""
    return normalise_sites(spark.read.schema(ddl).option("header", True).option("enforceSchema", False).csv(paths))


def read_points(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.schema(POINTS).option("header", True).csv(paths)


def manifest(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Files under a prefix: path, size, modification time. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def in_week(files: DataFrame, week: str, when: str = "modified") -> DataFrame:
    """Files of one ISO week that are not archived yet."""
    return files.filter((iso_week(F.col(when)) == week) & ~F.contains("path", F.lit("/archived/")))


def archive_counts(files: DataFrame, when: str = "modified") -> DataFrame:
    """Files per prefix and ISO week."""
    prefix = F.regexp_replace(F.col("path"), "/[^/]*$", "")
    return files.groupBy(prefix.alias("prefix"), iso_week(F.col(when)).alias("iso_week")).agg(
        F.count("*").alias("files")
    )


def over_threshold(files: DataFrame, threshold: int) -> DataFrame:
    """Number of files and whether a run is due."""
    return files.agg(F.count("*").alias("files")).withColumn("due", F.col("files") >= threshold)
