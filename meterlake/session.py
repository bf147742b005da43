"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


#: Scratch folders of this application.
_FOLDERS: set[str] = set()


def local_session(cpus: int | str = "*", partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("meterlake")
    conf = {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.driver.memory": "8g",
        **extra,
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to the machine's own
    temporary folder; on a cluster the setting is required, since a folder of
    one machine would be lost with it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    folder = f"{base.rstrip('/')}/meterlake/{spark.sparkContext.applicationId}"
    _FOLDERS.add(folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has written to its scratch folders; call it when no result is to be read any more.

    Results are lazy and read their staged tables when they are used, so nothing can go earlier by itself.
    """
    for folder in sorted(_FOLDERS):
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    _FOLDERS.clear()


def staged(df: DataFrame, name: str = "stage", sort: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage at a table that outlives any executor, and gives the
    optimizer true sizes for whatever joins the result.
    """
    path = scratch_dir(df.sparkSession, name)
    out = df.sortWithinPartitions(*sort) if sort else df
    out.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
