"""Each file once, in micro-batches, drained and stopped.

The checkpoint is the record of what was processed: a file delivered twice is
not read twice. Should a batch be replayed after a failure, the keyed upsert
makes the second run a no-op. Late and corrected data are upserts as well, so
no watermark is set and nothing is dropped as late.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterlake.functions.text import decode_key
from meterlake.operators import lake
from meterlake.plans import ingest
from meterlake.sources.tables import CORRUPT, lake_csv, rejects
from meterlake.streaming.totals import observed

ARRIVALS = "path string, modificationTime timestamp, length bigint, content binary"


def _source(spark: SparkSession, fmt: str, max_files: int, archive: str | None):
    reader = spark.readStream.format(fmt).option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader


def _drain(stream: DataFrame, checkpoint: str, work: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(work)
        .start()
    )


def lake_rows(
    spark: SparkSession, source: str, lake_path: str, checkpoint: str,
    max_files: int = ingest.BATCH_FILES, archive: str | None = None,
) -> StreamingQuery:
    """Lake-source CSV files into the lake; returns when all are there. An empty batch only consumes its files.

    A batch is written once, beside the lake, since its rows, the lines that do not fit (kept below ``<lake>_unreadable``,
    by batch) and the counts for ``totals.BatchTotals`` come from one reading. The batches of a drain are merged at its end,
    in one change; those of a drain that broke off, by the next.
    """

    def usable(put: DataFrame) -> DataFrame:
        return put.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)

    lake.settle(spark, lake_path, usable)
    rows = lake_csv(_source(spark, "csv", max_files, archive)).load(source)
    rows = rows.select("*", F.col("_metadata.file_path").alias("file"), F.current_timestamp().cast("timestamp_ntz").alias("ats"))

    def work(batch: DataFrame, batch_id: int) -> None:
        held = batch.sparkSession.read.schema(batch.schema).parquet(lake.defer(lake_path, batch, batch_id))
        bad = rejects(held).withColumn("batch", F.lit(batch_id))
        bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{lake_path.rstrip('/')}_unreadable")

    query = _drain(observed(rows, CORRUPT), checkpoint, work)
    query.awaitTermination()
    lake.settle(spark, lake_path, usable)
    return query


def source_files(
    spark: SparkSession, landing: str, mapping: DataFrame, lake_path: str, checkpoint: str,
    audit_path: str | None = None, outcomes_path: str | None = None,
    max_files: int = ingest.BATCH_FILES, archive: str | None = None,
) -> StreamingQuery:
    """Meter and vendor files into the lake.

    The stream carries only the paths of new files, contents are not read with
    it; each micro-batch then reads its at most ``max_files`` files with the
    batch readers.
    """
    arrivals = (
        _source(spark, "binaryFile", max_files, archive).schema(ARRIVALS).load(landing).select("path", "length")
    )

    def work(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        path = decode_key(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")))
        paths = [r["path"] for r in batch.filter(F.col("length") > 0).select(path.alias("path")).collect()]
        if not paths:
            return
        outcomes = ingest.run(session, paths, mapping, lake_path, audit_path, f"{batch_id:09d}")
        if outcomes_path:
            (
                outcomes.withColumn("batch", F.lit(batch_id))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch")
                .parquet(outcomes_path)
            )

    return _drain(arrivals, checkpoint, work)
