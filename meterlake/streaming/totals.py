"""Totals of each micro-batch, kept as a table.

The counts are observed while a batch is written and cost no further pass. A listener takes them from the progress report
of each batch and puts them down as one small document named by run and batch, so that a report that comes twice
leaves one.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

OBSERVED = "batch"
TOTALS = "query string, batch_id long, input_rows long, rows long, rejected long, without_value long"


def observed(rows: DataFrame, corrupt: str) -> DataFrame:
    """Rows of a stream with the counts that the totals are made of."""
    return rows.observe(
        OBSERVED,
        F.count(F.when(F.col(corrupt).isNull(), 1)).alias("rows"),
        F.count(F.col(corrupt)).alias("rejected"),
        F.count(F.when(F.col(corrupt).isNull() & F.col("val").isNull(), 1)).alias("without_value"),
    )


class BatchTotals(StreamingQueryListener):
    """Writes the observed counts of every batch below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def settle(self, spark: SparkSession) -> None:
        """Wait until the reports sent so far have been taken."""
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get(OBSERVED)
        if counts is None:
            return
        document = {"query": str(progress.id), "batch_id": progress.batchId, "input_rows": progress.numInputRows, **counts.asDict()}
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{progress.id}-{progress.batchId:012d}.json")
        out = target.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(target, True)
        try:
            out.write(bytearray(json.dumps(document).encode()))
        finally:
            out.close()


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOTALS).json(path)
