"""New and changed files: a file that is written again at its path counts as an arrival again.

Spark's file source never looks at a path twice, so a corrected report under the same name would be lost. Here each poll
of the landing folder is one small table of ``path, size, modified`` (contents are not read), polls are a stream, and the
state of each path is the size and time it was last passed on with. A path whose state is the same is a redelivery and
goes no further. State that was not touched for a while expires, so it does not grow with all files there ever were; a
file that comes again later than that is read again, which the keyed upsert makes harmless.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from meterlake.functions.text import decode_key
from meterlake.plans import ingest
from meterlake.session import staged
from meterlake.sources.tables import manifest

POLL = "path string, size long, modified long"
# Fixed value: hours after which a path is forgotten.
FORGET_HOURS = 12


def poll(spark: SparkSession, landing: str, polls: str) -> None:
    """Append what lies in the landing folder now to the table of polls."""
    manifest(spark, landing).filter(F.col("size") > 0).select("path", "size", F.unix_micros("modified").alias("modified")).coalesce(1).write.mode("append").parquet(polls)


def latest(forget_ms: int) -> Callable:
    """Passes a path on when its size or time differ from what was seen last; of several polls of one batch the latest counts."""

    def run(key: tuple, polled: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        seen = max((int(t), int(n)) for rows in polled for t, n in zip(rows["modified"], rows["size"], strict=True))
        before = tuple(state.get) if state.exists else None
        state.update(seen)
        state.setTimeoutDuration(forget_ms)
        if before != seen:
            yield pd.DataFrame({"path": [key[0]], "size": [seen[1]], "modified": [seen[0]]})

    return run


def changed(polls: DataFrame, forget_hours: float = FORGET_HOURS) -> DataFrame:
    """The paths of a stream of polls that are new, or not as they were."""
    return polls.groupBy("path").applyInPandasWithState(
        latest(int(forget_hours * 3_600_000)), POLL, "modified long, size long", "append", GroupStateTimeout.ProcessingTimeTimeout
    )


def drain(
    spark: SparkSession, polls: str, checkpoint: str, work: Callable[[DataFrame, int], None], forget_hours: float = FORGET_HOURS
) -> StreamingQuery:
    """Hand the new and changed files of all polls not seen yet to ``work``, and stop."""
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")  # a batch without a poll, only to look for expired state, would be followed by another for good
    try:
        stream = changed(spark.readStream.schema(POLL).parquet(polls), forget_hours)
        return stream.writeStream.option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).foreachBatch(work).start()
    finally:
        spark.conf.set(setting, before)  # a query keeps the settings that it starts with


def source_files(
    spark: SparkSession, landing: str, mapping: DataFrame, lake_path: str, base: str,
    audit_path: str | None = None, batch_files: int = ingest.BATCH_FILES, forget_hours: float = FORGET_HOURS,
) -> StreamingQuery:
    """Poll the landing folder and ingest what is new or has changed, in runs of ``batch_files``; state lives below ``base``."""
    poll(spark, landing, f"{base}/polls")

    def work(batch: DataFrame, batch_id: int) -> None:
        path = decode_key(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")))
        # written first: a batch is to be computed once, on the stream's own thread
        for n, paths in enumerate(ingest.runs(staged(batch.select(path.alias("path"), "size", "modified"), "arrivals"), batch_files)):
            ingest.run(batch.sparkSession, paths, mapping, lake_path, audit_path, f"{batch_id:09d}-{n:06d}")

    return drain(spark, f"{base}/polls", f"{base}/checkpoint", work, forget_hours)
