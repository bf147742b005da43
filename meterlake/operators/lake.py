"""The reading table: keyed upsert and delete on year and month partitions.

A change rewrites the partitions it touches and no others. The finer month
level keeps a rewrite small, since new data covers recent days. One writer at
a time, as with any copy-on-write table without a transaction log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.operators.dedupe import KEYS, last_write_wins
from meterlake.session import staged

PARTITIONS = ["its_year", "its_month"]
PROVENANCE = ["file", "split", "pos"]
REJECT = "__reject"
#: Number of the delivery among those that wait to be merged.
BATCH = "__batch"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def with_partitions(df: DataFrame, stamp: str = "ts") -> DataFrame:
    return df.withColumn("its_year", F.year(stamp)).withColumn("its_month", F.month(stamp))


def merged(stored: DataFrame, batch: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Stored rows that the batch does not replace, and the batch.

    A small batch is broadcast and the stored side is not shuffled; whether it
    is small is for Spark to measure.
    """
    keys = keys or KEYS
    kept = stored.join(batch.select(*keys), keys, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def without(stored: DataFrame, gone: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = keys or KEYS
    return stored.join(gone.select(*keys), keys, "left_anti")


def _touched(df: DataFrame, partitions: list[str]) -> list:
    """Distinct partition values: calendar months, so few by nature. A plain table is one partition."""
    if not partitions:
        return df.limit(1).collect()
    return df.select(*partitions).distinct().collect()


def write(df: DataFrame, path: str, partitions: list[str] | None = None, keys: list[str] | None = None) -> None:
    """Overwrite the partitions present in ``df``.

    Rebalancing splits a heavy month over several tasks and packs light ones
    together; files are sorted by key, so their statistics prune by sensor, and
    a bloom filter on the first key tells which row groups cannot hold one.
    """
    partitions, keys = PARTITIONS if partitions is None else partitions, keys or KEYS
    writer = (
        df.hint("rebalance", *partitions)
        .sortWithinPartitions(*partitions, *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option(f"parquet.bloom.filter.enabled#{keys[0]}", "true")
    )
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def _complete(columns: list[str]) -> Column:
    """Whether none of the columns is NULL."""
    return F.lit(True) if not columns else ~F.exists(F.array(*[F.col(c).isNull() for c in columns]), lambda null: null)


def _reject(rows: DataFrame, path: str) -> None:
    """Write rows without a key beside the table; the same rows land in the same folder, so a repeated batch adds none."""
    n, digest = rows.agg(F.count("*"), F.sum(F.col(REJECT).cast("decimal(38,0)"))).first()
    if n:
        rows.drop(REJECT).write.mode("overwrite").parquet(f"{path.rstrip('/')}_rejected/batch={n}x{abs(digest)}")


def _folder(path: str, partitions: list[str], row) -> str:
    values = [NO_VALUE if row[p] is None else row[p] for p in partitions]
    return "/".join([path.rstrip("/"), *[f"{p}={v}" for p, v in zip(partitions, values, strict=True)]])


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def stored(spark: SparkSession, path: str, rows: list, partitions: list[str]) -> DataFrame | None:
    """The stored rows of the touched partitions; None if there are none yet.

    Only those partitions are listed, and only their footers are merged, so a
    column added earlier survives the rewrite.
    """
    folders = [f for f in (_folder(path, partitions, r) for r in rows) if exists(spark, f)]
    if not folders:
        return None
    return spark.read.option("basePath", path).option("mergeSchema", True).parquet(*folders)


def upsert(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: list[str] | None = None,
    partitions: list[str] | None = None,
    order: list[str] | None = None,
) -> int:
    """Insert or replace by key; the newest row of a batch wins, the batch wins over the table.

    Rows with a NULL in the key or the partition go to ``<path>_rejected``, equal
    ones once, as no later batch could replace them. With ``partitions=[]`` the table is
    plain and rewritten as a whole. The merged rows are written to the scratch
    folder first, so that a commit that fails can be repeated from there.
    Returns the number of rows written by key. Running the same batch again
    changes nothing.
    """
    keys, partitions = keys or KEYS, PARTITIONS if partitions is None else partitions
    whole = _complete([*keys, *[p for p in partitions if p not in keys]])
    order = order or [c for c in ["ats", *PROVENANCE] if c in incoming.columns]
    # rows without a key are told apart by their content, so that they neither replace each other nor meet in one task
    told = incoming.withColumn(REJECT, F.when(~whole, F.xxhash64(*[c for c in incoming.columns if c != BATCH])))
    newest = staged(last_write_wins(told, [*keys, REJECT], order).drop("split", "pos", BATCH), "batch")
    batch = newest.filter(F.col(REJECT).isNull()).drop(REJECT, *PROVENANCE)
    _reject(newest.filter(F.col(REJECT).isNotNull()), path)
    touched = _touched(batch, partitions)
    if not touched:
        return 0
    old = stored(spark, path, touched, partitions)
    write(batch if old is None else staged(merged(old, batch, keys), "merged"), path, partitions, keys)
    return batch.count()


def upsert_readings(spark: SparkSession, path: str, rows: DataFrame) -> int:
    """Upsert of lake rows; the partition follows from ``its``, which equals ``ts``."""
    return upsert(spark, path, with_partitions(rows))


def _pending(path: str) -> str:
    return f"{path.rstrip('/')}_pending"


def defer(path: str, rows: DataFrame, batch: int) -> str:
    """Put a delivery beside the table, to be merged by ``settle``; the same one again replaces itself. Returns its folder."""
    folder = f"{_pending(path)}/{BATCH}={batch}"
    rows.write.mode("overwrite").parquet(folder)
    return folder


def settle(spark: SparkSession, path: str, usable: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Merge all deliveries that wait beside the table, in one upsert; of a key the latest delivery counts.

    A table that is merged once per delivery is rewritten once per delivery, so the work grows with their number times
    its size; this rewrites it once. Breaking off between merge and clearing does no harm, as merging again changes nothing.
    ``usable`` makes the rows to merge from those that were put down.
    """
    folder = _pending(path)
    if not exists(spark, folder):
        return 0
    rows = spark.read.parquet(folder)
    rows = with_partitions(rows if usable is None else usable(rows))
    order = [BATCH, *[c for c in ["ats", *PROVENANCE] if c in rows.columns]]
    written = upsert(spark, path, rows, order=order)
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return written


def delete(
    spark: SparkSession,
    path: str,
    gone: DataFrame,
    keys: list[str] | None = None,
    partitions: list[str] | None = None,
) -> int:
    """Delete by key; ``gone`` carries the keys and the partition columns. NULL keys are in no table and delete nothing."""
    keys, partitions = keys or KEYS, PARTITIONS if partitions is None else partitions
    doomed = staged(gone.filter(_complete(keys)).select(*keys, *[p for p in partitions if p not in keys]), "delete-keys")
    touched = _touched(doomed, partitions)
    if not touched:
        return 0
    old = stored(spark, path, touched, partitions)
    if old is None:
        return 0
    left = staged(without(old, doomed, keys), "survivors")
    write(left, path, partitions, keys)
    _clear(spark, path, left, touched, partitions)
    return doomed.count()


def _clear(spark: SparkSession, path: str, left: DataFrame, touched: list, partitions: list[str]) -> None:
    """Drop the touched partitions of which no row is left; a dynamic overwrite leaves those alone.

    Dropping a folder moves no data and runs no job. A table that has no other partition keeps an empty one, for its schema.
    """
    if not partitions:
        return
    filled = {tuple(r) for r in left.select(*partitions).distinct().collect()}
    emptied = [_folder(path, partitions, row) for row in touched if tuple(row) not in filled]
    gone = [f for f in emptied if exists(spark, f)]
    if not gone:
        return
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in gone[1:] if not filled else gone:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(folder), True)
    if not filled:
        left.drop(*partitions).limit(0).write.mode("overwrite").parquet(gone[0])


def replace_window(
    spark: SparkSession, path: str, incoming: DataFrame, start: str, end: str, sensors: DataFrame | None = None
) -> dict[str, int]:
    """Make the stored rows of ``[start, end)`` exactly the incoming ones, in one change; numbers of rows by what became of them.

    Rows of the window that the delivery no longer holds go, changed ones are replaced, new ones come in. Only the sensors
    given (those of the delivery unless named) are touched, and only the months of the window are read and rewritten.
    Incoming rows outside the window are left out; of several rows of a key the newest counts. Running it again
    changes nothing.
    """
    first, last = (F.lit(x).cast("timestamp_ntz") for x in (start, end))
    inside = (F.col("ts") >= first) & (F.col("ts") < last)
    order = [c for c in ["ats", *PROVENANCE] if c in incoming.columns]
    whole = with_partitions(incoming.filter(inside & _complete(KEYS)))
    batch = staged(last_write_wins(whole, KEYS, order).drop(*PROVENANCE), "window")
    scope = batch.select("sensorId") if sensors is None else sensors.select(F.col(sensors.columns[0]).alias("sensorId"))
    scope = staged(scope.distinct(), "window-sensors")
    months = spark.range(1).select(F.explode(F.sequence(F.trunc(first.cast("date"), "MM"), F.trunc((last - F.expr("INTERVAL '1' SECOND")).cast("date"), "MM"), F.expr("INTERVAL 1 MONTH"))).alias("m"))
    touched = months.select(F.year("m").alias("its_year"), F.month("m").alias("its_month")).collect()  # calendar months
    old = stored(spark, path, touched, PARTITIONS)
    if old is None:
        write(batch, path)
        return {"inserted": batch.count(), "replaced": 0, "withdrawn": 0}
    held = old.filter(inside).join(scope, "sensorId", "left_semi")
    keys = staged(held.select(*KEYS, "its_year", "its_month"), "window-held")
    rest = old.filter(~inside).unionByName(old.filter(inside).join(scope, "sensorId", "left_anti"))
    left = staged(rest.unionByName(batch, allowMissingColumns=True), "window-rows")
    replaced = batch.join(keys.select(*KEYS), KEYS, "left_semi").count()
    write(left, path)
    _clear(spark, path, left, touched, PARTITIONS)
    return {"inserted": batch.count() - replaced, "replaced": replaced, "withdrawn": keys.count() - replaced}


def export_per_sensor(rows: DataFrame, path: str) -> None:
    """CSV files in one folder per sensor."""
    (
        rows.hint("rebalance", "sensorId")
        .sortWithinPartitions("sensorId", "ts")
        .write.mode("overwrite")
        .option("header", True)
        .partitionBy("sensorId")
        .csv(path)
    )


def write_lake_csv(rows: DataFrame, path: str, max_records: int = 50_000) -> None:
    """Lake-source CSV, staged and committed by Spark's output committer."""
    (
        rows.select("sensorId", "ts", "val", "unit", "its", "quality")
        .write.mode("append")
        .option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .option("maxRecordsPerFile", max_records)
        .csv(path)
    )
