"""Helpers that the operators of this package share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.session import scratch_dir, staged

__all__ = ["held_out", "reader", "scratch_dir", "shipped", "shuffle_parts", "staged", "table", "texts", "uniform"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept out of learning: crc32 of the id's text, modulo 4, is 2 (a null id is not)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def uniform(seed: int, *columns: Column) -> Column:
    """A repeatable number in [0, 1) from the columns' values."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 40)) / float(1 << 40)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a column of strings."""
    return column.cast(pa.binary()).to_pylist()


def reader(batches: Iterator[pa.RecordBatch], text: str = "text", rows: int = 512) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Record batches in slices of at most ``rows``, each with its texts' bytes, so that only a slice is held as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, texts(part.column(part.schema.get_field_index(text)))


_SHIPPED: set[str] = set()


def shipped(query: Callable) -> Callable:
    """A query whose session's Python workers get this package as a file, once per application, wherever the driver has it."""

    @wraps(query)
    def run(spark: SparkSession, *args):
        context = spark.sparkContext
        if context.applicationId not in _SHIPPED:
            root = Path(__file__).resolve().parent.parent
            path = Path(tempfile.mkdtemp(prefix="spark-")) / f"{root.name}.zip"
            with zipfile.ZipFile(path, "w") as archive:
                for file in sorted(root.rglob("*.py")):
                    archive.write(file, file.relative_to(root.parent))
            context.addPyFile(str(path))
            _SHIPPED.add(context.applicationId)
        return query(spark, *args)

    return run
