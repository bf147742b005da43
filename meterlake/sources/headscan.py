"""The heads of files without their bodies: a data source that opens each file and stops after a few lines.

Spark's own readers hand a task whole files, so looking at ten lines of each costs a pass over every byte. Here a partition
is a group of files; of each one block is read, and more only until there are lines enough. Classification thus costs the
same for a file of a megabyte and one of a terabyte.

The executors open the files themselves through Arrow's file systems (local or mounted folders, object stores, HDFS). For
stores that only Spark's readers know, ``scan`` takes the heads from a text scan instead, with the same result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from meterlake.functions.text import base_name, clean_line
from meterlake.sources.lines import HEAD_LINES, NUL_PROBE_BYTES, heads, read_lines

NAME = "meter_heads"
RAW = "file string, head array<string>, has_nul boolean, unreadable boolean"
BLOCK = 1 << 16


def head_of(stream) -> tuple[list[str], bool]:
    """The first lines of a byte stream, and whether its first bytes hold a NUL; reads block by block, as far as it has to."""
    data = bytearray()
    while True:
        block = stream.read(BLOCK)
        data += block
        # carriage returns end lines too, and one at the end of a block may have its newline in the next
        ended = bytes(data).replace(b"\r\n", b"\n").replace(b"\r", b"\n").count(b"\n")
        if not block or ended > HEAD_LINES:
            break
    lines = bytes(data).replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n")
    if lines and not lines[-1]:
        lines.pop()
    return [line.decode("utf-8", "replace") for line in lines[:HEAD_LINES]], b"\0" in data[:NUL_PROBE_BYTES]


@dataclass
class Group(InputPartition):
    files: list[str]


class _Reader(DataSourceReader):
    def __init__(self, files: list[str], per_task: int):
        self.files, self.per_task = files, per_task

    def partitions(self) -> list[Group]:
        return [Group(self.files[i : i + self.per_task]) for i in range(0, len(self.files), self.per_task)] or [Group([])]

    def read(self, partition: Group) -> Iterator[tuple]:
        from pyarrow import fs

        for file in partition.files:
            try:
                store, path = fs.FileSystem.from_uri(file)
                with store.open_input_stream(path, compression=None, buffer_size=0) as stream:
                    lines, has_nul = head_of(stream)
            except FileNotFoundError:  # moved since it was listed: a failure of this file
                yield file, [], False, True
            else:
                yield file, lines, has_nul, False


class HeadSource(DataSource):
    """``option("files", <JSON list of URIs>)``, ``option("filesPerTask", n)``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return RAW

    def reader(self, schema) -> DataSourceReader:
        return _Reader(json.loads(self.options["files"]), int(self.options.get("filesPerTask", "16")))


def reachable(file: str) -> bool:
    """Whether Arrow knows the store of a URI."""
    from pyarrow import fs
    from pyarrow.lib import ArrowException

    try:
        fs.FileSystem.from_uri(file)
    except (ArrowException, OSError, ValueError):
        return False
    return True


def scan(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per file, as ``lines.heads`` gives it for their text, without ``head_pos``."""
    # listed by Spark, contents are not read; the files of one run
    listed = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("file"), "length").collect()
    files = [r["file"] for r in listed if r["length"] > 0]
    if not all(reachable(f) for f in {f.split("/")[0]: f for f in files}.values()):
        return heads(read_lines(spark, paths)).drop("head_pos")
    spark.dataSource.register(HeadSource)
    raw = spark.read.format(NAME).option("files", json.dumps(files)).load()
    return raw.select("file", base_name(F.col("file")).alias("name"), F.transform("head", clean_line).alias("head"), "has_nul", "unreadable")
