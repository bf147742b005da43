"""Text files as ordered lines, with the few header lines each file needs.

A line is ``(file, split, pos, line)``. ``split`` is the byte offset of the
input split and ``pos`` grows within it, so ``(file, split, pos)`` is file
order even when one large file is read by many tasks. Nothing here groups a
whole file in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterlake.functions.text import base_name, cells, clean_line

HEAD_LINES = 10
NUL_PROBE_BYTES = 4096
NUL = "\x00"
# Fixed value: classes of places by which the end of the heads is found.
CLASSES = 16

LINES_DDL = "file string, split long, pos long, line string"


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """UTF-8 text, splittable; a byte-order mark and carriage returns are dropped."""
    return _tagged(spark.read.text(paths)).withColumn("line", clean_line(F.col("line")))


def read_utf16_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """UTF-16 LE text, also splittable.

    The record separator is the two-byte newline, so every task starts on a
    character boundary; each line is then decoded from its bytes.
    """
    raw = _tagged(spark.read.option("lineSep", "\n\x00").text(paths))
    text = F.decode(F.col("line").cast("binary"), "UTF-16LE")
    return raw.withColumn("line", clean_line(text))


def _tagged(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").cast("long").alias("split"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"),
    )


def read_zipped_lines(spark: SparkSession, paths: str | list[str], chunk: int = 20_000) -> DataFrame:
    """Lines of archives that hold exactly one file, unpacked on the executors.

    Inflation is a stream, so a task holds one archive and one chunk of lines.
    A file that is no archive is read as plain text. An archive with several
    members, an encrypted or a broken one gives one row with a NULL line and no
    other: a parse failure of that file, not of the job. So that damage near
    its end is known before its first line, an archive is inflated twice.
    """

    def unpack(batches: Iterator) -> Iterator:
        import io
        import lzma
        import zipfile
        import zlib

        import pandas as pd

        # encryption and unknown methods are RuntimeErrors
        broken = (zipfile.BadZipFile, zlib.error, lzma.LZMAError, RuntimeError, EOFError, OSError, ValueError)

        def frame(path: str, n: int, rows: list) -> pd.DataFrame:
            first = n * chunk
            return pd.DataFrame(
                {"file": path, "split": n, "pos": range(first, first + len(rows)), "line": rows}
            )

        def text_of(content: bytes):
            if not zipfile.is_zipfile(io.BytesIO(content)):
                if content[:2] == b"PK":
                    raise zipfile.BadZipFile("damaged archive")
                return io.BytesIO(content)
            archive = zipfile.ZipFile(io.BytesIO(content))
            members = [m for m in archive.infolist() if not m.is_dir()]
            if len(members) != 1:
                raise zipfile.BadZipFile("expected exactly one member")
            with archive.open(members[0]) as whole:
                while whole.read(1 << 20):
                    pass
            return archive.open(members[0])

        for batch in batches:
            for path, content in zip(batch["file"], batch["content"], strict=True):
                n, rows = 0, []
                try:
                    for raw in io.TextIOWrapper(text_of(bytes(content)), "utf-8-sig", "replace"):
                        rows.append(raw.rstrip("\r\n"))
                        if len(rows) == chunk:
                            yield frame(path, n, rows)
                            n, rows = n + 1, []
                except broken:
                    rows = [None]
                if rows:
                    yield frame(path, n, rows)

    files = spark.read.format("binaryFile").load(paths).select(F.col("path").alias("file"), "content")
    return files.mapInPandas(unpack, LINES_DDL)


def _reach(lines: DataFrame) -> Column:
    """A ``pos`` that none of the first lines of any file lies beyond; no line is sorted or shuffled for it.

    Lines are dealt to classes by their ``pos``. As many classes as a head has lines hold as many different lines, so the
    head ends no later than the last of their smallest places.
    """
    of = F.pmod(F.xxhash64("pos"), F.lit(CLASSES))
    lowest = [F.min(F.when(of == i, F.col("pos"))).alias(f"p{i}") for i in range(CLASSES)]
    per_file = lines.groupBy("file").agg(*lowest, F.max("pos").alias("last"))
    enough = F.get(F.array_sort(F.array(*[F.col(f"p{i}") for i in range(CLASSES)])), F.lit(HEAD_LINES - 1))
    return per_file.agg(F.max(F.coalesce(enough, F.col("last")))).scalar()


def _tops(lines: DataFrame) -> DataFrame:
    """``file, head, head_pos``: the first lines of each file and where they are.

    Only the first split of a file can hold them; lines that lie too far for any file go first, and the row-number limit is
    applied inside every map task, so few lines are sorted and fewer shuffled.
    """
    begun = lines.filter(F.col("split") == 0)
    order = W.partitionBy("file").orderBy("split", "pos")
    first = begun.filter(F.col("pos") <= _reach(begun)).withColumn("n", F.row_number().over(order)).filter(F.col("n") <= HEAD_LINES)
    found = first.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("n", "split", "pos", "line"))).alias("found"))
    return found.select(
        "file", F.transform("found", lambda h: h["line"]).alias("head"), F.transform("found", lambda h: h["pos"]).alias("head_pos")
    )


def _probed(lines: DataFrame) -> DataFrame:
    """``file, has_nul, unreadable`` of the probed bytes of each file.

    A file that fits the probe, or has neither a NUL nor a missing line, needs sums only. Of the others the lines up to the
    last such one are put in order, at most as many per file and task as the probed bytes can hold.
    """
    begun = lines.filter(F.col("split") == 0)
    nul, missing = F.coalesce(F.contains("line", F.lit(NUL)), F.lit(False)), F.col("line").isNull()
    sums = begun.groupBy("file").agg(
        F.max(nul).alias("nul"),
        F.max(missing).alias("missing"),
        F.sum(F.coalesce(F.octet_length("line"), F.lit(0)) + 1).alias("bytes"),
        F.max(F.when(nul | missing, F.col("pos"))).alias("to"),
    )
    open_ = (F.col("nul") | F.col("missing")) & (F.col("bytes") > NUL_PROBE_BYTES)
    doubtful = sums.filter(open_).select("file")
    order = W.partitionBy("file").orderBy("split", "pos")
    first = (
        begun.filter(F.col("pos") <= sums.filter(open_).agg(F.max("to")).scalar())
        .join(doubtful, "file", "left_semi")
        .withColumn("n", F.row_number().over(order))
        .filter(F.col("n") <= NUL_PROBE_BYTES)  # a line has a byte at least, its end
        .withColumn(
            "offset",
            F.coalesce(F.sum(F.octet_length("line") + 1).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
        )
    )
    probe = F.substring(F.col("line"), F.lit(1), F.greatest(F.lit(0), F.lit(NUL_PROBE_BYTES) - F.col("offset")).cast("int"))
    seen = first.groupBy(F.col("file").alias("_file")).agg(
        F.coalesce(F.max(F.contains(probe, F.lit(NUL))), F.lit(False)).alias("_nul"), F.max(missing).alias("_missing")
    )
    settled = sums.join(seen, F.col("file") == F.col("_file"), "left")
    return settled.select(
        "file",
        F.when(open_, F.coalesce("_nul", F.lit(False))).otherwise(F.col("nul")).alias("has_nul"),
        F.when(open_, F.coalesce("_missing", F.lit(False))).otherwise(F.col("missing")).alias("unreadable"),
    )


def heads(lines: DataFrame) -> DataFrame:
    """One row per file: its first lines and whether its first bytes hold a NUL."""
    probed = _probed(lines).withColumnRenamed("file", "_file")
    return (
        _tops(lines)
        .join(probed, F.col("file").eqNullSafe(F.col("_file")))
        .select("file", base_name(F.col("file")).alias("name"), "head", "head_pos", "has_nul", "unreadable")
    )


def headers(lines: DataFrame, line_no: int) -> DataFrame:
    """One row per file: the header cells found on line ``line_no``."""
    return _tops(lines).select(
        "file",
        cells(F.coalesce(F.get("head", F.lit(line_no - 1)), F.lit(""))).alias("header"),
        F.get("head_pos", F.lit(line_no - 1)).alias("header_pos"),
        "head",
    )


def place(name: str) -> str:
    """The column that holds where a file's header has ``name``, from 0; -1 where it has not."""
    return f"at {name}"


def table_rows(lines: DataFrame, line_no: int = 1, keep_blank_lines: bool = False, names: tuple[str, ...] = ()) -> DataFrame:
    """Data rows below the header on line ``line_no``, each with its file's header.

    The header is searched for ``names`` once per file, not once per row and cell; ``place`` says where they are.
    The join side is one row per file. Whether it is broadcast is left to
    Spark, which knows its size; otherwise the join shuffles by file and a
    dominant file is split by adaptive skew handling.
    """
    body = lines if keep_blank_lines else lines.filter(F.trim("line") != "")
    places = [(F.array_position("header", F.lit(name)) - 1).cast("int").alias(place(name)) for name in names]
    return (
        body.join(headers(lines, line_no).select("*", *places), "file")
        .filter((F.col("split") > 0) | (F.col("pos") > F.col("header_pos")))
        .select("file", "split", "pos", "header", "head", *[F.col(f"`{place(name)}`") for name in names], cells(F.col("line")).alias("row"))
    )


def numbered(lines: DataFrame) -> DataFrame:
    """Adds ``line_no``, counted from 1 over the whole file.

    Works on one small row per split: lines before the split, then the distance
    from the split's first line. Needs the consecutive ``pos`` that the readers
    here give. No line is sorted.
    """
    per_split = lines.groupBy("file", "split").agg(F.min("pos").alias("first_pos"), F.count("*").alias("n"))
    before = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_split.select(
        "file", "split", "first_pos", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    return lines.join(offsets, ["file", "split"]).select(
        *lines.columns, (F.col("before") + F.col("pos") - F.col("first_pos") + 1).alias("line_no")
    )
