"""Source files to lake rows and file outcomes."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, reduce
from itertools import islice

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.text import decode_key
from meterlake.operators import journal, outcome, resolve
from meterlake.schemas import COUNTED, EACH, FILLED, conform
from meterlake.session import staged
from meterlake.sources import headscan, nem12
from meterlake.sources.classify import NEM, classify, content_flags, late_records, nem_readings, nem_records, read_layout, read_nem, rivals, settle_nem
from meterlake.sources.layouts import BY_NAME
from meterlake.sources.lines import headers, heads, read_lines, read_utf16_lines, read_zipped_lines
from meterlake.sources.tables import manifest

log = logging.getLogger(__name__)

# Fixed value: files of one run; a drain makes as many runs as there are files for.
BATCH_FILES = 400
#: Meter data with quoted record types: without a plain separator it is cut by lines, each split with the context before it.
BY_LINE = "nem by line"


@dataclass(frozen=True)
class Ingested:
    """What a run knows about its input, in lazy DataFrames; a plan that nobody asks for is not made.

    ``records`` are the resolved records of meter data, by version, ``others`` the resolved readings.
    """

    records: list[tuple[str, DataFrame]]
    others: list[DataFrame]
    outcomes: DataFrame

    @cached_property
    def resolved(self) -> DataFrame:
        return _spread(self.records, self.others, EACH)

    @cached_property
    def filled(self) -> DataFrame:
        return _spread(self.records, self.others, FILLED)

    @cached_property
    def samples(self) -> DataFrame:
        first = [nem_readings(name, outcome.sampled(of_version, nem_readings(name, of_version, COUNTED))) for name, of_version in self.records]
        return outcome.skip_samples(_union([*first, *self.others]))

    @cached_property
    def identifiers(self) -> DataFrame:
        return resolve.unmapped_identifiers(self.filled)

    def rows(self) -> DataFrame:
        return resolve.to_lake(self.filled)

    def audit(self) -> DataFrame:
        return outcome.audit(self.outcomes, self.samples, self.identifiers)


def _spread(records: list[tuple[str, DataFrame]], others: list[DataFrame], blanks: str) -> DataFrame:
    rest = [o.withColumn("cells", F.lit(1).cast("long")) if blanks == COUNTED else o for o in others]
    return _union([*[nem_readings(name, of_version, blanks) for name, of_version in records], *rest])


def _nothing(spark: SparkSession) -> DataFrame:
    return conform(spark.range(0))


def _no_lines(spark: SparkSession) -> DataFrame:
    """As a plan; an empty local list would start a Python worker for every core."""
    return spark.sql("SELECT '' AS file, 0L AS split, 0L AS pos, '' AS line WHERE false")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _classified(tops: DataFrame, lines_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The layout of every file; one that only looks like meter data falls through to its vendor layout.

    ``lines_of`` gives the lines of a few files.
    """
    tops = staged(tops, "heads")
    files = staged(classify(tops), "files")
    unknown = files.filter(F.col("fmt").isNull()).join(tops.filter(~F.col("unreadable")), "file", "left_semi").select("file", "name")
    late = staged(late_records(lines_of(unknown.select("file"))), "late")
    if not late.isEmpty():
        nothing = F.lit(None).cast("string")
        late = late.join(unknown, "file").select("file", "name", "fmt", nothing.alias("status"), nothing.alias("reason"), "envelope", "quoted")
        files = staged(files.join(late, "file", "left_anti").unionByName(late), "files")
    doubtful = staged(rivals(files, tops), "rivals")
    if doubtful.isEmpty():
        return files
    for name in NEM:
        held = read_nem(name, lines_of(doubtful.filter(F.col("meter") == name).select("file")), COUNTED)
        held = held.filter(F.col("t_start").isNotNull()).select("file").distinct()
        doubtful = doubtful.join(held, "file", "left_anti")
    fallen = doubtful.drop("meter")
    return staged(files.join(fallen, "file", "left_anti").unionByName(fallen), "files")


def ingest_lines(lines: DataFrame, mapping: DataFrame, formats: list[str] | None = None) -> Ingested:
    """Ingest lines that are already a DataFrame, of any mix of layouts.

    The classification, one row per file, and the resolved records are
    written once, since several results read each of them.
    """
    files = _classified(heads(lines), lambda few: lines.join(few, "file", "left_semi"))
    meter, readings, flags = [], [_nothing(lines.sparkSession)], []
    for name in formats or [*NEM, *[x.name for x in BY_NAME.values() if x.parse is not None]]:
        live = files.filter((F.col("fmt") == name) & F.col("status").isNull()).select("file")
        own = lines.join(live, "file", "left_semi")
        if name in NEM:
            meter.append((name, nem_records(name, own, mapping)))
            continue
        readings.append(read_layout(name, own))
        if BY_NAME[name].flags:
            flags.append(content_flags(name, own))
    return _account(files, meter, readings, flags, mapping)


def _settled(files: DataFrame, flags: list[DataFrame]) -> DataFrame:
    """Files with the verdicts that needed their bodies."""
    late = _union(flags).select("file", F.col("status").alias("_s"), F.col("reason").alias("_r"))
    return (
        files.join(late, "file", "left")
        .withColumn("status", F.coalesce("status", "_s"))
        .withColumn("reason", F.coalesce("reason", "_r"))
        .drop("_s", "_r")
    )


def _account(files: DataFrame, meter: list[tuple[str, DataFrame]], readings: list[DataFrame], flags: list[DataFrame], mapping: DataFrame) -> Ingested:
    """``meter`` are resolved records of meter data, by version; ``readings`` are to be resolved."""
    # Read by the lake write, the counts, the samples and the identifiers. Meter data are kept as records, far fewer than
    # their cells, and each result spreads them no further than it must.
    records = [(name, staged(of_version, "records")) for name, of_version in meter]
    others = [staged(resolve.resolve(_union(readings), mapping), "resolved")] if len(readings) > 1 or not meter else []
    # The cells are gone over once for all counts; whether a meter-data file holds readings shows there too.
    channels = staged(outcome.by_channel(_spread(records, others, COUNTED)), "channels")
    settled = staged(_settled(files, [*flags, settle_nem(files, channels)]), "settled")
    return Ingested(records, others, outcome.file_outcomes(outcome.channel_totals(channels), settled))


def _path() -> Column:
    return decode_key(F.replace(F.col("file"), F.lit("+"), F.lit("%2B"))).alias("path")


def _paths(files: DataFrame) -> dict[str, list[str]]:
    """Paths per layout, of the files of one run."""
    by_line = (F.col("fmt") == "nem") & F.col("quoted") & ~F.lower("file").endswith(".zip")
    fmt = F.when(by_line, F.lit(BY_LINE)).otherwise(F.col("fmt"))
    rows = files.filter(F.col("status").isNull()).select(fmt.alias("fmt"), _path()).collect()
    found: dict[str, list[str]] = {}
    for row in rows:
        found.setdefault(row["fmt"], []).append(row["path"])
    return found


def _sources(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """Lines of plain files, and of archives."""
    zips = [p for p in paths if p.lower().endswith(".zip")]
    plain = [p for p in paths if not p.lower().endswith(".zip")]
    return ([read_lines(spark, plain)] if plain else []) + ([read_zipped_lines(spark, zips)] if zips else [])


def ingest_files(spark: SparkSession, paths: list[str], mapping: DataFrame) -> Ingested:
    """Ingest the files of one run, each layout with its own native reader."""
    zips = [p for p in paths if p.lower().endswith(".zip")]
    loose = [p for p in paths if not p.lower().endswith(".zip")]
    tops = ([headscan.scan(spark, loose)] if loose else []) + ([heads(read_zipped_lines(spark, zips)).drop("head_pos")] if zips else [])
    files = _classified(
        _union(tops),
        lambda few: _union([_no_lines(spark), *_sources(spark, [r["path"] for r in few.select(_path()).collect()])]),
    )
    if zips:
        packed = read_zipped_lines(spark, zips)
    by_layout = _paths(files)
    meter, readings, flags = [], [_nothing(spark)], []
    for name, of_layout in by_layout.items():
        if name == BY_LINE:
            meter.append(("nem", nem_records("nem", read_lines(spark, of_layout), mapping)))
            continue
        loose = [p for p in of_layout if not p.lower().endswith(".zip")]
        boxed = len(loose) < len(of_layout)
        if boxed:
            in_zip = packed.join(files.filter(F.col("fmt") == name).select("file"), "file", "left_semi")
        if name == "nem":
            meter += [(name, nem12.resolve_days(nem12.read_blocks(spark, loose), mapping))] if loose else []
            meter += [(name, nem_records(name, in_zip, mapping))] if boxed else []
        else:
            lines = _union(([_lines_of(spark, name, loose)] if loose else []) + ([in_zip] if boxed else []))
            if name == "nem13":
                meter.append((name, nem_records(name, lines, mapping)))
                continue
            lines, broken = _decoded_heads(name, lines)
            readings.append(read_layout(name, lines))
            if broken is not None:
                flags.append(broken)
            if BY_NAME[name].flags:
                flags.append(content_flags(name, lines))
    return _account(files, meter, readings, flags, mapping)


def _lines_of(spark: SparkSession, name: str, paths: list[str]) -> DataFrame:
    utf16 = name in BY_NAME and BY_NAME[name].utf16
    return read_utf16_lines(spark, paths) if utf16 else read_lines(spark, paths)


def _decoded_heads(name: str, lines: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Header check of layouts whose text only exists after decoding."""
    layout = BY_NAME[name]
    if not layout.utf16:
        return lines, None
    checked = headers(lines, layout.header_line)
    bad = checked.filter(~F.coalesce(layout.required(F.col("header"), F.col("head")), F.lit(False))).select("file")
    broken = bad.select("file", F.lit("parse_failed").alias("status"), F.lit("parser_error").alias("reason"))
    return lines.join(bad, "file", "left_anti"), broken


def runs(files: DataFrame, batch_files: int = BATCH_FILES) -> Iterator[list[str]]:
    """The paths of a manifest, oldest first, run by run; the driver holds one run at a time, whatever their number."""
    ordered = files.filter(F.col("size") > 0).orderBy("modified", "path").select("path")
    rows = ordered.toLocalIterator()
    while batch := [r["path"] for r in islice(rows, batch_files)]:
        yield batch


def run(
    spark: SparkSession, paths: list[str], mapping: DataFrame, lake_path: str, audit_path: str | None = None, batch: str = "run"
) -> DataFrame:
    """Ingest files into the lake; returns the outcome of every file.

    Rows, audit and outcomes are written beside the lake first and then applied as one: a run that fails between the two
    writes is finished by the next one, or by ``journal.recover``.
    """
    done = ingest_files(spark, paths, mapping)
    return journal.commit(spark, lake_path, batch, done.rows(), done.audit() if audit_path else None, done.outcomes, audit_path)


def drain(
    spark: SparkSession, landing: str, mapping: DataFrame, lake_path: str,
    audit_path: str | None = None, outcomes_path: str | None = None, batch_files: int = BATCH_FILES, name: str = "drain",
) -> dict[str, int]:
    """Ingest every file below ``landing``, in runs of ``batch_files``; totals of files, runs and failed runs.

    A run that fails leaves its files for the next drain and the others go on.
    """
    files = staged(manifest(spark, landing), "manifest")
    totals = {"files": 0, "runs": 0, "failed": 0}
    for n, paths in enumerate(runs(files, batch_files)):
        totals["runs"] += 1
        try:
            outcomes = run(spark, paths, mapping, lake_path, audit_path, f"{name}-{n:06d}")
            if outcomes_path:
                outcomes.withColumn("batch", F.lit(f"{name}-{n:06d}")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(outcomes_path)
        except PySparkException as error:
            log.error("run %s of %s failed: %s", n, landing, error)
            totals["failed"] += 1
            continue
        totals["files"] += len(paths)
    return totals
