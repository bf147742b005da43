"""Which layout a file has, and whether its content lets it through."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.text import BOM, cells
from meterlake.operators import resolve, series
from meterlake.schemas import COUNTED, EACH
from meterlake.sources import nem12, nem13
from meterlake.sources.layouts import BY_NAME, LAYOUTS, NO_DEMAND_DATA

NEM_HEAD = f'^{BOM}?\\s*"?(100|200|250|300)"?\\s*,'
ENVELOPE = "^100,NEM1[23],"
QUOTED = f'^{BOM}?\\s*"200"\\s*,'
ACCUMULATION = f'^{BOM}?\\s*"?100"?\\s*,\\s*"?NEM13"?'
NEM = ("nem", "nem13")


def classify(heads: DataFrame, meter: bool = True) -> DataFrame:
    """First matching layout per file, from its name and first lines only.

    A file that starts like a meter-data envelope is ``nem`` (interval data) or
    ``nem13`` (accumulation data, by its header); whether it really holds
    readings is settled when it is parsed. ``status`` is set for files
    whose fate is clear already: archived, recognised as empty, or broken.
    """
    is_nem = F.lit(meter) & F.exists("head", lambda line: line.rlike(NEM_HEAD))
    is_nem13 = F.lit(meter) & F.exists("head", lambda line: line.rlike(ACCUMULATION))
    fmt = F.when(is_nem13, F.lit("nem13")).when(is_nem, F.lit("nem"))
    for layout in LAYOUTS:
        fmt = fmt.when(F.coalesce(layout.gate(), F.lit(False)), F.lit(layout.name))

    def per_layout(pick, kind="string"):
        out = F.lit(None).cast(kind)
        for layout in LAYOUTS:
            out = F.when(F.col("fmt") == layout.name, pick(layout)).otherwise(out)
        return out

    def broken(layout):
        # The head of a UTF-16 file is checked where its text is decoded.
        if layout.parse is None or layout.utf16:
            return F.lit(layout.status).cast("string")
        ok = F.coalesce(layout.required(F.col("header"), F.col("head")), F.lit(False))
        return F.when(~ok, F.lit("parse_failed"))

    header_line = per_layout(lambda x: F.lit(x.header_line), "int")
    found = heads.select(
        "file",
        "name",
        "head",
        F.coalesce(F.get("head", F.lit(0)), F.lit("")).rlike(ENVELOPE).alias("envelope"),
        F.exists("head", lambda line: line.rlike(QUOTED)).alias("quoted"),
        F.when(~F.col("unreadable"), fmt).alias("fmt"),
    )
    with_header = found.select(
        "*", cells(F.coalesce(F.get("head", F.coalesce(header_line, F.lit(1)) - 1), F.lit(""))).alias("header")
    )
    empty_demand = (F.col("fmt") == "demand") & F.exists("head", lambda h: F.contains(h, F.lit(NO_DEMAND_DATA)))
    judged = with_header.select(
        "*",
        F.when(F.col("fmt").isNull(), F.lit("parse_failed"))
        .when(empty_demand, F.lit("processed_empty"))
        .otherwise(per_layout(broken))
        .alias("status"),
    )
    fixed = per_layout(lambda x: F.lit(x.reason if x.status else None).cast("string"))
    reason = (
        F.when(F.col("status") == "parse_failed", F.lit("parser_error"))
        .when(F.col("fmt") == "demand", F.when(F.col("status").isNotNull(), F.lit("no_data_sentinel")))
        .otherwise(fixed)
    )
    return judged.select("file", "name", "fmt", "status", reason.alias("reason"), "envelope", "quoted")


def content_flags(name: str, lines: DataFrame) -> DataFrame:
    """Files of a layout whose body makes them fail or count as empty.

    One thin aggregate per file with partial sums in every task.
    """
    layout = BY_NAME[name]
    verdict = F.lit(None).cast("string")
    for status, check in layout.flags.items():
        verdict = F.coalesce(verdict, F.when(check(), F.lit(status)))
    reason = F.when(F.col("status") == "parse_failed", F.lit("parser_error")).otherwise(F.lit("no_data_sentinel"))
    return (
        layout.rows(lines)
        .groupBy("file")
        .agg(verdict.alias("status"))
        .filter(F.col("status").isNotNull())
        .select("file", "status", reason.alias("reason"))
    )


def read_layout(name: str, lines: DataFrame) -> DataFrame:
    """Readings of lines that all belong to layout ``name``, flagged files left out."""
    layout = BY_NAME[name]
    readings = layout.read(lines)
    if not layout.flags:
        return readings
    return readings.join(content_flags(name, lines).select("file"), "file", "left_anti")


def nem_records(name: str, lines: DataFrame, mapping: DataFrame) -> DataFrame:
    """Resolved records, days or register reads, of lines that all belong to meter-data files of one version."""
    if name == "nem13":
        return resolve.resolve(nem13.parse_lines(lines), mapping)
    return nem12.resolve_days(nem12.days_from_lines(lines), mapping)


def nem_readings(name: str, records: DataFrame, blanks: str = EACH) -> DataFrame:
    """Readings of records; ``blanks`` as for ``nem12.expand_days``.

    An accumulated quantity may cover months; valid ones become one reading per calendar day, or one row with their
    number where cells are only counted.
    """
    if name != "nem13":
        return nem12.expand_days(records, blanks)
    valid = F.col("skip_reason").isNull()
    return records.withColumn("cells", series.pieces(valid)) if blanks == COUNTED else series.split_days(records, valid)


def read_nem(name: str, lines: DataFrame, blanks: str = EACH) -> DataFrame:
    """Readings, without sensors, of lines that all belong to meter-data files of one version."""
    return nem_readings(name, nem13.parse_lines(lines) if name == "nem13" else nem12.days_from_lines(lines), blanks)


def settle_nem(files: DataFrame, channels: DataFrame) -> DataFrame:
    """Files that looked like meter data but hold no reading, by their channels: empty or not ours."""
    filled = channels.filter("dated").select("file").distinct()
    nem = files.filter(F.col("fmt").isin(*NEM) & F.col("status").isNull()).join(filled, "file", "left_anti")
    return nem.select(
        "file",
        F.when(F.col("envelope"), F.lit("processed_empty")).otherwise(F.lit("parse_failed")).alias("status"),
        F.when(F.col("envelope"), F.lit("no_data_sentinel")).otherwise(F.lit("parser_error")).alias("reason"),
    )


def late_records(lines: DataFrame) -> DataFrame:
    """``file, fmt, envelope, quoted`` of the files that hold a meter record, on whatever line.

    For files whose head suits no layout: any number of lead lines may stand above the first record.
    """
    line = F.col("line")
    found = lines.filter(line.rlike(NEM_HEAD)).groupBy("file").agg(F.max(line.rlike(ACCUMULATION)).alias("sums"), F.max(line.rlike(ENVELOPE)).alias("envelope"), F.max(line.rlike(QUOTED)).alias("quoted"))
    return found.select("file", F.when(F.col("sums"), F.lit("nem13")).otherwise(F.lit("nem")).alias("fmt"), "envelope", "quoted")


def rivals(files: DataFrame, tops: DataFrame) -> DataFrame:
    """Files that look like meter data, carry no envelope and also suit a vendor layout, as that layout, with ``meter``.

    A vendor file whose first column holds 100, 200, 250 or 300 is one. Few files are, so whether they hold a reading
    can be asked of these alone.
    """
    doubtful = files.filter(F.col("fmt").isin(*NEM) & ~F.col("envelope")).select("file", F.col("fmt").alias("meter"))
    other = classify(tops.join(doubtful, "file", "left_semi"), meter=False).filter(F.col("fmt").isNotNull())
    return other.join(doubtful, "file")
