"""What became of every file: counts, status, destination, samples, metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterlake.functions.coerce import is_candidate, is_skipped
from meterlake.functions.identifiers import supported_suffix
from meterlake.functions.text import safe_file_name
from meterlake.schemas import SKIP_REASONS
from meterlake.sources.layouts import LAYOUTS

SAMPLE_CAP = 100
# Folder per status.
DESTINATIONS = {
    "processed": "processed/",
    "processed_empty": "processed/",
    "processed_external": "processed/",
    "unmapped": "unmapped/",
    "parse_failed": "failed/",
}


def skip_counts(readings: DataFrame) -> DataFrame:
    """Skips per file and reason."""
    return (
        readings.filter(is_skipped(F.col("skip_reason")))
        .groupBy("file", "skip_reason")
        .agg(F.count("*").alias("skipped"))
    )


def by_channel(resolved: DataFrame) -> DataFrame:
    """Counts per file and channel: the small table all per-file figures come from. A row may stand for several ``cells``.

    ``dated`` tells whether some row of the channel has a stamp.

    Aggregating by channel first keeps one dominant file from meeting in one
    task before it has been reduced.
    """
    unsupported = F.col("suffix").isNotNull() & ~supported_suffix(F.col("suffix"))
    n = F.sum("cells") if "cells" in resolved.columns else F.count("*")
    raw = resolved.groupBy("file", "lookup_key", "uom", "suffix", F.col("sensor_id").isNotNull().alias("mapped"), "skip_reason").agg(
        n.alias("n"), F.count(F.when(F.col("row_start"), 1)).alias("rows"), F.max(F.col("t_start").isNotNull()).alias("dated")
    )
    # the channel is judged once per group, not once per cell
    keys = ["file", "lookup_key", "uom", F.when(unsupported, F.col("suffix")).alias("unsupported"), "mapped", "skip_reason"]
    return raw.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"), F.max("dated").alias("dated"))


def file_counts(resolved: DataFrame) -> DataFrame:
    """Per file: source rows, candidates, written, unmapped, skipped, mapped points, skip reasons."""
    return channel_totals(by_channel(resolved))


def channel_totals(channels: DataFrame) -> DataFrame:
    """``file_counts`` from the counts per channel."""
    candidate = is_candidate(F.col("skip_reason")) & F.col("unsupported").isNull()

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")

    reasons = [total(F.col("skip_reason") == r).alias(r) for r in SKIP_REASONS]
    counts = (
        channels.groupBy("file")
        .agg(
            F.sum("rows").cast("long").alias("source_row_count"),
            total(candidate).alias("candidate_row_count"),
            total(candidate & F.col("mapped")).alias("rows_written"),
            total(candidate & ~F.col("mapped")).alias("unmapped_count"),
            total(is_skipped(F.col("skip_reason"))).alias("rows_skipped"),
            F.count(F.when(candidate & F.col("mapped"), 1)).alias("mapped_points"),
            F.array_sort(F.collect_set("unsupported")).alias("unsupported_suffixes"),
            *reasons,
        )
    )
    pairs = F.array(*[F.struct(F.lit(r).alias("k"), F.col(r).alias("v")) for r in SKIP_REASONS])
    present = F.filter(pairs, lambda p: p["v"] > 0)
    return counts.withColumn("skip_reasons", F.map_from_entries(present)).drop(*SKIP_REASONS)


def ladder(default_reason: Column) -> tuple[Column, Column]:
    """Final status and reason from the counts, first rule that holds."""
    none_left = (F.col("candidate_row_count") > 0) & (F.col("unmapped_count") == F.col("candidate_row_count"))
    no_candidates = F.col("candidate_row_count") == 0
    status = (
        F.when(F.col("rows_written") > 0, F.lit("processed"))
        .when(none_left, F.lit("unmapped"))
        .otherwise(F.lit("processed_empty"))
    )
    reason = (
        F.when((F.col("rows_written") > 0) | none_left, F.lit(None).cast("string"))
        .when(no_candidates & (F.size("unsupported_suffixes") > 0), F.lit("all_unknown_suffix"))
        .when(no_candidates & (F.col("rows_skipped") > 0), F.lit("all_skipped"))
        .otherwise(default_reason)
    )
    return status, reason


def destination(status: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, folder in DESTINATIONS.items():
        out = F.when(status == name, F.lit(folder)).otherwise(out)
    return out


COUNTS = ["source_row_count", "candidate_row_count", "rows_written", "unmapped_count", "rows_skipped", "mapped_points"]


def file_outcomes(counts: DataFrame, files: DataFrame) -> DataFrame:
    """One row per file. ``files`` holds ``(file, fmt, status, reason)``; a status
    that is already set there (broken, archived, recognised as empty) stands."""
    defaults = F.lit(None).cast("string")
    for layout in LAYOUTS:
        if layout.parse is not None:
            defaults = F.when(F.col("fmt") == layout.name, F.lit(layout.reason)).otherwise(defaults)
    # Null-safe, so that no filter on the file goes down one side of the joins that made the counts.
    counted = counts.withColumnRenamed("file", "_file")
    joined = files.select("file", "fmt", F.col("status").alias("_status"), F.col("reason").alias("_reason")).join(
        counted, F.col("file").eqNullSafe(F.col("_file")), "left"
    )
    settled = F.col("_status").isNotNull()
    filled = joined.select(
        "file",
        "fmt",
        "_status",
        "_reason",
        *[F.when(settled, F.lit(0)).otherwise(F.coalesce(F.col(c), F.lit(0))).cast("long").alias(c) for c in COUNTS],
        F.when(~settled, F.col("unsupported_suffixes")).alias("_unsupported"),
        F.when(~settled, F.col("skip_reasons")).alias("_skips"),
    )
    full = filled.withColumn(
        "unsupported_suffixes", F.coalesce("_unsupported", F.array().cast("array<string>"))
    ).withColumn("skip_reasons", F.coalesce("_skips", F.create_map().cast("map<string,bigint>")))
    status, reason = ladder(defaults)
    status, reason = F.coalesce("_status", status), F.when(settled, F.col("_reason")).otherwise(reason)
    return full.select(
        "file",
        "fmt",
        status.alias("status"),
        reason.alias("reason"),
        destination(status).alias("dest"),
        *COUNTS,
        "unsupported_suffixes",
        "skip_reasons",
    )


def violations(outcomes: DataFrame) -> DataFrame:
    """Outcome rows that contradict themselves; must be empty."""
    zero = F.col("rows_written") == 0
    skips = F.aggregate(F.map_values("skip_reasons"), F.lit(0).cast("long"), lambda a, v: a + v)
    fits = (
        F.when(F.col("status") == "processed", F.col("rows_written") >= 1)
        .when(F.col("status") == "processed_empty", zero & (F.col("unmapped_count") == 0))
        .when(
            F.col("status") == "unmapped",
            zero & (F.col("candidate_row_count") > 0) & (F.col("unmapped_count") == F.col("candidate_row_count")),
        )
        .when(F.col("status") == "processed_external", zero & (F.col("candidate_row_count") == 0))
        .when(F.col("status") == "parse_failed", zero & F.col("reason").isin("parser_error", "processing_error"))
        .otherwise(F.lit(False))
    )
    ok = fits & ((skips == 0) | (F.col("rows_skipped") <= skips))
    return outcomes.filter(~F.coalesce(ok, F.lit(False)))


def skipped_cells(readings: DataFrame) -> DataFrame:
    """Every skipped cell as a row, ``file, split, row, column, t_start, value, reason``; nothing is shuffled."""
    value = F.when(F.col("skip_reason") == "unparseable_timestamp", F.col("t_start").cast("string"))
    return readings.filter(is_skipped(F.col("skip_reason"))).select(
        "file",
        "split",
        F.col("pos").alias("row"),
        "column",
        "t_start",
        F.coalesce("raw_val", value, F.lit("")).alias("value"),
        F.col("skip_reason").alias("reason"),
    )


def skip_samples(readings: DataFrame, limit: int = SAMPLE_CAP) -> DataFrame:
    """The first ``limit`` skipped cells of each file, in file order, for the audit document; ``skipped_cells`` has them all.

    The limit is also applied inside every map task, before the shuffle.
    """
    order = W.partitionBy("file").orderBy("split", "row", "t_start", "column")
    numbered = skipped_cells(readings).withColumn("n", F.row_number().over(order)).filter(F.col("n") <= limit)
    return numbered.select("file", "n", "row", "column", "value", "reason")


def sampled(records: DataFrame, counted: DataFrame, limit: int = SAMPLE_CAP) -> DataFrame:
    """The records that hold the first ``limit`` skipped cells of each file, of readings with ``cells`` counted.

    Every such row stands for a cell at least, so the cells looked for lie in the records of the first ``limit`` rows.
    """
    order = W.partitionBy("file").orderBy("split", "pos")
    rows = counted.filter(is_skipped(F.col("skip_reason"))).select("file", "split", "pos")
    first = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= limit)
    return records.join(first, ["file", "split", "pos"], "left_semi")


def audit(outcomes: DataFrame, samples: DataFrame, identifiers: DataFrame) -> DataFrame:
    """One JSON document per file that skipped, missed or did not know something."""
    per_file = samples.groupBy("file").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("n", "row", "column", "value", "reason"))),
            lambda s: F.struct(
                s["row"].alias("row"), s["column"].alias("column"), s["value"].alias("value"), s["reason"].alias("reason")
            ),
        ).alias("samples")
    )
    due = outcomes.filter(
        (F.col("rows_skipped") > 0) | (F.col("unmapped_count") > 0) | (F.size("unsupported_suffixes") > 0)
    )
    joined = due.join(per_file, "file", "left").join(identifiers, "file", "left")
    # The marker is one more list element, so samples are rendered one by one.
    listed = F.coalesce(F.transform("samples", lambda s: F.to_json(s)), F.array().cast("array<string>"))
    cut = F.col("rows_skipped") > F.size(listed)
    marker = F.to_json(F.struct(F.lit(True).alias("truncated"), F.col("rows_skipped").alias("total_skipped")))
    all_samples = F.when(cut, F.concat(listed, F.array(marker))).otherwise(listed)
    pairs = F.transform(
        F.coalesce("unmapped_identifiers", F.array().cast("array<struct<id_kind:string,lookup_key:string>>")),
        lambda i: F.array(i["id_kind"], i["lookup_key"]),
    )
    name = F.substring_index("file", "/", -1)
    head = F.to_json(
        F.struct(
            name.alias("source_file"),
            F.struct(
                "status",
                "reason",
                "source_row_count",
                "candidate_row_count",
                "rows_written",
                "rows_skipped",
                "unmapped_count",
            ).alias("outcome"),
            "skip_reasons",
            pairs.alias("unmapped_identifiers"),
            "unsupported_suffixes",
        ),
        {"ignoreNullFields": "false"},
    )
    document = F.concat(
        F.expr("left(head, length(head) - 1)"),
        F.lit(',"skipped_samples":['),
        F.array_join(F.col("all_samples"), ","),
        F.lit("]}"),
    )
    return joined.select("file", head.alias("head"), all_samples.alias("all_samples"), name.alias("name")).select(
        "file", F.concat(safe_file_name(F.col("name")), F.lit(".skipped.json")).alias("audit_name"), document.alias("value")
    )


def write_audit(documents: DataFrame, path: str, batch: str) -> None:
    """One text line per document under a folder per batch; a batch that is written again replaces its own."""
    rows = documents.select(F.lit(batch).alias("batch"), "value").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    rows.partitionBy("batch").text(path)


def run_metrics(outcomes: DataFrame) -> DataFrame:
    """Totals of a run, one row per status."""
    return outcomes.groupBy("status").agg(
        F.count("*").alias("files"),
        F.sum("mapped_points").cast("long").alias("mapped_points"),
        F.sum("candidate_row_count").cast("long").alias("candidates"),
        F.sum("unmapped_count").cast("long").alias("unmapped"),
        F.sum("rows_skipped").cast("long").alias("skipped"),
        F.sum(F.coalesce(F.try_element_at("skip_reasons", F.lit("unparseable_value")), F.lit(0)))
        .cast("long")
        .alias("malformed"),
        F.count(F.when(F.size("unsupported_suffixes") > 0, 1)).alias("files_with_unsupported"),
    )


def file_ratios(outcomes: DataFrame) -> DataFrame:
    """Unmapped and skipped shares of each file, in percent."""
    seen = F.greatest(F.col("source_row_count"), F.col("candidate_row_count") + F.col("rows_skipped"))
    return outcomes.select(
        "file",
        "status",
        F.when(F.col("candidate_row_count") > 0, 100.0 * F.col("unmapped_count") / F.col("candidate_row_count")).alias(
            "partial_mapped_ratio"
        ),
        F.when(seen > 0, 100.0 * F.col("rows_skipped") / seen).alias("rows_skipped_ratio"),
    )


def unmapped_kinds(keys: DataFrame) -> DataFrame:
    """Unmapped identifiers per file and kind, from their rows."""
    return keys.groupBy("file", F.col("id_kind").alias("kind")).agg(F.count("*").alias("identifiers"))


def load_summary(resolved: DataFrame) -> DataFrame:
    """Meters, mapped and unmapped meters, points and readings per file."""
    rows = resolved.filter(F.col("skip_reason").isNull())
    channels = rows.groupBy("file", "nmi", "lookup_key").agg(
        F.max(F.col("sensor_id").isNotNull()).alias("mapped"), F.count("*").alias("n")
    )
    meters = channels.groupBy("file", "nmi").agg(
        F.min("mapped").alias("all_mapped"),
        F.count(F.when(F.col("mapped"), 1)).alias("points"),
        F.sum(F.when(F.col("mapped"), F.col("n")).otherwise(0)).alias("n"),
    )
    return meters.groupBy("file").agg(
        F.count("*").alias("nmis_total"),
        F.count(F.when(F.col("all_mapped"), 1)).alias("nmis_mapped"),
        F.count(F.when(~F.col("all_mapped"), 1)).alias("nmis_unmapped"),
        F.sum("points").cast("long").alias("monitor_points"),
        F.sum("n").cast("long").alias("readings_total"),
    )


def channels(readings: DataFrame) -> DataFrame:
    """Meters of each file with their channels."""
    return (
        readings.filter(F.col("nmi").isNotNull())
        .select("file", "nmi", "suffix")
        .distinct()
        .groupBy("file", "nmi")
        .agg(F.array_sort(F.collect_list("suffix")).alias("channels"))
    )
