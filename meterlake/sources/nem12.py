"""NEM12 interval files.

Two ways in, one result:

* ``read_blocks`` cuts the text at every 200 record, so a row is one channel
  block that carries its own context. No ordering, no window and no shuffle;
  blocks of one large file are spread over all its splits.
* ``days_from_lines`` takes ordered lines from anywhere (an archive, a table)
  and carries the 200 context forward in two levels: inside each split, then
  over one small row per split.

Both give *days*: one row per 300 record with its meter context and its own
400 records, which ``expand_days`` turns into one reading per interval.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions.coerce import number, skip_reason
from meterlake.functions.identifiers import lookup_key, supported_suffix, unit_or_default
from meterlake.functions.stamps import nem_stamp, slot_start, slots_per_day
from meterlake.functions.text import BOM, cells, first_cell, named
from meterlake.operators import resolve
from meterlake.schemas import CELLS, COUNTED, EACH, FILLED, IGNORED, READINGS, RESOLVED, conform

FMT = "nem12"
BLOCK_SEPARATOR = "\n200,"
# An indicator may be quoted, or have blanks around it.
KINDS = "[ \\t]*(200|300|400|900)[ \\t]*"
INDICATOR = rf'\n(?:"{KINDS}"|{KINDS})(?:,|(?=\r?\n|\z))'


def _context(fields):
    """Meter context from the cells after a 200 indicator; NULL if malformed."""
    interval = F.trim(F.get(fields, F.lit(7))).try_cast("int")
    nmi = F.get(fields, F.lit(0))
    ok = (F.size(fields) >= 8) & interval.between(1, 1440) & (F.trim(nmi) != "")
    return F.when(
        ok,
        named(
            nmi=nmi,
            suffix=F.get(fields, F.lit(3)),
            serno=F.get(fields, F.lit(5)),
            uom=F.get(fields, F.lit(6)),
            interval=interval,
        ),
    )


def read_blocks(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Days of NEM12 files, read block by block without a shuffle."""
    blocks = (
        spark.read.option("lineSep", BLOCK_SEPARATOR)
        .text(paths)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").cast("long").alias("split"),
            F.monotonically_increasing_id().alias("pos"),
            F.regexp_replace("value", f"^{BOM}", "").alias("value"),
        )
    )
    # A separator that was missed only glues blocks together: indicators get one form, then each piece is cut again.
    headed = F.col("value").rlike(r'^("[ \t]*[12]00[ \t]*"|[ \t]*[12]00[ \t]*),')
    text = F.regexp_replace(F.concat(F.when(headed, F.lit("\n")).otherwise(F.lit(BLOCK_SEPARATOR)), "value"), INDICATOR, "\n$1$2,")
    blocks = blocks.select("file", "split", "pos", F.explode(F.split(text, BLOCK_SEPARATOR)).alias("block"))
    return days_from_blocks(blocks)


def days_from_blocks(blocks: DataFrame) -> DataFrame:
    """Days of ``(file, split, pos, block)``; a block starts after ``200,``. Days after a 900 have no meter."""
    blocks = blocks.select("file", "split", "pos", F.posexplode(F.split("block", "\n900,")).alias("ended", "block"))
    first_line = F.regexp_replace(F.substring_index("block", "\n", 1), "\r$", "")
    parts = F.split("block", "\n300,")
    fields = F.when(F.col("ended") == 0, cells(first_line)).otherwise(F.array().cast("array<string>"))
    opened = blocks.select("file", "split", "pos", fields.alias("fields"), parts.alias("parts"))
    chunks = opened.select(
        "file",
        "split",
        "pos",
        _context("fields").alias("ctx"),
        F.explode_outer(F.slice("parts", F.lit(2), F.greatest(F.size("parts") - 1, F.lit(0)))).alias("chunk"),
    ).filter(F.col("chunk").isNotNull())
    events = F.col("parts")
    return chunks.select("*", F.split("chunk", "\n400,").alias("parts")).select(
        "file",
        "split",
        "pos",
        "ctx",
        F.regexp_replace(F.substring_index("chunk", "\n", 1), "\r$", "").alias("day"),
        F.transform(
            F.slice(events, F.lit(2), F.greatest(F.size(events) - 1, F.lit(0))),
            lambda e: F.regexp_replace(F.substring_index(e, "\n", 1), "\r$", ""),
        ).alias("events"),
    )


def days_from_lines(lines: DataFrame) -> DataFrame:
    """Days of ordered lines, with the context carried across splits."""
    rec = F.trim(F.regexp_replace(first_cell(F.col("line")), '^"|"$', "")).try_cast("int")
    rest = F.substring(F.col("line"), F.instr("line", ",") + 1, F.length("line"))
    in_split = W.partitionBy("file", "split").orderBy("pos")
    opens = F.col("rec").isin(200, 300, 900)
    # A 900 or a malformed 200 is a context too: the one without a meter.
    ctx = F.when(F.col("rec").isin(200, 900), F.struct(_context("fields").alias("c")))
    marked = (
        lines.select("file", "split", "pos", rec.alias("rec"), rest.alias("body"))
        .filter(F.col("rec").isin(200, 300, 400, 900))
        .select("*", F.when(F.col("rec") == 200, cells(F.col("body"))).alias("fields"))
        .select("file", "split", "pos", "rec", ctx.alias("ctx"), F.when(F.col("rec").isin(300, 400), F.col("body")).alias("body"))
        .select(
            "file",
            "split",
            "pos",
            "rec",
            F.last("ctx", ignorenulls=True).over(in_split).alias("ctx"),
            F.count(F.when(opens, 1)).over(in_split).alias("seq"),
            "body",
        )
    )
    # One group per opening record; already partitioned by (file, split).
    groups = marked.groupBy("file", "split", "seq").agg(
        F.max(F.when(F.col("rec") == 300, F.col("pos"))).alias("pos"),
        F.max(F.when(F.col("rec") == 300, F.col("body"))).alias("day"),
        F.max(F.struct("pos", "ctx"))["ctx"].alias("ctx"),
        F.transform(
            F.array_sort(F.collect_list(F.when(F.col("rec") == 400, F.struct("pos", "body")))), lambda e: e["body"]
        ).alias("events"),
    )
    per_split = groups.groupBy("file", "split").agg(
        F.max("seq").alias("last_seq"),
        F.max(F.struct("seq", "ctx"))["ctx"].alias("ctx_out"),
        F.max(F.when(F.col("seq") == 0, F.col("events"))).alias("head_events"),
    )
    # From here on one small row per split. 400 records cut off from their 300
    # by a split boundary belong to the last opening record before it.
    in_file = W.partitionBy("file").orderBy("split")
    before = in_file.rowsBetween(W.unboundedPreceding, -1)
    owned = per_split.select(
        "*",
        F.last("ctx_out", ignorenulls=True).over(before).alias("ctx_in"),
        F.count(F.when(F.col("last_seq") > 0, 1)).over(before).alias("owner"),
    )
    same_owner = W.partitionBy("file", "owner").orderBy("split").rowsBetween(
        W.unboundedPreceding, W.unboundedFollowing
    )
    chained = owned.withColumn("heads", F.flatten(F.collect_list("head_events").over(same_owner)))
    context = chained.select(F.col("file").alias("_file"), F.col("split").alias("_split"), "last_seq", "ctx_in", F.lead("heads").over(in_file).alias("late"))
    is_last = (F.col("seq") == F.col("last_seq")) & (F.size("late") > 0)
    # Null-safe: plain equality would have the lines of one side read through a filter of its own, and so made twice.
    same = F.col("file").eqNullSafe(F.col("_file")) & F.col("split").eqNullSafe(F.col("_split"))
    return (
        groups.filter(F.col("day").isNotNull())
        .join(context, same, "left")
        .select(
            "file",
            "split",
            "pos",
            F.coalesce("ctx", "ctx_in")["c"].alias("ctx"),
            "day",
            F.when(is_last, F.concat("events", "late")).otherwise(F.col("events")).alias("events"),
        )
    )


def overlay_events(events, slots):
    """Valid 400 records as structs, in file order."""
    parsed = F.transform(
        F.transform(events, cells),
        lambda c: named(
            first=F.trim(F.get(c, F.lit(0))).try_cast("int"),
            last=F.trim(F.get(c, F.lit(1))).try_cast("int"),
            quality=F.coalesce(F.get(c, F.lit(2)), F.lit("")),
            code=F.coalesce(F.get(c, F.lit(3)), F.lit("")),
            desc=F.coalesce(F.get(c, F.lit(4)), F.lit("")),
        ),
    )
    return F.when(
        F.size(events) > 0,
        F.filter(parsed, lambda e: (e["first"] >= 1) & (e["first"] <= e["last"]) & (e["last"] <= slots)),
    )


def event_places(events, slots):
    """For every slot the place of the last event that covers it, if any; NULL without events."""

    def last(number):
        return F.array_max(F.transform(events, lambda e, place: F.when((e["first"] <= number) & (e["last"] >= number), place)))

    return F.when(events.isNotNull(), F.transform(F.sequence(F.lit(1), slots), last))


def resolve_days(days: DataFrame, mapping: DataFrame) -> DataFrame:
    """Days with the ``sensor_id`` that ``resolve.resolve`` gives their readings; a map too large to broadcast shuffles days, not slots."""
    meter = F.col("ctx")["nmi"]
    known = days.select("*", meter.alias("nmi"), lookup_key(meter, F.col("ctx")["suffix"]).alias("lookup_key"))
    return resolve.resolve(known, mapping).drop("nmi", "lookup_key")


def expand_days(days: DataFrame, blanks: str = EACH) -> DataFrame:
    """One reading per interval of every accepted day, one marker row per rejected day.

    Whatever is the same for a whole day is worked out before the day is spread
    over its slots; resolved days give resolved readings. Most days are largely
    empty, so who does not need every empty cell says so: ``COUNTED`` gives the
    empty cells of a day as one row, over the time from the first to the last of
    them, and the number of cells of every row in ``cells``; ``FILLED`` leaves
    out empty cells and rejected days.
    """
    sensor = ["sensor_id"] if "sensor_id" in days.columns else []
    row, ctx, ok = F.col("row"), F.col("ctx"), F.col("reject").isNull()
    n = slots_per_day(ctx["interval"])
    reject = (
        F.when(ctx.isNull(), F.lit("row_anchor_failure"))
        .when(F.size(row) < n + 2, F.lit("row_shape_mismatch"))
        .when(F.col("date").isNull(), F.lit("unparseable_timestamp"))
    )
    # Cut by a generator, or Spark would cut the day again for every filter that it moves below.
    shaped = (
        days.withColumn("row", F.explode_outer(F.array(cells(F.col("day")))))
        .withColumn("date", nem_stamp(F.get(row, F.lit(0))))
        .withColumn("reject", reject)
    )
    spread = shaped.select(
        "file",
        "split",
        "pos",
        *sensor,
        F.concat(ctx["suffix"], F.lit("_"), F.coalesce(F.nullif(ctx["uom"], F.lit("")), F.lit("kWh"))).alias("column"),
        ctx["nmi"].alias("nmi"),
        ctx["suffix"].alias("suffix"),
        unit_or_default(ctx["uom"]).alias("uom"),
        lookup_key(ctx["nmi"], ctx["suffix"]).alias("lookup_key"),
        ctx["serno"].alias("serno"),
        ctx["interval"].alias("minutes"),
        # A channel outside the supported set yields no candidates and no skips.
        F.when(~ok, F.col("reject")).when(~supported_suffix(ctx["suffix"]), F.lit(IGNORED)).alias("day_reason"),
        F.when(ok, F.col("date")).alias("date"),
        F.when(ok, F.get(row, n + 1)).alias("quality"),
        F.when(ok, F.coalesce(F.get(row, n + 2), F.lit(""))).alias("code"),
        F.when(ok, F.coalesce(F.get(row, n + 3), F.lit(""))).alias("desc"),
        F.when(ok, overlay_events(F.col("events"), n)).alias("events"),
        F.when(ok, F.slice(row, F.lit(2), n)).otherwise(F.array(F.lit(None).cast("string"))).alias("values"),
    )
    if blanks == EACH:
        # By day: a lambda beside the slots would have the rest of the day copied for every slot.
        places = event_places(F.col("events"), F.size("values"))
        spread = spread.select(*spread.columns[:-1], places.alias("places"), "values")
    # Outer, or Spark would test the never empty array on a second copy of its expressions.
    kept = spread.columns[:-1]
    if blanks == COUNTED:
        empty = F.size("values") - F.size(F.array_remove("values", ""))
        first = F.array_position("values", F.lit("")).cast("int") - 1
        last = F.size("values") - F.array_position(F.reverse("values"), F.lit("")).cast("int")
        spread = spread.select(*kept, empty.alias("empty"), first.alias("first"), last.alias("last"), "values")
        kept = spread.columns[:-1]
    slots = spread.select(*kept, F.posexplode_outer("values").alias("slot", "raw_val"))
    until = F.col("slot")
    if blanks == FILLED:
        slots = slots.filter(F.col("raw_val") != "")
    if blanks == COUNTED:
        blank = F.coalesce(F.col("raw_val") == "", F.lit(False))
        slots = slots.filter(~blank | (F.col("slot") == F.col("first")))
        until = F.when(blank, F.col("last")).otherwise(F.col("slot"))
        slots = slots.withColumn("cells", F.when(blank, F.col("empty")).otherwise(F.lit(1)).cast("long"))
    number_of = F.col("slot") + 1
    if blanks == EACH:
        event = F.get("events", F.get("places", F.col("slot")))
    else:
        event = F.when(
            F.col("events").isNotNull(),
            F.try_element_at(
                F.filter("events", lambda e: (e["first"] <= number_of) & (e["last"] >= number_of)), F.lit(-1)
            ),
        )
    placed = slots.select(
        "*",
        event.alias("event"),
        slot_start(F.col("date"), F.col("slot"), F.col("minutes")).alias("t_start"),
        slot_start(F.col("date"), until + 1, F.col("minutes")).alias("t_end"),
        number(F.col("raw_val")).alias("val"),
    )
    reason = F.coalesce("day_reason", skip_reason(F.col("raw_val"), F.col("t_start"), val=F.col("val")))
    return conform(
        placed.select(
            *[c for c in placed.columns if c not in ("quality", "event", "events", "places")],
            F.lit(FMT).alias("fmt"),
            F.lit(False).alias("row_start"),
            F.lit("nem12_nmi").alias("id_kind"),
            F.coalesce(F.col("event")["quality"], F.col("quality")).alias("quality"),
            F.coalesce(F.col("event")["code"], F.col("code")).alias("event_code"),
            F.coalesce(F.col("event")["desc"], F.col("desc")).alias("event_desc"),
            reason.alias("skip_reason"),
        ),
        T.StructType([*(RESOLVED if sensor else READINGS).fields, *([CELLS] if blanks == COUNTED else [])]),
    )


def read_nem12(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return expand_days(read_blocks(spark, paths))


def parse_lines(lines: DataFrame, mapping: DataFrame | None = None, blanks: str = EACH) -> DataFrame:
    """Readings of ordered lines, resolved if there is a ``mapping``; ``blanks`` as for ``expand_days``."""
    days = days_from_lines(lines)
    return expand_days(days if mapping is None else resolve_days(days, mapping), blanks)


def strict(readings: DataFrame) -> DataFrame:
    """Readings of files without any rejected day; one bad record fails its file."""
    bad = readings.filter(F.col("t_start").isNull()).select("file").distinct()
    return readings.join(bad, "file", "left_anti")
