"""Vendor CSV layouts: one ``Layout`` each, in the order they are tried.

A layout turns table rows (``file, split, pos, header, head, row``) into one
reading row per cell. Column positions come from each file's own header, so
files of one layout with different columns share a plan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterlake.functions import identifiers as ids
from meterlake.functions import stamps
from meterlake.functions.coerce import ignore_blank, is_blank, number
from meterlake.functions.text import cell, cells, first_cell, has_columns, has_content, named
from meterlake.schemas import IGNORED, conform
from meterlake.sources.lines import place, table_rows

ROW, HEADER = "row", "header"

# Report column, key suffix, and whether its unit is usage or spend.
BILLING_FIELDS = [
    ("Peak", "billing-peak-usage", "usage"),
    ("OffPeak", "billing-off-peak-usage", "usage"),
    ("Shoulder", "billing-shoulder-usage", "usage"),
    ("Total Usage", "billing-total-usage", "usage"),
    ("Total GreenPower", "billing-total-greenpower-usage", "usage"),
    ("Estimated Peak", "billing-estimated-peak-usage", "usage"),
    ("Estimated OffPeak", "billing-estimated-off-peak-usage", "usage"),
    ("Estimated Shoulder", "billing-estimated-shoulder-usage", "usage"),
    ("Total Estimated Usage", "billing-total-estimated-usage", "usage"),
    ("Total Estimated GreenPower", "billing-total-estimated-greenpower-usage", "usage"),
    ("Energy Charge", "billing-energy-charge", "spend"),
    ("Total Network Charge", "billing-network-charge", "spend"),
    ("Environmental Charge", "billing-environmental-charge", "spend"),
    ("Metering Charge", "billing-metering-charge", "spend"),
    ("Other Charge", "billing-other-charge", "spend"),
    ("Total Spend", "billing-total-spend", "spend"),
    ("GreenPower Spend", "billing-greenpower-spend", "spend"),
    ("Estimated Energy Charge", "billing-estimated-energy-charge", "spend"),
    ("Estimated Network Charge", "billing-estimated-network-charge", "spend"),
    ("Estimated Environmental Charge", "billing-estimated-environmental-charge", "spend"),
    ("Estimated Metering Charge", "billing-estimated-metering-charge", "spend"),
    ("Estimated Other Charge", "billing-estimated-other-charge", "spend"),
    ("Total Estimated Spend", "billing-total-estimated-spend", "spend"),
]
# Report column, key suffix, unit.
DEMAND_FIELDS = [("kW", "kw", "kw"), ("kVa", "kva", "kva"), ("Power Factor", "pf", "")]
# Report column and channel.
INTERVAL_FIELDS = [("Usage", "E1"), ("Generation", "B1")]
# Inverter status text to code.
STATUS_CODES = {
    "Off": 1,
    "In Operation, No Feed In": 2,
    "Run Up Phase": 3,
    "Normal Operation": 4,
    "Power Reduction": 5,
    "Switch Off Phase": 6,
    "Error Exists": 7,
    "Standby": 8,
    "No Fronius Solar Net Comm": 9,
    "No Comm with Inverter": 10,
    "Overcurrent detected in Fronius Solar Net": 11,
    "Inverter Update being Performed": 12,
    "AFCI Event": 13,
}
# Texts that mark a file without data, and the marker of a logger file.
NO_INTERVAL_DATA = "No data is available"
NO_DEMAND_DATA = "No data found"
COMX_MARKER = "ComX510_Green_Square"

# Columns that a layout needs.
WATER_COLUMNS = ["Serial_No", "Interval_Start", "Interval_End", "Consumption", "Consumption Unit"]
ELECTRICITY_COLUMNS = ["Serial_No", "Interval_Start", "Interval_End", "kWh"]
BULK_COLUMNS = ["Serial_No", "Date_Time", "kL"]


@dataclass(frozen=True)
class Layout:
    """How to recognise, check and read one layout."""

    name: str
    gate: Callable[[], Column]
    header_line: int | None = None
    parse: Callable[[DataFrame], DataFrame] | None = None
    required: Callable[[Column, Column], Column] = lambda header, head: F.lit(True)
    status: str | None = None
    reason: str | None = None
    flags: dict[str, Callable[[], Column]] = field(default_factory=dict)
    utf16: bool = False
    keep_blank_lines: bool = False
    names: tuple[str, ...] = ()
    """Columns that are looked up in the header once per file."""

    def rows(self, lines: DataFrame) -> DataFrame:
        return table_rows(lines, self.header_line, self.keep_blank_lines, self.names)

    def read(self, lines: DataFrame) -> DataFrame:
        return self.parse(self.rows(lines))


def _field(name: str) -> Column:
    return cell(ROW, HEADER, name)


def _place(name: str) -> Column:
    return F.col(f"`{place(name)}`")


def _at(name: str) -> Column:
    """The cell under one of the layout's ``names``."""
    return F.get(ROW, _place(name))


def _value(column: str, raw: Column, present: Column | None = None, **extra: Column) -> Column:
    """One cell of a row before the unpivot."""
    nothing = F.lit(None).cast("string")
    return named(
        column=F.lit(column),
        raw=raw,
        present=F.lit(True) if present is None else present,
        suffix=extra.get("suffix", nothing),
        uom=extra.get("uom", nothing),
        key=extra.get("key", nothing),
    )


def _judged(flat: DataFrame, na_texts: bool) -> DataFrame:
    """Adds what every later rule asks of a cell, once: its number, and whether it is blank."""
    return flat.select("*", number(F.col("raw")).alias("num"), is_blank(F.col("raw"), na_texts).alias("blank"))


def _unpivot(
    rows: DataFrame,
    fmt: str,
    nmi: Column,
    ts: Column,
    values: list[Column],
    na_texts: bool = True,
    of_cells: dict[str, Callable[[Column], Column]] | None = None,
    **more: Column,
) -> DataFrame:
    """One row per value cell present in the header; ``cell_no`` 0 leads its source row."""
    wide = rows.select(
        "file",
        "split",
        "pos",
        nmi.alias("nmi"),
        ts.alias("t_start"),
        *[c.alias(k) for k, c in more.items()],
        F.filter(F.array(*values), lambda v: v["present"]).alias("v"),
    )
    if of_cells:
        wide = wide.select("*", *[f(F.col("v")).alias(k) for k, f in of_cells.items()])
    flat = wide.select(F.lit(fmt).alias("fmt"), *[c for c in wide.columns if c != "v"], F.posexplode_outer("v").alias("cell_no", "v"))
    # Outer, or Spark would test the array for emptiness on a second copy of all its expressions.
    flat = flat.filter(F.col("cell_no").isNotNull())
    return _judged(flat.select(*[c for c in flat.columns if c != "v"], "v.column", "v.raw", "v.suffix", "v.uom", "v.key"), na_texts)


def _finish(df: DataFrame, reason: Column, val: Column | None = None, id_kind: str = "nem12_nmi") -> DataFrame:
    rest = [c for c in df.columns if c not in ("uom", "key", "raw", "num", "blank", "cell_no")]
    return conform(
        df.select(
            *rest,
            (F.col("cell_no") == 0).alias("row_start"),
            F.lower("uom").alias("uom"),
            F.coalesce(F.col("key"), ids.lookup_key(F.col("nmi"), F.col("suffix"))).alias("lookup_key"),
            F.lit(id_kind).alias("id_kind"),
            F.col("raw").alias("raw_val"),
            (F.col("num") if val is None else val).alias("val"),
            reason.alias("skip_reason"),
        )
    )


def _cell_reason() -> Column:
    return (
        F.when(F.col("blank"), F.lit("blank_value"))
        .when(F.col("t_start").isNull(), F.lit("unparseable_timestamp"))
        .when(F.col("num").isNull(), F.lit("unparseable_value"))
    )


def _bad_stamp() -> Column:
    return F.when(F.col("t_start").isNull(), F.lit("unparseable_timestamp"))


def _per_row(row_reason: Column, cell_reason: Column) -> Column:
    """A row-level reason is counted once, on the row's first cell."""
    return F.when(row_reason.isNull(), cell_reason).when(F.col("cell_no") == 0, row_reason).otherwise(F.lit(IGNORED))


# ---- interval usage -------------------------------------------------------


def parse_interval(rows: DataFrame) -> DataFrame:
    ts = stamps.parse_any(F.concat_ws(" ", _at("Date"), _at("Start Time")), stamps.INTERVAL_PATTERNS)
    values = [
        _value(c, _at(c), _place(c) >= 0, suffix=F.lit(s), uom=F.lit("kWh")) for c, s in INTERVAL_FIELDS
    ]
    flat = _unpivot(
        rows,
        "interval",
        ids.prefixed(_at("Identifier"), ids.OPTIMA),
        ts,
        values,
        of_cells={
            "usable": lambda v: F.exists(v, lambda c: number(c["raw"]).isNotNull()),
            "first_blank": lambda v: F.array_position(F.transform(v, lambda c: is_blank(c["raw"], True)), True),
        },
    )
    # A row without any usable value counts one blank, not one per column.
    repeated = F.col("blank") & ~F.col("usable") & (F.col("cell_no") + 1 != F.col("first_blank"))
    cell_reason = F.when(repeated, F.lit(IGNORED)).otherwise(_cell_reason())
    return _finish(flat, _per_row(_bad_stamp(), cell_reason))


# ---- demand profile and usage-and-spend report -----------------------------


def row_shape(required: list[str]) -> Column:
    """Why a ragged row is skipped: too many cells, no identifier cell, or another required cell missing."""
    # a row ends before the last of its required columns, or a column is absent
    missing = F.greatest(*map(_place, required)) >= F.size(ROW)
    absent = F.least(*map(_place, required)) < 0
    return (
        F.when(F.size(ROW) > F.size(HEADER), F.lit("row_shape_mismatch"))
        .when(_at("Identifier").isNull(), F.lit("row_anchor_failure"))
        .when(missing | absent, F.lit("row_shape_mismatch"))
    )


def _report(rows: DataFrame, fmt: str, required: list[str], ts: Column, values: list[Column], ident: Column) -> DataFrame:
    """Rows of the two reports: the same row rules, blank cells are normal."""
    flat = _unpivot(
        rows.filter(has_content(ROW)), fmt, ident, ts, values, na_texts=False, row_shape=row_shape(required)
    )
    row_reason = F.coalesce(
        F.col("row_shape"), F.when(F.col("nmi") == "", F.lit("row_anchor_failure")), _bad_stamp()
    )
    return _finish(flat, _per_row(row_reason, ignore_blank(_cell_reason())), id_kind="nmi")


DEMAND_COLUMNS = ["Identifier", "ReadingDateTime", *[c for c, _, _ in DEMAND_FIELDS]]
BILLING_COLUMNS = ["Identifier", "Date", *[c for c, _, _ in BILLING_FIELDS]]
BILLING_UNITS = ["Usage Measurement Unit", "Spend Currency"]
INTERVAL_COLUMNS = ["Identifier", "Date", "Start Time", *[c for c, _ in INTERVAL_FIELDS]]


def parse_demand(rows: DataFrame) -> DataFrame:
    ident = F.trim(_at("Identifier"))
    ts = stamps.parse_any(_at("ReadingDateTime"), stamps.DEMAND_PATTERNS)
    values = [
        _value(c, F.trim(_at(c)), uom=F.lit(u), key=F.concat(F.lit(ids.OPTIMA), ident, F.lit(f"-demand-{s}")))
        for c, s, u in DEMAND_FIELDS
    ]
    return _report(rows, "demand", DEMAND_COLUMNS, ts, values, ident)


def parse_billing(rows: DataFrame) -> DataFrame:
    known = rows.select(
        "*",
        F.trim(_at("Identifier")).alias("ident"),
        ids.unit_or_default(F.trim(_at("Usage Measurement Unit")), "kWh").alias("usage"),
        ids.unit_or_default(F.trim(_at("Spend Currency")), "AUD").alias("spend"),
    )
    ident = F.col("ident")
    values = [
        _value(c, F.trim(_at(c)), uom=F.col(ids.billing_unit_source(s)), key=F.concat(ident, F.lit(f"-{s}")))
        for c, s, _ in BILLING_FIELDS
    ]
    return _report(known, "billing", BILLING_COLUMNS, stamps.billing_month(_at("Date")), values, ident)


# ---- one meter per row: water, electricity, bulk water, logger --------------


def _tall(rows: DataFrame, fmt: str, ident: Column, stamp: Column, column: str, uom: Column, **more: Column):
    values = [_value(column, _field(column), suffix=F.lit("E1"), uom=uom)]
    flat = _unpivot(rows, fmt, ident, stamp, values, **more)
    return _finish(flat, _per_row(_bad_stamp(), _cell_reason()))


def _iso(name: str) -> Column:
    return stamps.parse_any(_field(name), stamps.ISO_PATTERNS)


def _serial() -> Column:
    return ids.prefixed(_field("Serial_No"), ids.ENVIZI)


def first_units(readings: DataFrame) -> DataFrame:
    """Per file and meter: the unit of its first candidate row, and how many units it has."""
    valid = readings.filter(F.col("skip_reason").isNull())
    return valid.groupBy("file", "nmi").agg(
        F.min_by("uom", F.struct("split", "pos")).alias("first_unit"),
        F.count_distinct("uom").alias("units"),
    )


def water_cells(rows: DataFrame) -> DataFrame:
    """Water readings with the unit each row names."""
    return _tall(
        rows, "envizi_water", _serial(), _iso("Interval_Start"), "Consumption", _field("Consumption Unit"),
        t_end=_iso("Interval_End"),
    )


def parse_water(rows: DataFrame) -> DataFrame:
    """The first unit seen for a meter in a file names the unit of all its rows."""
    tall = water_cells(rows)
    units = first_units(tall).select("file", "nmi", "first_unit")
    joined = tall.join(units, ["file", "nmi"], "left")
    return conform(joined.withColumn("uom", F.coalesce("first_unit", "uom")))


def parse_electricity(rows: DataFrame) -> DataFrame:
    return _tall(
        rows, "envizi_electricity", _serial(), _iso("Interval_Start"), "kWh", F.lit("kWh"), t_end=_iso("Interval_End")
    )


def parse_bulk_water(rows: DataFrame) -> DataFrame:
    return _tall(rows, "envizi_bulk_water", _serial(), _iso("Date_Time"), "kL", F.lit("kL"))


def parse_comx(rows: DataFrame) -> DataFrame:
    """Energy in Wh or kWh; the value is judged before the timestamp here."""
    site = F.get(cells(F.coalesce(F.get("head", F.lit(1)), F.lit(""))), F.lit(4))
    in_wh = F.array_contains(HEADER, "Active energy (Wh)")
    raw = F.when(in_wh, _field("Active energy (Wh)")).otherwise(_field("Active energy (kWh)"))
    values = [_value("Active energy", raw, suffix=F.lit("E1"), uom=F.lit("kWh"))]
    flat = _unpivot(
        rows,
        "comx",
        ids.prefixed(ids.without_spaces(site), ids.COMX),
        stamps.parse_any(_field("Local Time Stamp"), stamps.LOGGER_PATTERNS),
        values,
        in_wh=in_wh,
    )
    reason = (
        F.when(F.col("blank"), F.lit("blank_value"))
        .when(F.col("num").isNull(), F.lit("unparseable_value"))
        .when(F.col("t_start").isNull(), F.lit("unparseable_timestamp"))
    )
    val = F.when(F.col("in_wh"), ids.wh_to_kwh(F.col("num"))).otherwise(F.col("num"))
    return _finish(flat, reason, val)


# ---- one meter per column ---------------------------------------------------


def melt(rows: DataFrame, fmt: str, ts: Column, wanted: Callable[[Column], Column], nmi: Callable[[Column], Column]):
    """Every cell under a wanted header, whatever columns the file has."""
    paired = F.transform(
        HEADER,
        lambda h, i: F.struct(i.alias("at"), h.alias("column"), F.get(ROW, i).alias("raw")),
    )
    wide = rows.select(
        "file",
        "split",
        "pos",
        ts.alias("t_start"),
        F.filter(paired, lambda c: wanted(c["column"])).alias("cells_of_row"),
    )
    flat = wide.select(
        F.lit(fmt).alias("fmt"), "file", "split", "pos", "t_start", F.posexplode_outer("cells_of_row").alias("cell_no", "c")
    ).filter(F.col("cell_no").isNotNull())
    return _judged(
        flat.select(
            *[c for c in flat.columns if c != "c"],
            "c.at",
            "c.column",
            "c.raw",
            nmi(F.col("c")["column"]).alias("nmi"),
            F.lit("E1").alias("suffix"),
            F.lit("kWh").alias("uom"),
            F.lit(None).cast("string").alias("key"),
        ),
        na_texts=True,
    )


def drop_zero_days(df: DataFrame, keys: list[str], val: Column) -> Column:
    """Whether the meter's day sums to zero; the groups are single meter days."""
    day = W.partitionBy(*keys, F.to_date("t_start"))
    return F.coalesce(F.sum(val).over(day), F.lit(0.0)) == 0


def parse_wide_kwh(rows: DataFrame) -> DataFrame:
    ts = stamps.parse_any(F.concat_ws(" ", _field("Date"), _field("Start Time")), stamps.INTERVAL_PATTERNS)
    flat = melt(
        rows,
        "wide_kwh",
        ts,
        lambda h: F.contains(h, F.lit("kWh")),
        lambda h: ids.prefixed(ids.before_space(h), ids.OPTIMA),
    )
    marked = flat.withColumn("zero_day", drop_zero_days(flat, ["file", "at"], F.col("num")))
    cell_reason = ignore_blank(_cell_reason())
    quiet = F.when(cell_reason.isNull() & F.col("zero_day"), F.lit(IGNORED)).otherwise(cell_reason)
    return _finish(marked, _per_row(_bad_stamp(), quiet))


def column_kinds(flat: DataFrame) -> DataFrame:
    """Per file and column: is it empty, and do at least half of its values read as numbers?"""
    filled = F.count(F.when(~F.col("blank"), 1))
    numeric = F.count(F.when(~F.col("blank"), F.col("num")))
    return (
        flat.filter(F.col("t_start").isNotNull())
        .groupBy("file", "at")
        .agg(filled.alias("filled"), numeric.alias("numeric"))
        .select("file", "at", "filled", (F.col("numeric") >= F.col("filled") * 0.5).alias("is_numeric"))
    )


def status_code(text: Column) -> Column:
    pairs = [F.lit(x) for kv in STATUS_CODES.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), text).cast("double")


def solar_stamp(text: Column) -> Column:
    return stamps.parse_any(F.regexp_replace(text, r"\s+AEST$", ""), stamps.SOLAR_PATTERNS)


def parse_solar(rows: DataFrame) -> DataFrame:
    flat = melt(rows, "solar", solar_stamp(_field("timestamp")), lambda h: h.startswith("p:"), ids.before_unit)
    kinds = column_kinds(flat)
    code = status_code(F.col("raw"))
    joined = flat.drop("uom").join(kinds, ["file", "at"], "left").select(
        "*", F.when(F.col("is_numeric"), F.lit("kWh")).otherwise(F.lit("mode")).alias("uom"),
        F.when(~F.col("is_numeric"), code).alias("code"),
    )
    reason = (
        F.when(F.coalesce(F.col("filled"), F.lit(0)) == 0, F.lit(IGNORED))
        .when(F.col("is_numeric"), ignore_blank(_cell_reason()))
        .when(F.col("code").isNull(), F.lit(IGNORED))
    )
    val = F.when(F.col("is_numeric"), F.col("num")).otherwise(F.col("code"))
    return _finish(joined, _per_row(_bad_stamp(), reason), val)


# ---- the registry -----------------------------------------------------------


def _line(n: int) -> Column:
    return F.coalesce(F.get("head", F.lit(n - 1)), F.lit(""))


def _all_in(line: Column, tokens: list[str]) -> Column:
    hits = [F.contains(line, F.lit(t)) for t in tokens]
    out = hits[0]
    for h in hits[1:]:
        out = out & h
    return out


def _not_generation() -> Column:
    return ~F.contains("file", F.lit("OptimaGenerationData"))


def _named(text: str) -> Column:
    return F.contains("name", F.lit(text))


def _needs(columns: list[str]):
    return lambda header, head: has_columns(header, columns)


def _comx_ok(header: Column, head: Column) -> Column:
    site = F.get(cells(F.coalesce(F.get(head, F.lit(1)), F.lit(""))), F.lit(4))
    energy = F.array_contains(header, "Active energy (Wh)") | F.array_contains(header, "Active energy (kWh)")
    return energy & F.array_contains(header, "Local Time Stamp") & (F.trim(F.coalesce(site, F.lit(""))) != "")


def _interval_ok(header: Column, head: Column) -> Column:
    return F.array_contains(header, "Usage") | F.array_contains(header, "Generation")


def _sentinel_row() -> Column:
    """The only cell with content is the first and says there is no data."""
    others = F.filter(ROW, lambda c, i: (i != F.coalesce(F.array_position(HEADER, "BuyerShortName") - 1, F.lit(-1))) & (F.trim(c) != ""))
    return (F.trim(_field("BuyerShortName")) == NO_INTERVAL_DATA) & (F.size(others) == 0)


def _interval_empty() -> Column:
    return (F.count("*") == 1) & F.max(F.coalesce(_sentinel_row(), F.lit(False)))


def _ragged() -> Column:
    return F.max(F.size(ROW) > F.size(HEADER))


def _bad_zone() -> Column:
    zone = F.regexp_extract(F.coalesce(_field("timestamp"), F.lit("")), r"\s+([A-Z]{3,4})$", 1)
    return F.max(~zone.isin("", "AEST") | (F.size(ROW) > F.size(HEADER))) | ~F.max(~is_blank(_field("timestamp"), True))


def _demand_empty() -> Column:
    return F.max(F.exists(ROW, lambda c: F.contains(c, F.lit(NO_DEMAND_DATA))))


FAILED, EMPTY = "parse_failed", "processed_empty"

LAYOUTS: list[Layout] = [
    Layout(
        "synergy_no_data",
        lambda: F.col("name").startswith("Meter_Data_WA (AU)_Electricity_") & (F.trim(_line(1)) == "Unnamed: 0,NMI,Unnamed: 2"),
        status=EMPTY,
        reason="no_data_sentinel",
    ),
    Layout(
        "solar",
        lambda: _named("RACV_Noosa_Solar"),
        1,
        parse_solar,
        lambda header, head: F.get(header, F.lit(0)) == "timestamp",
        flags={FAILED: _bad_zone},
        reason="all_blank",
    ),
    Layout(
        "envizi_water",
        lambda: _not_generation() & ~F.col("has_nul") & _all_in(_line(1), WATER_COLUMNS),
        1,
        parse_water,
        _needs(WATER_COLUMNS),
        flags={FAILED: _ragged},
        reason="all_blank",
    ),
    Layout(
        "envizi_electricity",
        lambda: _not_generation() & ~F.col("has_nul") & _all_in(_line(1), ELECTRICITY_COLUMNS),
        1,
        parse_electricity,
        _needs(ELECTRICITY_COLUMNS),
        flags={FAILED: _ragged},
        reason="all_blank",
    ),
    Layout(
        "wide_kwh",
        lambda: _not_generation() & _all_in(_line(3), ["Date", "Start Time", "kWh"]),
        3,
        parse_wide_kwh,
        lambda header, head: has_columns(header, ["Date", "Start Time"])
        & F.exists(header, lambda h: F.contains(h, F.lit("kWh"))),
        flags={FAILED: _ragged},
        reason="all_zero_valid",
    ),
    Layout(
        "archived_billing",
        lambda: _not_generation() & _named("RACV-Usage and Spend Report"),
        status="processed_external",
        reason="external_archive",
    ),
    Layout(
        "billing",
        lambda: _named("Bunnings-Usage and Spend Report"),
        8,
        parse_billing,
        _needs(BILLING_COLUMNS),
        reason="all_blank",
        utf16=True,
        names=(*BILLING_COLUMNS, *BILLING_UNITS),
    ),
    Layout(
        "demand",
        lambda: F.contains(F.replace(F.lower("name"), F.lit("_"), F.lit(" ")), F.lit("demand profile"))
        & _line(1).startswith("Commodities:"),
        9,
        parse_demand,
        _needs(DEMAND_COLUMNS),
        flags={EMPTY: _demand_empty},
        reason="all_blank",
        names=tuple(DEMAND_COLUMNS),
    ),
    Layout(
        "interval",
        lambda: _all_in(_line(1), ["Date", "Start Time", "Identifier"]),
        1,
        parse_interval,
        _interval_ok,
        flags={EMPTY: _interval_empty, FAILED: _ragged},
        reason="all_blank",
        names=tuple(INTERVAL_COLUMNS),
    ),
    Layout(
        "envizi_bulk_water",
        lambda: _not_generation() & ~F.col("has_nul") & _all_in(_line(1), BULK_COLUMNS),
        1,
        parse_bulk_water,
        _needs(BULK_COLUMNS),
        flags={FAILED: _ragged},
        reason="all_blank",
    ),
    Layout(
        "comx",
        lambda: F.trim(F.regexp_replace(F.trim(first_cell(_line(2))), '^"|"$', "")) == COMX_MARKER,
        7,
        parse_comx,
        _comx_ok,
        flags={FAILED: _ragged},
        reason="all_blank",
        keep_blank_lines=True,
    ),
]

BY_NAME = {layout.name: layout for layout in LAYOUTS}
