"""NEM13 accumulation files, and the NEM header and transaction records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.coerce import number, skip_reason
from meterlake.functions.identifiers import lookup_key, supported_suffix, unit_or_default
from meterlake.functions.stamps import nem_stamp
from meterlake.functions.text import cells
from meterlake.schemas import IGNORED, conform

FMT = "nem13"

# Cell positions of a 250 record.
NMI, SUFFIX, SERIAL = 1, 4, 6
PREV_READ, PREV_DATE = 8, 9
CUR_READ, CUR_DATE, CUR_QUALITY = 13, 14, 15
QUANTITY, UOM = 18, 19


def _records(lines: DataFrame, indicator: int) -> DataFrame:
    return lines.filter(F.col("line").rlike(f'^"?{indicator}"?,')).withColumn("row", cells(F.col("line")))


def parse_lines(lines: DataFrame) -> DataFrame:
    """One register-to-register reading per 250 record; records stand alone."""

    def at(i: int):
        return F.get("row", F.lit(i))

    # Named in steps, so that each cell is cut and converted once.
    taken = _records(lines, 250).select(
        "file",
        "split",
        "pos",
        (F.size("row") <= UOM).alias("broken"),
        at(NMI).alias("nmi"),
        at(SUFFIX).alias("suffix"),
        at(UOM).alias("unit"),
        at(SERIAL).alias("serno"),
        nem_stamp(at(PREV_DATE)).alias("t_start"),
        nem_stamp(at(CUR_DATE)).alias("t_end"),
        at(QUANTITY).alias("raw_val"),
        at(PREV_READ).alias("prev"),
        at(CUR_READ).alias("cur"),
        at(CUR_QUALITY).alias("quality"),
    )
    valued = taken.select(
        "*",
        number(F.col("raw_val")).alias("val"),
        number(F.col("prev")).alias("val_start"),
        number(F.col("cur")).alias("val_end"),
    )
    stamp = F.when(F.col("t_end").isNotNull(), F.col("t_start"))
    reason = (
        F.when(F.col("broken"), F.lit("row_shape_mismatch"))
        .when(~supported_suffix(F.col("suffix")), F.lit(IGNORED))
        .otherwise(skip_reason(F.col("raw_val"), stamp, val=F.col("val")))
    )
    return conform(
        valued.select(
            "*",
            F.lit(FMT).alias("fmt"),
            F.concat_ws("_", "suffix", "unit").alias("column"),
            F.lit(False).alias("row_start"),
            unit_or_default(F.col("unit")).alias("uom"),
            lookup_key(F.col("nmi"), F.col("suffix")).alias("lookup_key"),
            F.lit("nem12_nmi").alias("id_kind"),
            F.lit("").alias("event_code"),
            F.lit("").alias("event_desc"),
            reason.alias("skip_reason"),
        )
    )


def file_headers(heads: DataFrame) -> DataFrame:
    """Version header per file. A file without a 100 record counts as NEM12."""
    lead = F.try_element_at(F.filter("head", lambda line: F.trim(line) != ""), F.lit(1))
    row = cells(F.coalesce(lead, F.lit("")))
    has = F.trim(F.get(row, F.lit(0))) == "100"
    return heads.select(
        "file",
        F.when(has, F.get(row, F.lit(1))).otherwise(F.lit("NEM12")).alias("version_header"),
        F.when(has, nem_stamp(F.get(row, F.lit(2)))).alias("creation_date"),
        F.when(has, F.get(row, F.lit(3))).alias("from_participant"),
        F.when(has, F.get(row, F.lit(4))).alias("to_participant"),
        (~has).alias("assumed"),
    )


def transactions(lines: DataFrame) -> DataFrame:
    """Transaction records of both versions: 500 of NEM12, 550 of NEM13."""

    def at(i: int):
        return F.get("row", F.lit(i))

    interval = _records(lines, 500).select(
        "file",
        F.lit(500).alias("record"),
        at(1).alias("trans_code"),
        at(2).alias("ret_service_order"),
        nem_stamp(at(3)).alias("read_datetime"),
        at(4).alias("index_read"),
    )
    accumulation = _records(lines, 550).select(
        "file",
        F.lit(550).alias("record"),
        at(1).alias("previous_trans_code"),
        at(2).alias("previous_ret_service_order"),
        at(3).alias("current_trans_code"),
        at(4).alias("current_ret_service_order"),
    )
    return interval.unionByName(accumulation, allowMissingColumns=True)
