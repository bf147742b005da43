"""Fixed schemas and vocabularies. Schemas are never inferred from data.

Timestamps are naive local stamps, so every stamp column is ``TIMESTAMP_NTZ``:
the session time zone cannot shift a reading.
"""

from __future__ import annotations

from pyspark.sql import types as T

# One row per cell of a source file, valid or not.
READINGS = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("fmt", T.StringType()),
        T.StructField("split", T.LongType()),
        T.StructField("pos", T.LongType()),
        T.StructField("column", T.StringType()),
        T.StructField("row_start", T.BooleanType()),
        T.StructField("nmi", T.StringType()),
        T.StructField("suffix", T.StringType()),
        T.StructField("uom", T.StringType()),
        T.StructField("lookup_key", T.StringType()),
        T.StructField("id_kind", T.StringType()),
        T.StructField("t_start", T.TimestampNTZType()),
        T.StructField("t_end", T.TimestampNTZType()),
        T.StructField("raw_val", T.StringType()),
        T.StructField("val", T.DoubleType()),
        T.StructField("quality", T.StringType()),
        T.StructField("event_code", T.StringType()),
        T.StructField("event_desc", T.StringType()),
        T.StructField("serno", T.StringType()),
        T.StructField("val_start", T.DoubleType()),
        T.StructField("val_end", T.DoubleType()),
        T.StructField("skip_reason", T.StringType()),
    ]
)

# The same with the sensor that the map names.
RESOLVED = T.StructType([*READINGS.fields, T.StructField("sensor_id", T.StringType())])

# The same with the number of cells that a row stands for.
CELLS = T.StructField("cells", T.LongType())

# How the empty cells of a day are given: one row each, one row for all of a day (its number in ``cells``), or not at all.
EACH, COUNTED, FILLED = "each", "counted", "filled"

# The CSV rows that feed the lake.
LAKE_CSV = T.StructType(
    [
        T.StructField("sensorId", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("val", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("its", T.StringType()),
        T.StructField("quality", T.StringType()),
    ]
)

MAPPING = T.StructType(
    [
        T.StructField("lookup_key", T.StringType()),
        T.StructField("sensor_id", T.StringType()),
    ]
)

# The words a file outcome is described with.
STATUSES = ("processed", "processed_empty", "unmapped", "processed_external", "parse_failed")
REASONS = (
    "no_data_sentinel",
    "zero_rows",
    "all_blank",
    "all_zero_valid",
    "all_unknown_suffix",
    "all_skipped",
    "external_archive",
    "parser_error",
    "processing_error",
)
SKIP_REASONS = (
    "unparseable_value",
    "blank_value",
    "unparseable_timestamp",
    "row_anchor_failure",
    "row_shape_mismatch",
)

# A cell that is neither a candidate nor counted as skipped (a blank cell of a
# sparse layout, a cell of an all-zero day, a channel outside the supported set).
IGNORED = "ignored"


def conform(df, schema=READINGS):
    """Select the schema's columns in order, filling absent ones with typed NULLs."""
    from pyspark.sql import functions as F

    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
