"""Text to numbers, with one reason for every cell that is not usable.

A cell is judged on its raw text, once, in this order: blank, bad timestamp,
bad number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlake.schemas import IGNORED

# The texts a delimited-file reader commonly takes for "no value".
NA_TEXTS = [
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]


def is_blank(raw: Column, na_texts: bool = False) -> Column:
    """NULL or white space only; with ``na_texts`` also the usual NA spellings."""
    blank = raw.isNull() | (F.trim(raw) == "")
    return blank | F.trim(raw).isin(NA_TEXTS) if na_texts else blank


def number(raw: Column) -> Column:
    """The finite-or-infinite double in ``raw``, else NULL.

    Spark's cast also takes the type suffixes of Java literals (``1d``, ``1f``);
    those are not numbers here, and neither is NaN. Blank cells do not
    reach the cast, whose failure is far dearer than its success.
    """
    trimmed = F.trim(raw)
    typed = F.substring(trimmed, -1, 1).isin("d", "D", "f", "F") & ~F.lower(trimmed).endswith("inf")
    no_number = F.lit(None).cast("double")
    return F.when((trimmed != "") & ~typed, F.nanvl(trimmed.try_cast("double"), no_number))


def skip_reason(raw: Column, ts: Column, na_texts: bool = False, val: Column | None = None) -> Column:
    """Why a cell is not a candidate; NULL for a candidate. ``val`` is ``number(raw)`` if already at hand."""
    return (
        F.when(is_blank(raw, na_texts), F.lit("blank_value"))
        .when(ts.isNull(), F.lit("unparseable_timestamp"))
        .when((number(raw) if val is None else val).isNull(), F.lit("unparseable_value"))
    )


def ignore_blank(reason: Column) -> Column:
    """Sparse layouts: a blank cell is normal and is not counted."""
    return F.when(reason == "blank_value", F.lit(IGNORED)).otherwise(reason)


def is_candidate(reason: Column) -> Column:
    return reason.isNull()


def is_skipped(reason: Column) -> Column:
    return reason.isNotNull() & (reason != IGNORED)


def money(value: Column) -> Column:
    """Two decimals as text; NULL stays NULL and so becomes an empty cell."""
    return F.when(value.isNotNull(), F.format_string("%.2f", value))
