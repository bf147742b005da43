"""Cells of one delimited line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOM = "\ufeff"
QUOTED_OR_PLAIN = ',("[^"]*+(?:""[^"]*+)*+"[^,]*|[^,]*)'


def clean_line(line: Column) -> Column:
    """Drop a byte-order mark at the start and a carriage return at the end."""
    return F.regexp_replace(line, f"^{BOM}|\r$", "")


def cells(line: Column) -> Column:
    """Comma-separated cells; quotes protect commas and double to escape.

    Only lines that hold a quote pay for the pattern match.
    """
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(QUOTED_OR_PLAIN), F.lit(1))
    unquoted = F.transform(
        raw,
        lambda c: F.when(
            c.startswith('"'),
            F.replace(F.regexp_replace(c, '^"|"(?!")[^"]*$', ""), F.lit('""'), F.lit('"')),
        ).otherwise(c),
    )
    return F.when(F.contains(line, F.lit('"')), unquoted).otherwise(F.split(line, ",", -1))


def first_cell(line: Column) -> Column:
    return F.substring_index(line, ",", 1)


def has_content(row: Column) -> Column:
    """Some cell is not blank."""
    return F.exists(row, lambda c: F.trim(c) != "")


def cell(row: Column, header: Column, name: str) -> Column:
    """The row's cell under ``name``; NULL when the column or the cell is absent."""
    return F.get(row, (F.array_position(header, F.lit(name)) - 1).cast("int"))


def has_columns(header: Column, names: list[str]) -> Column:
    return F.size(F.array_except(F.array(*[F.lit(n) for n in names]), header)) == 0


def missing_columns(header: Column, names: list[str]) -> Column:
    return F.array_except(F.array(*[F.lit(n) for n in names]), header)


def safe_file_name(name: Column) -> Column:
    """A single path segment."""
    return F.regexp_replace(name, r"[/\\]", "_")


def decode_key(key: Column) -> Column:
    """Object key as delivered by a storage event: percent codes and ``+`` for a space."""
    return F.coalesce(F.try_url_decode(key), key)


def base_name(path: Column) -> Column:
    """Decoded last segment of a file path; here ``+`` stands for itself."""
    return decode_key(F.replace(F.substring_index(path, "/", -1), F.lit("+"), F.lit("%2B")))


def named(**columns: Column) -> Column:
    """A struct with fixed field names, also where aliases would be trimmed (next to a generator)."""
    return F.named_struct(*[part for name, column in columns.items() for part in (F.lit(name), column)])
