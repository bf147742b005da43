"""Meter identifiers, channel suffixes, lookup keys and units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 22 stream letters by 35 channel characters.
SUFFIX_PATTERN = "^[ABCDEFJKLPQRSTUGHYMWVZ][1-9A-Z]$"
NZ_ICP_PATTERN = "^[0-9]{10}[A-Z0-9]{5}$"
OPTIMA = "Optima_"
ENVIZI = "Envizi_"
COMX = "GPWComX_"
DIRECT = "p:"
BILLING = "-billing-"


def supported_suffix(suffix: Column) -> Column:
    return suffix.rlike(SUFFIX_PATTERN)


def prefixed(ident: Column, prefix: str) -> Column:
    """Put ``prefix`` in front unless it is there already."""
    return F.when(ident.startswith(prefix), ident).otherwise(F.concat(F.lit(prefix), ident))


def prefix_nem12_line(line: Column, prefix: str = OPTIMA) -> Column:
    """Prefix the meter of a 200 line, once; other lines stay as they are."""
    return F.regexp_replace(line, f"^200,(?!{prefix})([^,\r\n]+),", f"200,{prefix}$1,")


def is_direct(nmi: Column) -> Column:
    """The identifier is a sensor id already and needs no lookup."""
    return nmi.startswith(DIRECT)


def lookup_key(nmi: Column, suffix: Column) -> Column:
    return F.concat(nmi, F.lit("-"), suffix)


def unit_or_default(uom: Column, default: str = "kWh") -> Column:
    return F.lower(F.coalesce(F.nullif(uom, F.lit("")), F.lit(default)))


def is_money_field(field: Column) -> Column:
    return F.contains(field, F.lit("charge")) | F.contains(field, F.lit("spend"))


def billing_unit_source(suffix: str) -> str:
    """Charges and spends carry the currency, everything else the usage unit."""
    return "spend" if "charge" in suffix or "spend" in suffix else "usage"


def billing_field(suffix: Column) -> Column:
    """``billing-peak-usage`` to ``peak_usage``."""
    return F.translate(F.regexp_replace(suffix, "^billing-", ""), "-", "_")


def billing_key_parts(key: Column) -> tuple[Column, Column]:
    """Meter and field of a key, cut at its first ``-billing-``; NULL if it has none."""
    has = F.contains(key, F.lit(BILLING))
    parts = F.split(key, BILLING, 2)
    return F.when(has, parts[0]), F.when(has, billing_field(parts[1]))


def before_unit(header: Column) -> Column:
    """``p:site:x (kW-hr)`` to ``p:site:x``."""
    return F.substring_index(header, " (", 1)


def before_space(header: Column) -> Column:
    return F.substring_index(header, " ", 1)


def without_spaces(name: Column) -> Column:
    return F.replace(name, F.lit(" "), F.lit(""))


def wh_to_kwh(value: Column) -> Column:
    return value / 1000


def country(nmi: Column, site_name: Column) -> Column:
    """From the second word of the site name, else from the identifier's length."""
    word = F.try_element_at(F.split(F.trim(site_name), r"\s+"), F.lit(2))
    bare = F.regexp_replace(nmi, f"^{OPTIMA}", "")
    return (
        F.when(word == "NZ", F.lit("NZ"))
        .when(word == "AUS", F.lit("AU"))
        .when(F.length(bare) == 15, F.lit("NZ"))
        .otherwise(F.lit("AU"))
    )


def is_nz_icp(nmi: Column) -> Column:
    return nmi.rlike(NZ_ICP_PATTERN)
