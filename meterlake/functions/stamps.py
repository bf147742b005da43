"""Timestamps: parsing, grid arithmetic, week labels and date windows.

Arithmetic works on the calendar parts of naive stamps, never on an instant,
so no result depends on a time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"


def parse_any(text: Column, patterns: list[str]) -> Column:
    """First pattern that reads the trimmed text, else NULL. Read as UTC and counted from the epoch, whatever the session's zone."""
    marked = F.concat(F.trim(text), F.lit(" +00:00"))
    seconds = F.unix_seconds(F.coalesce(*(F.try_to_timestamp(marked, F.lit(f"{p} XXX")) for p in patterns)))
    days = F.floor(seconds / 86400).cast("int")
    return F.lit("1970-01-01").cast(NTZ) + F.make_dt_interval(days, F.lit(0), F.lit(0), F.pmod(seconds, F.lit(86400)).cast("decimal(18,6)"))


# Timestamp patterns per layout.
INTERVAL_PATTERNS = ["d MMM yyyy H:mm[:ss]", "yyyy-MM-dd H:mm[:ss]", "d-MMM-yyyy H:mm[:ss]", "d/M/yyyy H:mm[:ss]"]
ISO_PATTERNS = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd H:mm[:ss]", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd"]
DEMAND_PATTERNS = ["d-MMM-yyyy H:m:s"]
SOLAR_PATTERNS = ["d-MMM-yy h:mm a"]
LOGGER_PATTERNS = ["d/M/yyyy H:mm[:ss]", "d-M-yyyy H:mm[:ss]", "yyyy-MM-dd H:mm[:ss]"]
MONTH_PATTERNS = ["MMM yyyy"]


def billing_month(text: Column) -> Column:
    """``Mar 2026`` to the first instant of that month."""
    return parse_any(text, MONTH_PATTERNS)


def nem_stamp(text: Column) -> Column:
    """Date8, DateTime12 or DateTime14, chosen by length; anything else NULL."""
    t = F.trim(text)
    p = F.rpad(t, 14, "0")
    marks = ["", "-", "-", " ", ":", ":"]
    starts = [(1, 4), (5, 2), (7, 2), (9, 2), (11, 2), (13, 2)]
    parts = [part for mark, (at, n) in zip(marks, starts, strict=True) for part in (F.lit(mark), F.substring(p, at, n))]
    return F.when(t.rlike("^([0-9]{8}|[0-9]{12}|[0-9]{14})$"), F.concat(*parts).try_cast(NTZ))


def day_start(ts: Column) -> Column:
    return F.to_date(ts).cast(NTZ)


def plus_minutes(ts: Column, minutes: Column) -> Column:
    """Naive stamp plus a whole number of minutes."""
    return ts + F.expr("INTERVAL '1' MINUTE") * minutes


def plus_seconds(ts: Column, seconds: Column) -> Column:
    """Naive stamp plus a whole number of seconds."""
    return ts + F.expr("INTERVAL '1' SECOND") * seconds


def epoch_seconds(ts: Column) -> Column:
    """Seconds on the naive calendar since 1970-01-01, whole seconds only."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def seconds_between(start: Column, end: Column) -> Column:
    return epoch_seconds(end) - epoch_seconds(start)


def slot_start(day: Column, slot: Column, minutes: Column) -> Column:
    """Start of the zero-based ``slot`` of a day cut into ``minutes``-long slots."""
    return plus_minutes(day, slot * minutes)


def slots_per_day(minutes: Column) -> Column:
    return F.floor(F.lit(1440) / minutes).cast("int")


def floor_minutes(ts: Column, minutes: int) -> Column:
    """Stamp floored to the ``minutes`` grid of its own day."""
    of_day = F.hour(ts) * 60 + F.minute(ts)
    return plus_minutes(day_start(ts), of_day - of_day % minutes)


def year_of(ts: Column) -> Column:
    return F.year(ts)


def its_text(ts: Column) -> Column:
    """The partition stamp as text, ``yyyy-MM-dd H:mm:ss``."""
    return F.concat(
        F.date_format(F.to_date(ts), "yyyy-MM-dd"),
        F.lit(" "),
        F.hour(ts).cast("string"),
        F.lit(":"),
        F.lpad(F.minute(ts).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad(F.second(ts).cast("string"), 2, "0"),
    )


def month_key(ts: Column) -> Column:
    """Calendar day as text; billing stamps always fall on the first of a month."""
    return F.date_format(F.to_date(ts), "yyyy-MM-dd")


def iso_week(ts: Column) -> Column:
    """ISO week label, such as ``2026-W03``."""
    day = F.to_date(ts)
    return F.concat(
        F.extract(F.lit("YEAROFWEEK"), day).cast("string"),
        F.lit("-W"),
        F.lpad(F.weekofyear(day).cast("string"), 2, "0"),
    )


def is_iso_week(text: Column) -> Column:
    return text.rlike("^[0-9]{4}-W(0[1-9]|[1-4][0-9]|5[0-3])$")


def previous_month(today: Column) -> tuple[Column, Column]:
    """First and last day of the month before ``today``."""
    first = F.to_date(F.trunc(F.add_months(today, -1), "MM"))
    return first, F.last_day(first)


def rolling_days(today: Column, days: int) -> tuple[Column, Column]:
    """The last ``days`` full days; the window ends yesterday."""
    return F.date_sub(today, days), F.date_sub(today, 1)


def past_months(today: Column, months: int) -> tuple[Column, Column]:
    """The last ``months`` calendar months, the current one included."""
    return F.to_date(F.trunc(F.add_months(today, 1 - months), "MM")), F.last_day(today)


def within(ts: Column, window: tuple[Column, Column]) -> Column:
    """Both days inclusive; a plain range on ``ts``, so it reaches the scan."""
    start, end = window
    return (ts >= start.cast(NTZ)) & (ts < F.date_add(end, 1).cast(NTZ))
