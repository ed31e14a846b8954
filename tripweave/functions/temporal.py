"""Timestamps: best-effort parsing, truncation and differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: Indonesian month abbreviations that differ from English ------------------
MONTH_WORDS = {"Mei": "May", "Agt": "Aug", "Okt": "Oct", "Des": "Dec"}
# -------------------------------------------------------------------------------------------


def timestamp(c: Column, source_tz: str | None = None) -> Column:
    """Text in any of the known shapes to a timestamp with second precision, else NULL.

    Text with an offset is an instant. Text without one is read in the session zone, or in
    ``source_tz`` when the source is known to write local time. The shape picks one parser, so
    the usual ISO text is parsed once and nothing else is tried.
    """
    text = F.trim(c)
    size = F.length(text)

    def parsed(pattern: str) -> Column:
        return F.try_to_timestamp(text, F.lit(pattern))

    local = (
        F.when(F.substring(text, 5, 1) == "-", text.try_cast("timestamp"))
        .when(text.contains("/"), parsed("d/M/yyyy[ H:mm:ss]"))
        .when(text.contains(" "), parsed("d MMM yyyy[ H:mm:ss]"))
        .when(size == 8, parsed("yyyyMMdd"))
        .when(size == 14, parsed("yyyyMMddHHmmss"))
    )
    epoch = size.between(9, 10) & text.rlike("^[0-9]+$")
    if source_tz:
        has_offset = text.rlike(r"[0-9](Z|[+-][0-9]{2}:?[0-9]{2})$")
        local = F.when(has_offset, local).otherwise(F.to_utc_timestamp(local, source_tz))
    return F.date_trunc("second", F.when(epoch, F.timestamp_seconds(text.cast("bigint"))).otherwise(local))


def timestamp_id(c: Column) -> Column:
    """As :func:`timestamp`, also reading Indonesian month names (``15 Agt 2024``)."""
    out = c
    for local, english in MONTH_WORDS.items():
        out = F.regexp_replace(out, rf"\b{local}\b", english)
    return timestamp(out)


def day(c: Column) -> Column:
    return F.to_date(timestamp(c))


def month_start(c: Column) -> Column:
    return F.to_date(F.date_trunc("month", c))


def hours_between(start: Column, end: Column) -> Column:
    """Number of hour boundaries crossed: 10:59 to 11:00 is one hour."""
    def hour_no(c: Column) -> Column:
        return F.floor(F.unix_timestamp(c) / 3600)

    return hour_no(end) - hour_no(start)


def days_since(c: Column, as_of: str) -> Column:
    """Whole days from a timestamp to ``as_of``; a date in the future counts as zero."""
    return F.greatest(F.datediff(F.lit(as_of).cast("date"), F.to_date(c)), F.lit(0)).cast("bigint")
