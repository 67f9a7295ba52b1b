"""Dates from mixed texts. Invalid dates are NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(c: Column) -> Column:
    """ISO timestamps, year first, or day first; - or / between."""
    s = F.trim(c)
    ymd, dmy = r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})", r"^(\d{1,2})[-/](\d{1,2})[-/](\d{4})"
    text = lambda p, y, m, d: F.concat_ws("-", F.regexp_extract(s, p, y), F.lpad(F.regexp_extract(s, p, m), 2, "0"), F.lpad(F.regexp_extract(s, p, d), 2, "0"))
    iso = F.when(s.contains("T"), F.try_to_timestamp(F.substring(s, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("date"))
    return F.coalesce(iso, F.when(s.rlike(ymd), F.try_to_date(text(ymd, 1, 2, 3), "yyyy-MM-dd")), F.when(s.rlike(dmy), F.try_to_date(text(dmy, 3, 2, 1), "yyyy-MM-dd")))


def iso_week(d: Column) -> Column:
    """2026-W53 and so on; the year is the week's."""
    return F.format_string("%d-W%02d", F.extract(F.lit("YEAROFWEEK"), d), F.weekofyear(d))


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days, NULL if negative."""
    n = F.datediff(later, earlier)
    return F.when(n >= 0, n)


def due(last: Column, now: Column, days: float) -> Column:
    """True if never, unreadable, or at least so many days ago."""
    return F.coalesce((F.unix_seconds(now) - F.unix_seconds(F.try_to_timestamp(last))) / 86400.0 >= days, F.lit(True))


def local(ts: Column, zone: str = "Asia/Ho_Chi_Minh") -> Column:
    return F.from_utc_timestamp(ts, zone)
