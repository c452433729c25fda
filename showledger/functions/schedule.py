"""Weekdays, broadcast windows and the next release."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from .codes import lookup
from .text import col

_CLOCK = r"\b(\d{1,2}):(\d{2})\b"


def weekday_name(c) -> Column:
    """First English or Indonesian weekday in the text, in English; '' when there is none."""
    names = sorted(rules.WEEKDAYS, key=len, reverse=True)
    word = F.regexp_extract(F.lower(F.coalesce(col(c), F.lit(""))), r"\b(" + "|".join(names) + r")\b", 1)
    return F.coalesce(lookup(rules.WEEKDAYS, word), F.lit(""))


def time_window(c) -> Column:
    """`20:50` or `20:50 - 22:00` found in the text; '' when there is none."""
    return F.regexp_extract(F.coalesce(col(c), F.lit("")), r"\b\d{1,2}:\d{2}(?:\s*-\s*\d{1,2}:\d{2})?\b", 0)


def weekday_index(day: Column) -> Column:
    """monday = 0 ... sunday = 6; NULL for anything else."""
    return F.create_map(*[x for i, d in enumerate(rules.WEEKDAY_ORDER) for x in (F.lit(d), F.lit(i))])[day]


def next_weekly_release(day, window, zone, now) -> Column:
    """Next local occurrence of (weekday, first H:MM of window) strictly after now, in UTC.

    NULL without a weekday, a valid clock time or a zone. The wall clock is kept
    across daylight-saving changes because the local time is converted last.
    """
    zone = F.nullif(F.trim(col(zone)), F.lit(""))
    hour = F.nullif(F.regexp_extract(col(window), _CLOCK, 1), F.lit("")).try_cast("int")
    minute = F.nullif(F.regexp_extract(col(window), _CLOCK, 2), F.lit("")).try_cast("int")
    local_now = F.from_utc_timestamp(col(now), zone)
    ahead = F.pmod(weekday_index(col(day)) - F.weekday(local_now), F.lit(7))
    at = F.make_dt_interval(ahead, hour, minute)
    slot = F.date_trunc("day", local_now) + at
    later = F.when(slot > local_now, slot).otherwise(slot + F.expr("interval '7' day"))
    valid = hour.between(0, 23) & minute.between(0, 59) & zone.isNotNull()
    return F.when(valid, F.to_utc_timestamp(later, zone))
