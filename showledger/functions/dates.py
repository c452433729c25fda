"""Localized and feed dates. Every parser yields a UTC timestamp or NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from .text import col

_ISO_STAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"


def parse_timestamp(c) -> Column:
    return F.nullif(F.trim(col(c)), F.lit("")).try_cast("timestamp")


def _month_map(indonesian: bool) -> Column:
    pairs = []
    for i, name in enumerate(rules.MONTHS_EN, 1):
        pairs += [(name, i), (name[:3], i)] if name != "may" else [(name, i)]
    if indonesian:
        known = {n for n, _ in pairs}
        pairs += [(n, i) for i, n in enumerate(rules.MONTHS_ID, 1) if n not in known]
    return F.create_map(*[x for name, i in pairs for x in (F.lit(name), F.lit(i))])


def month_number(word: Column, indonesian: bool = True) -> Column:
    return _month_map(indonesian)[F.lower(word)]


def _day(year: Column, month: Column, day: Column) -> Column:
    text = F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0"), F.lpad(day, 2, "0"))
    return F.when(month.isNotNull() & (day != ""), text.try_cast("timestamp"))


def _word_date(text: Column, pattern: str, d: int, m: int, y: int) -> Column:
    part = lambda g: F.regexp_extract(text, pattern, g)
    return F.when(text.rlike(pattern), _day(part(y), month_number(part(m)), part(d)))


def parse_localized_date(c) -> Column:
    """ISO date/stamp, D/M/Y, `Month D, Y`, `D Month Y`; English and Indonesian months."""
    text = F.trim(F.coalesce(col(c), F.lit("")))
    slash = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
    g = lambda n: F.regexp_extract(text, slash, n)
    return F.coalesce(
        F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$") | text.rlike(_ISO_STAMP), text.try_cast("timestamp")),
        F.when(text.rlike(slash), _day(g(3), g(2).try_cast("int"), g(1))),
        _word_date(text, r"^([A-Za-z]+) (\d{1,2}), (\d{4})$", 2, 1, 3),
        _word_date(text, r"^(\d{1,2}) ([A-Za-z]+) (\d{4})$", 1, 2, 3),
    )


def embedded_date(c) -> Column:
    found = F.regexp_extract(F.coalesce(col(c), F.lit("")), r"\b((?:19|20)\d{2}-\d{2}-\d{2})\b", 1)
    return F.nullif(found, F.lit("")).try_cast("timestamp")


def embedded_timestamp(c) -> Column:
    stamp = r"\b((?:19|20)\d{2}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:Z|[+\-]\d{2}:\d{2}))(?!\d)"
    return F.nullif(F.regexp_extract(F.coalesce(col(c), F.lit("")), stamp, 1), F.lit("")).try_cast("timestamp")


def parse_feed_date(c) -> Column:
    """RFC 822 / RFC 1123 dates; a zone name without an offset counts as UTC."""
    text = F.trim(F.coalesce(col(c), F.lit("")))
    shape = r"^(?:[A-Za-z]{3}, )?(\d{1,2}) ([A-Za-z]{3}) (\d{4}|\d{2}) (\d{2}:\d{2}(?::\d{2})?) ([+-]\d{4}|[A-Z]{3,4})$"
    g = lambda n: F.regexp_extract(text, shape, n)
    year = F.when(F.length(g(3)) == 4, g(3)).otherwise(
        F.concat(F.when(g(3) >= "69", F.lit("19")).otherwise(F.lit("20")), g(3))
    )
    clock = F.when(F.length(g(4)) == 5, F.concat(g(4), F.lit(":00"))).otherwise(g(4))
    zone = F.when(g(5).rlike(r"^[+-]"), F.concat(F.left(g(5), F.lit(3)), F.lit(":"), F.right(g(5), F.lit(2)))).otherwise(F.lit("Z"))
    month = F.lpad(month_number(g(2), False).cast("string"), 2, "0")
    iso = F.concat(F.concat_ws("-", year, month, F.lpad(g(1), 2, "0")), F.lit("T"), clock, zone)
    return F.when(text.rlike(shape) & month.isNotNull(), iso.try_cast("timestamp"))


def iso_z(c) -> Column:
    """`2024-01-30T23:57:12Z`."""
    return F.date_format(col(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")
