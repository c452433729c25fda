"""Numbers written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, normalize_space

_FLOAT = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def to_number(c) -> Column:
    """Whole text as a double, NULL unless it is a plain decimal number."""
    text = F.trim(col(c))
    return F.when(text.rlike(_FLOAT), text.try_cast("double"))


def _guarded(c, pattern: str, kind: str) -> Column:
    text = F.trim(col(c))
    return F.when(text.rlike(pattern), text.try_cast(kind))


def parse_smallint(c) -> Column:
    return _guarded(c, r"^[0-9]{1,5}$", "smallint")


def parse_integer(c) -> Column:
    return _guarded(c, r"^[0-9]{1,10}$", "int")


def parse_real(c) -> Column:
    return _guarded(c, r"^[0-9]+(\.[0-9]+)?$", "double")


def _int_group(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("int")


def parse_duration_minutes(c) -> Column:
    text = F.lower(F.trim(col(c)))
    total = F.coalesce(_int_group(text, r"([0-9]+)\s*h"), F.lit(0)) * 60 + F.coalesce(
        _int_group(text, r"([0-9]+)\s*m"), F.lit(0)
    )
    return F.when(text.rlike(r"^[0-9]+\s*min$"), _int_group(text, r"^([0-9]+)")).otherwise(F.nullif(total, F.lit(0)))


def chapter_number(label) -> Column:
    """`Chapter 12.5` -> `12.5`: leading chapter words removed, one after another."""
    text = F.lower(normalize_space(label))
    for prefix in ("chapter ", "chapter", r"ch\. ", "ch "):
        text = F.regexp_replace(text, "^" + prefix, "")
    return F.trim(text)


def sequence_index(number, fallback) -> Column:
    text = F.replace(F.trim(F.coalesce(col(number), F.lit(""))), F.lit(","), F.lit("."))
    digits = F.regexp_replace(text, "[^0-9.]", "")
    dot = F.instr(digits, ".")
    one_dot = F.when(
        dot > 0,
        F.concat(F.left(digits, dot), F.replace(F.substring(digits, dot + 1, F.length(digits)), F.lit("."), F.lit(""))),
    ).otherwise(digits)
    return F.coalesce(to_number(text), to_number(one_dot), col(fallback).cast("double"))


def episode_number(*values) -> Column:
    """First value that is a number or says `episode N`; 0 when none does."""
    options = []
    for value in values:
        named = F.nullif(F.regexp_extract(col(value), r"(?i)episode\s+(\d+(?:\.\d+)?)", 1), F.lit(""))
        options += [to_number(value), named.try_cast("double")]
    return F.coalesce(*options, F.lit(0.0))


def card_score(c) -> Column:
    return F.coalesce(
        F.nullif(F.regexp_extract(col(c), r"\b\d+(?:\.\d+)?\b", 0), F.lit("")).try_cast("double"), F.lit(0.0)
    )


def card_views(c) -> Column:
    raw = F.regexp_replace(F.regexp_extract(col(c), r"(\d[\d.,]*)\s*Views?", 1), "[.,]", "")
    return F.coalesce(F.nullif(raw, F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))


def quality_label(c) -> Column:
    return F.upper(F.regexp_extract(F.lower(F.coalesce(col(c), F.lit(""))), r"\b(?:240|360|480|540|720|1080|2160)p\b", 0))


def release_year(*values) -> Column:
    """First `19xx`/`20xx` found, as text; '' when there is none."""
    found = [F.nullif(F.regexp_extract(F.coalesce(col(v), F.lit("")), r"(?:19|20)\d{2}", 0), F.lit("")) for v in values]
    return F.coalesce(*found, F.lit(""))


def bounded_year(c, low: int = 1800, high: int = 9999) -> Column:
    value = F.when(F.trim(col(c)).rlike(r"^[+-]?\d+$"), F.trim(col(c)).try_cast("int"))
    return F.when(value.between(low, high), value)


def year_from_date(c) -> Column:
    return bounded_year(F.left(col(c), F.lit(4)), 1900, 2100)


def format_number(c) -> Column:
    """Integral values without decimals, otherwise at most three of them."""
    value = col(c).cast("double")
    return F.when(value == F.floor(value), value.cast("bigint").cast("string")).otherwise(
        F.regexp_replace(F.format_string("%.3f", value), r"\.?0+$", "")
    )
