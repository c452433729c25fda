"""Code maps built from the rule tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from .text import col, contains_any, is_blank


def encode(table: str, c) -> Column:
    """Label -> one-letter code; first matching row of the table wins."""
    rows, default = rules.CODE_TABLES[table]
    text = F.lower(F.trim(F.coalesce(col(c), F.lit(""))))
    out = None
    for code, kind, values in rows:
        hit = text.isin(values) if kind == "eq" else contains_any(text, values)
        out = F.when(hit, code) if out is None else out.when(hit, code)
    return out.otherwise(F.lit(default))


def decode(table: str, c) -> Column:
    """One-letter code -> label; '' for an unknown code."""
    pairs = [F.lit(x) for kv in rules.CODE_LABELS[table].items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[col(c)], F.lit(""))


def lookup(table: dict[str, str], key: Column) -> Column:
    """Literal map lookup, NULL for an absent key."""
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[key]


def fetch_status_code(status, error, effective_kind) -> Column:
    low = lambda c: F.lower(F.coalesce(col(c), F.lit("")))
    return (
        F.when(F.trim(low(effective_kind)) == "secondary", "s")
        .when(low(status).contains("block") | low(error).contains("challenge"), "b")
        .when(low(status).contains("primary_fetched"), "p")
        .otherwise("x")
    )


def download_status_code(status, error, payload) -> Column:
    low = lambda c: F.lower(F.coalesce(col(c), F.lit("")))
    at = lambda p: F.get_json_object(col(payload), p)
    links = F.from_json(at("$.links"), "array<string>")
    return (
        F.when(at("$.resolved_count").try_cast("int") > 0, "r")
        .when(F.coalesce(F.size(links), F.lit(0)) > 0, "r")
        .when(
            low(status).contains("block") | low(error).contains("challenge")
            | (F.coalesce(at("$.http_status"), F.lit("")) == "403"),
            "b",
        )
        .when(~is_blank(status), "p")
        .otherwise("x")
    )


def country_code(c) -> Column:
    """JP/CN/KR/US by synonym; any other two-letter text as is; else ''."""
    text = F.upper(F.trim(F.coalesce(col(c), F.lit(""))))
    return F.coalesce(lookup(rules.COUNTRY_SYNONYMS, text), F.when(F.length(text) == 2, text), F.lit(""))


def first_country(*cols) -> Column:
    return F.coalesce(*[F.nullif(country_code(c), F.lit("")) for c in cols], F.lit(""))


def source_key(c) -> Column:
    text = F.lower(F.trim(F.coalesce(col(c), F.lit(""))))
    return F.when(text.isin(rules.READING_SOURCES), text).otherwise(rules.DEFAULT_READING_SOURCE)


def reading_media_type(source, c) -> Column:
    text = F.lower(F.trim(F.coalesce(col(c), F.lit(""))))
    return F.coalesce(
        F.nullif(text, F.lit("")), lookup(rules.DEFAULT_READING_TYPE, col(source)), F.lit(rules.FALLBACK_READING_TYPE)
    )


def comic_type(c) -> Column:
    """manhwa / manhua / manga by mention, manga by default."""
    text = F.lower(F.coalesce(col(c), F.lit("")))
    return F.when(text.contains("manhwa"), "manhwa").when(text.contains("manhua"), "manhua").otherwise("manga")


def content_format(categories, title) -> Column:
    """Format of the first telling category, else by title marker, else the default."""
    table = {v: fmt for fmt, values in rules.FORMAT_BY_CATEGORY for v in values}
    told = F.filter(
        F.transform(F.coalesce(col(categories), F.array().cast("array<string>")), lambda x: lookup(table, F.lower(F.trim(x)))),
        lambda x: x.isNotNull(),
    )
    by_title = None
    for fmt, marks in rules.FORMAT_BY_TITLE:
        hit = contains_any(title, marks)
        by_title = F.when(hit, fmt) if by_title is None else by_title.when(hit, fmt)
    return F.coalesce(F.get(told, 0), by_title.otherwise(rules.DEFAULT_FORMAT))


def card_status(media_type, badge, section) -> Column:
    """Movies are completed; an episode badge or the ongoing section means ongoing."""
    low = lambda c: F.lower(F.trim(F.coalesce(col(c), F.lit(""))))
    return (
        F.when(low(media_type) == "movie", "completed")
        .when(low(badge).contains("episode"), "ongoing")
        .when(low(section) == "ongoing", "ongoing")
        .otherwise("")
    )


def aired_status(media_type, aired) -> Column:
    """Movies are completed; an open-ended air date (`?`) means ongoing."""
    return (
        F.when(col(media_type) == "movie", "completed")
        .when(F.coalesce(col(aired), F.lit("")).contains("?"), "ongoing")
        .otherwise("completed")
    )


def overall_fetch_status(primary, secondary) -> Column:
    """Outcome of two fetch attempts, by the decision table."""
    p, s = F.coalesce(col(primary), F.lit("")), F.coalesce(col(secondary), F.lit(""))
    out = None
    for first, second, overall in rules.FETCH_OUTCOMES:
        hit = (p == first) & (s == second)
        out = F.when(hit, overall) if out is None else out.when(hit, overall)
    return (
        out.when(s == "fetched", "secondary_fetched")
        .when((p != "") & (p != "not_attempted"), F.concat(F.lit("primary_"), p))
        .otherwise("pending")
    )


def effective_source(primary: Column, secondary: Column) -> Column:
    """struct(kind, url, domain) of the attempt that supplied the page."""
    def pick(kind: str, attempt: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), attempt["url"].alias("url"), attempt["domain"].alias("domain"))

    none = F.struct(F.lit("unknown").alias("kind"), F.lit("").alias("url"), F.lit("").alias("domain"))
    return (
        F.when(primary["status"] == "fetched", pick("primary", primary))
        .when(secondary["status"] == "fetched", pick("secondary", secondary))
        .when(~is_blank(primary["url"]), pick("primary", primary))
        .when(~is_blank(secondary["url"]), pick("secondary", secondary))
        .otherwise(none)
    )


def fetch_error(primary_error, secondary_error) -> Column:
    part = lambda label, c: F.when(~is_blank(c), F.concat(F.lit(label + ": "), col(c)))
    return F.concat_ws(" | ", part("primary", primary_error), part("secondary", secondary_error))
