"""Credits, videos and images of provider details."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from .arrays import compact_ci, union_ordered
from .codes import lookup
from .text import col, is_blank, none_if_blank


def poster_url(path, base: str = rules.POSTER_BASE) -> Column:
    text = F.trim(F.coalesce(col(path), F.lit("")))
    return (
        F.when(text == "", "")
        .when(text.rlike("^https?://"), text)
        .otherwise(F.concat(F.lit(base), F.when(text.startswith("/"), "").otherwise("/"), text))
    )


def directors(crew) -> Column:
    """Distinct names of crew members whose job is Director."""
    only = F.filter(col(crew), lambda m: F.lower(m["job"]) == "director")
    return union_ordered(F.transform(only, lambda m: m["name"]))


def cast_entries(cast, limit: int = 8, source: str = "tmdb") -> Column:
    """First `limit` named cast members as {name, source, role?}."""
    named = F.filter(col(cast), lambda m: ~is_blank(m["name"]))
    return F.slice(
        F.transform(
            named,
            lambda m: F.struct(
                F.trim(m["name"]).alias("name"), F.lit(source).alias("source"), none_if_blank(m["character"]).alias("role")
            ),
        ),
        1, limit if limit > 0 else 8,
    )


def trailer_url(videos) -> Column:
    """First official trailer, else the first video of any type; '' without one."""
    usable = F.filter(col(videos), lambda v: (F.lower(v["site"]) == "youtube") & ~is_blank(v["key"]))
    official = F.filter(usable, lambda v: (F.lower(v["type"]) == "trailer") & v["official"])
    key = F.coalesce(F.get(official, 0)["key"], F.get(usable, 0)["key"])
    return F.coalesce(F.concat(F.lit(rules.VIDEO_BASE), F.trim(key)), F.lit(""))


def country_names(countries, language) -> Column:
    """Production countries plus the country told by the original language."""
    extra = F.array(lookup(rules.COUNTRY_NAME_BY_LANGUAGE, F.trim(F.coalesce(col(language), F.lit("")))))
    return compact_ci(col(countries), extra)
