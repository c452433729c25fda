"""URL parts, by the generic URI syntax (scheme, authority, path)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import col

_PATH = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"
_HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"
_HOST_PORT = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)"


def _text(c) -> Column:
    return F.trim(F.coalesce(col(c), F.lit("")))


def url_path(c) -> Column:
    raw = F.regexp_extract(_text(c), _PATH, 1)
    decoded = F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    return F.when(raw.contains("%"), F.coalesce(decoded, raw)).otherwise(raw)


def slug_from_url(c) -> Column:
    """Last path segment; '' when the path is empty."""
    return F.trim(F.substring_index(F.trim(url_path(c), F.lit("/")), "/", -1))


def slug_from_text(c) -> Column:
    """String-only variant: text after the last inner slash, query text kept; NULL when blank."""
    return F.nullif(F.substring_index(F.trim(_text(c), F.lit("/")), "/", -1), F.lit(""))


def domain(c) -> Column:
    return F.regexp_extract(_text(c), _HOST_PORT, 1)


def host_norm(c) -> Column:
    """Lower-cased host without port and without a leading `www.`."""
    return F.regexp_replace(F.lower(F.regexp_extract(_text(c), _HOST, 1)), r"^www\.", "")


def strip_url_path(c) -> Column:
    """Absolute URL -> its path ('' without one); other text unchanged; blank -> ''."""
    text = F.coalesce(col(c), F.lit(""))
    return (
        F.when(F.trim(text) == "", F.lit(""))
        .when(text.rlike(r"(?i)^https?://"), F.regexp_extract(text, r"https?://[^/]+(/.*)$", 1))
        .otherwise(text)
    )


def youtube_id(c) -> Column:
    """Video id of the first matching URL form (short link, `v=`, embed); '' otherwise."""
    text = F.coalesce(col(c), F.lit(""))
    out = None
    for test, take in ((r"(?i)youtu\.be/", r"youtu\.be/"), (r"(?i)[?&]v=", "[?&]v="), ("(?i)/embed/", "/embed/")):
        value = F.regexp_extract(text, take + "([A-Za-z0-9_-]{6,})", 1)
        out = F.when(text.rlike(test), value) if out is None else out.when(text.rlike(test), value)
    return out.otherwise(F.lit(""))


@F.pandas_udf(T.StringType())
def resolve_url(base: pd.Series, ref: pd.Series) -> pd.Series:
    """Resolve a reference against a base URL (RFC 3986), Arrow batch at a time."""
    from urllib.parse import urljoin

    def one(b, r):
        r = (r or "").strip()
        if not r:
            return ""
        try:
            return urljoin((b or "").strip(), r)
        except ValueError:
            return r

    return pd.Series([one(b, r) for b, r in zip(base, ref)])


def page_url(base: str, slug, section: str = "") -> Column:
    """`<base>/[section/]<slug>/`."""
    parts = base.rstrip("/") + "/" + (section.strip("/") + "/" if section else "")
    return F.concat(F.lit(parts), F.trim(_text(slug), F.lit("/")), F.lit("/"))
