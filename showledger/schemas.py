"""Canonical row types."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _H, _F, _B, _TS = (
    T.StringType(), T.LongType(), T.IntegerType(), T.ShortType(), T.FloatType(), T.BooleanType(), T.TimestampType(),
)


def _struct(required: str, fields: list[tuple[str, T.DataType]]) -> T.StructType:
    must = set(required.split())
    return T.StructType([T.StructField(n, t, n not in must) for n, t in fields])


ITEM = _struct(
    "item_key source media_type slug",
    [
        ("item_key", _S), ("source", _S), ("media_type", _S), ("slug", _S), ("title", _S), ("cover_url", _S),
        ("status", _S), ("release_year", _H), ("score", _F), ("mal_id", _L), ("tmdb_id", _L), ("detail", _S),
        ("surface_type", _S), ("presentation_type", _S), ("origin_type", _S), ("release_country", _S),
        ("is_nsfw", _B), ("genre_names", T.ArrayType(_S)), ("taxonomy_confidence", _H), ("taxonomy_source", _S),
        ("release_day", _S), ("release_window", _S), ("release_timezone", _S), ("cadence", _S),
        ("next_release_at", _TS), ("created_at", _TS), ("updated_at", _TS),
    ],
)
UNIT = _struct(
    "unit_key item_key source unit_type slug",
    [
        ("unit_key", _S), ("item_key", _S), ("source", _S), ("unit_type", _S), ("slug", _S), ("title", _S),
        ("label", _S), ("number", _F), ("canonical_url", _S), ("published_at", _TS), ("prev_slug", _S),
        ("next_slug", _S), ("detail", _S), ("created_at", _TS), ("updated_at", _TS),
    ],
)
ENRICHMENT = _struct(
    "item_key provider",
    [
        ("item_key", _S), ("provider", _S), ("external_id", _S), ("match_status", _S), ("match_score", _H),
        ("matched_title", _S), ("matched_year", _H), ("payload", _S), ("created_at", _TS), ("updated_at", _TS),
    ],
)
HIT = _struct(
    "",
    [
        ("query_id", _S), ("query_pos", _I), ("hit_pos", _I), ("external_id", _S), ("titles", T.ArrayType(_S)),
        ("year", _I), ("kind", _S), ("payload", _S),
    ],
)
PAGE = _struct("", [("page_id", _L), ("url", _S), ("html", _S)])

TABLES = {"items": ITEM, "units": UNIT, "enrichments": ENRICHMENT, "hits": HIT, "pages": PAGE}
