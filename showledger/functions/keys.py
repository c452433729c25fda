"""Canonical keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def item_key(source, media_type, slug) -> Column:
    """`source:media_type:slug`; source and type lower-cased, all trimmed."""
    return F.concat_ws(":", F.lower(F.trim(col(source))), F.lower(F.trim(col(media_type))), F.trim(col(slug)))


def unit_key(source, unit_type, slug) -> Column:
    """`source:unit_type:slug`."""
    return item_key(source, unit_type, slug)
