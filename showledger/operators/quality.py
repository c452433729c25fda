"""Row checks, uniqueness and references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.text import is_blank

# Allowed classes
SURFACES = ["unknown", "movie", "series", "comic", "novel"]
PRESENTATIONS = ["unknown", "animation", "live_action", "illustrated"]


def not_object(c: str) -> Column:
    """True when JSON text is not an object."""
    return ~F.coalesce(F.schema_of_variant(F.try_parse_json(c)).startswith("OBJECT"), F.lit(False))


def item_checks() -> dict[str, Column]:
    """rule name -> true when an item row breaks it."""
    optional = lambda c: F.col(c).isNotNull() & (F.trim(c) == "")
    return {
        "source_blank": is_blank("source"), "media_type_blank": is_blank("media_type"), "slug_blank": is_blank("slug"),
        "release_year_range": F.col("release_year").isNotNull() & ~F.col("release_year").between(1800, 9999),
        "detail_not_object": not_object("detail"),
        "surface_type_enum": ~F.coalesce(F.col("surface_type"), F.lit("")).isin(SURFACES),
        "presentation_type_enum": ~F.coalesce(F.col("presentation_type"), F.lit("")).isin(PRESENTATIONS),
        "origin_type_blank": is_blank("origin_type"), "taxonomy_source_blank": is_blank("taxonomy_source"),
        "taxonomy_confidence_range": ~F.coalesce(F.col("taxonomy_confidence"), F.lit(-1)).between(0, 100),
        "release_day_enum": F.col("release_day").isNotNull() & ~F.col("release_day").isin(rules.WEEKDAY_ORDER),
        "cadence_enum": F.col("cadence").isNotNull() & ~F.col("cadence").isin(rules.CADENCES),
        "release_window_blank": optional("release_window"), "release_timezone_blank": optional("release_timezone"),
    }


def unit_checks() -> dict[str, Column]:
    return {
        "source_blank": is_blank("source"), "unit_type_blank": is_blank("unit_type"), "slug_blank": is_blank("slug"),
        "detail_not_object": not_object("detail"),
    }


def enrichment_checks() -> dict[str, Column]:
    return {
        "provider_blank": is_blank("provider"), "match_status_blank": is_blank("match_status"),
        "match_score_range": ~F.coalesce(F.col("match_score"), F.lit(-1)).between(0, 100),
        "matched_year_range": F.col("matched_year").isNotNull() & ~F.col("matched_year").between(1800, 9999),
        "payload_not_object": not_object("payload"),
    }


def validate(df: DataFrame, checks: dict[str, Column], key: Column) -> DataFrame:
    """(rule, key) for every broken check; one pass over the rows."""
    broken = F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(rule)) for rule, bad in checks.items()])
    return df.select(
        F.explode(F.filter(broken, lambda r: r.isNotNull())).alias("rule"), key.cast("string").alias("key")
    )


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def check_fk(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose parent is missing."""
    return child.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def cascade_delete(child: DataFrame, deleted_parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows left after their parents are deleted."""
    return child.join(deleted_parents.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def with_existing(batch: DataFrame, target: DataFrame, keys: list[str], ready: Column | None = None) -> DataFrame:
    """Batch rows flagged by whether the target already holds their key (and is ready)."""
    known = (target if ready is None else target.filter(ready)).select(*keys).distinct().withColumn("_hit", F.lit(True))
    return batch.join(known, keys, "left").withColumn("exists", F.coalesce("_hit", F.lit(False))).drop("_hit")
