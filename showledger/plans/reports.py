"""Coverage, freshness and gap reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.text import is_blank

_STAMP = "yyyy-MM-dd HH:mm:ss"


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)


def coverage_report(items: DataFrame, units: DataFrame, *, ready: Column, parent: str = "parent_slug") -> DataFrame:
    """Per source: items, detail-ready items, episodes, chapters, their distinct
    parents and the latest updates; a source may exist on one side only.

    Units are first reduced to (source, type, parent), which makes the distinct
    parent counts plain sums and keeps a dominant source spread over its parents.
    """
    left = items.groupBy("source").agg(
        F.count("*").alias("items"), F.count_if(ready).alias("detail_ready"), F.max("updated_at").alias("_li")
    )
    named = F.nullif(F.trim(F.coalesce(F.col(parent).cast("string"), F.lit(""))), F.lit(""))
    per_parent = units.groupBy("source", "unit_type", named.alias("_parent")).agg(
        F.count("*").alias("_n"), F.max("updated_at").alias("_lu")
    )
    total = lambda kind: F.coalesce(F.sum(F.when(F.col("unit_type") == kind, F.col("_n"))), F.lit(0)).cast("bigint")
    parents = lambda kind: F.count_if((F.col("unit_type") == kind) & F.col("_parent").isNotNull())
    right = per_parent.groupBy("source").agg(
        parents("episode").alias("episode_parents"), total("episode").alias("episodes"),
        parents("chapter").alias("chapter_parents"), total("chapter").alias("chapters"), F.max("_lu").alias("_lu"),
    )
    stamp = lambda c: F.coalesce(F.date_format(c, _STAMP), F.lit("-"))
    counts = ["items", "detail_ready", "episode_parents", "episodes", "chapter_parents", "chapters"]
    return left.join(right, "source", "full_outer").select(
        "source", *[_zero(c) for c in counts], stamp("_li").alias("latest_item_utc"), stamp("_lu").alias("latest_unit_utc")
    ).orderBy("source")


def freshness_report(items: DataFrame, units: DataFrame, now: Column, fresh_h: int = rules.FRESH_HOURS, stale_h: int = rules.STALE_HOURS) -> DataFrame:
    """Per source: counts, latest touch, whole minutes since, fresh / stale / late."""
    left = items.groupBy("source").agg(F.count("*").alias("items"), F.max("updated_at").alias("_li"))
    right = units.groupBy("source").agg(
        F.count_if(F.col("unit_type") == "episode").alias("episodes"),
        F.count_if(F.col("unit_type") == "chapter").alias("chapters"), F.max("updated_at").alias("_lu"),
    )
    epoch = F.timestamp_seconds(F.lit(0))
    touch = F.greatest(F.coalesce("_li", epoch), F.coalesce("_lu", epoch))
    seconds = (F.unix_micros(now) - F.unix_micros(F.col("_touch"))) / F.lit(1_000_000)
    hours = lambda h: now - F.make_dt_interval(F.lit(0), F.lit(h))
    status = F.when(F.col("_touch") >= hours(fresh_h), "fresh").when(F.col("_touch") >= hours(stale_h), "stale").otherwise("late")
    return (
        left.join(right, "source", "full_outer")
        .withColumn("_touch", touch)
        .select(
            "source", _zero("items"), _zero("episodes"), _zero("chapters"), F.date_format("_touch", _STAMP).alias("latest_touch_utc"),
            F.floor(seconds / 60).cast("bigint").alias("age_minutes"), status.alias("status"),
        )
        .orderBy("source")
    )


def gap_report(items: DataFrame, units: DataFrame, exceptions: DataFrame, *, key: str = "slug", parent: str = "parent_slug") -> DataFrame:
    """One row of counts: ready items, parents with units, exceptions, ready items
    that have neither units nor an exception."""
    def told(df: DataFrame, slug: str, what: str) -> DataFrame:
        return df.select(F.col(slug).alias("slug"), *[F.lit(int(n == what)).alias(n) for n in ("ready", "kid", "excuse")])

    rows = told(items, key, "ready").unionByName(told(units.filter(~is_blank(parent)), parent, "kid")).unionByName(told(exceptions.filter(~is_blank("slug")), "slug", "excuse"))
    each = rows.groupBy("slug").agg(F.sum("ready").alias("ready"), F.max("kid").alias("kid"), F.sum("excuse").alias("excuse"))
    return each.agg(
        F.coalesce(F.sum("ready"), F.lit(0)).alias("detail_ready"), F.count_if(F.col("kid") == 1).alias("with_children"),
        F.coalesce(F.sum("excuse"), F.lit(0)).alias("exceptions"),
        F.coalesce(F.sum(F.when((F.col("kid") == 0) & (F.col("excuse") == 0), F.col("ready"))), F.lit(0)).alias("pending"))


def recent_parents(units: DataFrame, parent: str = "parent_slug") -> DataFrame:
    """Parents by their latest unit update, newest first."""
    return (
        units.filter(~is_blank(parent)).groupBy(parent).agg(F.max("updated_at").alias("latest"))
        .orderBy(F.col("latest").desc(), parent)
    )


def host_summary(entries: DataFrame, source: str = "source_type", host: str = "final_host") -> DataFrame:
    """Entries per (source, host); a blank host is `unresolved`."""
    named = F.when(is_blank(host), "unresolved").otherwise(F.col(host))
    return entries.groupBy(source, named.alias("host")).agg(F.count("*").alias("n"))
