"""Which titles to publish again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.dates import iso_z
from ..operators.ranking import top_per_group


def domains_of(domain_rules: list) -> Column:
    """array<struct<domain, unit_type>> of the rules a row meets."""
    found = []
    for name, sources, kinds, unit_type in domain_rules:
        hit = F.lit(True)
        if sources != "*":
            hit = hit & F.col("source").isin(list(sources))
        if kinds != "*":
            hit = hit & F.col("media_type").isin(list(kinds))
        domain = F.col("source") if name == "@source" else F.lit(name)
        found.append(F.when(hit, F.struct(domain.alias("domain"), F.lit(unit_type).alias("unit_type"))))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def patch_targets(items: DataFrame, units: DataFrame, now: Column, lookback_minutes: int = rules.LOOKBACK_MINUTES,
                  top: int = rules.TARGETS_PER_DOMAIN, domain_rules: list = rules.DOMAIN_RULES) -> DataFrame:
    """(domain, slug, touched_at): the latest-touched titles of every domain.

    A title is touched by its own update or by a unit of the domain's unit type.
    All domains share one plan. Only units inside the lookback can matter - an
    older unit never lifts a title over the cut-off - so older ones are filtered
    at the scan. Items are split at the cut-off too: the recent ones are few after
    the pushed-down filter, and the others need an inner join with the recent
    units, which lets Spark filter them at runtime before any shuffle.
    """
    cutoff = now - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(lookback_minutes))
    types = sorted({r[3] for r in domain_rules})
    last = lambda t: F.max("updated_at") if t == "*" else F.max(F.when(F.col("unit_type") == t, F.col("updated_at")))
    recent = units.filter(F.col("updated_at") >= cutoff).groupBy("item_key").agg(*[last(t).alias("_u_" + t) for t in types])
    slim = items.select("item_key", "slug", "updated_at", "source", "media_type")
    fresh = slim.filter(F.col("updated_at") >= cutoff).join(recent, "item_key", "left")
    older = slim.filter(F.col("updated_at") < cutoff).join(recent, "item_key")
    member = fresh.unionByName(older).withColumn("_d", F.explode(domains_of(domain_rules)))
    by_type = None
    for t in types:
        hit = F.col("_d.unit_type") == t
        by_type = F.when(hit, F.col("`_u_" + t + "`")) if by_type is None else by_type.when(hit, F.col("`_u_" + t + "`"))
    touched = member.select(
        F.col("_d.domain").alias("domain"), "slug", F.greatest("updated_at", by_type).alias("touched_at")
    ).filter(F.col("touched_at") >= cutoff)
    newest = touched.groupBy("domain", "slug").agg(F.max("touched_at").alias("touched_at"))
    best = top_per_group(newest, ["domain"], [F.col("touched_at").desc(), F.col("slug")], top)
    return best.orderBy(F.col("touched_at").desc(), "domain", "slug").select("domain", "slug", iso_z("touched_at").alias("touched_at"))
