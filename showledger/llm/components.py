"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def _least(edges: DataFrame, name: str) -> DataFrame:
    """(u, least neighbour or u itself); combined in the map tasks first."""
    return edges.groupBy(F.col("u").alias(name)).agg(F.min("v").alias("low")).select(name, F.least(name, "low").alias("low"))


def _stars(edges: DataFrame) -> bool:
    """True when every u has one v and no v is a u: the components are found."""
    ends = edges.select(F.col("u").alias("k"), F.lit(1).alias("as_u"), F.lit(0).alias("as_v")).unionByName(
        edges.select(F.col("v").alias("k"), F.lit(0).alias("as_u"), F.lit(1).alias("as_v")))
    open_ = ends.groupBy("k").agg(F.sum("as_u").alias("as_u"), F.max("as_v").alias("as_v")).where("as_u > 1 or (as_u = 1 and as_v = 1)")
    return open_.isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(key, root) of every key in `edges` (u, v), root being the least key of its component.

    Each round shortens paths until only stars are left; the tables hold keys only and are checkpointed after each round.
    """
    now = cut_lineage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not _stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both, "c"), F.col("u") == F.col("c")).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        low = _least(large, "c")
        small = large.join(low, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(low.select(F.col("c").alias("u"), F.col("low").alias("v")))
        now = cut_lineage(small.where("u <> v").distinct())
    return now.select(F.col("u").alias("key"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("key"), F.col("v").alias("root")).distinct())
