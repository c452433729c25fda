"""Registry and table loading."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from showledger.session import adopt, spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, when it has one, its SQL equivalent."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(adopt(spark), sf_dir))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


class Tables:
    """Tables of one scale folder; zone-less timestamps are read as UTC."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        zoneless = {c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"}
        return df.withColumns(zoneless) if zoneless else df


    def heavy(self, name: str) -> DataFrame:
        """A table about to get CPU-heavy per-row work (dealt out when it has few splits)."""
        return spread(getattr(self, name))


def at(stamp: str) -> Column:
    return F.to_timestamp(F.lit(stamp))


def shown(c) -> Column:
    """Timestamp as comparable text."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def r6(c) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def joined(c) -> Column:
    """Array as comparable text."""
    return F.array_join(c, "|")


# -- canonical shapes bound to customer (items) and orders (units) --------------

def shop_items(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(
        F.col("c_custkey").cast("string").alias("item_key"), F.lower("c_mktsegment").alias("source"),
        F.when(F.col("c_acctbal") < 0, "movie").when(F.col("c_acctbal") >= 5000, "anime").otherwise("donghua").alias("media_type"),
        F.lower(F.replace("c_name", F.lit("#"), F.lit("-"))).alias("slug"), F.col("c_name").alias("title"),
        "c_acctbal", "c_nationkey",
        (at("1995-01-01 00:00:00") + F.make_dt_interval(F.col("c_nationkey"))).alias("updated_at"),
    )


def shop_units(t: Tables) -> DataFrame:
    owner = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_name")
    return t.orders.join(owner, "o_custkey").select(
        F.col("o_orderkey").cast("string").alias("unit_key"), F.col("o_custkey").cast("string").alias("item_key"),
        F.lower("c_mktsegment").alias("source"), F.when(F.col("o_orderstatus") == "F", "chapter").otherwise("episode").alias("unit_type"),
        F.lower(F.replace("c_name", F.lit("#"), F.lit("-"))).alias("parent_slug"), "o_orderstatus", "o_orderpriority", "o_totalprice",
        F.col("o_orderdate").alias("updated_at"),
    )


SHOP_SQL = """
items AS (
  SELECT CAST(c_custkey AS VARCHAR) AS item_key, lower(c_mktsegment) AS source,
         CASE WHEN c_acctbal < 0 THEN 'movie' WHEN c_acctbal >= 5000 THEN 'anime' ELSE 'donghua' END AS media_type,
         lower(replace(c_name, '#', '-')) AS slug, c_name AS title, c_acctbal, c_nationkey,
         TIMESTAMP '1995-01-01' + to_days(c_nationkey) AS updated_at
  FROM customer),
units AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS unit_key, CAST(o_custkey AS VARCHAR) AS item_key, lower(c_mktsegment) AS source,
         CASE WHEN o_orderstatus = 'F' THEN 'chapter' ELSE 'episode' END AS unit_type,
         lower(replace(c_name, '#', '-')) AS parent_slug, o_orderstatus, o_orderpriority, o_totalprice,
         CAST(o_orderdate AS TIMESTAMP) AS updated_at
  FROM orders JOIN customer ON c_custkey = o_custkey)
"""
