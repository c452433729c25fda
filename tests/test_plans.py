"""Plan shapes that matter at scale."""

import re

from pyspark.sql import functions as F

from showledger.operators import merge as M, ranking


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_incremental_merge_keeps_target_in_place(spark, sf):
    """A small batch joins the target by broadcast; only the batch side is shuffled."""
    target = spark.read.parquet(sf + "/orders.parquet").select(F.col("o_orderkey").alias("k"), "o_orderstatus")
    batch = target.limit(5)
    plan = plan_of(M.merge(target, batch, ["k"], {"o_orderstatus": M.if_present}, unique=True, incremental=True))
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
    first = plan[: plan.index("LeftAnti")]
    assert not re.search(r"Exchange hashpartitioning\(s_k", first)


def test_merge_picks_plan_by_size(spark, sf):
    target = spark.read.parquet(sf + "/orders.parquet").select(F.col("o_orderkey").alias("k"), "o_orderstatus")
    small = plan_of(M.merge(target, target.limit(5), ["k"], {}, unique=True))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = plan_of(M.merge(target, target, ["k"], {}, unique=True))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "FullOuter" in large and "FullOuter" not in small


def test_group_limit_runs_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    plan = plan_of(ranking.keep_first(df, ["g"], [F.col("id")]))
    assert "Partial" in plan[plan.index("Exchange"):] and plan.count("WindowGroupLimit") == 2


def test_page_scan_is_pruned(spark, sf):
    """A two-column projection reads two columns."""
    df = spark.read.parquet(sf + "/lineitem.parquet")
    plan = plan_of(M.ensure_parents(df.select("l_partkey").distinct().select(F.col("l_partkey").cast("string").alias("k"), F.lit("t").alias("t")),
                                    df.select(F.col("l_partkey").cast("string").alias("k"), F.col("l_shipdate").alias("at")), "k", "t", "at"))
    assert "l_quantity" not in plan
