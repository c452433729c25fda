from __future__ import annotations

from pyspark.sql import functions as F

from showledger.operators import quality as X

from .base import Tables, at, query
from .taxonomy import CLASSIFIED_SQL, classified

S = F.lit


@query("quality_violations", "WITH " + CLASSIFIED_SQL + """,
v AS (SELECT CAST(doc_id AS VARCHAR) AS key, unnest([CASE WHEN n < 200 THEN 'release_year_range' END, CASE WHEN n > 3000 THEN 'detail_not_object' END, CASE WHEN source = 'src8' THEN 'surface_type_enum' END,
  CASE WHEN source = 'src9' THEN 'taxonomy_confidence_range' END, CASE WHEN lang = 'de' THEN 'release_day_enum' END, CASE WHEN n BETWEEN 600 AND 650 THEN 'slug_blank' END]) AS rule FROM c)
SELECT rule, key FROM v WHERE rule IS NOT NULL
""")
def _violations(t: Tables):
    n = F.col("n_chars")
    df = classified(t).withColumns({
        "release_year": F.when(n < 200, 17).otherwise(2000), "detail": F.when(n > 3000, '["a"]').otherwise(F.col("detail")),
        "surface_type": F.when(F.col("source") == "src8", "radio").otherwise(F.col("surface_type")),
        "taxonomy_confidence": F.when(F.col("source") == "src9", 101).otherwise(F.col("taxonomy_confidence")),
        "release_day": F.when(F.col("media_type") == "drama", "someday").otherwise(F.col("release_day")),
        "slug": F.when(n.between(600, 650), " ").otherwise(F.col("slug"))})
    return X.validate(df, X.item_checks(), F.col("item_key"))


@query("unit_violations", """
WITH v AS (SELECT CAST(o_orderkey AS VARCHAR) AS key, unnest([CASE WHEN o_orderstatus = 'P' THEN 'source_blank' END, CASE WHEN o_orderpriority = '5-LOW' THEN 'unit_type_blank' END,
  CASE WHEN o_custkey % 3 = 0 THEN 'slug_blank' END, CASE WHEN o_custkey % 5 = 0 THEN 'detail_not_object' END]) AS rule FROM orders)
SELECT rule, key FROM v WHERE rule IS NOT NULL
""")
def _unit_violations(t: Tables):
    o = t.orders
    df = o.select(F.col("o_orderkey").cast("string").alias("key"), F.when(F.col("o_orderstatus") != "P", "s").alias("source"), F.when(F.col("o_orderpriority") == "5-LOW", " ").otherwise("episode").alias("unit_type"),
                  F.when(F.col("o_custkey") % 3 == 0, "").otherwise("x").alias("slug"), F.when(F.col("o_custkey") % 5 == 0, "[1]").otherwise("{}").alias("detail"))
    return X.validate(df, X.unit_checks(), F.col("key")).select("rule", "key")


@query("unique_violations", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _unique(t: Tables):
    return X.check_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("reference_violations", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type <> 'PROMO')")
def _fk(t: Tables):
    out = X.check_fk(t.lineitem, t.part.filter(F.col("p_type") != "PROMO"), "l_partkey", "p_partkey")
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")


@query("cascade_delete", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def _cascade(t: Tables):
    return X.cascade_delete(t.orders, t.customer.filter(F.col("c_acctbal") < 0), "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


@query("existing_flags", "SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 490000) AS known FROM customer")
def _existing(t: Tables):
    target = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return X.with_existing(t.customer, target, ["c_custkey"], F.col("o_totalprice") > 490000).select("c_custkey", F.col("exists").alias("known"))


@query("enrichment_checks", "SELECT 'match_score_range' AS rule, CAST(event_id AS VARCHAR) AS key FROM events WHERE value > 100 UNION ALL SELECT 'provider_blank', CAST(event_id AS VARCHAR) FROM events WHERE event_type = 'error'")
def _enrichment(t: Tables):
    df = t.events.select("event_id", F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("provider"), S("matched").alias("match_status"),
                         F.col("value").alias("match_score"), S(None).cast("int").alias("matched_year"), F.col("props").alias("payload"))
    return X.validate(df, X.enrichment_checks(), F.col("event_id"))


del at
