from __future__ import annotations

from pyspark.sql import functions as F

from showledger.functions import urls
from showledger.operators.ranking import recent
from showledger.plans.backfill import plan_backfill
from showledger.plans.enrichment import run_counters, run_failures, run_report
from showledger.plans.reports import coverage_report, freshness_report, gap_report, host_summary, recent_parents

from .base import SHOP_SQL, Tables, at, query, shop_items, shop_units, shown

NOW = "2001-08-01 06:30:00"


@query("coverage_report", f"""
WITH {SHOP_SQL},
i AS (SELECT source, count(*) AS items, count(*) FILTER (c_acctbal > 0) AS detail_ready, max(updated_at) AS li FROM items GROUP BY 1),
u AS (SELECT source,
        count(DISTINCT parent_slug) FILTER (unit_type = 'episode' AND parent_slug <> '') AS episode_parents,
        count(*) FILTER (unit_type = 'episode') AS episodes,
        count(DISTINCT parent_slug) FILTER (unit_type = 'chapter' AND parent_slug <> '') AS chapter_parents,
        count(*) FILTER (unit_type = 'chapter') AS chapters, max(updated_at) AS lu FROM units GROUP BY 1)
SELECT coalesce(i.source, u.source) AS source, coalesce(items, 0) AS items, coalesce(detail_ready, 0) AS detail_ready,
       coalesce(episode_parents, 0) AS episode_parents, coalesce(episodes, 0) AS episodes,
       coalesce(chapter_parents, 0) AS chapter_parents, coalesce(chapters, 0) AS chapters,
       coalesce(strftime(li, '%Y-%m-%d %H:%M:%S'), '-') AS latest_item_utc,
       coalesce(strftime(lu, '%Y-%m-%d %H:%M:%S'), '-') AS latest_unit_utc
FROM i FULL OUTER JOIN u ON i.source = u.source
""")
def _coverage(t: Tables):
    return coverage_report(shop_items(t), shop_units(t), ready=F.col("c_acctbal") > 0)


# items by language, units by event type: some sources exist on one side only
_SIDES_SQL = """
items AS (SELECT lang AS source, TIMESTAMP '2024-01-30' + to_minutes(n_chars) AS updated_at FROM documents),
units AS (SELECT CASE event_type WHEN 'view' THEN 'en' WHEN 'click' THEN 'de' ELSE event_type END AS source,
                 CASE WHEN value > 20 THEN 'chapter' ELSE 'episode' END AS unit_type, ts AS updated_at FROM events)
"""


@query("freshness_report", f"""
WITH {_SIDES_SQL},
i AS (SELECT source, count(*) AS items, max(updated_at) AS li FROM items GROUP BY 1),
u AS (SELECT source, count(*) FILTER (unit_type = 'episode') AS episodes, count(*) FILTER (unit_type = 'chapter') AS chapters,
             max(updated_at) AS lu FROM units GROUP BY 1),
m AS (SELECT coalesce(i.source, u.source) AS source, coalesce(items, 0) AS items, coalesce(episodes, 0) AS episodes,
             coalesce(chapters, 0) AS chapters,
             greatest(coalesce(li, TIMESTAMP '1970-01-01'), coalesce(lu, TIMESTAMP '1970-01-01')) AS touch
      FROM i FULL OUTER JOIN u ON i.source = u.source)
SELECT source, items, episodes, chapters, strftime(touch, '%Y-%m-%d %H:%M:%S') AS latest_touch_utc,
       CAST(floor((epoch_us(TIMESTAMP '2024-01-31 04:00:00') - epoch_us(touch)) / 1000000.0 / 60) AS BIGINT) AS age_minutes,
       CASE WHEN touch >= TIMESTAMP '2024-01-31 00:00:00' THEN 'fresh' WHEN touch >= TIMESTAMP '2024-01-30 20:00:00' THEN 'stale' ELSE 'late' END AS status
FROM m
""")
def _freshness(t: Tables):
    items = t.documents.select(F.col("lang").alias("source"), (at("2024-01-30 00:00:00") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("n_chars").cast("int"))).alias("updated_at"))
    kind = F.col("event_type")
    units = t.events.select(
        F.when(kind == "view", "en").when(kind == "click", "de").otherwise(kind).alias("source"),
        F.when(F.col("value") > 20, "chapter").otherwise("episode").alias("unit_type"), F.col("ts").alias("updated_at"))
    return freshness_report(items, units, at("2024-01-31 04:00:00"))


@query("gap_report", f"""
WITH {SHOP_SQL},
ready AS (SELECT slug FROM items WHERE c_acctbal > 0),
kids AS (SELECT DISTINCT parent_slug AS slug FROM units WHERE unit_type = 'chapter'),
exceptions AS (SELECT slug FROM items WHERE c_nationkey = 3)
SELECT (SELECT count(*) FROM ready) AS detail_ready, (SELECT count(*) FROM kids) AS with_children,
       (SELECT count(*) FROM exceptions) AS exceptions,
       (SELECT count(*) FROM ready r WHERE NOT EXISTS (SELECT 1 FROM kids k WHERE k.slug = r.slug)
          AND NOT EXISTS (SELECT 1 FROM exceptions x WHERE x.slug = r.slug)) AS pending
""")
def _gap(t: Tables):
    items = shop_items(t)
    chapters = shop_units(t).filter(F.col("unit_type") == "chapter")
    return gap_report(items.filter(F.col("c_acctbal") > 0), chapters, items.filter(F.col("c_nationkey") == 3).select("slug"))


@query("recent_parents", f"""
WITH {SHOP_SQL}
SELECT parent_slug, strftime(max(updated_at), '%Y-%m-%d %H:%M:%S') AS latest FROM units WHERE parent_slug <> '' GROUP BY 1
""")
def _recent_parents(t: Tables):
    return recent_parents(shop_units(t)).select("parent_slug", shown("latest").alias("latest"))


@query("recent_items", f"""
WITH {SHOP_SQL}
SELECT item_key, slug, strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at FROM items WHERE source = 'building'
ORDER BY items.updated_at DESC NULLS LAST, item_key LIMIT 20
""")
def _recent_items(t: Tables):
    return recent(shop_items(t), "building", 20).select("item_key", "slug", shown("updated_at").alias("updated_at"))


@query("host_summary", r"""
SELECT regexp_extract(html, '<html lang="([a-z]+)"', 1) AS source_type,
       CASE WHEN url LIKE 'https://%' THEN regexp_replace(regexp_extract(lower(url), '^https?://([^/?#:]*)', 1), '^www\.', '') ELSE 'unresolved' END AS host,
       count(*) AS n
FROM pages GROUP BY 1, 2
""")
def _host_summary(t: Tables):
    entries = t.pages.select(
        F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("source_type"),
        F.when(F.col("url").startswith("https://"), urls.host_norm("url")).alias("final_host"))
    return host_summary(entries)


_PLAN_SQL = f"""
WITH {SHOP_SQL},
catalog AS (SELECT slug, media_type = 'movie' OR c_nationkey = 7 AS movie FROM items),
known AS (SELECT DISTINCT parent_slug AS slug FROM units WHERE o_totalprice > 450000),
seen AS (SELECT DISTINCT slug FROM catalog WHERE NOT movie),
plan AS (
  SELECT slug, 'skip' AS action, 'movie_without_episode_backfill' AS reason FROM catalog WHERE movie
  UNION ALL SELECT s.slug, CASE WHEN k.slug IS NOT NULL THEN 'skip' ELSE 'attempt' END, CASE WHEN k.slug IS NOT NULL THEN 'already_backfilled' ELSE '' END
  FROM seen s LEFT JOIN known k ON k.slug = s.slug)
"""


def _plan(t: Tables, limit: int = 0):
    known = shop_units(t).filter(F.col("o_totalprice") > 450000).select(F.col("parent_slug").alias("slug"))
    catalog = shop_items(t).select("slug", F.col("media_type").alias("content_type"), F.when(F.col("c_nationkey") == 7, "Movie").alias("anime_type"))
    return plan_backfill(catalog, known, ["slug"], limit=limit)


@query("backfill_plan", _PLAN_SQL + "SELECT slug, action, reason FROM plan")
def _backfill_plan(t: Tables):
    return _plan(t)


@query("backfill_plan_limited", _PLAN_SQL + """
SELECT slug, action, reason FROM plan WHERE slug < coalesce((SELECT slug FROM seen ORDER BY slug LIMIT 1 OFFSET 400), '~')
""")
def _backfill_plan_limited(t: Tables):
    """The run's own limit of 400 attempts: it ends at the next slug, and movies after that are not reported."""
    return _plan(t, 400)


@query("run_report", _PLAN_SQL + "SELECT action, reason, count(*) AS n FROM plan GROUP BY 1, 2")
def _run_report(t: Tables):
    return run_report(_plan(t))


@query("run_failures", """
SELECT CAST(user_id AS VARCHAR) AS slug, arg_max(props, event_id) AS error FROM events WHERE event_type = 'error' GROUP BY 1
""")
def _run_failures(t: Tables):
    e = t.events.select(F.col("user_id").cast("string").alias("slug"), F.when(F.col("event_type") == "error", "fail").otherwise("success").alias("outcome"), F.col("props").alias("error"), "event_id")
    return run_failures(e, order=[F.col("event_id")])


@query("run_counters", """
SELECT count(*) AS discovered, count(*) FILTER (event_type IN ('view', 'click', 'error')) AS attempted,
       count(*) FILTER (event_type IN ('signup', 'purchase')) AS skipped,
       count(*) FILTER (event_type IN ('view', 'click')) AS succeeded, count(*) FILTER (event_type = 'error') AS failed FROM events
""")
def _run_counters(t: Tables):
    e = F.col("event_type")
    return run_counters(t.events.select(F.when(e.isin("view", "click"), "success").when(e == "error", "fail").otherwise("skip").alias("outcome")))
