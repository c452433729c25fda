from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from showledger.plans.publish import patch_targets
from showledger.session import shared_dir
from showledger.sources.snapshot import build_snapshot, manifest, patch_snapshot, patched, snapshot_documents, touched_items

from .base import SHOP_SQL, Tables, at, query, shop_items, shop_units, shown

# domain rules over the shop sources
SHOP_DOMAINS = [
    ("anime", ["automobile", "furniture"], ["anime"], "episode"),
    ("movie", "*", ["movie"], "*"),
    ("@source", ["building", "machinery"], "*", "chapter"),
    ("donghua", "*", ["donghua"], "episode"),
]
NOW = "2001-08-01 12:00:00"


@query("patch_targets", f"""
WITH {SHOP_SQL},
member AS (
  SELECT 'anime' AS domain, item_key, slug, updated_at, 'episode' AS ut FROM items WHERE source IN ('automobile','furniture') AND media_type = 'anime'
  UNION ALL SELECT 'movie', item_key, slug, updated_at, '*' FROM items WHERE media_type = 'movie'
  UNION ALL SELECT source, item_key, slug, updated_at, 'chapter' FROM items WHERE source IN ('building','machinery')
  UNION ALL SELECT 'donghua', item_key, slug, updated_at, 'episode' FROM items WHERE media_type = 'donghua'),
touched AS (
  SELECT m.domain, m.slug, greatest(m.updated_at, coalesce(max(u.updated_at), m.updated_at)) AS touched
  FROM member m LEFT JOIN units u ON u.item_key = m.item_key AND (m.ut = '*' OR u.unit_type = m.ut)
  GROUP BY m.domain, m.item_key, m.slug, m.updated_at),
ranked AS (
  SELECT domain, slug, touched, row_number() OVER (PARTITION BY domain ORDER BY touched DESC, slug) AS rn
  FROM touched WHERE touched >= TIMESTAMP '{NOW}' - INTERVAL 20 DAY)
SELECT domain, slug, strftime(touched, '%Y-%m-%dT%H:%M:%SZ') AS touched_at FROM ranked WHERE rn <= 8
""")
def _patch_targets(t: Tables):
    return patch_targets(shop_items(t), shop_units(t), at(NOW), lookback_minutes=20 * 24 * 60, top=8, domain_rules=SHOP_DOMAINS)


_TOUCHED = f"""
{SHOP_SQL},
titles AS (
  SELECT i.item_key, i.source AS domain, i.slug, i.title,
         greatest(i.updated_at, coalesce(max(u.updated_at), i.updated_at)) AS touched_at, count(u.unit_key) AS unit_count
  FROM items i LEFT JOIN units u ON u.item_key = i.item_key GROUP BY i.item_key, i.source, i.slug, i.title, i.updated_at),
"""
_PACK = _TOUCHED + """
pack AS (
  SELECT domain, 'catalog' AS kind, slug AS title_slug, slug, touched_at FROM titles
  UNION ALL SELECT domain, 'title', slug, slug, touched_at FROM titles
  UNION ALL SELECT domain, 'search', slug, slug, touched_at FROM titles
  UNION ALL SELECT domain, 'home', slug, slug, touched_at FROM (
    SELECT *, row_number() OVER (PARTITION BY domain ORDER BY touched_at DESC, slug, item_key) AS rn FROM titles) WHERE rn <= 8
  UNION ALL SELECT t.domain, 'playback', t.slug, u.unit_key, u.updated_at FROM units u JOIN titles t ON t.item_key = u.item_key)
"""


def _units_with_slug(t: Tables):
    return shop_units(t).withColumn("slug", F.col("unit_key"))


@query("touched_titles", "WITH " + _TOUCHED.rstrip().rstrip(",") + """
SELECT domain, slug, strftime(touched_at, '%Y-%m-%d %H:%M:%S') AS touched_at, unit_count FROM titles
""")
def _touched(t: Tables):
    return touched_items(shop_items(t), shop_units(t), F.col("source")).select("domain", "slug", shown("touched_at").alias("touched_at"), "unit_count")


@query("snapshot_manifest", "WITH " + _PACK + """
SELECT domain, kind, count(*) AS documents, strftime(max(touched_at), '%Y-%m-%dT%H:%M:%SZ') AS touched_at FROM pack GROUP BY 1, 2
""")
def _snapshot(t: Tables):
    return manifest(snapshot_documents(shop_items(t), _units_with_slug(t), F.col("source"), 8))


# a patch replaces the title and playback documents of recently touched titles; the episodes of urgent orders are new in it
_PATCHED = "WITH " + _PACK + f"""
, targets AS (SELECT DISTINCT domain, slug FROM titles WHERE touched_at >= TIMESTAMP '2001-07-01'),
urgent AS (SELECT unit_key FROM units WHERE o_orderpriority = '1-URGENT'),
next AS (
  SELECT p.domain, p.kind, p.title_slug, p.slug,
         CASE WHEN p.kind IN ('title', 'playback') AND g.slug IS NOT NULL THEN TIMESTAMP '{NOW}' ELSE p.touched_at END AS touched_at
  FROM pack p LEFT JOIN targets g ON g.domain = p.domain AND g.slug = p.title_slug
  WHERE p.kind <> 'playback' OR g.slug IS NOT NULL OR p.slug NOT IN (SELECT unit_key FROM urgent))
"""


def _patch(t: Tables):
    """(items, units of the old pack, targets, documents of the patch)."""
    items, units = shop_items(t), _units_with_slug(t)
    titles = touched_items(items, units, F.col("source"))
    targets = titles.filter(F.col("touched_at") >= at("2001-07-01 00:00:00")).select("domain", "slug")
    docs = snapshot_documents(items, units, F.col("source"), 8).filter(F.col("kind").isin("title", "playback")).withColumn("touched_at", at(NOW))
    return items, units, targets, docs


def _old_pack(t: Tables, items, units):
    """All documents but the playback documents of urgent orders."""
    late = units.filter("o_orderpriority = '1-URGENT'").select(F.col("unit_key").alias("slug"), F.lit("playback").alias("kind"))
    return snapshot_documents(items, units, F.col("source"), 8).join(late, ["slug", "kind"], "left_anti")


@query("snapshot_patched", _PATCHED + "SELECT domain, kind, title_slug, slug, strftime(touched_at, '%Y-%m-%d %H:%M:%S') AS touched_at FROM next")
def _patched(t: Tables):
    items, units, targets, docs = _patch(t)
    return patched(_old_pack(t, items, units), targets, docs).select("domain", "kind", "title_slug", "slug", shown("touched_at").alias("touched_at"))


@query("snapshot_patch_files", "WITH " + _PACK + f"""
, targets AS (SELECT DISTINCT domain, slug FROM titles WHERE touched_at >= TIMESTAMP '2001-07-01')
SELECT p.domain, p.kind, p.slug, strftime(CASE WHEN p.kind IN ('title', 'playback') AND g.slug IS NOT NULL THEN TIMESTAMP '{NOW}' ELSE p.touched_at END, '%Y-%m-%d %H:%M:%S') AS touched_at
FROM pack p LEFT JOIN targets g ON g.domain = p.domain AND g.slug = p.title_slug
""")
def _patch_files(t: Tables):
    """Written, patched in place and read back; the home documents are refreshed."""
    out = f"{shared_dir(t.spark)}/snapshot-{uuid.uuid4().hex}"
    items, units, targets, docs = _patch(t)
    build_snapshot(items, units, F.col("source"), out, 8, buckets=4)
    home = snapshot_documents(items, units, F.col("source"), 8).filter("kind = 'home'")
    patch_snapshot(out, targets, docs, home)
    return t.spark.read.parquet(out + "/pack").select("domain", "kind", "slug", shown("touched_at").alias("touched_at"))


@query("snapshot_patch_manifest", "WITH " + _PACK + f"""
, targets AS (SELECT DISTINCT domain, slug FROM titles WHERE touched_at >= TIMESTAMP '2001-07-01'),
late AS (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'),
replaced AS (SELECT DISTINCT domain, title_slug FROM pack WHERE kind = 'playback' AND slug NOT IN (SELECT CAST(o_orderkey AS VARCHAR) FROM late)),
next AS (
  SELECT p.domain, p.kind, CASE WHEN p.kind IN ('title', 'playback') AND g.slug IS NOT NULL THEN TIMESTAMP '{NOW}' ELSE p.touched_at END AS touched_at
  FROM pack p LEFT JOIN targets g ON g.domain = p.domain AND g.slug = p.title_slug
  LEFT JOIN replaced r ON r.domain = p.domain AND r.title_slug = p.title_slug
  WHERE NOT (p.kind = 'playback' AND g.slug IS NOT NULL AND r.domain IS NOT NULL AND p.slug IN (SELECT CAST(o_orderkey AS VARCHAR) FROM late)))
SELECT domain, kind, count(*) AS documents, strftime(max(touched_at), '%Y-%m-%dT%H:%M:%SZ') AS touched_at FROM next GROUP BY 1, 2
""")
def _patch_manifest(t: Tables):
    """The manifest kept up by difference: playback documents of urgent orders go from the patched titles that have others."""
    out = f"{shared_dir(t.spark)}/snapshot-{uuid.uuid4().hex}"
    items, units, targets, docs = _patch(t)
    build_snapshot(items, units, F.col("source"), out, 8, buckets=8)
    urgent = units.filter("o_orderpriority = '1-URGENT'").select(F.col("slug"), F.lit("playback").alias("kind"))
    return patch_snapshot(out, targets, docs.join(urgent, ["slug", "kind"], "left_anti"))
