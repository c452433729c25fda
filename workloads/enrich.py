from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showledger.operators.matching import pick_best, score_hits
from showledger.plans import enrichment as X
from showledger.plans.backfill import promote_numbered
from showledger.functions.titles import decompose_numbered

from .base import Tables, at, joined, query
from .taxonomy import CLASSIFIED_SQL, classified

S = F.lit


def _items(t: Tables) -> DataFrame:
    return classified(t).withColumn("updated_at", at("2024-01-01 00:00:00") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("n_chars").cast("int")))


def _enrichments(t: Tables) -> DataFrame:
    q = F.col("quality")
    return t.labels.select(
        F.col("doc_id").cast("string").alias("item_key"), F.when(q == 1, "tmdb").otherwise("jikan").alias("provider"),
        F.when(F.col("toxic") == 0, "matched").otherwise("score_rejected").alias("match_status"))


_WORLD = CLASSIFIED_SQL + """,
e AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'tmdb' ELSE 'jikan' END AS provider, toxic = 0 AS ok FROM labels)
"""


@query("candidates_primary", "WITH " + _WORLD + """
SELECT CAST(doc_id AS VARCHAR) AS item_key, surface AS surface_type FROM c
WHERE (surface = 'movie' OR (surface = 'series' AND source IN ('src2', 'src9') AND origin <> 'variety'))
  AND NOT EXISTS (SELECT 1 FROM e WHERE e.doc_id = c.doc_id AND e.provider = 'tmdb' AND e.ok)
""")
def _primary(t: Tables):
    return X.candidates_primary(_items(t), _enrichments(t), series_sources=["src2", "src9"]).orderBy(*X.candidate_order()).select("item_key", "surface_type")


@query("candidates_fallback", "WITH " + _WORLD + """
SELECT CAST(doc_id AS VARCHAR) AS item_key, CAST(confidence AS BIGINT) AS confidence FROM c
WHERE (surface = 'comic' OR (presentation = 'animation' AND surface IN ('movie', 'series')))
  AND (confidence < 70 OR (surface = 'movie' AND NOT EXISTS (SELECT 1 FROM e WHERE e.doc_id = c.doc_id AND provider = 'tmdb' AND ok))
       OR (surface = 'series' AND NOT EXISTS (SELECT 1 FROM e WHERE e.doc_id = c.doc_id AND provider = 'jikan' AND ok)))
""")
def _fallback(t: Tables):
    return X.candidates_fallback(_items(t), _enrichments(t)).select("item_key", F.col("taxonomy_confidence").cast("bigint").alias("confidence"))


def _titled(t: Tables) -> DataFrame:
    """Parts as candidates whose titles come from several places of detail."""
    detail = F.to_json(F.struct(
        F.struct(F.when(F.col("p_size") > 25, F.concat(F.initcap("p_name"), S(" (2020)"))).alias("title_english"), F.array(F.upper("p_name"), F.lower("p_type")).alias("title_synonyms")).alias("search_hit"),
        F.concat("p_name", S("; "), "p_brand").alias("source_title"), F.concat(S(" "), "p_type", S("|"), "p_brand").alias("alt_title")))
    return t.part.select(F.col("p_partkey").cast("string").alias("item_key"), F.col("p_name").alias("title"), F.lit("src").alias("source"), (F.col("p_size") + 1990).alias("release_year"), detail.alias("detail"))


_QUERY_SQL = """
raw AS (SELECT CAST(p_partkey AS VARCHAR) AS item_key, p_size, list_filter([CASE WHEN p_size > 25 THEN upper(left(p_name, 1)) || substr(p_name, 2, strpos(p_name, ' ') - 1) || upper(substr(p_name, strpos(p_name, ' ') + 1, 1)) || substr(p_name, strpos(p_name, ' ') + 2) END,
     p_name, p_brand, upper(p_name), lower(p_type), p_type], lambda x: x IS NOT NULL) AS l FROM part),
q AS (SELECT item_key, p_size, unnest(k) AS query, generate_subscripts(k, 1) - 1 AS query_pos FROM (
  SELECT item_key, p_size, list_filter(l, lambda x, i: list_position(list_transform(l, lambda y: lower(y)), lower(x)) = i) AS k FROM raw))
"""


@query("build_queries", "WITH " + _QUERY_SQL + "SELECT item_key AS query_id, CAST(query_pos AS BIGINT) AS query_pos, query, CAST(1990 + p_size AS BIGINT) AS year FROM q")
def _queries(t: Tables):
    return X.build_queries(_titled(t)).select("query_id", F.col("query_pos").cast("bigint").alias("query_pos"), "query", F.col("year").cast("bigint").alias("year"))


@query("embedded_enrichments", """
SELECT CAST(p_partkey AS VARCHAR) AS item_key, 'jikan' AS provider, CAST(p_partkey AS VARCHAR) AS external_id, 95::BIGINT AS match_score,
  CASE WHEN p_type = 'PROMO' THEN p_name ELSE p_type || ' ' || p_name END AS matched_title, CASE WHEN p_size > 25 THEN 'long' WHEN p_size > 10 THEN 'short' END AS synopsis,
  array_to_string(list_sort(list_distinct(CASE WHEN p_size > 20 THEN [p_brand, 'Drama'] ELSE ['Drama', p_type] END)), '|') AS genres, CASE WHEN p_retailprice > 950 THEN p_retailprice END AS score
FROM part WHERE p_size <= 45
""")
def _embedded(t: Tables):
    n = F.col("p_size")
    detail = F.to_json(F.struct(
        F.when(F.col("p_type") == "PROMO", " ").otherwise(F.concat("p_type", S(" "), "p_name")).alias("source_title"), F.when(n > 25, "long").alias("synopsis_enriched"),
        F.when(n > 10, "short").otherwise(" ").alias("synopsis"), F.when(n > 20, F.array(F.col("p_brand"), S("Drama"), F.concat(S(" "), "p_brand"))).alias("genre_names"),
        F.array(F.col("p_type"), S("Drama")).alias("genres")))
    stamp = at("2024-01-01 00:00:00")
    items = t.part.select(F.col("p_partkey").cast("string").alias("item_key"), F.when(n <= 45, F.col("p_partkey")).alias("mal_id"), F.col("p_name").alias("title"), S("").alias("cover_url"), S("").alias("status"),
                          S(None).cast("int").alias("release_year"), F.when(F.col("p_retailprice") > 950, F.col("p_retailprice")).otherwise(0.0).alias("score"), detail.alias("detail"), stamp.alias("created_at"), stamp.alias("updated_at"))
    js = lambda k: F.get_json_object("payload", "$." + k)
    return X.embedded_enrichments(items).select("item_key", "provider", "external_id", F.col("match_score").cast("bigint").alias("match_score"), "matched_title", js("synopsis").alias("synopsis"),
                                                joined(F.from_json(js("genres"), "array<string>")).alias("genres"), js("score").cast("double").alias("score"))


# hits: the supplier of every lineitem answers the first query of its part
@query("enrich_pipeline", "WITH " + _QUERY_SQL + r""",
h AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS item_key, l_suppkey FROM lineitem),
n AS (SELECT DISTINCT item_key, l_suppkey, CASE WHEN l_suppkey > 90 THEN p_name WHEN l_suppkey > 70 THEN 'the ' || p_name || ' show' ELSE 'supplier' END AS title, 1990 + (l_suppkey // 2) AS yr
      FROM h JOIN part ON CAST(p_partkey AS VARCHAR) = h.item_key),
s AS (SELECT n.*, (CASE WHEN lower(title) = lower(q.query) THEN 100 WHEN contains(lower(title), lower(q.query)) THEN 70 ELSE 0 END) AS ts, 1990 + q.p_size AS qy FROM n JOIN q ON q.item_key = n.item_key AND q.query_pos = 0),
z AS (SELECT *, CASE WHEN ts > 0 THEN ts + CASE WHEN qy = yr THEN 20 WHEN abs(qy - yr) = 1 THEN 5 ELSE 0 END ELSE 0 END AS sc FROM s),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_key ORDER BY sc DESC, l_suppkey) AS rn FROM z) WHERE rn = 1)
SELECT CAST(p_partkey AS VARCHAR) AS item_key, 'tmdb' AS provider, CASE WHEN b.item_key IS NULL THEN 'search_empty' WHEN sc >= 70 THEN 'matched' ELSE CASE WHEN sc = 0 THEN 'score_rejected' ELSE 'score_rejected' END END AS match_status,
  CAST(least(100, coalesce(sc, 0)) AS BIGINT) AS match_score, CASE WHEN sc >= 70 THEN CAST(l_suppkey AS VARCHAR) END AS external_id,
  CASE WHEN sc >= 70 THEN 'Detail ' || l_suppkey ELSE p_name END AS matched_title, CASE WHEN sc >= 70 THEN 'movie' END AS kind, CASE WHEN sc >= 70 AND s_acctbal > 0 THEN s_acctbal END AS rating
FROM part LEFT JOIN b ON b.item_key = CAST(p_partkey AS VARCHAR) LEFT JOIN supplier ON s_suppkey = l_suppkey
""")
def _pipeline(t: Tables):
    items = _titled(t)
    queries = X.build_queries(items)
    pairs = t.lineitem.select(F.col("l_partkey").cast("string").alias("query_id"), "l_suppkey").distinct()
    sk = F.col("l_suppkey")
    hits = pairs.join(items.select(F.col("item_key").alias("query_id"), "title"), "query_id").select(
        "query_id", S(0).alias("query_pos"), sk.cast("int").alias("hit_pos"), sk.cast("string").alias("external_id"),
        F.array(F.when(sk > 90, F.col("title")).when(sk > 70, F.concat(S("the "), "title", S(" show"))).otherwise("supplier")).alias("titles"),
        (F.floor(sk / 2) + 1990).cast("int").alias("year"))
    best = pick_best(items, queries, score_hits(queries, hits, "A"), 70, F.col("title"))
    empty = lambda kind: F.lit(None).cast(kind)
    known = {"external_id": F.col("s_suppkey").cast("string"), "detail_title": F.concat(S("Detail "), "s_suppkey"), "vote_average": F.col("s_acctbal")}
    detail_type = t.spark.createDataFrame([], X.PROVIDER_DETAIL).schema
    details = t.supplier.select(*[known.get(f.name, empty(f.dataType)).alias(f.name) for f in detail_type.fields])
    rows = X.enrichment_rows(best, details, "tmdb", "movie", at("2024-01-01 00:00:00"))
    js = lambda k: F.get_json_object("payload", "$." + k)
    matched = F.col("match_status") == "matched"
    # queries after the first get no hits, so an unmatched part reports its best query
    return rows.select("item_key", "provider", "match_status", F.col("match_score").cast("bigint").alias("match_score"), "external_id", "matched_title",
                       F.when(matched, js("kind")).alias("kind"), js("rating").cast("double").alias("rating"))


LOCKS = [("src1", "*", "*"), ("src0", "anime", "*"), ("src2", "movie", "*"), ("src2", "*", "variety")]


@query("promote_locked", "WITH " + CLASSIFIED_SQL + """,
m AS (SELECT doc_id, quality AS q, toxic AS t, CASE WHEN toxic = 1 THEN 'KR' ELSE 'CN' END AS told FROM labels),
j AS (SELECT c.*, m.doc_id IS NOT NULL AS hit, q, t, told, source = 'src1' OR (source = 'src0' AND mt = 'anime') OR (source = 'src2' AND mt = 'movie') OR (source = 'src2' AND origin = 'variety') AS locked
      FROM c LEFT JOIN m ON m.doc_id = c.doc_id),
k AS (SELECT *, hit AND NOT locked AS open, coalesce(surface = 'comic' OR q = 0, false) AS comic FROM j)
SELECT CAST(doc_id AS VARCHAR) AS item_key, CASE WHEN open AND comic THEN 'comic' ELSE surface END AS surface_type,
  CASE WHEN open AND comic THEN 'illustrated' WHEN open THEN 'animation' ELSE presentation END AS presentation_type,
  CASE WHEN open AND comic THEN CASE told WHEN 'KR' THEN 'manhwa' ELSE 'manhua' END WHEN open THEN CASE told WHEN 'CN' THEN 'donghua' ELSE 'anime' END ELSE origin END AS origin_type,
  CASE WHEN open THEN told WHEN hit AND coalesce(country, '') = '' THEN told ELSE country END AS release_country, nsfw OR coalesce(t = 1, false) AS is_nsfw,
  CASE WHEN hit THEN genres || '|Drama' ELSE genres END AS genres, CAST(CASE WHEN hit THEN greatest(confidence, CASE WHEN q = 1 THEN 90 ELSE 60 END) ELSE confidence END AS BIGINT) AS confidence,
  CASE WHEN open THEN 'anilist_promotion' ELSE tsource END AS taxonomy_source, CAST(CASE WHEN hit THEN 2020 + q END AS BIGINT) AS release_year,
  CAST(CASE WHEN hit THEN CASE WHEN q = 1 THEN 7.8 ELSE 5.0 END ELSE 0.0 END AS DOUBLE) AS score, CASE WHEN hit THEN 'c.jpg' ELSE '' END AS cover_url, CASE WHEN hit THEN 'English ' || doc_id END AS english FROM k
""")
def _promote(t: Tables):
    items = classified(t).withColumns({"release_year": S(None).cast("smallint"), "score": S(0.0).cast("float"), "cover_url": S("")})
    q, x = F.col("quality"), F.col("toxic")
    payload = F.to_json(F.struct(
        F.when(q == 1, "ANIME").otherwise("MANGA").alias("type"), F.when(x == 1, "KR").otherwise("CN").alias("country_of_origin"), F.when(q == 1, 78).otherwise(50).alias("average_score"),
        (q + 2020).alias("season_year"), F.array(S("Drama"), S("school")).alias("genres"), (x == 1).alias("is_adult"), S("c.jpg").alias("cover_image"), F.concat(S("English "), "doc_id").alias("title_english")))
    matches = t.labels.select(F.col("doc_id").cast("string").alias("item_key"), F.when(q == 1, 97).otherwise(60).alias("match_score"), payload.alias("payload"))
    out = X.promote(items, matches, LOCKS)
    return out.select("item_key", "surface_type", "presentation_type", "origin_type", "release_country", "is_nsfw", joined("genre_names").alias("genres"),
                      F.col("taxonomy_confidence").cast("bigint").alias("confidence"), "taxonomy_source", F.col("release_year").cast("bigint").alias("release_year"),
                      F.round(F.col("score").cast("double"), 6).alias("score"), "cover_url", F.get_json_object("detail", "$.anilist_title_english").alias("english"))


@query("promote_numbered", """
WITH p AS (SELECT p_partkey, p_brand, p_name, p_size, CASE WHEN p_type = 'PROMO' THEN 'episode' WHEN p_type = 'SMALL' THEN 'standalone' ELSE 'numbered' END AS kind FROM part),
c AS (SELECT p_brand, p_name, count(*) AS n FROM p WHERE kind = 'numbered' GROUP BY 1, 2)
SELECT p_partkey, CASE WHEN kind = 'standalone' THEN p.p_name || ' x' ELSE p.p_name END AS base_title, CASE WHEN kind = 'numbered' AND (p_size > 1 OR coalesce(n, 0) > 1) THEN 'episode' ELSE kind END AS entry_kind,
  CAST(CASE WHEN kind = 'standalone' THEN 0 ELSE p_size END AS BIGINT) AS episode_number, kind = 'episode' OR (kind = 'numbered' AND (p_size > 1 OR coalesce(n, 0) > 1)) AS series_candidate
FROM p LEFT JOIN c ON c.p_brand = p.p_brand AND c.p_name = p.p_name AND p.kind <> 'standalone'
""")
def _numbered(t: Tables):
    name, n = F.col("p_name"), F.col("p_size").cast("string")
    title = F.when(F.col("p_type") == "PROMO", F.concat(name, S(" - Episode "), n)).when(F.col("p_type") == "SMALL", F.concat(name, S(" x"))).otherwise(F.concat(name, S("  "), n))
    df = t.part.select("p_partkey", "p_brand", decompose_numbered(title).alias("parts"))
    return promote_numbered(df, ["p_brand"]).select("p_partkey", "base_title", "entry_kind", F.col("episode_number").cast("bigint").alias("episode_number"), "series_candidate")


@query("fallback_payloads", """
SELECT c_custkey, CASE WHEN c_nationkey > 5 THEN c_name END AS title_english, CASE WHEN c_acctbal > 0 THEN CAST(floor(c_acctbal) AS BIGINT) END AS average_score,
  CASE WHEN c_nationkey % 3 = 0 THEN 'large' WHEN c_nationkey % 3 = 1 THEN 'medium' END AS cover_image, CASE WHEN c_nationkey > 9 THEN 'Action|Drama' END AS genres, c_nationkey = 1 AS is_adult FROM customer
""")
def _fallback_payloads(t: Tables):
    """Payload of a fallback provider: no blanks, no zeros, first cover that is there, genres distinct ignoring case."""
    none = S(None).cast("string")
    n = F.col("c_nationkey")
    hits = t.customer.select(
        "c_custkey", *[none.alias(c) for c in ("type", "format", "status", "country_of_origin", "title_romaji", "title_native", "description", "banner_image", "site_url")],
        S(0).alias("season_year"), F.col("c_acctbal").alias("average_score"), (n == 1).alias("is_adult"), F.when(n > 9, F.array(S("Action"), S(" action"), S("Drama"))).otherwise(F.array()).alias("genres"),
        F.when(n > 5, F.col("c_name")).otherwise(" ").alias("title_english"), F.array().cast("array<string>").alias("synonyms"),
        none.alias("cover_extra_large"), F.when(n % 3 == 0, "large").otherwise("").alias("cover_large"), F.when(n % 3 == 1, "medium").alias("cover_medium"))
    out = hits.select("c_custkey", X.fallback_payload().alias("p"))
    got = lambda c: F.get_json_object("p", "$." + c)
    return out.select("c_custkey", got("title_english").alias("title_english"), F.floor(got("average_score").cast("double")).cast("bigint").alias("average_score"), got("cover_image").alias("cover_image"),
                      joined(F.from_json(got("genres"), "array<string>")).alias("genres"), got("is_adult").cast("boolean").alias("is_adult"))
