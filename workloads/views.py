from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showledger.functions.jsoncol import has_payload
from showledger.plans import views as V

from .base import Tables, at, joined, query, shown
from .merges import _DIM_SQL, _dim, _part_words
from .taxonomy import doc_items
from showledger.operators.dims import encode_array

S = F.lit


def _movies(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("tmdb_id"), F.concat(S("movie-"), "p_partkey").alias("slug"), F.col("p_name").alias("title"), S("/p.jpg").alias("poster_path"),
        (F.col("p_size") + 1980).alias("year"), F.col("p_retailprice").alias("rating"), F.array("p_size").alias("genre_codes"), at("1998-01-01 00:00:00").alias("updated_at"))


def _meta(t: Tables) -> DataFrame:
    """Side rows of all shipped parts, under numbers 20 higher: some movies have none, some side rows no movie."""
    big = t.lineitem.groupBy((F.col("l_partkey") + 20).alias("tmdb_id")).agg(F.max("l_shipdate").alias("updated_at"), F.max("l_returnflag").alias("rf"))
    return big.select("tmdb_id", F.concat(S('["'), "rf", S('"]')).alias("cast_json"), F.array("rf").alias("director_names"), S(None).cast("string").alias("alt_titles_json"), "updated_at")


_META_SQL = "meta AS (SELECT l_partkey + 20 AS tmdb_id, max(l_shipdate) AS mu, max(l_returnflag) AS rf FROM lineitem GROUP BY 1)"
_GREATEST = "strftime(greatest(TIMESTAMP '1998-01-01', coalesce(mu, TIMESTAMP '1998-01-01')), '%Y-%m-%d %H:%M:%S')"


@query("movie_list", "SELECT p_partkey AS tmdb_id, 'movie-' || p_partkey AS slug, p_name AS title, CAST(p_size + 1980 AS BIGINT) AS year, p_retailprice AS rating FROM part")
def _list(t: Tables):
    return V.movie_list(_movies(t)).select("tmdb_id", "slug", "title", F.col("year").cast("bigint").alias("year"), "rating")


@query("movie_detail", f"""
WITH {_META_SQL}
SELECT p_partkey AS tmdb_id, p_name AS title, coalesce('["' || rf || '"]', '[]') AS cast_json, '[]' AS alt_titles_json, coalesce(rf, '') AS directors, {_GREATEST} AS updated_at
FROM part LEFT JOIN meta ON tmdb_id = p_partkey
""")
def _detail(t: Tables):
    return V.movie_detail(_movies(t), _meta(t)).select("tmdb_id", "title", "cast_json", "alt_titles_json", joined("director_names").alias("directors"), shown("updated_at").alias("updated_at"))


@query("movie_watch_summary", """
SELECT p_partkey AS tmdb_id, p_name AS title, (SELECT count(*) FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'A') AS watch_option_count,
  (SELECT count(*) FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND l_linestatus = 'O') AS download_option_count FROM part
""")
def _watch(t: Tables):
    base = t.lineitem.select(F.col("l_partkey").alias("tmdb_id"), "l_returnflag", "l_linestatus")
    watch = base.withColumn("status_code", F.when(F.col("l_returnflag") == "A", "a").otherwise("d"))
    down = base.withColumn("status_code", F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), "a").otherwise("x"))
    return V.movie_watch_summary(_movies(t), watch, down).select("tmdb_id", "title", "watch_option_count", "download_option_count")


def _records(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.col("l_suppkey").alias("id"), F.col("l_partkey").alias("tmdb_id")).agg(F.max("l_shipdate").alias("updated_at"), F.count("*").alias("offers"))


_RECORDS_SQL = "rec AS (SELECT l_suppkey AS id, l_partkey AS tmdb_id, max(l_shipdate) AS ru, count(*) AS offers FROM lineitem GROUP BY 1, 2)"


@query("movie_route_card", f"""
WITH {_RECORDS_SQL}
SELECT id AS provider_record_id, tmdb_id, offers, 'movie-' || tmdb_id AS slug, p_name AS title, strftime(greatest(ru, TIMESTAMP '1998-01-01'), '%Y-%m-%d %H:%M:%S') AS updated_at FROM rec JOIN part ON p_partkey = tmdb_id
""")
def _card(t: Tables):
    return V.movie_route_card(_records(t), _movies(t)).select("provider_record_id", "tmdb_id", "offers", "slug", "title", shown("updated_at").alias("updated_at"))


@query("movie_route_detail", f"""
WITH {_RECORDS_SQL}, {_META_SQL}
SELECT id AS provider_record_id, rec.tmdb_id, p_name AS title, coalesce('["' || rf || '"]', '[]') AS cast_json, strftime(greatest(ru, TIMESTAMP '1998-01-01', coalesce(mu, TIMESTAMP '1998-01-01')), '%Y-%m-%d %H:%M:%S') AS updated_at
FROM rec JOIN part ON p_partkey = rec.tmdb_id LEFT JOIN meta ON meta.tmdb_id = rec.tmdb_id
""")
def _route(t: Tables):
    return V.movie_route_detail(_records(t), _movies(t), _meta(t)).select("provider_record_id", "tmdb_id", "title", "cast_json", shown("updated_at").alias("updated_at"))


@query("catalog_sync_view", f"""
WITH {_DIM_SQL}, g AS (SELECT w.p_partkey, coalesce(string_agg(DISTINCT dim.name, '|' ORDER BY dim.name), '') AS genres FROM w LEFT JOIN dim ON dim.name = w.name GROUP BY 1)
SELECT CAST(p_partkey AS VARCHAR) AS slug, 'https://pages.example.org/anime/' || p_partkey || '/' AS canonical_url,
  CASE WHEN p_size < 10 THEN '' WHEN p_size < 20 THEN 'https://img.example.org/images/' || p_partkey WHEN p_size < 30 THEN 'https://pages.example.org/x/' || p_partkey ELSE 'http://o/' || p_partkey END AS poster_url,
  CASE WHEN p_type = 'PROMO' THEN 'Special' WHEN p_type = 'SMALL' THEN '' ELSE 'TV' END AS anime_type, CASE WHEN p_size > 40 THEN 'Upcoming' WHEN p_size > 20 THEN 'Completed' ELSE '' END AS status, genres
FROM part JOIN g USING (p_partkey)
""")
def _sync_view(t: Tables):
    k, n = F.col("p_partkey").cast("string"), F.col("p_size")
    codes = encode_array(_part_words(t), "p_partkey", "names", _dim(t), "genre_codes")
    cat = t.part.join(codes, "p_partkey").select(
        k.alias("slug"), F.col("p_name").alias("title"),
        F.when(n < 10, "").when(n < 20, F.concat(S("/images/"), k)).when(n < 30, F.concat(S("/x/"), k)).otherwise(F.concat(S("http://o/"), k)).alias("poster_path"),
        F.when(F.col("p_type") == "PROMO", "p").when(F.col("p_type") == "SMALL", "u").otherwise("t").alias("type_code"), F.when(n > 40, "u").when(n > 20, "f").otherwise("x").alias("status_code"),
        S(0.0).alias("score"), S("").alias("synopsis_source"), "genre_codes", at("1998-01-01 00:00:00").alias("updated_at"))
    out = V.view_catalog_sync(cat, _dim(t), "https://pages.example.org", "https://img.example.org", "shop")
    return out.select("slug", "canonical_url", "poster_url", "anime_type", "status", joined("genres").alias("genres"))


@query("detail_ready", """
WITH m AS (SELECT l_partkey + 20 AS l_partkey FROM lineitem GROUP BY 1 HAVING count(*) FILTER (l_returnflag = 'R') > 0)
SELECT CAST(p_partkey AS VARCHAR) AS slug FROM part LEFT JOIN m ON l_partkey = p_partkey WHERE p_size > 45 OR p_type = 'PROMO' OR p_brand = 'Brand#1' OR l_partkey IS NOT NULL
""")
def _ready(t: Tables):
    cat = t.part.select(F.col("p_partkey").cast("string").alias("slug"), F.when(F.col("p_size") > 45, F.col("p_size")).alias("mal_id"), F.when(F.col("p_type") == "PROMO", "w").otherwise("x").alias("season_code"),
                        F.when(F.col("p_brand") == "Brand#1", F.array(S(1))).otherwise(F.array().cast("array<int>")).alias("studio_codes"))
    meta = t.lineitem.groupBy((F.col("l_partkey") + 20).cast("string").alias("slug")).agg(
        F.max(F.when(F.col("l_returnflag") == "R", '["x"]').otherwise("[]")).alias("_x"), F.count_if(F.col("l_returnflag") == "R").alias("n")).select(
        "slug", S("").alias("trailer_youtube_id"), F.when(F.col("n") > 0, '["x"]').otherwise("[]").alias("cast_json"))
    return V.detail_ready(cat, meta)


_LINKS = """CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 1 WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O' THEN 1 ELSE 0 END"""


@query("ready_parents", f"SELECT DISTINCT o_custkey FROM orders WHERE {_LINKS} = 1")
def _parents(t: Tables):
    p, s = F.col("o_orderpriority"), F.col("o_orderstatus")
    links = F.when((p == "1-URGENT") & (s == "F"), '{"primary":"u","mirrors":[]}').when((p == "2-HIGH") & (s == "O"), '{"primary":" ","mirrors":{"a":"b"}}').otherwise('{"mirrors":{},"primary":""}')
    return V.ready_parents(t.orders.withColumn("links", links), "o_custkey", "links")


@query("presence_flags", f"SELECT o_orderkey, {_LINKS} = 1 AS present FROM orders")
def _presence(t: Tables):
    p, s = F.col("o_orderpriority"), F.col("o_orderstatus")
    doc = F.when(((p == "1-URGENT") & (s == "F")) | ((p == "2-HIGH") & (s == "O")), '{"a":{"b":{"c":1}}}').when(s == "F", '{"a":{"b":{}}}').otherwise("{}")
    return t.orders.withColumn("doc", doc).select("o_orderkey", has_payload("doc", "a.b").alias("present"))


def _typed(t: Tables) -> DataFrame:
    n = F.col("n_chars")
    extra = F.to_json(F.struct(F.concat(S("T"), n).alias("type_code"), n.cast("string").alias("episode_count"), F.when(n > 500, F.concat(n, S("m"))).otherwise(n.cast("string")).alias("runtime_minutes"),
                               F.col("title").alias("overview"), F.col("source").alias("author"), S("c").alias("latest_chapter_label")))
    cols = {c: S(None).cast(k) for c, k in (("cover_url", "string"), ("status", "string"), ("release_year", "int"), ("score", "double"), ("mal_id", "bigint"), ("tmdb_id", "bigint"))}
    return doc_items(t).withColumns(cols).withColumn("detail", extra).withColumn("updated_at", at("2024-01-01 00:00:00"))


@query("view_series", "SELECT CAST(doc_id AS VARCHAR) AS item_key, 'T' || n_chars AS type_code, CAST(n_chars AS BIGINT) AS episode_count FROM documents WHERE lang = 'en'")
def _series(t: Tables):
    return V.view_series(_typed(t)).select("item_key", "type_code", F.col("episode_count").cast("bigint").alias("episode_count"))


@query("view_movie", "SELECT CAST(doc_id AS VARCHAR) AS item_key, 'Doc ' || doc_id AS overview, CAST(CASE WHEN n_chars > 500 THEN NULL ELSE n_chars END AS BIGINT) AS runtime_minutes FROM documents WHERE lang = 'es'")
def _movie(t: Tables):
    return V.view_movie(_typed(t)).select("item_key", "overview", F.col("runtime_minutes").cast("bigint").alias("runtime_minutes"))


@query("view_comic", "SELECT CAST(doc_id AS VARCHAR) AS item_key, source AS author, 'c' AS latest_chapter_label FROM documents WHERE lang = 'fr'")
def _comic(t: Tables):
    return V.view_comic(_typed(t)).select("item_key", "author", "latest_chapter_label")


@query("items_with_units", """
SELECT c_custkey, o_orderkey FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING' AND o_orderstatus = 'F'
""")
def _with_units(t: Tables):
    items = t.customer.withColumn("item_key", F.col("c_custkey"))
    units = t.orders.withColumn("item_key", F.col("o_custkey"))
    return V.items_with_units(items, units, F.col("c_mktsegment") == "BUILDING", F.col("o_orderstatus") == "F").select("c_custkey", "o_orderkey")
