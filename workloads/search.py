from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showledger.functions.register import register_search, register_token_search
from showledger.operators import search as X
from showledger.operators.postings import Postings
from showledger.operators.ranking import numeric_sort_keys, page, result_to_json, rows_to_json, top_per_group, work_queue
from showledger.plans.backfill import select_slugs
from showledger.plans.views import lookup_item
from showledger.session import shared_dir

from .base import Tables, query, shop_items
from .taxonomy import doc_items


def _parts(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("id"), F.initcap("p_name").alias("title"), F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("-"), F.lower("p_brand")).alias("slug"))


_PARTS_SQL = """
parts AS (SELECT p_partkey AS id, p_name AS lt, replace(p_name, ' ', '-') || '-' || lower(p_brand) AS slug FROM part),
m AS (SELECT id, q.query, CASE WHEN lt = q.query THEN 0 WHEN slug = s THEN 1 WHEN starts_with(lt, q.query) THEN 2 WHEN starts_with(slug, s) THEN 3
        WHEN contains(lt, ' ' || q.query) THEN 4 WHEN contains(lt, q.query) THEN 5 WHEN contains(slug, s) THEN 6 END AS rank_bucket,
        CASE WHEN strpos(lt, q.query) > 0 THEN strpos(lt, q.query) ELSE 9999 END AS pos, lt, slug
      FROM parts, q),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY rank_bucket, pos, lt, slug, id) AS rn FROM m WHERE rank_bucket IS NOT NULL)
"""


@query("search_titles", "WITH q AS (SELECT 'bolt' AS query, 'bolt' AS s)," + _PARTS_SQL + """
SELECT lt AS title, slug, CAST(rank_bucket AS BIGINT) AS rank_bucket FROM r WHERE rn <= 12
""")
def _search(t: Tables):
    return X.search_titles(_parts(t), " Bolt ", 12).select(F.lower("title").alias("title"), "slug", F.col("rank_bucket").cast("bigint").alias("rank_bucket"))


@query("search_table_function", "WITH q AS (SELECT unnest(['bolt', 'hot gizmo', 'd r']) AS query, unnest(['bolt', 'hot-gizmo', 'd-r']) AS s)," + _PARTS_SQL + """
SELECT query, lt AS title, slug, CAST(rank_bucket AS BIGINT) AS rank_bucket, rn AS place FROM r WHERE rn <= CASE query WHEN 'bolt' THEN 12 WHEN 'd r' THEN 8 ELSE 20 END
""")
def _search_function(t: Tables):
    """The search as a SQL table function: one call with a limit, one without, one above the greatest limit."""
    _parts(t).createOrReplaceTempView("sl_parts")
    register_search(t.spark, "sl_parts")
    asked = " UNION ALL ".join(f"SELECT '{q}' AS query, lower(title) AS title, slug, CAST(rank_bucket AS BIGINT) AS rank_bucket, CAST(place AS BIGINT) AS place FROM sl_search('{given}', {n})"
                               for q, given, n in (("bolt", " Bolt ", "12"), ("d r", "D r", "NULL"), ("hot gizmo", "hot gizmo", "999")))
    return t.spark.sql(asked)


@query("token_search_function", "SELECT doc_id FROM documents WHERE list_has_all(" + r"list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda v: v <> ''))" + ", ['the', 'and', 'nd'])")
def _token_function(t: Tables):
    t.documents.createOrReplaceTempView("sl_documents")
    register_token_search(t.spark, "sl_documents", "doc_id", "text")
    return t.spark.sql("SELECT doc_id FROM sl_token_search('The, nd AND')")


@query("search_titles_batch", "WITH q AS (SELECT query, regexp_replace(query, '\\s+', '-', 'g') AS s FROM (SELECT unnest(['red', 'bolt', 'hot gizmo', 'ring-brand#1', 'd r', 'brand#25', 'zzz']) AS query))," + _PARTS_SQL + """
SELECT query, rn AS place, lt AS title, slug, CAST(rank_bucket AS BIGINT) AS rank_bucket FROM r WHERE rn <= 8
""")
def _batch(t: Tables):
    out = X.search_titles_batch(_parts(t), ["red", "Bolt", "hot gizmo", "ring-brand#1", "d r", "brand#25", "zzz", "x"])
    return out.select("query", F.col("place").cast("bigint").alias("place"), F.lower("title").alias("title"), "slug", F.col("rank_bucket").cast("bigint").alias("rank_bucket"))


_TOKENS = r"list_distinct(list_filter(regexp_split_to_array(lower({x}), '[^\p{{L}}\p{{N}}]+'), lambda v: v <> ''))"


@query("token_search", "SELECT doc_id FROM documents WHERE list_has_all(" + _TOKENS.format(x="text") + ", ['the', 'and', 'nd'])")
def _tokens(t: Tables):
    return X.token_search(t.heavy("documents"), ["text"], "The, nd AND").select("doc_id")


@query("token_search_batch", f"""
WITH d AS (SELECT doc_id, {_TOKENS.format(x='text')} AS have FROM documents), b AS (SELECT item_id, {_TOKENS.format(x='text')} AS want FROM benchmark)
SELECT item_id, doc_id FROM b JOIN d ON list_has_all(have, want)
""")
def _token_batch(t: Tables):
    return X.token_search_batch(t.heavy("documents"), "doc_id", ["text"], t.benchmark, "item_id", "text")


@query("token_index", f"SELECT token, count(*) AS docs FROM (SELECT unnest({_TOKENS.format(x='text')}) AS token FROM documents) GROUP BY 1")
def _index(t: Tables):
    return X.token_index(t.heavy("documents"), "doc_id", ["text"]).groupBy("token").agg(F.count("*").alias("docs"))


def _store(t: Tables, prefix: int = 0) -> Postings:
    return Postings(t.spark, f"{shared_dir(t.spark)}/postings-{uuid.uuid4().hex}", 16, prefix)


_STORED_SQL = f"""
WITH d AS (SELECT doc_id, {_TOKENS.format(x='text')} AS have FROM documents WHERE doc_id % 5 <> 3),
b AS (SELECT item_id, {_TOKENS.format(x='text')} AS want FROM benchmark)
"""


def _stored(t: Tables) -> Postings:
    """All documents in three batches: some with other texts at first, then all, then a fifth of them deleted."""
    store, docs = _store(t), t.documents
    store.update(X.token_changes(docs.where("doc_id % 3 = 0").withColumn("text", F.reverse("text")), "doc_id", ["text"]))
    store.update(X.token_changes(docs, "doc_id", ["text"]))
    store.update(X.token_changes(docs.where("doc_id % 5 = 3"), "doc_id", ["text"], F.lit(True)))
    return store


@query("token_search_stored", _STORED_SQL + "SELECT item_id, doc_id FROM b JOIN d ON list_has_all(have, want)")
def _token_stored(t: Tables):
    store = _stored(t)
    store.compact(3)
    return X.token_search_stored(store, t.benchmark, "item_id", "text", "doc_id")


@query("token_frequencies", _STORED_SQL + "SELECT token, count(*) AS docs FROM (SELECT unnest(have) AS token FROM d) WHERE token IN (SELECT unnest(want) FROM b) GROUP BY 1")
def _frequencies(t: Tables):
    """Stored document frequencies of all words of the benchmark, after texts have changed and gone."""
    words = t.benchmark.select(F.explode(X.tokens("text")).alias("term"))
    return _stored(t).asked(words)[1].where("df > 0").select(F.col("term").alias("token"), F.col("df").alias("docs"))


@query("search_titles_table", """
WITH q AS (SELECT DISTINCT query, regexp_replace(query, '\\s+', '-', 'g') AS s FROM (
  SELECT lower(substr(p_name, 1 + p_partkey % 5, 2 + p_partkey % 9)) AS query FROM part UNION ALL SELECT lower(p_brand) FROM part)
  WHERE length(trim(query)) >= 2 AND query = trim(query)),""" + _PARTS_SQL + """
SELECT query, rn AS place, lt AS title, slug, CAST(rank_bucket AS BIGINT) AS rank_bucket FROM r WHERE rn <= 8
""")
def _titles_table(t: Tables):
    """A query for every part (a piece of its name) and every brand, through a title store that was built in two batches."""
    store, parts = _store(t, X.GRAM), _parts(t).withColumn("text", X.title_key())
    texts = lambda df: df.select("text", "title", "slug").distinct()
    store.update(X.title_changes(texts(parts.where("id % 2 = 0")), "text"))
    store.update(X.title_changes(texts(parts), "text"))
    piece = F.lower(F.substring("p_name", 1 + F.col("p_partkey").cast("int") % 5, 2 + F.col("p_partkey").cast("int") % 9))
    asked = t.part.select(piece.alias("query")).unionByName(t.part.select(F.lower("p_brand").alias("query"))).where(F.col("query") == F.trim("query"))
    out = X.search_titles_stored(store, parts, "text", asked, tie=[F.col("id")])
    return out.select("query", F.col("place").cast("bigint").alias("place"), F.lower("title").alias("title"), "slug", F.col("rank_bucket").cast("bigint").alias("rank_bucket"))


@query("work_queue", """
WITH f AS (SELECT d.doc_id, d.source, l.quality IS NULL AS m1, n_chars < 300 AS m2, lang = 'fr' AS m3, n_chars FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT doc_id, m1 AS missing_label, m2 AS missing_body, m3 AS missing_lang FROM f WHERE m1 OR m2 OR m3
ORDER BY m1 DESC, m2 DESC, m3 DESC, n_chars DESC, doc_id LIMIT 60
""")
def _queue(t: Tables):
    df = t.documents.join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    out = work_queue(df, {"label": F.col("quality").isNull(), "body": F.col("n_chars") < 300, "lang": F.col("lang") == "fr"}, [F.col("n_chars").desc(), F.col("doc_id")], 60)
    return out.select("doc_id", "missing_label", "missing_body", "missing_lang")


@query("numeric_sort_page", """
WITH l AS (SELECT DISTINCT CASE WHEN l_returnflag = 'N' THEN 'Part ' || l_linenumber WHEN l_returnflag = 'R' THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) ELSE l_linenumber || '.5' END AS label FROM lineitem),
r AS (SELECT label, row_number() OVER (ORDER BY TRY_CAST(label AS DOUBLE) IS NULL, coalesce(TRY_CAST(label AS DOUBLE), 0), label) AS rn FROM l)
SELECT label FROM r WHERE rn > 10 AND rn <= 50
""")
def _numeric(t: Tables):
    f = F.col("l_returnflag")
    label = F.when(f == "N", F.concat(F.lit("Part "), "l_linenumber")).when(f == "R", F.col("l_quantity").cast("bigint").cast("string")).otherwise(F.concat("l_linenumber", F.lit(".5")))
    return page(t.lineitem.select(label.alias("label")).distinct(), numeric_sort_keys("label"), 40, 10)


@query("capped_children", """
SELECT o_custkey, o_orderkey, rn AS place FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn <= 3
""")
def _capped(t: Tables):
    out = top_per_group(t.orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], 3, rank="place")
    return out.select("o_custkey", "o_orderkey", F.col("place").cast("bigint").alias("place"))


_ROWS_SQL = """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
SELECT o_custkey, '[' || string_agg('{"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%d') || '","o_orderkey":' || o_orderkey || '}', ',' ORDER BY rn) || ']' AS rows_json FROM r
"""


@query("rows_as_json", _ROWS_SQL + "GROUP BY 1")
def _json(t: Tables):
    df = t.orders.select("o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderkey")
    return rows_to_json(df, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("rows_as_json_top5", _ROWS_SQL + "WHERE rn <= 5 GROUP BY 1")
def _json_top(t: Tables):
    """The capped form."""
    df = t.orders.select("o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderkey")
    return rows_to_json(df, ["o_custkey"], ["o_orderdate", "o_orderkey"], 5)


@query("result_as_json", """
WITH p AS (SELECT '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || '}' AS j, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders)
SELECT 'page' AS part, '[' || string_agg(j, ',' ORDER BY rn) || ']' AS rows_json FROM p WHERE rn BETWEEN 21 AND 60
UNION ALL SELECT 'beyond', '[]'
""")
def _result_json(t: Tables):
    """One page of the whole result, and a page beyond its end."""
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey")]
    df = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    page_of = lambda part, offset: result_to_json(df, order, 40, offset, columns=["o_orderkey", "o_custkey"]).select(F.lit(part).alias("part"), "rows_json")
    return page_of("page", 20).unionByName(page_of("beyond", df.count()))


_LOOKUP_SQL = """
SELECT CAST(doc_id AS VARCHAR) AS item_key, 'Doc ' || doc_id AS title, 'doc-' || doc_id AS slug, 'https://example.org/' || doc_id AS canonical_url, doc_id % 7 AS page_number,
  CASE WHEN doc_id % 2 = 0 THEN 'special' WHEN lang = 'en' THEN 'anime' WHEN lang = 'de' THEN 'drama' WHEN lang = 'es' THEN 'movie' ELSE 'manhwa' END AS content_type,
  CASE WHEN doc_id % 3 = 0 THEN 'TV' ELSE '' END AS anime_type
FROM documents WHERE (source, doc_id) IN (SELECT source, doc_id FROM documents WHERE doc_id IN (3, 8))
"""


@query("lookup_item", _LOOKUP_SQL)
def _lookup(t: Tables):
    k = F.col("item_key")
    n = k.cast("bigint")
    detail = F.to_json(F.struct(
        F.concat(F.lit("https://example.org/"), k).alias("canonical_url"), (n % 7).alias("page_number"),
        F.when(n % 2 == 0, "special").alias("content_type"), F.when(n % 3 == 0, "TV").alias("anime_type")))
    items = doc_items(t).withColumn("detail", detail)
    own = t.documents.filter(F.col("doc_id").isin(3, 8)).select("doc_id", "source").collect()  # two rows
    found = [lookup_item(items, r["source"], f"doc-{r['doc_id']}") for r in own]
    return found[0].unionByName(found[1]).withColumn("page_number", F.col("page_number").cast("bigint"))


@query("select_slugs", "SELECT lower(replace(c_name, '#', '-')) AS slug FROM customer WHERE c_name IN ('Customer#000000003', 'Customer#000000120')")
def _slugs(t: Tables):
    return select_slugs(shop_items(t), ["customer-000000003", "customer-000000120"], [F.col("slug")], 1).select("slug")
