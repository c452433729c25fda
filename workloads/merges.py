from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showledger.functions import jsoncol
from showledger.operators import dims
from showledger.operators import merge as M
from showledger.plans.views import view_plain

from .base import SHOP_SQL, Tables, at, joined, query, r6, shop_items, shop_units, shown

NOW = "2002-01-01 00:00:00"
S = F.lit


def js(doc: str, path: str) -> Column:
    return F.get_json_object(doc, "$." + path)


# -- items -------------------------------------------------------------------------

def _item_target(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(
        F.col("c_custkey").cast("string").alias("item_key"), F.col("c_name").alias("title"),
        F.when(F.col("c_nationkey") < 10, "").otherwise(F.concat(S("u"), "c_custkey")).alias("cover_url"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_mktsegment")).alias("status"),
        F.when(F.col("c_nationkey") > 12, F.col("c_nationkey") + 1980).alias("release_year"),
        F.col("c_acctbal").alias("score"), S(None).cast("bigint").alias("mal_id"), S(None).cast("bigint").alias("tmdb_id"),
        F.concat(S('{"seg":"'), "c_mktsegment", S('","n":'), F.col("c_nationkey").cast("string"), S("}")).alias("detail"),
        at("1995-01-01 00:00:00").alias("created_at"), at("1995-01-01 00:00:00").alias("updated_at"),
    )


def _item_batch(t: Tables) -> DataFrame:
    """Incoming rows: orders touch their customer; pending orders are new items."""
    pri = F.col("o_orderpriority")
    return t.orders.select(
        F.when(F.col("o_orderstatus") == "P", F.concat(S("o"), "o_orderkey")).otherwise(F.col("o_custkey").cast("string")).alias("item_key"),
        F.when(pri == "5-LOW", "  ").otherwise(F.concat(S("order "), pri)).alias("title"),
        F.when(pri == "3-MEDIUM", "c.jpg").alias("cover_url"), F.when(pri == "1-URGENT", "").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(pri != "4-NOT SPECIFIED", F.year("o_orderdate")).alias("release_year"),
        F.when(pri == "2-HIGH", F.col("o_totalprice")).otherwise(0.0).alias("score"),
        F.when(pri == "1-URGENT", F.col("o_orderkey")).alias("mal_id"), S(None).cast("bigint").alias("tmdb_id"),
        F.concat(S('{"p":"'), pri, S('"'), F.when(pri == "2-HIGH", ',"n":null').otherwise(""), S("}")).alias("detail"),
        "o_orderdate", "o_orderkey",
    )


def _latest() -> list[Column]:
    return [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]


_ITEM_SQL = """
WITH t AS (
  SELECT CAST(c_custkey AS VARCHAR) AS item_key, c_name AS title, CASE WHEN c_nationkey < 10 THEN '' ELSE 'u' || c_custkey END AS cover_url,
         CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END AS status, CASE WHEN c_nationkey > 12 THEN c_nationkey + 1980 END AS release_year,
         c_acctbal AS score, CAST(NULL AS BIGINT) AS mal_id, c_mktsegment AS seg, CAST(c_nationkey AS VARCHAR) AS n FROM customer),
r AS (
  SELECT CASE WHEN o_orderstatus = 'P' THEN 'o' || o_orderkey ELSE CAST(o_custkey AS VARCHAR) END AS item_key,
         CASE WHEN o_orderpriority = '5-LOW' THEN '  ' ELSE 'order ' || o_orderpriority END AS title,
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'c.jpg' END AS cover_url,
         CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE o_orderstatus END AS status,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN year(o_orderdate) END AS release_year,
         CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice ELSE 0.0 END AS score,
         CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END AS mal_id, o_orderpriority AS p, o_orderdate, o_orderkey FROM orders),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_key ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM r) WHERE rn = 1)
SELECT coalesce(t.item_key, b.item_key) AS item_key,
  CASE WHEN t.item_key IS NULL THEN b.title WHEN trim(coalesce(b.title, '')) <> '' THEN b.title ELSE t.title END AS title,
  CASE WHEN t.item_key IS NULL THEN coalesce(b.cover_url, '') WHEN trim(coalesce(b.cover_url, '')) <> '' THEN b.cover_url ELSE t.cover_url END AS cover_url,
  CASE WHEN t.item_key IS NULL THEN b.status WHEN trim(coalesce(b.status, '')) <> '' THEN b.status ELSE t.status END AS status,
  CAST(coalesce(b.release_year, t.release_year) AS BIGINT) AS release_year,
  CASE WHEN t.item_key IS NULL THEN b.score WHEN b.score > 0 THEN b.score ELSE t.score END AS score,
  coalesce(b.mal_id, t.mal_id) AS mal_id, t.seg AS seg, CASE WHEN b.p = '2-HIGH' THEN NULL ELSE t.n END AS n, b.p AS p,
  CASE WHEN b.item_key IS NULL THEN '1995-01-01 00:00:00' ELSE '2002-01-01 00:00:00' END AS updated_at,
  CASE WHEN t.item_key IS NULL THEN '2002-01-01 00:00:00' ELSE '1995-01-01 00:00:00' END AS created_at
FROM t FULL OUTER JOIN b ON t.item_key = b.item_key
"""


def _item_out(df: DataFrame) -> DataFrame:
    return df.select(
        "item_key", "title", "cover_url", "status", F.col("release_year").cast("bigint").alias("release_year"), "score", "mal_id",
        js("detail", "seg").alias("seg"), js("detail", "n").alias("n"), js("detail", "p").alias("p"),
        shown("updated_at").alias("updated_at"), shown("created_at").alias("created_at"))


@query("upsert_items", _ITEM_SQL)
def _upsert_items(t: Tables):
    return _item_out(M.upsert_items(_item_target(t), _item_batch(t), at(NOW), order=_latest(), incremental=False))


@query("upsert_items_incremental", _ITEM_SQL)
def _upsert_items_inc(t: Tables):
    return _item_out(M.upsert_items(_item_target(t), _item_batch(t), at(NOW), order=_latest(), incremental=True))


@query("upsert_items_small_batch", _ITEM_SQL.replace("FROM orders)", "FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) - INTERVAL 2 DAY FROM orders))"))
def _upsert_items_small(t: Tables):
    """The incremental plan's real case: what arrived in the last two days."""
    last = t.orders.agg(F.max("o_orderdate").alias("last"))
    recent = _item_batch(t).join(F.broadcast(last), F.col("o_orderdate") >= F.col("last") - F.expr("INTERVAL 2 DAYS"), "inner").drop("last")
    return _item_out(M.upsert_items(_item_target(t), recent, at(NOW), order=_latest(), incremental=True))


_NULL_KEYS = """
WITH t AS (SELECT CASE WHEN p_size % 5 > 0 THEN p_brand END AS a, CASE WHEN p_size % 7 > 0 THEN p_partkey END AS b, p_name AS name FROM part),
n AS (SELECT DISTINCT p_brand AS a, l_partkey AS b, 'line ' || l_partkey AS name FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_quantity > 45),
m AS (SELECT coalesce(t.a, n.a) AS a, coalesce(t.b, n.b) AS b, coalesce(n.name, t.name) AS name FROM t FULL OUTER JOIN n ON t.a = n.a AND t.b = n.b)
SELECT mode, a, b, name FROM m, (SELECT unnest(['full', 'incremental', 'default']) AS mode)
"""


@query("upsert_null_keys", _NULL_KEYS)
def _upsert_null_keys(t: Tables):
    """Stored rows with a NULL in a two-column key stay as they are, whichever plan runs."""
    target = t.part.select(F.when(F.col("p_size") % 5 > 0, F.col("p_brand")).alias("a"), F.when(F.col("p_size") % 7 > 0, F.col("p_partkey")).alias("b"), F.col("p_name").alias("name"))
    lines = t.lineitem.filter(F.col("l_quantity") > 45).select(F.col("l_partkey").alias("b")).distinct()
    batch = lines.join(t.part.select(F.col("p_partkey").alias("b"), F.col("p_brand").alias("a")), "b").withColumn("name", F.concat(S("line "), F.col("b").cast("string")))
    made = [M.merge(target, batch, ["a", "b"], {"name": M.replace}, incremental=how).select(S(mode).alias("mode"), "a", "b", "name")
            for mode, how in (("full", False), ("incremental", True), ("default", None))]
    return made[0].unionByName(made[1]).unionByName(made[2])


# -- units ---------------------------------------------------------------------------

_LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
_LINE_LATEST_SQL = ", ".join(c + " DESC" for c in _LINE_ORDER)


def _line_latest() -> list[Column]:
    return [F.col(c).desc() for c in _LINE_ORDER]


def _lines(t: Tables) -> DataFrame:
    return t.lineitem.withColumn("unit_key", F.concat_ws("-", "l_orderkey", "l_linenumber"))


@query("upsert_units", f"""
WITH l AS (SELECT *, l_orderkey || '-' || l_linenumber AS unit_key FROM lineitem),
t AS (SELECT unit_key, CAST(l_orderkey AS VARCHAR) AS item_key, 'line ' || l_linestatus AS title, '' AS label, l_quantity AS number,
        'old/' || unit_key AS canonical_url, CAST(NULL AS VARCHAR) AS next_slug
      FROM (SELECT *, row_number() OVER (PARTITION BY unit_key ORDER BY {_LINE_LATEST_SQL}) AS rn FROM l WHERE l_shipdate < TIMESTAMP '2000-01-01') WHERE rn = 1),
b AS (SELECT unit_key, CAST(l_partkey AS VARCHAR) AS item_key, CASE WHEN l_returnflag = 'N' THEN '' ELSE 'ret ' || l_returnflag END AS title,
        'lab ' || l_suppkey AS label, CASE WHEN l_returnflag <> 'A' THEN l_quantity + 100 END AS number, 'new/' || unit_key AS canonical_url,
        CASE WHEN l_linestatus = 'O' THEN 's' || l_suppkey END AS next_slug
      FROM (SELECT *, row_number() OVER (PARTITION BY unit_key ORDER BY {_LINE_LATEST_SQL}) AS rn FROM l WHERE l_shipdate >= TIMESTAMP '1998-01-01') WHERE rn = 1)
SELECT coalesce(t.unit_key, b.unit_key) AS unit_key, coalesce(t.item_key, b.item_key) AS item_key,
  CASE WHEN t.unit_key IS NULL THEN b.title WHEN coalesce(b.title, '') <> '' THEN b.title ELSE t.title END AS title,
  coalesce(b.label, t.label) AS label, coalesce(b.number, t.number) AS number, coalesce(t.canonical_url, b.canonical_url) AS canonical_url,
  coalesce(b.next_slug, t.next_slug) AS next_slug
FROM t FULL OUTER JOIN b ON t.unit_key = b.unit_key
""")
def _upsert_units(t: Tables):
    lines = _lines(t)
    stamp = at("1995-01-01 00:00:00")
    none = S(None).cast("string")
    old = M.last_write(lines.filter(F.col("l_shipdate") < at("2000-01-01 00:00:00")), ["unit_key"], _line_latest())
    target = old.select(
        "unit_key", F.col("l_orderkey").cast("string").alias("item_key"), F.concat(S("line "), "l_linestatus").alias("title"), S("").alias("label"),
        F.col("l_quantity").alias("number"), F.concat(S("old/"), "unit_key").alias("canonical_url"), S(None).cast("timestamp").alias("published_at"),
        none.alias("prev_slug"), none.alias("next_slug"), S("{}").alias("detail"), stamp.alias("created_at"), stamp.alias("updated_at"))
    batch = lines.filter(F.col("l_shipdate") >= at("1998-01-01 00:00:00")).select(
        "unit_key", F.col("l_partkey").cast("string").alias("item_key"),
        F.when(F.col("l_returnflag") == "N", "").otherwise(F.concat(S("ret "), "l_returnflag")).alias("title"), F.concat(S("lab "), "l_suppkey").alias("label"),
        F.when(F.col("l_returnflag") != "A", F.col("l_quantity") + 100).alias("number"), F.concat(S("new/"), "unit_key").alias("canonical_url"),
        F.when(F.col("l_linestatus") == "O", F.concat(S("s"), "l_suppkey")).alias("next_slug"), *_LINE_ORDER)
    out = M.upsert_units(target, batch, at(NOW), order=_line_latest())
    return out.select("unit_key", "item_key", "title", "label", "number", "canonical_url", "next_slug")


# -- ranked catalog and detail -----------------------------------------------------------

def _catalog(t: Tables) -> DataFrame:
    p = t.part
    codes = lambda *c: F.array(*[x.cast("smallint") for x in c])
    return p.select(
        F.col("p_partkey").cast("string").alias("slug"), F.when(F.col("p_size") > 25, "m").otherwise("s").alias("meta_source_code"),
        F.when(F.col("p_size") <= 45, F.col("p_partkey")).alias("mal_id"),
        F.when(F.col("p_type") == "PROMO", "").otherwise(F.col("p_name")).alias("title"),
        F.when(F.col("p_type") == "SMALL", "").otherwise(F.concat(S("/images/"), "p_partkey")).alias("poster_path"),
        F.when(F.col("p_type") == "ECONOMY", "u").otherwise("t").alias("type_code"), F.when(F.col("p_size") < 20, "x").otherwise("a").alias("status_code"),
        F.when(F.col("p_size") < 30, 0.0).otherwise(F.col("p_retailprice")).alias("score"), codes(F.col("p_size"), S(7)).alias("genre_codes"),
        F.when(F.col("p_type") == "LARGE", "").otherwise(F.col("p_brand")).alias("synopsis_source"), S("{}").alias("batch_links_json"),
        at("1997-06-01 00:00:00").alias("updated_at"))


def _catalog_batch(t: Tables) -> DataFrame:
    g = t.lineitem.groupBy(F.col("l_partkey").cast("string").alias("slug")).agg(
        F.max("l_returnflag").alias("rf"), F.max("l_quantity").alias("q"), F.min("l_linenumber").alias("lo"), F.max("l_linenumber").alias("hi"),
        F.max("l_discount").alias("d"), F.max("l_shipdate").alias("updated_at"), F.min("l_suppkey").alias("sk"))
    return g.select(
        "slug", F.when(F.col("q") > 49, F.col("sk")).alias("mal_id"), F.when(F.col("rf") == "R", F.concat(S("part "), "slug")).otherwise("").alias("title"),
        F.concat(S("/p/"), "slug").alias("poster_path"), F.when(F.col("q") > 48, "m").otherwise("u").alias("type_code"),
        F.when(F.col("q") > 46, "f").otherwise("x").alias("status_code"), F.when(F.col("d") >= 0.1, F.col("q")).otherwise(0.0).alias("score"),
        F.array(F.col("lo").cast("smallint"), F.col("hi").cast("smallint")).alias("genre_codes"), F.when(F.col("q") < 47, "").otherwise("syn").alias("synopsis_source"),
        F.when(F.col("q") > 45, '{"b":1}').otherwise("{}").alias("batch_links_json"), "updated_at")


_CATALOG_SQL = """
WITH t AS (
  SELECT CAST(p_partkey AS VARCHAR) AS slug, CASE WHEN p_size > 25 THEN 'm' ELSE 's' END AS meta, CASE WHEN p_size <= 45 THEN p_partkey END AS mal_id,
    CASE WHEN p_type = 'PROMO' THEN '' ELSE p_name END AS title, CASE WHEN p_type = 'SMALL' THEN '' ELSE '/images/' || p_partkey END AS poster,
    CASE WHEN p_type = 'ECONOMY' THEN 'u' ELSE 't' END AS tc, CASE WHEN p_size < 20 THEN 'x' ELSE 'a' END AS sc,
    CASE WHEN p_size < 30 THEN 0.0 ELSE p_retailprice END AS score, [p_size, 7] AS codes, CASE WHEN p_type = 'LARGE' THEN '' ELSE p_brand END AS syn FROM part),
g AS (SELECT CAST(l_partkey AS VARCHAR) AS slug, max(l_returnflag) AS rf, max(l_quantity) AS q, min(l_linenumber) AS lo, max(l_linenumber) AS hi,
        max(l_discount) AS d, max(l_shipdate) AS u, min(l_suppkey) AS sk FROM lineitem GROUP BY 1),
b AS (SELECT slug, CASE WHEN q > 49 THEN sk END AS mal_id, CASE WHEN rf = 'R' THEN 'part ' || slug ELSE '' END AS title, '/p/' || slug AS poster,
        CASE WHEN q > 48 THEN 'm' ELSE 'u' END AS tc, CASE WHEN q > 46 THEN 'f' ELSE 'x' END AS sc, CASE WHEN d >= 0.1 THEN q ELSE 0.0 END AS score,
        [lo, hi] AS codes, CASE WHEN q < 47 THEN '' ELSE 'syn' END AS syn, CASE WHEN q > 45 THEN '{"b":1}' ELSE '{}' END AS links, u FROM g)
"""
_CODES_SQL = """CASE WHEN b.slug IS NULL THEN array_to_string(t.codes, '|') WHEN t.slug IS NULL THEN array_to_string(b.codes, '|')
       ELSE array_to_string(list_sort(list_distinct(list_concat(t.codes, b.codes))), '|') END"""


@query("upsert_ranked", _CATALOG_SQL + f"""
SELECT coalesce(t.slug, b.slug) AS slug,
  CASE WHEN t.slug IS NULL THEN b.title WHEN t.meta = 'm' AND t.title <> '' THEN t.title WHEN coalesce(b.title, '') <> '' THEN b.title ELSE t.title END AS title,
  CASE WHEN t.slug IS NULL THEN b.poster WHEN t.meta = 'm' AND t.poster <> '' THEN t.poster WHEN coalesce(b.poster, '') <> '' THEN b.poster ELSE t.poster END AS poster_path,
  CASE WHEN t.slug IS NULL OR (t.tc = 'u' AND b.tc <> 'u') THEN b.tc ELSE t.tc END AS type_code,
  CASE WHEN t.slug IS NULL OR (t.sc = 'x' AND b.sc <> 'x') THEN b.sc ELSE t.sc END AS status_code,
  CASE WHEN t.slug IS NULL OR (t.score = 0 AND b.score <> 0) THEN b.score ELSE t.score END AS score, {_CODES_SQL} AS codes,
  CASE WHEN t.slug IS NULL OR coalesce(b.syn, '') <> '' THEN b.syn ELSE t.syn END AS synopsis,
  strftime(CASE WHEN t.slug IS NULL THEN b.u ELSE greatest(TIMESTAMP '1997-06-01', coalesce(b.u, TIMESTAMP '1997-06-01')) END, '%Y-%m-%d %H:%M:%S') AS updated_at
FROM t FULL OUTER JOIN b ON t.slug = b.slug
""")
def _upsert_ranked(t: Tables):
    out = M.upsert_ranked(_catalog(t), _catalog_batch(t), ["slug"], M.RANKED_CATALOG, unique=True)
    return out.select("slug", "title", "poster_path", "type_code", "status_code", "score", joined("genre_codes").alias("codes"),
                      F.col("synopsis_source").alias("synopsis"), shown("updated_at").alias("updated_at"))


@query("upsert_detail", _CATALOG_SQL + f"""
SELECT coalesce(t.slug, b.slug) AS slug, CASE WHEN b.mal_id IS NOT NULL AND t.slug IS NOT NULL THEN 'm' ELSE t.meta END AS meta_source_code,
  coalesce(b.mal_id, t.mal_id) AS mal_id, CASE WHEN t.slug IS NULL OR coalesce(b.title, '') <> '' THEN b.title ELSE t.title END AS title,
  CASE WHEN t.slug IS NULL OR coalesce(b.tc, 'u') <> 'u' THEN b.tc ELSE t.tc END AS type_code,
  CASE WHEN t.slug IS NULL OR coalesce(b.sc, 'x') <> 'x' THEN b.sc ELSE t.sc END AS status_code,
  CASE WHEN t.slug IS NULL OR coalesce(b.score, 0) <> 0 THEN b.score ELSE t.score END AS score, {_CODES_SQL} AS codes,
  CASE WHEN t.slug IS NULL OR coalesce(b.links, '{{}}') <> '{{}}' THEN b.links ELSE '{{}}' END AS links
FROM t FULL OUTER JOIN b ON t.slug = b.slug
""")
def _upsert_detail(t: Tables):
    out = M.upsert_ranked(_catalog(t), _catalog_batch(t), ["slug"], M.RANKED_DETAIL, unique=True)
    return out.select("slug", "meta_source_code", "mal_id", "title", "type_code", "status_code", "score",
                      joined("genre_codes").alias("codes"), F.col("batch_links_json").alias("links"))


# -- keyed replaces ----------------------------------------------------------------------------

@query("upsert_enrichments", """
WITH t AS (SELECT CAST(doc_id AS VARCHAR) AS item_key, CASE WHEN quality = 1 THEN 'tmdb' ELSE 'jikan' END AS provider,
             CASE WHEN toxic = 1 THEN 'score_rejected' ELSE 'matched' END AS st, 50 + quality AS sc, NULL AS ext, NULL AS yr FROM labels),
b AS (SELECT CAST(doc_id AS VARCHAR) AS item_key, CASE WHEN lang = 'en' THEN 'tmdb' ELSE 'anilist' END AS provider,
        CASE WHEN source = 'src1' THEN 'matched' ELSE lang END AS st, CAST(least(100, n_chars) AS INTEGER) AS sc,
        CASE WHEN source = 'src2' THEN NULL ELSE source END AS ext, CASE WHEN n_chars > 500 THEN 2000 END AS yr FROM documents)
SELECT coalesce(b.item_key, t.item_key) AS item_key, coalesce(b.provider, t.provider) AS provider, coalesce(b.st, t.st) AS match_status,
  CAST(coalesce(b.sc, t.sc) AS BIGINT) AS match_score, CASE WHEN b.item_key IS NULL THEN t.ext ELSE b.ext END AS external_id,
  CAST(CASE WHEN b.item_key IS NULL THEN NULL ELSE b.yr END AS BIGINT) AS matched_year,
  CASE WHEN t.item_key IS NULL THEN '2002-01-01 00:00:00' ELSE '1995-01-01 00:00:00' END AS created_at
FROM t FULL OUTER JOIN b ON t.item_key = b.item_key AND t.provider = b.provider
""")
def _upsert_enrichments(t: Tables):
    stamp = at("1995-01-01 00:00:00")
    target = t.labels.select(
        F.col("doc_id").cast("string").alias("item_key"), F.when(F.col("quality") == 1, "tmdb").otherwise("jikan").alias("provider"),
        S(None).cast("string").alias("external_id"), F.when(F.col("toxic") == 1, "score_rejected").otherwise("matched").alias("match_status"),
        (F.col("quality") + 50).cast("smallint").alias("match_score"), S("t").alias("matched_title"), S(None).cast("smallint").alias("matched_year"),
        S("{}").alias("payload"), stamp.alias("created_at"), stamp.alias("updated_at"))
    batch = t.documents.select(
        F.col("doc_id").cast("string").alias("item_key"), F.when(F.col("lang") == "en", "tmdb").otherwise("anilist").alias("provider"),
        F.when(F.col("source") == "src2", " ").otherwise(F.col("source")).alias("external_id"),
        F.when(F.col("source") == "src1", "").otherwise(F.col("lang")).alias("match_status"), F.least(S(100), F.col("n_chars")).cast("smallint").alias("match_score"),
        F.col("lang").alias("matched_title"), F.when(F.col("n_chars") > 500, 2000).otherwise(0).alias("matched_year"), S("{}").alias("payload"))
    out = M.upsert_enrichments(target, batch, at(NOW))
    return out.select("item_key", "provider", "match_status", F.col("match_score").cast("bigint").alias("match_score"), "external_id",
                      F.col("matched_year").cast("bigint").alias("matched_year"), shown("created_at").alias("created_at"))


@query("upsert_options", f"""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_returnflag, l_linestatus, p ORDER BY {_LINE_LATEST_SQL}, l_orderkey DESC) AS rn
           FROM (SELECT *, CASE WHEN l_shipdate < TIMESTAMP '1999-01-01' THEN 0 ELSE 1 END AS p FROM lineitem)),
t AS (SELECT * FROM l WHERE p = 0 AND rn = 1), b AS (SELECT * FROM l WHERE p = 1 AND rn = 1)
SELECT coalesce(b.l_suppkey, t.l_suppkey) AS record_id, coalesce(b.l_returnflag, t.l_returnflag) AS label, coalesce(b.l_linestatus, t.l_linestatus) AS embed_url,
  CASE WHEN b.l_suppkey IS NULL THEN 'a' WHEN b.l_tax > 0.04 THEN 'd' ELSE 'u' END AS status_code, coalesce(b.l_quantity, t.l_quantity) AS size
FROM t FULL OUTER JOIN b ON t.l_suppkey = b.l_suppkey AND t.l_returnflag = b.l_returnflag AND t.l_linestatus = b.l_linestatus
""")
def _upsert_options(t: Tables):
    order = _line_latest() + [F.col("l_orderkey").desc()]
    shape = lambda df, code: df.select(
        F.col("l_suppkey").alias("record_id"), F.col("l_returnflag").alias("label"), F.col("l_linestatus").alias("embed_url"), code.alias("status_code"),
        F.col("l_quantity").alias("size"), *_LINE_ORDER, "l_orderkey")
    day = at("1999-01-01 00:00:00")
    keys = ["record_id", "label", "embed_url"]
    target = M.last_write(shape(t.lineitem.filter(F.col("l_shipdate") < day), S("a")), keys, order).select(*keys, "status_code", "size")
    batch = shape(t.lineitem.filter(F.col("l_shipdate") >= day), F.when(F.col("l_tax") > 0.04, "d"))
    return M.upsert_options(target, batch, "embed_url", "u", order)


@query("upsert_movies", """
WITH t AS (SELECT p_partkey AS tmdb_id, p_name AS title,
             CASE WHEN p_size < 10 THEN '' WHEN p_size < 30 THEN 'movie-' || p_partkey ELSE 'kept-' || p_partkey END AS slug, 'p' AS st FROM part WHERE p_type <> 'PROMO'),
g AS (SELECT l_partkey AS tmdb_id, max(l_returnflag) AS rf, max(l_linestatus) AS ls, max(l_quantity) AS q FROM lineitem GROUP BY 1),
b AS (SELECT tmdb_id, 'part ' || rf AS title, CASE WHEN q > 48 THEN ' new-' || tmdb_id || ' ' ELSE ' ' END AS slug, CASE WHEN q > 49 THEN '' ELSE ls END AS st FROM g)
SELECT coalesce(t.tmdb_id, b.tmdb_id) AS tmdb_id, coalesce(b.title, t.title) AS title,
  CASE WHEN t.tmdb_id IS NULL THEN CASE WHEN trim(b.slug) = '' THEN 'movie-' || b.tmdb_id ELSE trim(b.slug) END
       WHEN b.tmdb_id IS NULL THEN t.slug
       WHEN t.slug = '' OR t.slug = 'movie-' || t.tmdb_id THEN CASE WHEN trim(b.slug) = '' THEN 'movie-' || t.tmdb_id ELSE trim(b.slug) END
       ELSE t.slug END AS slug,
  CASE WHEN b.tmdb_id IS NULL THEN t.st WHEN b.st = '' THEN 'r' ELSE b.st END AS status_code
FROM t FULL OUTER JOIN b ON t.tmdb_id = b.tmdb_id
""")
def _upsert_movies(t: Tables):
    p = t.part.filter(F.col("p_type") != "PROMO")
    key = F.col("p_partkey")
    target = p.select(
        key.alias("tmdb_id"), F.col("p_name").alias("title"),
        F.when(F.col("p_size") < 10, "").when(F.col("p_size") < 30, F.concat(S("movie-"), key)).otherwise(F.concat(S("kept-"), key)).alias("slug"), S("p").alias("status_code"))
    g = t.lineitem.groupBy(F.col("l_partkey").alias("tmdb_id")).agg(F.max("l_returnflag").alias("rf"), F.max("l_linestatus").alias("ls"), F.max("l_quantity").alias("q"))
    batch = g.select(
        "tmdb_id", F.concat(S("part "), "rf").alias("title"), F.when(F.col("q") > 48, F.concat(S(" new-"), "tmdb_id", S(" "))).otherwise(" ").alias("slug"),
        F.when(F.col("q") > 49, "").otherwise(F.col("ls")).alias("status_code"))
    return M.upsert_movies(target, batch, unique=True)


@query("view_plain", _CATALOG_SQL + "SELECT slug, title, tc AS type_code, score FROM t")
def _view_plain(t: Tables):
    extra = {"source_code": S("s"), "season_code": S("x"), "year": S(None).cast("smallint"), "episode_count": S(None).cast("int"), "studio_codes": F.array().cast("array<smallint>")}
    return view_plain(_catalog(t).withColumns(extra), "series_list").select("slug", "title", "type_code", "score")


@query("upsert_movie_meta", """
WITH t AS (SELECT p_partkey AS tmdb_id, '["' || p_brand || '"]' AS cast_json, [p_type] AS d FROM part WHERE p_size < 30),
b AS (SELECT p_partkey AS tmdb_id, CASE WHEN p_type = 'PROMO' THEN '[]' ELSE '["x"]' END AS cast_json, CASE WHEN p_type = 'SMALL' THEN [] ELSE [p_name] END AS d FROM part WHERE p_size > 20)
SELECT coalesce(b.tmdb_id, t.tmdb_id) AS tmdb_id, coalesce(b.cast_json, t.cast_json) AS cast_json,
       array_to_string(CASE WHEN b.tmdb_id IS NULL THEN t.d ELSE b.d END, '|') AS director_names
FROM t FULL OUTER JOIN b ON t.tmdb_id = b.tmdb_id
""")
def _upsert_movie_meta(t: Tables):
    p = t.part
    target = p.filter(F.col("p_size") < 30).select(F.col("p_partkey").alias("tmdb_id"), F.concat(S('["'), "p_brand", S('"]')).alias("cast_json"), F.array("p_type").alias("director_names"))
    batch = p.filter(F.col("p_size") > 20).select(
        F.col("p_partkey").alias("tmdb_id"), F.when(F.col("p_type") != "PROMO", '["x"]').alias("cast_json"), F.when(F.col("p_type") != "SMALL", F.array("p_name")).alias("director_names"))
    return M.upsert_movie_meta(target, batch).select("tmdb_id", "cast_json", joined("director_names").alias("director_names"))


@query("upsert_provider_records", """
WITH t AS (SELECT s_suppkey + 1 AS id, n_name AS pc, s_name AS ps, 'old' AS title FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_acctbal > 2000),
b AS (SELECT n_name AS pc, s_name AS ps, 'bal ' || CAST(round(s_acctbal) AS BIGINT) AS title FROM supplier JOIN nation ON n_nationkey = s_nationkey),
n AS (SELECT b.*, row_number() OVER (ORDER BY b.pc, b.ps) AS rn FROM b ANTI JOIN t ON t.pc = b.pc AND t.ps = b.ps)
SELECT t.id, b.pc AS provider_code, b.ps AS provider_slug, b.title FROM t JOIN b ON t.pc = b.pc AND t.ps = b.ps
UNION ALL SELECT (SELECT max(id) FROM t) + rn, pc, ps, title FROM n
""")
def _upsert_provider_records(t: Tables):
    s = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey"))
    shape = [F.col("n_name").alias("provider_code"), F.col("s_name").alias("provider_slug")]
    target = s.filter(F.col("s_acctbal") > 2000).select((F.col("s_suppkey") + 1).alias("id"), *shape, S("old").alias("title"))
    batch = s.select(*shape, F.concat(S("bal "), F.round("s_acctbal").cast("bigint")).alias("title"))
    return M.upsert_provider_records(target, batch)


# -- JSON merges ------------------------------------------------------------------------------------

@query("detail_shallow_merge", """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN '-1' ELSE json_extract_string(props, '$.k') END AS k,
       event_type AS t, CAST(user_id AS VARCHAR) AS u FROM events
""")
def _shallow(t: Tables):
    kind = F.col("event_type")
    new = F.concat(S('{"t":"'), kind, S('"'), F.when(kind == "error", ',"k":null').when(kind == "view", ',"k":-1').otherwise(""), S("}"))
    old = t.heavy("events").withColumn("detail", jsoncol.merge_shallow("props", F.concat(S('{"u":'), F.col("user_id").cast("string"), S("}"))))
    out = old.withColumn("detail", jsoncol.merge_shallow("detail", new))
    return out.select("event_id", js("detail", "k").alias("k"), js("detail", "t").alias("t"), js("detail", "u").alias("u"))


@query("subdoc_merge", """
SELECT event_id, json_extract_string(props, '$.k') AS k, CASE WHEN event_type = 'view' THEN 'view' ELSE 'old' END AS p1,
       CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS p2, 'side' AS sibling FROM events
""")
def _subdoc(t: Tables):
    base = t.heavy("events").withColumn("detail", jsoncol.merge_shallow("props", S('{"sources":{"p1":{"v":"old"},"s":"side"}}')))
    payload = F.concat(S('{"v":"'), "event_type", S('"}'))
    one = base.withColumn("d1", jsoncol.merge_subdoc("detail", "sources", "p1", payload)).withColumn("d2", jsoncol.merge_subdoc("detail", "sources", "p2", payload))
    d = F.when(F.col("event_type") == "view", F.col("d1")).otherwise(F.col("d2"))
    return one.withColumn("d", d).select("event_id", js("d", "k").alias("k"), js("d", "sources.p1.v").alias("p1"), js("d", "sources.p2.v").alias("p2"), js("d", "sources.s").alias("sibling"))


@query("map_merge_left", """
SELECT p_partkey, CASE WHEN p_size < 10 THEN p_type ELSE p_name END AS a, p_brand AS b, CASE WHEN p_size >= 10 THEN 'left' END AS c FROM part
""")
def _map_left(t: Tables):
    p = t.part
    left = F.create_map(S("a"), F.when(F.col("p_size") < 10, " ").otherwise(F.col("p_name")), S("c"), F.when(F.col("p_size") >= 10, "left").otherwise(""), S(" "), S("blank key"))
    right = F.create_map(S("a"), F.col("p_type"), S("b"), F.col("p_brand"))
    m = p.withColumn("m", jsoncol.map_merge_left(left, right))
    return m.select("p_partkey", *[F.try_element_at("m", S(k)).alias(k) for k in "abc"])


# -- other shapes -----------------------------------------------------------------------------------------

_SYNC_SQL = """
WITH t AS (SELECT l_orderkey AS k, count(*) AS lines, max(l_extendedprice) AS top FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-06-01' GROUP BY 1),
s AS (SELECT l_orderkey AS k, count(*) AS lines, max(l_extendedprice) AS top FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY 1),
d AS (SELECT coalesce(s.k, t.k) AS k, CASE WHEN s.k IS NULL THEN t.lines ELSE s.lines END AS lines, CASE WHEN s.k IS NULL THEN t.top ELSE s.top END AS top,
        CASE WHEN t.k IS NULL THEN 'insert' WHEN s.k IS NULL THEN 'delete' WHEN s.lines IS NOT DISTINCT FROM t.lines AND s.top IS NOT DISTINCT FROM t.top THEN 'unchanged' ELSE 'update' END AS action
      FROM t FULL OUTER JOIN s ON s.k = t.k)
"""


def _sync(t: Tables):
    agg = lambda df: df.groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("lines"), F.max("l_extendedprice").alias("top"))
    old = agg(t.lineitem.filter(F.col("l_shipdate") < at("1998-06-01 00:00:00")))
    new = agg(t.lineitem.filter(F.col("l_shipdate") >= at("1998-01-01 00:00:00")))
    return M.sync_read_model(old, new, ["k"])


@query("read_model_sync", _SYNC_SQL + "SELECT k, lines, top FROM d WHERE action <> 'delete'")
def _sync_model(t: Tables):
    return _sync(t)[0]


@query("read_model_counts", _SYNC_SQL + "SELECT action, count(*) AS n FROM d GROUP BY 1")
def _sync_counts(t: Tables):
    return _sync(t)[1]


def _rekey(t: Tables):
    base = shop_items(t)
    items = base.select("item_key", "source", F.lit("anime").alias("media_type"), "slug", "c_acctbal", "updated_at").unionByName(
        base.filter(F.col("c_nationkey") == 5).select(
            F.concat_ws(":", "source", S("movie"), "slug").alias("item_key"), "source", S("movie").alias("media_type"), "slug", S(9999.0).alias("c_acctbal"), "updated_at"))
    units = shop_units(t).withColumn("detail", S('{"x":1}'))
    return M.rekey_items(items, units.select("unit_key", "item_key", "detail", "updated_at"), (F.col("media_type") == "anime") & (F.col("c_acctbal") < 3000), "movie", at(NOW))


_REKEY_SQL = f"""
WITH {SHOP_SQL},
i AS (SELECT item_key, source, 'anime' AS media_type, slug, c_acctbal FROM items
      UNION ALL SELECT source || ':movie:' || slug, source, 'movie', slug, 9999.0 FROM items WHERE c_nationkey = 5),
u AS (SELECT * FROM units),
n AS (SELECT item_key, count(*) AS c FROM u GROUP BY 1),
m AS (SELECT i.item_key AS old_key, i.source || ':movie:' || i.slug AS new_key, i.slug, coalesce(n.c, 0) AS children FROM i LEFT JOIN n ON n.item_key = i.item_key
      WHERE i.media_type = 'anime' AND i.c_acctbal < 3000 AND coalesce(n.c, 0) <= 1 AND NOT EXISTS (SELECT 1 FROM i x WHERE x.item_key = i.source || ':movie:' || i.slug))
"""


@query("rekey_items", _REKEY_SQL + """
SELECT coalesce(m.new_key, i.item_key) AS item_key, CASE WHEN m.new_key IS NULL THEN i.media_type ELSE 'movie' END AS media_type, i.slug
FROM i LEFT JOIN m ON m.old_key = i.item_key
""")
def _rekey_items(t: Tables):
    return _rekey(t)[0].select("item_key", "media_type", "slug")


@query("rekey_units", _REKEY_SQL + """
SELECT u.unit_key, coalesce(m.new_key, u.item_key) AS item_key, m.slug AS parent, '1' AS x FROM u LEFT JOIN m ON m.old_key = u.item_key
""")
def _rekey_units(t: Tables):
    return _rekey(t)[1].select("unit_key", "item_key", js("detail", "anime_slug").alias("parent"), js("detail", "x").alias("x"))


@query("rekey_mapping", _REKEY_SQL + "SELECT old_key, new_key, slug, children FROM m")
def _rekey_mapping(t: Tables):
    return _rekey(t)[2].select("old_key", "new_key", "slug", "children")


@query("parent_stubs", """
WITH i AS (SELECT CAST(p_partkey AS VARCHAR) AS slug, p_name AS title, TIMESTAMP '1995-01-01' AS touched FROM part WHERE p_size > 10),
s AS (SELECT CAST(l_partkey AS VARCHAR) AS slug, max(l_shipdate) AS touched FROM lineitem GROUP BY 1)
SELECT slug, title, strftime(touched, '%Y-%m-%d %H:%M:%S') AS touched FROM i
UNION ALL SELECT slug, slug, strftime(touched, '%Y-%m-%d %H:%M:%S') FROM s WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.slug = s.slug)
""")
def _stubs(t: Tables):
    items = t.part.filter(F.col("p_size") > 10).select(F.col("p_partkey").cast("string").alias("slug"), F.col("p_name").alias("title"), at("1995-01-01 00:00:00").alias("touched"))
    units = t.lineitem.select(F.col("l_partkey").cast("string").alias("slug"), F.col("l_shipdate").alias("touched"))
    return M.ensure_parents(items, units, "slug", "title", "touched").select("slug", "title", shown("touched").alias("touched"))


@query("prune_empty", """
SELECT p_partkey, CASE WHEN p_size < 20 THEN '' ELSE p_name END AS trailer, CASE WHEN p_type = 'PROMO' THEN '[]' ELSE '["a"]' END AS cast_json
FROM part WHERE NOT (p_size < 20 AND p_type = 'PROMO')
""")
def _prune(t: Tables):
    df = t.part.select("p_partkey", F.when(F.col("p_size") < 20, "").otherwise(F.col("p_name")).alias("trailer"), F.when(F.col("p_type") == "PROMO", "[]").otherwise('["a"]').alias("cast_json"))
    return M.prune_empty(df, {"trailer": [""], "cast_json": ["[]"]})


_LEGACY_SQL = """
WITH u AS (SELECT l_orderkey, l_partkey AS parent, l_linenumber AS number, l_orderkey || '-' || l_linenumber || CASE WHEN l_returnflag = 'R' THEN '-subtitle-indonesia' ELSE '' END AS slug FROM lineitem)
SELECT slug, parent, number FROM u WHERE NOT (slug LIKE '%subtitle-indonesia%' AND EXISTS (
  SELECT 1 FROM u c WHERE c.parent = u.parent AND c.number = u.number AND c.slug NOT LIKE '%subtitle-indonesia%'))
"""


@query("legacy_dedupe", _LEGACY_SQL)
def _legacy(t: Tables):
    u = t.lineitem.select(
        F.concat(F.concat_ws("-", "l_orderkey", "l_linenumber"), F.when(F.col("l_returnflag") == "R", "-subtitle-indonesia").otherwise("")).alias("slug"),
        F.col("l_partkey").alias("parent"), F.col("l_linenumber").alias("number"))
    return M.dedupe_legacy(u, "parent", "number", "slug").select("slug", "parent", "number")


@query("supplement_records", """
WITH a AS (SELECT o_custkey AS k, max(o_orderpriority) AS title, max(CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE '' END) AS status, [min(o_orderpriority), max(o_orderstatus)] AS genres FROM orders GROUP BY 1),
b AS (SELECT c_custkey AS k, n_name AS title, [n_name, c_mktsegment] AS genres FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT c_custkey AS k, CASE WHEN c_acctbal < 2000 THEN coalesce(a.title, b.title) ELSE c_name END AS title,
       coalesce(nullif(a.status, ''), c_mktsegment) AS status,
       array_to_string(list_filter(g, lambda v, i: list_position(g, v) = i), '|') AS genres
FROM (SELECT c.*, list_concat([c_mktsegment], coalesce(a.genres, []), b.genres) AS g
      FROM customer c LEFT JOIN a ON a.k = c.c_custkey LEFT JOIN b ON b.k = c.c_custkey) c
LEFT JOIN a ON a.k = c.c_custkey LEFT JOIN b ON b.k = c.c_custkey
""")
def _supplement(t: Tables):
    base = t.customer.select(
        F.col("c_custkey").alias("k"), F.when(F.col("c_acctbal") < 2000, "").otherwise(F.col("c_name")).alias("title"), F.col("c_mktsegment").alias("status"), F.array("c_mktsegment").alias("genres"))
    a = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(
        F.max("o_orderpriority").alias("title"), F.max(F.when(F.col("o_orderstatus") == "F", "done").otherwise("")).alias("status"),
        F.array(F.min("o_orderpriority"), F.max("o_orderstatus")).alias("genres"))
    b = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("c_custkey").alias("k"), F.col("n_name").alias("title"), F.array("n_name", "c_mktsegment").alias("genres"))
    return M.supplement(base, [a, b], "k", ["title", "status"], ["genres"], overriding=["status"]).withColumn("genres", joined("genres"))


_REFILL_SQL = """
WITH b AS (SELECT p_partkey AS k, CASE WHEN p_size < 20 THEN '' ELSE p_name END AS v FROM part),
x AS (SELECT l_partkey AS k, max(CASE WHEN l_quantity > 48 THEN l_shipdate::VARCHAR ELSE '' END) AS v FROM lineitem GROUP BY 1)
SELECT b.k AS k, coalesce(nullif(b.v, ''), nullif(x.v, ''), '') AS filled, coalesce(nullif(x.v, ''), nullif(b.v, ''), '') AS overwritten FROM b LEFT JOIN x ON x.k = b.k
"""


@query("refill_policies", _REFILL_SQL)
def _refill(t: Tables):
    base = t.part.select(F.col("p_partkey").alias("k"), F.when(F.col("p_size") < 20, "").otherwise(F.col("p_name")).alias("v"))
    base = base.select("k", F.col("v").alias("filled"), F.col("v").alias("overwritten"))
    extra = t.lineitem.groupBy(F.col("l_partkey").alias("k")).agg(F.max(F.when(F.col("l_quantity") > 48, shown("l_shipdate")).otherwise("")).alias("filled"))
    extra = extra.withColumn("overwritten", F.col("filled"))
    return M.refill(M.refill(base, extra, "k", ["filled"], "fill"), extra, "k", ["overwritten"], "overwrite")


@query("resolve_parents", f"""
WITH {SHOP_SQL},
i AS (SELECT 'a' || item_key AS item_key, source, title AS slug, updated_at FROM items WHERE c_acctbal > 0
      UNION ALL SELECT 'b' || item_key, source, title, TIMESTAMP '1995-01-10' FROM items WHERE c_nationkey > 5),
newest AS (SELECT source, slug, arg_max(item_key, (updated_at, item_key)) AS item_key FROM i GROUP BY 1, 2)
SELECT u.unit_key, coalesce(n.item_key, u.source || ':anime:' || c.c_name) AS item_key
FROM units u JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = u.item_key LEFT JOIN newest n ON n.source = u.source AND n.slug = c.c_name
""")
def _resolve(t: Tables):
    items = shop_items(t)
    two = items.filter(F.col("c_acctbal") > 0).select(F.concat(S("a"), "item_key").alias("item_key"), "source", F.col("title").alias("slug"), "updated_at").unionByName(
        items.filter(F.col("c_nationkey") > 5).select(F.concat(S("b"), "item_key").alias("item_key"), "source", F.col("title").alias("slug"), at("1995-01-10 00:00:00").alias("updated_at")))
    names = t.customer.select(F.col("c_custkey").cast("string").alias("item_key"), F.col("c_name").alias("parent"))
    units = shop_units(t).join(names, "item_key").select("unit_key", "item_key", "source", "parent")
    return M.resolve_parent_keys(units, two, "parent").select("unit_key", "item_key")


@query("repair_provenance", r"""
WITH p AS (SELECT page_id, 's' || page_id AS slug, url AS c, CASE WHEN url LIKE 'https://m.%' THEN 'https://home.example.org/s' || page_id || '/' ELSE url END AS canonical FROM pages),
a AS (SELECT page_id, slug, canonical, canonical LIKE 'https://home.example.org/%' AS own, 'https://home.example.org/' || slug || '/' AS home FROM p)
SELECT page_id, CASE WHEN own THEN canonical ELSE home END AS canonical_url, home AS primary_url, CASE WHEN own THEN '' ELSE canonical END AS secondary_url,
  CASE WHEN own THEN home ELSE canonical END AS effective_url, CASE WHEN own THEN 'primary' ELSE 'secondary' END AS effective_kind,
  CASE WHEN own THEN 'pending' ELSE 'legacy_secondary_only' END AS fetch_status,
  CASE WHEN own THEN 'home.example.org' ELSE regexp_extract(canonical, '^https?://([^/?#]*)', 1) END AS effective_domain
FROM a
""")
def _provenance(t: Tables):
    p = t.pages.select(
        "page_id", F.concat(S("s"), "page_id").alias("slug"),
        F.when(F.col("url").startswith("https://m."), F.concat(S("https://home.example.org/s"), "page_id", S("/"))).otherwise(F.col("url")).alias("canonical_url"),
        *[S("").alias(c) for c in ("primary_url", "secondary_url", "effective_url", "effective_kind", "fetch_status")])
    out = M.repair_provenance(p, "https://home.example.org")
    return out.select("page_id", "canonical_url", "primary_url", "secondary_url", "effective_url", "effective_kind", "fetch_status", "effective_domain")


@query("annotate_detail", """
SELECT p_partkey, CASE WHEN p_type = 'PROMO' OR p_name LIKE 'red%' THEN 'live_action' END AS adaptation,
       CASE WHEN p_type = 'PROMO' OR p_name LIKE 'red%' THEN 'series' END AS fmt, p_brand AS brand FROM part
""")
def _annotate(t: Tables):
    slug = F.concat(F.replace("p_name", S(" "), S("-")), F.when(F.col("p_type") == "PROMO", "-live-action").otherwise(""))
    title = F.concat("p_name", F.when(F.col("p_name").startswith("red"), " Live Action").otherwise(""))
    df = t.part.select("p_partkey", slug.alias("slug"), title.alias("title"), F.concat(S('{"brand":"'), "p_brand", S('"}')).alias("detail"))
    return M.annotate(df).select("p_partkey", js("detail", "adaptation_type").alias("adaptation"), js("detail", "entry_format").alias("fmt"), js("detail", "brand").alias("brand"))


# -- dimensions -----------------------------------------------------------------------------------------------

_WORDS = "list_concat(string_split(p_name, ' '), [lower(p_type), ' '])"


def _part_words(t: Tables):
    return t.part.select("p_partkey", F.concat(F.split("p_name", " "), F.array(F.lower("p_type"), S(" "))).alias("names"), "p_size")


def _dim(t: Tables):
    """Dimension of the words seen in small parts: codes in name order, from 1."""
    words = _part_words(t).filter(F.col("p_size") < 3).select(F.explode("names").alias("w"))
    empty = t.spark.createDataFrame([], "code smallint, name string")
    return dims.ensure_dim(empty, words, "w")


_DIM_SQL = f"""
w AS (SELECT p_partkey, p_size, unnest({_WORDS}) AS name FROM part),
dim AS (SELECT row_number() OVER (ORDER BY name) AS code, name FROM (SELECT DISTINCT trim(name) AS name FROM w WHERE p_size < 3 AND trim(name) <> ''))
"""


@query("ensure_dim", f"""
WITH {_DIM_SQL}, more AS (SELECT DISTINCT trim(name) AS name FROM w WHERE trim(name) <> '')
SELECT code, name FROM dim UNION ALL
SELECT (SELECT max(code) FROM dim) + row_number() OVER (ORDER BY name), name FROM more WHERE name NOT IN (SELECT name FROM dim)
""")
def _ensure_dim(t: Tables):
    grown = dims.ensure_dim(_dim(t), _part_words(t).select(F.explode("names").alias("w")), "w")
    return grown.select(F.col("code").cast("bigint").alias("code"), "name")


@query("dim_encode", f"""
WITH {_DIM_SQL}
SELECT w.p_partkey, coalesce(array_to_string(list_sort(list_distinct(list(dim.code) FILTER (dim.code IS NOT NULL))), '|'), '') AS codes
FROM w LEFT JOIN dim ON dim.name = w.name GROUP BY 1
""")
def _encode(t: Tables):
    return dims.encode_array(_part_words(t), "p_partkey", "names", _dim(t)).select("p_partkey", joined("codes").alias("codes"))


@query("dim_decode", f"""
WITH {_DIM_SQL}
SELECT w.p_partkey, coalesce(string_agg(DISTINCT dim.name, '|' ORDER BY dim.name), '') AS names FROM w LEFT JOIN dim ON dim.name = w.name GROUP BY 1
""")
def _decode(t: Tables):
    dim = _dim(t)
    coded = dims.encode_array(_part_words(t), "p_partkey", "names", dim)
    return dims.decode_array(coded, "p_partkey", "codes", dim).select("p_partkey", joined("names").alias("names"))


del r6
