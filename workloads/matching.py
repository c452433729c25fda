from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showledger.operators import matching as X
from showledger.plans.review import review_children, review_hits, review_titles
from showledger.session import cut_lineage
from showledger.sources.sinks import report_rows

from .base import Tables, query, r6

S = F.lit


def _page_titles(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Page titles, and the same pages' headings with filler and a section word."""
    title = F.replace(F.regexp_extract("html", "<title>(.*?)</title>", 1), S("&amp;"), S("&"))
    heading = F.replace(F.regexp_extract("html", "<h1>(.*?)</h1>", 1), S("&amp;"), S("&"))
    section = F.regexp_extract("url", "^https?://[^/]+/([a-z]+)/", 1)
    own = t.pages.select("page_id", title.alias("title"))
    ext = t.pages.select(F.col("page_id").alias("ext_id"), F.concat(heading, S(" Sub Indo "), section).alias("ext_title"))
    return own, ext


# token sets, brute force over every pair that shares a token
_MATCH_SQL = r"""
own AS (SELECT page_id, replace(regexp_extract(html, '<title>(.*?)</title>', 1), '&amp;', '&') AS title FROM pages),
ext AS (SELECT page_id AS ext_id, replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '&amp;', '&') || ' Sub Indo ' || regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS ext_title FROM pages),
ot AS (SELECT page_id, list_filter(list_distinct(string_split(trim(regexp_replace(lower(trim(regexp_replace(title, '\s+', ' ', 'g'))), '[^a-z0-9]+', ' ', 'g')), ' ')), lambda x: x NOT IN ('', 'subtitle', 'indonesia', 'sub', 'indo', 'episode', 'lengkap')) AS toks FROM own),
et AS (SELECT ext_id, ext_title, list_filter(list_distinct(string_split(trim(regexp_replace(lower(replace(trim(regexp_replace(ext_title, '\s+', ' ', 'g')), 'Sub Indo', '')), '[^a-z0-9]+', ' ', 'g')), ' ')), lambda x: x NOT IN ('', 'subtitle', 'indonesia', 'sub', 'indo', 'episode', 'lengkap')) AS toks FROM ext),
sc AS (SELECT page_id, ext_id, ext_title, greatest(0, least(1, CAST(len(list_intersect(o.toks, e.toks)) AS DOUBLE) / (len(o.toks) + len(e.toks) - len(list_intersect(o.toks, e.toks)))
         - abs(len(o.toks) - len(e.toks)) * CAST(0.03 AS DOUBLE))) AS score
       FROM ot o JOIN et e ON len(list_intersect(o.toks, e.toks)) > 0),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, ext_id) AS rn FROM sc WHERE score >= {min}) WHERE rn = 1)
"""


@query("title_match", "WITH " + _MATCH_SQL.replace("{min}", "0.55") + """
SELECT own.page_id, ext_id, ext_title, round(score, 6) AS match_score FROM own LEFT JOIN best ON best.page_id = own.page_id
""")
def _match(t: Tables):
    own, ext = _page_titles(t)
    out = X.match_titles(own, ext, left_title="title", right_id="ext_id", right_title="ext_title", min_score=0.55)
    return out.select("page_id", "ext_id", "ext_title", r6("match_score").alias("match_score"))


_TEXT_NORM = r"trim(regexp_replace(regexp_replace(replace(replace(lower({x}), '''', ''), '’', ''), '[_\-:!?,.()|]', ' ', 'g'), '[\s\p{Z}]+', ' ', 'g'))"
# each turn asks; the next two turns of the conversation answer
_HITS_SQL = f"""
q AS (SELECT conv_id, turn, text, {_TEXT_NORM.replace('{x}', 'text')} AS nt FROM conversations),
pairs AS (SELECT a.conv_id, a.turn AS query_pos, b.turn - a.turn - 1 AS hit_pos, b.text AS hit_text, a.text AS query, a.nt AS tgt, b.nt AS val, 2000 + b.turn AS yr
          FROM q a JOIN q b ON a.conv_id = b.conv_id AND b.turn - a.turn IN (1, 2)),
sh AS (SELECT *, len(list_filter(string_split(tgt, ' '), lambda x: x <> '' AND list_contains(string_split(val, ' '), x))) AS shared FROM pairs),
base AS (SELECT *, CASE WHEN tgt = '' OR val = '' THEN 0 WHEN val = tgt THEN 100 WHEN contains(val, tgt) OR contains(tgt, val) THEN 70 WHEN shared >= 2 THEN 40 + shared ELSE 0 END AS ts FROM sh),
scored AS (SELECT *, CASE WHEN ts > 0 THEN ts + CASE WHEN yr = 2003 THEN 20 WHEN abs(yr - 2003) = 1 THEN 5 ELSE 0 END ELSE 0 END AS score FROM base)
"""


def _turns(t: Tables):
    c = t.heavy("conversations")
    queries = c.select(F.col("conv_id").alias("query_id"), F.col("turn").alias("query_pos"), F.col("text").alias("query"), S(2003).alias("year"))
    answers = c.select(F.col("conv_id").alias("query_id"), "turn", F.array("text").alias("titles"), (F.col("turn") + 2000).cast("int").alias("year"))
    hits = answers.select(
        "query_id", F.explode(F.array(S(1), S(2))).alias("back"), "turn", F.concat_ws("-", "query_id", "turn").alias("external_id"), "titles", "year"
    ).select("query_id", (F.col("turn") - F.col("back")).alias("query_pos"), (F.col("back") - 1).alias("hit_pos"), "external_id", "titles", "year")
    return queries, hits.filter(F.col("query_pos") >= 0)


@query("scored_match", "WITH " + _HITS_SQL + "SELECT conv_id AS query_id, query_pos, hit_pos, CAST(score AS BIGINT) AS score FROM scored")
def _scored(t: Tables):
    queries, hits = _turns(t)
    return X.score_hits(queries, hits, "A").select("query_id", "query_pos", F.col("hit_pos").cast("bigint").alias("hit_pos"), F.col("score").cast("bigint").alias("score"))


def _profile_sql(contains: int, least: int, base: int, near: bool, season: bool) -> str:
    """The scores under another profile; every other turn names a season."""
    norm = _TEXT_NORM.replace("|]", "]") if season else _TEXT_NORM
    said = "text || CASE WHEN turn % 2 = 0 THEN ' | Season 2' ELSE '' END"
    year = "CASE WHEN yr = 2003 THEN 20 WHEN abs(yr - 2003) = 1 THEN 5 ELSE 0 END" if near else "0"
    bonus = "CASE WHEN contains(tgt, 'season 2') AND contains(val, 'season 2') THEN 15 ELSE 0 END" if season else "0"
    return f"""
WITH q AS (SELECT conv_id, turn, {norm.replace('{x}', said)} AS nt FROM conversations),
pairs AS (SELECT a.conv_id, a.turn AS query_pos, b.turn - a.turn - 1 AS hit_pos, a.nt AS tgt, b.nt AS val, 2000 + b.turn AS yr FROM q a JOIN q b ON a.conv_id = b.conv_id AND b.turn - a.turn IN (1, 2)),
sh AS (SELECT *, len(list_filter(string_split(tgt, ' '), lambda x: x <> '' AND list_contains(string_split(val, ' '), x))) AS shared FROM pairs),
base AS (SELECT *, CASE WHEN tgt = '' OR val = '' THEN 0 WHEN val = tgt THEN 100 WHEN contains(val, tgt) OR contains(tgt, val) THEN {contains} WHEN shared >= {least} THEN {base} + shared ELSE 0 END + {bonus} AS ts FROM sh)
SELECT conv_id AS query_id, query_pos, hit_pos, CAST(CASE WHEN ts > 0 THEN ts + {year} ELSE 0 END AS BIGINT) AS score FROM base
"""


def _profile(t: Tables, profile: str) -> DataFrame:
    season = lambda turn: F.when(turn % 2 == 0, " | Season 2").otherwise("")
    queries, hits = _turns(t)
    queries = queries.withColumn("query", F.concat("query", season(F.col("query_pos"))))
    turn = F.col("query_pos") + F.col("hit_pos") + 1
    hits = hits.withColumn("titles", F.transform("titles", lambda x: F.concat(x, season(turn))))
    return X.score_hits(queries, hits, profile).select("query_id", "query_pos", F.col("hit_pos").cast("bigint").alias("hit_pos"), F.col("score").cast("bigint").alias("score"))


@query("scored_match_b", _profile_sql(65, 2, 45, True, False))
def _scored_b(t: Tables):
    return _profile(t, "B")


@query("scored_match_c", _profile_sql(70, 3, 40, False, True))
def _scored_c(t: Tables):
    return _profile(t, "C")


@query("enrich_best", "WITH " + _HITS_SQL + """,
pq AS (SELECT q.conv_id, q.turn, q.text, coalesce(max(s.score), 0) AS sc, count(s.score) AS n, arg_min(s.hit_pos, (-s.score, s.hit_pos)) AS hp FROM q LEFT JOIN scored s ON s.conv_id = q.conv_id AND s.query_pos = q.turn GROUP BY 1, 2, 3),
pick AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY CASE WHEN sc >= 48 THEN 0 ELSE 1 END, CASE WHEN sc >= 48 THEN turn ELSE -sc END, turn) AS rn FROM pq) WHERE rn = 1),
c AS (SELECT DISTINCT conv_id FROM conversations UNION ALL SELECT 1000000 + doc_id FROM labels)
SELECT c.conv_id AS item_key, CASE WHEN p.conv_id IS NULL THEN 'missing_query' WHEN sc >= 48 THEN 'matched' WHEN n = 0 THEN 'search_empty' ELSE 'score_rejected' END AS match_status,
  CAST(least(100, coalesce(sc, 0)) AS BIGINT) AS match_score, CASE WHEN sc >= 48 THEN p.conv_id || '-' || (turn + hp + 1) END AS external_id, CASE WHEN sc >= 48 THEN text END AS matched_query
FROM c LEFT JOIN pick p ON p.conv_id = c.conv_id
""")
def _best(t: Tables):
    queries, hits = _turns(t)
    items = t.conversations.select(F.col("conv_id").alias("item_key")).distinct().unionByName(t.labels.select((F.col("doc_id") + 1000000).alias("item_key")))
    out = X.pick_best(items, queries, X.score_hits(queries, hits, "A"), 48, F.concat(S("item "), "item_key"))
    return out.select("item_key", "match_status", F.col("match_score").cast("bigint").alias("match_score"), "external_id", "matched_query")


# -- review: page titles against headings; children are nav links against paragraphs ---------

_NAV = r'<li><a href="([^"]*)">'


def _review(t: Tables, cap: int = 0) -> DataFrame:
    own, ext = _page_titles(t)
    verdicts = cut_lineage(review_titles(own, ext, ext_id="ext_id", ext_title="ext_title", ext_order=["ext_id"]))  # used twice
    nav = t.pages.select(F.col("page_id").alias("ext_id"), F.posexplode(F.regexp_extract_all("html", S(_NAV), S(1))).alias("at", "href"))
    ext_children = verdicts.filter(F.col("match_status") == "matched").select("page_id", "ext_id").join(nav, "ext_id").select(
        "page_id", (F.col("at") + 1).alias("pos"), (F.col("at") + 1).cast("string").alias("number"), "href")
    own_children = t.pages.select("page_id", F.posexplode(F.regexp_extract_all("html", S("<p>([^<]*)</p>"), S(1))).alias("at", "text")).select(
        "page_id", F.concat(S(" "), F.col("at") + 1, S(" ")).alias("own_number"), F.concat(S("par-"), F.col("at") + 1).alias("own_slug"))
    kids = X.reconcile_children(ext_children, own_children, "page_id", "number", "own_number", ["own_slug"], [F.col("pos")], cap=cap)
    return review_children(verdicts, kids, "page_id", "number", ["number", "href", "own_slug"], cap=cap)


_REVIEW_SQL = "WITH " + _MATCH_SQL.replace("{min}", "0.55") + r""",
v AS (SELECT own.page_id, own.title, best.ext_id, coalesce(score, 0) AS score, score IS NOT NULL AS ok FROM own LEFT JOIN best ON best.page_id = own.page_id),
nav AS (SELECT page_id AS ext_id, unnest(l) AS href, generate_subscripts(l, 1) AS n FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">', 1) AS l FROM pages)),
par AS (SELECT page_id, len(regexp_extract_all(html, '<p>([^<]*)</p>', 1)) AS k FROM pages),
kids AS (SELECT v.page_id, nav.n, nav.href, CASE WHEN nav.n <= par.k THEN 'par-' || nav.n END AS own_slug FROM v JOIN nav ON nav.ext_id = v.ext_id {cap} JOIN par ON par.page_id = v.page_id)
"""


_REPORT_SQL = """
SELECT v.page_id, v.ext_id, round(score, 6) AS match_score, CASE WHEN ok THEN 'matched' ELSE 'no_match' END AS match_status, ok AND score < 0.8 AS needs_review,
  CASE WHEN ok AND score < 0.8 THEN 'low confidence title match' WHEN ok THEN '' ELSE 'no search results' END AS notes,
  string_agg(k.n || '=' || k.href || '=' || coalesce(k.own_slug, ''), '|' ORDER BY k.n) AS children
FROM v LEFT JOIN kids k ON k.page_id = v.page_id GROUP BY ALL
"""


@query("review_report_capped", _REVIEW_SQL.replace("{cap}", "AND nav.n <= 5") + _REPORT_SQL)
def _review_capped(t: Tables):
    """The report's own limit of five children."""
    return _report(_review(t, 5))


@query("review_report", _REVIEW_SQL.replace("{cap}", "") + _REPORT_SQL)
def _review_report(t: Tables):
    return _report(_review(t))


def _report(review: DataFrame) -> DataFrame:
    kids = F.transform("children", lambda c: F.concat(c["number"], S("="), c["href"], S("="), F.coalesce(c["own_slug"], S(""))))
    return review.select("page_id", "ext_id", r6("match_score").alias("match_score"), "match_status", "needs_review", "notes", F.array_join(kids, "|").alias("children"))


@query("review_csv_rows", _REVIEW_SQL.replace("{cap}", "") + """
SELECT CAST(v.page_id AS VARCHAR) AS page_id, format('{:.3f}', score) AS match_score, CASE WHEN ok AND score < 0.8 THEN 'true' ELSE 'false' END AS needs_review,
  coalesce(CAST(k.n AS VARCHAR), '') AS number, coalesce(k.own_slug, '') AS own_slug
FROM v LEFT JOIN kids k ON k.page_id = v.page_id
""")
def _review_csv(t: Tables):
    return report_rows(_review(t), ["page_id", "match_score", "needs_review"], "children", ["number", "own_slug"])


@query("review_hits", r"""
WITH q AS (SELECT conv_id, turn, list_filter(list_distinct(string_split(trim(regexp_replace(lower(trim(regexp_replace(text, '\s+', ' ', 'g'))), '[^a-z0-9]+', ' ', 'g')), ' ')), lambda x: x NOT IN ('', 'subtitle', 'indonesia', 'sub', 'indo', 'episode', 'lengkap')) AS toks FROM conversations),
s AS (SELECT a.conv_id, b.turn, CASE WHEN len(a.toks) = 0 OR len(b.toks) = 0 THEN 0 ELSE greatest(0, least(1, CAST(len(list_intersect(a.toks, b.toks)) AS DOUBLE) / (len(a.toks) + len(b.toks) - len(list_intersect(a.toks, b.toks)))
       - abs(len(a.toks) - len(b.toks)) * CAST(0.03 AS DOUBLE))) END AS score FROM q a JOIN q b ON a.conv_id = b.conv_id AND a.turn = 0 AND b.turn > 0),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, turn) AS rn FROM s WHERE score > 0) WHERE rn = 1)
SELECT q.conv_id, round(coalesce(score, 0), 6) AS match_score, CASE WHEN score >= 0.1 THEN 'matched' ELSE 'no_match' END AS match_status, CASE WHEN score >= 0.1 THEN 'turn ' || b.turn END AS hit_url
FROM q LEFT JOIN b ON b.conv_id = q.conv_id WHERE q.turn = 0
""")
def _hits_review(t: Tables):
    c = t.conversations
    own = c.filter(F.col("turn") == 0).select("conv_id", F.col("text").alias("title"))
    hits = c.filter(F.col("turn") > 0).select("conv_id", F.col("turn").alias("hit_pos"), F.col("text").alias("hit_title"), F.concat(S("turn "), "turn").alias("hit_url"))
    return review_hits(own, hits, "conv_id", min_score=0.1).select("conv_id", r6("match_score").alias("match_score"), "match_status", "hit_url")
