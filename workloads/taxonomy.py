from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showledger.functions import schedule
from showledger.functions.text import contains_any
from showledger.plans import taxonomy as X

from .base import Tables, at, joined, query, shown

NOW = "2026-03-30 08:00:00"

# the rule table's shape over neutral source names
RULES = [
    ("src0", "movie", "*", "movie", "animation", "anime", "JP", 90, "by_label"),
    ("src0", "*", "*", "series", "animation", "anime", "JP", 95, "by_label"),
    ("src1", "*", "*", "series", "animation", "donghua", "CN", 98, "by_label"),
    ("src2", "movie", "*", "movie", "live_action", "movie", "detail:KR", 94, "by_label"),
    ("src2", "*", "*", "series", "live_action", "variety_check", "detail:KR", 94, "by_label"),
    ("src3", "*", "*", "comic", "illustrated", "manhwa", "KR", 92, "by_label"),
    ("src4", "*", "*", "comic", "illustrated", "manga", "JP", 92, "true"),
    ("src5", "*", "animation", "by_type", "animation", "anime", "JP", 88, "true"),
    ("src5", "*", "*", "movie", "live_action", "movie", "JP", 88, "true"),
    ("src6", "*", "*", "by_type", "animation", "anime", "JP", 94, "true"),
]
WEEKLY = [("src0", "*"), ("src1", "*"), ("src2", "drama")]


def doc_items(t: Tables) -> DataFrame:
    n, lang = F.col("n_chars"), F.col("lang")
    detail = F.to_json(F.struct(
        F.array(F.when(n < 300, "Adult").otherwise("Action"), F.lit("action"), F.lit("School")).alias("genres"),
        F.when(n > 700, " Animation_2d").otherwise("live_action").alias("content_format"),
        F.when(n.between(400, 900), "South Korea").when(n > 2000, "us").alias("country"),
        F.when(n.between(300, 500), "Talk Show").alias("format"),
        F.when(n < 600, "Ongoing").when(n < 1200, "Finished Airing").otherwise("Currently Airing").alias("status"),
        F.when(lang == "de", "Monday & Tuesday 20:50 - 22:00").alias("runtime"), F.when(lang == "en", "Every Jumat").alias("release_day"),
        F.when(lang == "en", F.when(F.col("source") == "src0", "22:30").otherwise("9:05")).alias("broadcast_time"),
        F.when(n > 5000, "Biweekly").alias("cadence"),
    ))
    return t.documents.select(
        F.col("doc_id").cast("string").alias("item_key"), "source",
        F.when(lang == "en", "anime").when(lang == "de", "drama").when(lang == "es", "movie").otherwise("manhwa").alias("media_type"),
        F.concat(F.lit("doc-"), "doc_id").alias("slug"), F.concat(F.lit("Doc "), "doc_id").alias("title"), detail.alias("detail"), "n_chars",
    )


def classified(t: Tables) -> DataFrame:
    return X.classify(doc_items(t), at(NOW), RULES, weekly_rules=WEEKLY)


CLASSIFIED_SQL = """
d AS (SELECT doc_id, source, n_chars AS n, lang, CASE lang WHEN 'en' THEN 'anime' WHEN 'de' THEN 'drama' WHEN 'es' THEN 'movie' ELSE 'manhwa' END AS mt,
  CASE WHEN n_chars BETWEEN 400 AND 900 THEN 'KR' WHEN n_chars > 2000 THEN 'US' ELSE '' END AS named, n_chars BETWEEN 300 AND 500 AS variety,
  CASE WHEN n_chars < 600 THEN 'ongoing' WHEN n_chars < 1200 THEN 'finished airing' ELSE 'currently airing' END AS st FROM documents),
c1 AS (SELECT *,
  CASE WHEN source = 'src0' THEN CASE WHEN mt = 'movie' THEN 'movie' ELSE 'series' END WHEN source = 'src1' THEN 'series'
       WHEN source = 'src2' THEN CASE WHEN mt = 'movie' THEN 'movie' ELSE 'series' END WHEN source IN ('src3', 'src4') THEN 'comic'
       WHEN source = 'src5' THEN CASE WHEN n > 700 AND mt = 'anime' THEN 'series' ELSE 'movie' END
       WHEN source = 'src6' THEN CASE WHEN mt = 'anime' THEN 'series' ELSE 'movie' END
       WHEN mt = 'movie' THEN 'movie' WHEN mt = 'manhwa' THEN 'comic' ELSE 'series' END AS surface,
  CASE WHEN source IN ('src0', 'src1', 'src6') THEN 'animation' WHEN source = 'src2' THEN 'live_action' WHEN source IN ('src3', 'src4') THEN 'illustrated'
       WHEN source = 'src5' THEN CASE WHEN n > 700 THEN 'animation' ELSE 'live_action' END
       WHEN mt = 'anime' THEN 'animation' WHEN mt = 'manhwa' THEN 'illustrated' ELSE 'live_action' END AS presentation,
  CASE WHEN source IN ('src0', 'src6') THEN 'anime' WHEN source = 'src1' THEN 'donghua'
       WHEN source = 'src2' THEN CASE WHEN mt = 'movie' THEN 'movie' WHEN variety THEN 'variety' ELSE 'drama' END
       WHEN source = 'src3' THEN 'manhwa' WHEN source = 'src4' THEN 'manga' WHEN source = 'src5' THEN CASE WHEN n > 700 THEN 'anime' ELSE 'movie' END ELSE mt END AS origin FROM d),
c2 AS (SELECT *,
  CASE WHEN source IN ('src0', 'src4', 'src5', 'src6') THEN 'JP' WHEN source = 'src1' THEN 'CN' WHEN source = 'src3' THEN 'KR'
       WHEN source = 'src2' THEN coalesce(nullif(named, ''), 'KR') WHEN named <> '' THEN named
       WHEN origin = 'anime' THEN 'JP' WHEN origin IN ('drama', 'manhwa') THEN 'KR' END AS country,
  CASE WHEN source = 'src0' THEN CASE WHEN mt = 'movie' THEN 90 ELSE 95 END WHEN source = 'src1' THEN 98 WHEN source = 'src2' THEN 94
       WHEN source IN ('src3', 'src4') THEN 92 WHEN source = 'src5' THEN 88 WHEN source = 'src6' THEN 94 ELSE 20 END AS confidence,
  CASE WHEN source IN ('src0', 'src1', 'src2', 'src3', 'src4', 'src5', 'src6') THEN 'provider_heuristic' ELSE 'legacy_fallback' END AS tsource,
  source IN ('src4', 'src5', 'src6') OR n < 300 AS nsfw, CASE WHEN n < 300 THEN 'Adult|action|School' ELSE 'Action|School' END AS genres,
  CASE lang WHEN 'en' THEN 'friday' WHEN 'de' THEN 'monday' END AS day,
  CASE lang WHEN 'en' THEN CASE WHEN source = 'src0' THEN '22:30' ELSE '9:05' END WHEN 'de' THEN '20:50 - 22:00' END AS win FROM c1),
c3 AS (SELECT *,
  CASE country WHEN 'JP' THEN 'Asia/Tokyo' WHEN 'CN' THEN 'Asia/Shanghai' WHEN 'KR' THEN 'Asia/Seoul' WHEN 'US' THEN 'America/New_York' END AS tz,
  CASE WHEN st = 'finished airing' THEN 'completed' WHEN n > 5000 THEN 'biweekly'
       WHEN surface = 'series' AND origin <> 'variety' AND (source IN ('src0', 'src1') OR (source = 'src2' AND mt = 'drama')) THEN 'weekly' END AS cadence,
  CASE country WHEN 'CN' THEN 8 WHEN 'US' THEN -4 ELSE 9 END AS off,
  CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 1 END AS dow, CASE lang WHEN 'en' THEN CASE WHEN source = 'src0' THEN 1350 ELSE 545 END ELSE 1250 END AS mins FROM c2),
c4 AS (SELECT *, TIMESTAMP '2026-03-30 08:00:00' + to_hours(off) AS ln FROM c3),
c5 AS (SELECT *, date_trunc('day', ln) + to_days(CAST((dow - isodow(ln) + 7) % 7 AS INTEGER)) + to_minutes(mins) AS slot FROM c4),
c AS (SELECT *, CASE WHEN surface = 'series' AND cadence = 'weekly' AND day IS NOT NULL THEN
        (CASE WHEN slot <= ln THEN slot + INTERVAL 7 DAY ELSE slot END) - to_hours(off) END AS nxt FROM c5)
"""


@query("classify_taxonomy", "WITH " + CLASSIFIED_SQL + """
SELECT CAST(doc_id AS VARCHAR) AS item_key, surface AS surface_type, presentation AS presentation_type, origin AS origin_type, country AS release_country,
  CAST(confidence AS BIGINT) AS confidence, tsource AS taxonomy_source, nsfw AS is_nsfw, genres, day AS release_day, win AS release_window, tz AS release_timezone,
  cadence, strftime(nxt, '%Y-%m-%d %H:%M:%S') AS next_release_at FROM c
""")
def _classify(t: Tables):
    return classified(t).select(
        "item_key", "surface_type", "presentation_type", "origin_type", "release_country", F.col("taxonomy_confidence").cast("bigint").alias("confidence"),
        "taxonomy_source", "is_nsfw", joined("genre_names").alias("genres"), "release_day", "release_window", "release_timezone", "cadence",
        shown("next_release_at").alias("next_release_at"))


@query("refine_video", "WITH " + CLASSIFIED_SQL + """
SELECT CAST(doc_id AS VARCHAR) AS item_key,
  CASE WHEN source = 'src5' AND mt = 'movie' THEN 'movie' WHEN source = 'src5' AND variety THEN 'variety' ELSE origin END AS origin_type,
  CAST(CASE WHEN source = 'src5' AND mt = 'movie' THEN 94 WHEN source = 'src5' AND variety THEN 96 ELSE confidence END AS BIGINT) AS confidence,
  CASE WHEN source = 'src5' AND mt = 'movie' THEN 'movie' WHEN source = 'src5' AND variety THEN 'series' ELSE surface END AS surface_type FROM c
""")
def _refine(t: Tables):
    return X.refine_video(classified(t), "src5").select("item_key", "origin_type", F.col("taxonomy_confidence").cast("bigint").alias("confidence"), "surface_type")


@query("keyword_flag", r"""
SELECT doc_id, regexp_matches(lower(text), 'license|copyright|password|api key|the thing|queique') AS flagged FROM documents
""")
def _flag(t: Tables):
    return t.documents.select("doc_id", contains_any("text", ["license", "copyright", "password", "api key", "the thing", "queique"]).alias("flagged"))


def _modal_sql(value: str, name: str) -> str:
    return f"""
SELECT user_id, {name}, n FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, {name}) AS rn
  FROM (SELECT user_id, {value} AS {name}, count(*) AS n FROM events GROUP BY 1, 2)) WHERE rn = 1"""


_DAY_SQL = _modal_sql("lower(dayname(ts))", "release_day")
_TIME_SQL = _modal_sql("strftime(ts + INTERVAL 7 HOUR, '%H:%M')", "release_window")


@query("modal_weekday", _DAY_SQL)
def _modal_day(t: Tables):
    return X.modal_weekday(t.events, "user_id", "ts")


@query("modal_time", _TIME_SQL)
def _modal_time(t: Tables):
    return X.modal_time(t.events, "Asia/Jakarta", "user_id", "ts")


@query("infer_release", f"""
WITH d AS ({_DAY_SQL}), w AS ({_TIME_SQL}),
i AS (SELECT c_custkey AS k, CASE WHEN c_nationkey < 12 THEN 'stated' ELSE '' END AS release_day, CASE WHEN c_nationkey > 5 THEN 'old' END AS release_window FROM customer)
SELECT CAST(k AS VARCHAR) AS item_key, coalesce(nullif(i.release_day, ''), d.release_day) AS release_day, coalesce(w.release_window, i.release_window) AS release_window
FROM i LEFT JOIN d ON d.user_id = k LEFT JOIN w ON w.user_id = k
""")
def _infer_release(t: Tables):
    """Days fill blanks only; windows are overwritten where the units have one."""
    items = t.customer.select(F.col("c_custkey").cast("string").alias("item_key"), F.when(F.col("c_nationkey") < 12, "stated").otherwise("").alias("release_day"),
                              F.when(F.col("c_nationkey") > 5, "old").alias("release_window"))
    units = t.events.select(F.col("user_id").cast("string").alias("item_key"), F.col("ts").alias("published_at"))
    return X.infer_release_window(X.infer_release_day(items, units), units, "Asia/Jakarta")


@query("next_release", f"""
WITH d AS ({_DAY_SQL}), w AS ({_TIME_SQL}),
j AS (SELECT d.user_id, release_day, release_window, CASE WHEN release_day IN ('monday', 'tuesday') THEN 9 WHEN release_day IN ('wednesday', 'thursday') THEN 8 ELSE 7 END AS off,
        CASE release_day WHEN 'monday' THEN 1 WHEN 'tuesday' THEN 2 WHEN 'wednesday' THEN 3 WHEN 'thursday' THEN 4 WHEN 'friday' THEN 5 WHEN 'saturday' THEN 6 ELSE 7 END AS dow
      FROM d JOIN w ON w.user_id = d.user_id),
k AS (SELECT *, TIMESTAMP '2024-02-01 10:00:00' + to_hours(off) AS ln FROM j),
s AS (SELECT *, date_trunc('day', ln) + to_days(CAST((dow - isodow(ln) + 7) % 7 AS INTEGER)) + CAST(release_window || ':00' AS INTERVAL) AS slot FROM k)
SELECT user_id, release_day, release_window, strftime((CASE WHEN slot <= ln THEN slot + INTERVAL 7 DAY ELSE slot END) - to_hours(off), '%Y-%m-%d %H:%M:%S') AS next_release_at FROM s
""")
def _next(t: Tables):
    day = X.modal_weekday(t.events, "user_id", "ts").drop("n")
    df = day.join(X.modal_time(t.events, "Asia/Jakarta", "user_id", "ts").drop("n"), "user_id")
    zone = F.when(F.col("release_day").isin("monday", "tuesday"), "Asia/Tokyo").when(F.col("release_day").isin("wednesday", "thursday"), "Asia/Shanghai").otherwise("Asia/Jakarta")
    return df.select("user_id", "release_day", "release_window", shown(schedule.next_weekly_release("release_day", "release_window", zone, at("2024-02-01 10:00:00"))).alias("next_release_at"))


@query("infer_schedule", "WITH " + CLASSIFIED_SQL + f""",
u AS (SELECT CAST(user_id AS VARCHAR) AS item_key, release_day FROM ({_DAY_SQL})),
x AS (SELECT c.*, coalesce(c.day, u.release_day) AS rday FROM c LEFT JOIN u ON u.item_key = CAST(c.doc_id AS VARCHAR))
SELECT CAST(doc_id AS VARCHAR) AS item_key, rday AS release_day, win AS release_window, tz AS release_timezone, strftime(nxt, '%Y-%m-%d %H:%M:%S') AS next_release_at,
  CASE WHEN day IS NULL AND rday IS NOT NULL THEN '2026-03-30 08:00:00' ELSE '2024-01-01 00:00:00' END AS updated_at FROM x
""")
def _infer(t: Tables):
    items = classified(t).withColumn("updated_at", at("2024-01-01 00:00:00"))
    units = t.events.select(F.col("user_id").cast("string").alias("item_key"), F.col("ts").alias("published_at"))
    out = X.infer_schedule(items, units, at(NOW))
    return out.select("item_key", "release_day", "release_window", "release_timezone", shown("next_release_at").alias("next_release_at"), shown("updated_at").alias("updated_at"))
