import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from showledger import rules
from showledger.functions import register
from showledger.operators import dims, matching, merge as M, quality, ranking, search
from showledger.plans import backfill, enrichment, ingest, publish, reports, review, taxonomy

T0, NOW = dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)
L = F.lit
# sources of the default rule tables, by what they carry
SRC = {"anime": rules.SOURCE_RULES[0][0], "donghua": rules.SOURCE_RULES[2][0], "drama": rules.SOURCE_RULES[3][0], "manga": rules.SOURCE_RULES[6][0],
       "mixed": rules.SOURCE_RULES[8][0], "reading": rules.DOMAIN_RULES[2][1][1]}
ITEM = ("item_key string, source string, media_type string, slug string, title string, cover_url string, status string, release_year int, score double, "
        "mal_id bigint, tmdb_id bigint, detail string, created_at timestamp, updated_at timestamp")


def item(key, **kw):
    row = dict(item_key=key, source="s1", media_type="anime", slug=key, title="Old", cover_url="old.jpg", status="Ongoing", release_year=2000, score=7.5,
               mal_id=1, tmdb_id=None, detail='{"a":1,"b":{"x":1}}', created_at=T0, updated_at=T0)
    return tuple({**row, **kw}.values())


def by(df, *cols):
    return {r[0]: tuple(r[c] for c in cols) for r in df.collect()}


@pytest.mark.parametrize("incremental", [False, True])
def test_merge_matrix(spark, incremental):
    target = spark.createDataFrame([item("a"), item("b"), item("z")], ITEM)
    batch = spark.createDataFrame([
        item("a", title=" ", cover_url="", status=None, release_year=None, score=0.0, mal_id=None, tmdb_id=9, detail='{"b":{"y":2},"c":null}'),
        item("b", title="First", score=1.0), item("b", title="Last", score=2.0, updated_at=NOW), item("n", title="New", detail=None), item(" ", title="blank key")], ITEM)
    now = F.lit(NOW)
    out = M.upsert_items(target, batch, now, order=[F.col("updated_at").desc()], incremental=incremental)
    rows = {r["item_key"]: r for r in out.collect()}
    assert sorted(rows) == ["a", "b", "n", "z"]
    a = rows["a"]
    assert (a.title, a.cover_url, a.status, a.release_year, a.score, a.mal_id, a.tmdb_id) == ("Old", "old.jpg", "Ongoing", 2000, 7.5, 1, 9)
    assert json.loads(a.detail) == {"a": 1, "b": {"y": 2}, "c": None}
    assert (a.created_at, a.updated_at) == (T0, NOW)
    assert (rows["b"].title, rows["b"].score) == ("Last", 2.0)
    assert (rows["n"].title, rows["n"].detail, rows["n"].created_at) == ("New", "{}", NOW)
    assert rows["z"].updated_at == T0


def test_merge_idempotent(spark):
    rnd = random.Random(3)
    rows = [item(f"k{i}", title=rnd.choice(["", "t"]), score=rnd.choice([0.0, 2.0]), mal_id=rnd.choice([None, 5])) for i in range(40)]
    target, batch = spark.createDataFrame(rows[:30], ITEM), spark.createDataFrame([item(f"k{i}", title=rnd.choice(["", "x"]), score=rnd.choice([0.0, 3.0])) for i in range(20, 40)], ITEM)
    once = M.upsert_items(target, batch, F.lit(NOW)).drop("updated_at", "created_at")
    again = M.upsert_items(M.upsert_items(target, batch, F.lit(NOW)), batch, F.lit(NOW)).drop("updated_at", "created_at")
    key = lambda df: sorted((r.item_key, r.title, r.score, r.mal_id, tuple(sorted(json.loads(r.detail)))) for r in df.collect())
    assert key(once) == key(again)
    assert once.count() == once.select("item_key").distinct().count()


def test_movie_slug_survives(spark):
    schema = "tmdb_id bigint, slug string, title string"
    target = spark.createDataFrame([(1, "kept", "a"), (2, "movie-2", "a"), (3, "", "a")], schema)
    batch = spark.createDataFrame([(1, "other", "b"), (2, "real", "b"), (3, " ", "b"), (4, None, "b")], schema)
    assert by(M.upsert_movies(target, batch), "slug", "title") == {1: ("kept", "b"), 2: ("real", "b"), 3: ("movie-3", "b"), 4: ("movie-4", "b")}


def test_rekey_and_legacy(spark):
    items = spark.createDataFrame([("s:anime:a", "s", "anime", "a", T0), ("s:anime:b", "s", "anime", "b", T0), ("s:anime:c", "s", "anime", "c", T0), ("s:anime:d", "s", "anime", "d", T0), ("s:movie:d", "s", "movie", "d", T0)],
                                  "item_key string, source string, media_type string, slug string, updated_at timestamp")
    units = spark.createDataFrame([("u1", "s:anime:b", "{}", T0), ("u2", "s:anime:c", "{}", T0), ("u3", "s:anime:c", "{}", T0)], "unit_key string, item_key string, detail string, updated_at timestamp")
    i, u, m = M.rekey_items(items, units, F.col("media_type") == "anime", "movie", F.lit(NOW))
    assert sorted(r.item_key for r in i.collect()) == ["s:anime:c", "s:anime:d", "s:movie:a", "s:movie:b", "s:movie:d"]
    assert by(u, "item_key")["u1"] == ("s:movie:b",) and by(u, "item_key")["u2"] == ("s:anime:c",)
    assert json.loads(by(u, "detail")["u1"][0]) == {"anime_slug": "b"}
    assert m.count() == 2
    legacy = spark.createDataFrame([("p", 1.0, "x-subtitle-indonesia"), ("p", 1.0, "x"), ("p", 2.0, "y-subtitle-indonesia"), ("p", None, "z-subtitle-indonesia"), ("p", None, "z")], "parent string, number double, slug string")
    assert sorted(r.slug for r in M.dedupe_legacy(legacy, "parent", "number", "slug").collect()) == ["x", "y-subtitle-indonesia", "z", "z-subtitle-indonesia"]


def test_dense_index(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    rows = sorted((r.v, r.n) for r in ranking.dense_index(df, [F.col("v")], "n", start=5).collect())
    assert rows == [(v, v + 6) for v in range(1000)]


def test_dims(spark):
    empty = spark.createDataFrame([], "code smallint, name string")
    names = spark.createDataFrame([(" b",), ("a",), ("",), (None,), ("b",)], "w string")
    one = dims.ensure_dim(empty, names, "w")
    two = dims.ensure_dim(one, spark.createDataFrame([("0",), ("a",)], "w string"), "w")
    assert sorted((r.code, r.name) for r in two.collect()) == [(1, "a"), (2, "b"), (3, "0")]
    df = spark.createDataFrame([(1, ["b", "a", "zz"]), (2, []), (3, None)], "k int, names array<string>")
    coded = dims.encode_array(df, "k", "names", two)
    assert by(coded, "codes") == {1: ([1, 2],), 2: ([],), 3: ([],)}
    assert by(dims.decode_array(coded, "k", "codes", two), "names") == {1: (["a", "b"],), 2: ([],), 3: ([],)}


def brute_jaccard(a, b):
    a, b = set(a), set(b)
    if not a or not b:
        return 0.0
    s = len(a & b)
    return max(0.0, min(1.0, s / (len(a) + len(b) - s) - abs(len(a) - len(b)) * 0.03))


@pytest.mark.parametrize("threshold", [0.2, 0.55, 0.8, 1.0])
def test_match_titles_brute_force(spark, threshold):
    """Skewed words and repeated titles, against every pair."""
    rnd = random.Random(int(threshold * 100))
    words = ["the", "of"] * 8 + [f"w{i}" for i in range(25)]
    make = lambda n: [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 9))) for _ in range(n)]
    lt, rt = make(150), make(150)
    lt[:30] = ["the hot title"] * 30
    rt[:20] = ["the hot title again"] * 20
    left = spark.createDataFrame(list(enumerate(lt)), "lid int, lt string")
    right = spark.createDataFrame(list(enumerate(rt)), "rid int, rt string")
    got = by(matching.match_titles(left, right, left_title="lt", right_id="rid", right_title="rt", min_score=threshold), "rid", "match_score")
    assert len(got) == 150
    for lid, title in enumerate(lt):
        scored = [(-brute_jaccard(title.split(), r.split()), rid) for rid, r in enumerate(rt)]
        best = min(scored)
        if -best[0] >= threshold:
            assert got[lid][0] == best[1] and got[lid][1] == pytest.approx(-best[0])
        else:
            assert got[lid] == (None, None)


def test_pick_best(spark):
    items = spark.createDataFrame([(k,) for k in "abcde"], "item_key string")
    queries = spark.createDataFrame([("a", 0, "x", 0), ("a", 1, "bleach", 0), ("b", 0, "q", 0), ("c", 0, "zz", 0), ("d", 0, "show", 0), ("d", 1, "show two", 0)], "query_id string, query_pos int, query string, year int")
    hits = spark.createDataFrame([("a", 0, 0, "h1", ["unrelated"], 0), ("a", 1, 0, "h2", ["bleach movie"], 0), ("a", 1, 1, "h3", ["bleach"], 0), ("c", 0, 0, "h4", ["other"], 0),
                                  ("d", 0, 0, "h5", ["the show"], 0), ("d", 1, 0, "h6", ["show two"], 0)],
                                 "query_id string, query_pos int, hit_pos int, external_id string, titles array<string>, year int")
    out = by(matching.pick_best(items, queries, matching.score_hits(queries, hits), 1, L("fallback")), "match_status", "match_score", "external_id", "matched_title")
    assert out["a"] == ("matched", 100, "h3", "bleach")
    assert out["b"] == ("search_empty", 0, None, "fallback")
    assert out["c"] == ("score_rejected", 0, None, "fallback")
    assert out["d"] == ("matched", 70, "h5", "the show")  # the first query that matches decides
    assert out["e"] == ("missing_query", 0, None, "fallback")


def test_search_buckets(spark):
    titles = [("red", "a"), ("x", "red"), ("redo", "b"), ("x", "red-2"), ("big red", "c"), ("bored", "d"), ("x", "my-red"), ("zzz", "q")]
    df = spark.createDataFrame(titles, "title string, slug string")
    got = [(r.title, r.slug, r.rank_bucket) for r in search.search_titles(df, "Red").collect()]
    assert [g[2] for g in got] == [0, 1, 2, 3, 4, 5, 6] and got[0][0] == "red"
    assert search.search_titles(df, "r").count() == 0
    batch = search.search_titles_batch(df, ["red", "zz"], limit=2)
    assert sorted((r.query, r.place, r.rank_bucket) for r in batch.collect()) == [("red", 1, 0), ("red", 2, 1), ("zz", 1, 2)]


def test_token_search(spark):
    df = spark.createDataFrame([(1, "Red fox; jumps"), (2, "red dog"), (3, "fox")], "id int, t string")
    assert [r.id for r in search.token_search(df, ["t"], "FOX red").collect()] == [1]
    q = spark.createDataFrame([("a", "red"), ("b", "fox red"), ("c", "none")], "qid string, q string")
    assert sorted((r.qid, r.id) for r in search.token_search_batch(df, "id", ["t"], q, "qid", "q").collect()) == [("a", 1), ("a", 2), ("b", 1)]


def test_numeric_sort(spark):
    df = spark.createDataFrame([("10",), ("2",), ("1",), ("x",), ("2.0",), ("a",)], "n string")
    assert [r.n for r in df.orderBy(*ranking.numeric_sort_keys("n")).collect()] == ["1", "2", "2.0", "10", "a", "x"]


def test_reconcile(spark):
    ext = spark.createDataFrame([("p", 1, "1", "u1"), ("p", 2, "2", "u2"), ("p", 3, "3", "u3")], "parent string, pos int, number string, href string")
    own = spark.createDataFrame([("p", " 1 ", "own-1"), ("p", "", "own-x")], "parent string, own_number string, own_slug string")
    out = matching.reconcile_children(ext, own, "parent", "number", "own_number", ["own_slug"], [F.col("pos")], cap=2)
    assert sorted((r.number, r.own_slug) for r in out.collect()) == [("1", "own-1"), ("2", None)]


def test_quality(spark):
    df = spark.createDataFrame([("a", "", "m", "s", None, "{}", "movie", "animation", "x", 5, "src", None, None, None, None), ("b", "s", "m", "s", 17, "[]", "tv", "animation", " ", 101, "src", "someday", "never", "", "")],
                               "item_key string, source string, media_type string, slug string, release_year int, detail string, surface_type string, presentation_type string, origin_type string, "
                               "taxonomy_confidence int, taxonomy_source string, release_day string, cadence string, release_window string, release_timezone string")
    got = {(r.rule, r.key) for r in quality.validate(df, quality.item_checks(), F.col("item_key")).collect()}
    assert got == {("source_blank", "a")} | {(r, "b") for r in ("release_year_range", "detail_not_object", "surface_type_enum", "origin_type_blank", "taxonomy_confidence_range", "release_day_enum", "cadence_enum", "release_window_blank", "release_timezone_blank")}


CLASSIFY = "source string, media_type string, detail string"


def classify_one(spark, source, kind, detail):
    df = spark.createDataFrame([(source, kind, json.dumps(detail))], CLASSIFY)
    return taxonomy.classify(df, F.lit(dt.datetime(2026, 3, 30, 8))).first()


def test_classify(spark):
    r = classify_one(spark, SRC["anime"], "anime", {"genres": ["Action", "action", " Drama "], "tags": "X, drama", "status": "Ongoing", "release_day": "Sabtu", "release_time": "22:30"})
    assert (r.surface_type, r.presentation_type, r.origin_type, r.release_country, r.taxonomy_confidence, r.taxonomy_source, r.is_nsfw) == ("series", "animation", "anime", "JP", 95, "provider_heuristic", False)
    assert (r.genre_names, r.release_day, r.release_timezone, r.cadence, r.next_release_at) == (["Action", "Drama", "X"], "saturday", "Asia/Tokyo", "weekly", dt.datetime(2026, 4, 4, 13, 30))
    r = classify_one(spark, SRC["drama"], "drama", {"country": "South Korea", "aired": "Every Friday", "broadcast_time": "22:30", "status": "Ongoing"})
    assert (r.origin_type, r.release_day, r.release_window, r.release_timezone, r.cadence) == ("drama", "friday", "22:30", "Asia/Seoul", "weekly")
    r = classify_one(spark, SRC["drama"], "drama", {"title": "Running Man", "status": "Ongoing"})
    assert (r.origin_type, r.cadence, r.next_release_at) == ("variety", None, None)
    r = classify_one(spark, SRC["drama"], "drama", {"runtime": "Monday & Tuesday 20:50"})
    assert (r.release_day, r.release_window) == ("monday", "20:50")
    r = classify_one(spark, SRC["manga"], "manga", {})
    assert (r.surface_type, r.origin_type, r.is_nsfw) == ("comic", "manga", True)
    r = classify_one(spark, "elsewhere", "donghua", {"genres": ["Ecchi"], "cadence": "Monthly"})
    assert (r.surface_type, r.presentation_type, r.release_country, r.taxonomy_confidence, r.taxonomy_source, r.is_nsfw, r.cadence) == ("series", "animation", "CN", 20, "legacy_fallback", True, "monthly")
    r = classify_one(spark, "elsewhere", "podcast", {"status": "Completed", "cadence": "weekly"})
    assert (r.surface_type, r.presentation_type, r.origin_type, r.release_country, r.cadence) == ("unknown", "unknown", "podcast", None, "completed")
    r = classify_one(spark, SRC["mixed"], "movie", {"content_format": "Animation_2d"})
    assert (r.surface_type, r.presentation_type, r.origin_type) == ("movie", "animation", "anime")


def test_modal_ties(spark):
    stamps = [("a", dt.datetime(2024, 1, 1, 10)), ("a", dt.datetime(2024, 1, 5, 9)), ("b", dt.datetime(2024, 1, 2, 23, 30)), ("b", dt.datetime(2024, 1, 2, 23, 30)), ("b", dt.datetime(2024, 1, 3)), ("c", None)]
    units = spark.createDataFrame(stamps, "item_key string, published_at timestamp")
    assert by(taxonomy.modal_weekday(units), "release_day", "n") == {"a": ("friday", 1), "b": ("tuesday", 2)}
    assert by(taxonomy.modal_time(units, "Asia/Tokyo"), "release_window") == {"a": ("18:00",), "b": ("08:30",)}


def test_queries(spark):
    detail = {"search_hit": {"title_english": "English", "title_synonyms": ["Syn"]}, "source_title": "Native; Other (2020)", "alt_title": "english"}
    df = spark.createDataFrame([("k", "s", "Title", 2020, json.dumps(detail)), ("d", SRC["drama"], "Drama Korea Honour (2026)", None, '{"native_title":"아너"}')], "item_key string, source string, title string, release_year int, detail string")
    rows = [(r.query_id, r.query_pos, r.query) for r in enrichment.build_queries(df).orderBy("query_id", "query_pos").collect()]
    assert rows == [("d", 0, "Honour"), ("k", 0, "English"), ("k", 1, "Native"), ("k", 2, "Other"), ("k", 3, "Title"), ("k", 4, "Syn")]
    fallback = [r.query for r in enrichment.build_queries(df.filter("item_key = 'k'"), rules.ALIASES_FALLBACK, split_variants=False).orderBy("query_pos").collect()]
    assert fallback == ["Native; Other (2020)", "english", "Title"]


PROMO = ("item_key string, source string, media_type string, surface_type string, presentation_type string, origin_type string, release_country string, is_nsfw boolean, genre_names array<string>, "
         "taxonomy_confidence smallint, taxonomy_source string, release_year smallint, score float, cover_url string, detail string")


def test_promotion_locks(spark):
    comic = ("c", "x", "manga", "comic", "illustrated", "manga", None, False, ["Action"], 20, "legacy_fallback", None, 0.0, "", "{}")
    locked = ("l", SRC["donghua"], "donghua", "series", "animation", "donghua", "", True, [], 98, "provider_heuristic", 2000, 8.0, "own.jpg", "{}")
    items = spark.createDataFrame([comic, locked], PROMO)
    payload = json.dumps({"type": "MANGA", "country_of_origin": "KR", "average_score": 78, "season_year": 2021, "genres": ["action", "School"], "cover_image": "n.jpg", "title_english": "E", "synonyms": ["S"], "is_adult": False})
    m = spark.createDataFrame([("c", 97, payload), ("l", 97, payload)], "item_key string, match_score int, payload string")
    out = {r.item_key: r for r in enrichment.promote(items, m).collect()}
    c, k = out["c"], out["l"]
    assert (c.origin_type, c.release_country, c.genre_names, c.taxonomy_confidence, c.release_year, round(c.score, 3), c.cover_url, c.taxonomy_source) == ("manhwa", "KR", ["Action", "School"], 90, 2021, 7.8, "n.jpg", "anilist_promotion")
    assert json.loads(c.detail) == {"anilist_title_english": "E", "anilist_synonyms": ["S"]}
    assert (k.surface_type, k.origin_type, k.release_country, k.taxonomy_confidence, k.release_year, k.cover_url, k.taxonomy_source, k.is_nsfw) == ("series", "donghua", "KR", 98, 2000, "own.jpg", "provider_heuristic", True)


def test_freshness_boundaries(spark):
    now = dt.datetime(2024, 1, 2, 12)
    hours = {"fresh": 4, "stale": 8, "late": 8.01}
    items = spark.createDataFrame([(s, now - dt.timedelta(hours=h)) for s, h in hours.items()], "source string, updated_at timestamp")
    units = spark.createDataFrame([("only", "chapter", now)], "source string, unit_type string, updated_at timestamp")
    out = by(reports.freshness_report(items, units, F.lit(now)), "status", "age_minutes", "items", "chapters")
    assert out == {"fresh": ("fresh", 240, 1, 0), "stale": ("stale", 480, 1, 0), "late": ("late", 480, 1, 0), "only": ("fresh", 0, 0, 1)}


def test_coverage_sides(spark):
    items = spark.createDataFrame([("a", True, T0)], "source string, ready boolean, updated_at timestamp")
    units = spark.createDataFrame([("b", "episode", "p", T0), ("b", "episode", "p", NOW), ("b", "episode", " ", T0), ("b", "chapter", "q", T0)], "source string, unit_type string, parent_slug string, updated_at timestamp")
    out = by(reports.coverage_report(items, units, ready=F.col("ready")), "items", "detail_ready", "episode_parents", "episodes", "chapter_parents", "chapters", "latest_item_utc", "latest_unit_utc")
    assert out == {"a": (1, 1, 0, 0, 0, 0, "2024-01-01 00:00:00", "-"), "b": (0, 0, 1, 3, 1, 1, "-", "2024-06-01 00:00:00")}


def test_patch_targets(spark):
    now = dt.datetime(2024, 1, 1, 12)
    ago = lambda m: now - dt.timedelta(minutes=m)
    items = spark.createDataFrame([("k1", SRC["anime"], "anime", "a", ago(500)), ("k2", SRC["anime"], "movie", "m", ago(45)), ("k3", SRC["reading"], SRC["reading"], "c", ago(46)), ("k4", "x", "donghua", "d", ago(1)), ("k5", "y", "movie", "m", ago(3))],
                                  "item_key string, source string, media_type string, slug string, updated_at timestamp")
    units = spark.createDataFrame([("k1", "episode", ago(10)), ("k1", "episode", ago(400)), ("k3", "episode", ago(2)), ("k4", "episode", ago(600))], "item_key string, unit_type string, updated_at timestamp")
    got = [tuple(r) for r in publish.patch_targets(items, units, F.lit(now)).collect()]
    assert got == [("donghua", "d", "2024-01-01T11:59:00Z"), ("movie", "m", "2024-01-01T11:57:00Z"), ("anime", "a", "2024-01-01T11:50:00Z")]
    many = spark.createDataFrame([(f"k{i}", "y", "movie", f"m{i:02d}", ago(1)) for i in range(30)], items.schema)
    assert [r.slug for r in publish.patch_targets(many, units, F.lit(now)).collect()] == [f"m{i:02d}" for i in range(8)]


def test_backfill_plan(spark):
    cat = spark.createDataFrame([(1, "a", "anime"), (2, "m", "Movie"), (3, "b", "anime"), (4, "a", "anime"), (5, "c", "anime"), (6, " ", "anime")], "n int, slug string, content_type string")
    known = spark.createDataFrame([(" b ",)], "slug string")
    plan = lambda **k: sorted(tuple(r) for r in backfill.plan_backfill(cat, known, ["n"], **k).collect())
    movie = ("m", "skip", "movie_without_episode_backfill")
    assert plan() == sorted([("a", "attempt", ""), ("b", "skip", "already_backfilled"), ("c", "attempt", ""), movie])
    assert plan(limit=2) == sorted([("a", "attempt", ""), ("b", "skip", "already_backfilled"), movie])
    assert plan(limit=1) == sorted([("a", "attempt", ""), movie])
    late = cat.withColumn("anime_type", F.when(F.col("n") == 5, "MOVIE"))
    got = sorted(tuple(r) for r in backfill.plan_backfill(late.filter("n <> 2"), known, ["n"], limit=1).collect())
    assert got == [("a", "attempt", "")]  # the movie after the end of the run is not looked at
    got = sorted(tuple(r) for r in backfill.plan_backfill(late, known, ["n"]).collect())
    assert ("c", "skip", "movie_without_episode_backfill") in got
    assert plan(include=["c"]) == sorted([("c", "attempt", ""), movie])


def test_crawl_stops(spark):
    cards = spark.createDataFrame([("s", 1, 1, "x"), ("s", 1, 2, "y"), ("s", 2, 1, "y"), ("s", 3, 1, "z"), ("t", 1, 1, "x"), ("t", 2, 1, "x"), ("t", 2, 2, "w"), ("t", 4, 1, "v")], "source string, page_number int, pos int, href string")
    pages = spark.createDataFrame([("s", 1), ("s", 2), ("s", 3), ("t", 1), ("t", 2), ("t", 3), ("t", 4)], "source string, page_number int")
    got = sorted((r.source, r.page_number, r.href) for r in ingest.new_cards(cards, pages).collect())
    assert got == [("s", 1, "x"), ("s", 1, "y"), ("t", 1, "x"), ("t", 2, "w")]


def test_promote_numbered(spark):
    from showledger.functions.titles import decompose_numbered

    df = spark.createDataFrame([("X 1",), ("X 2",), ("Y 1",), ("Z",)], "t string").withColumn("batch", L(1)).withColumn("parts", decompose_numbered("t"))
    assert by(backfill.promote_numbered(df, ["batch"]).drop("batch"), "base_title", "entry_kind") == {"X 1": ("X", "episode"), "X 2": ("X", "episode"), "Y 1": ("Y", "numbered"), "Z": ("Z", "standalone")}


def test_review_hits(spark):
    own = spark.createDataFrame([("a", "One Piece", ""), ("b", "Lonely", ""), ("c", "x", "Naruto Shippuden Long Title Here")], "slug string, title string, source_title string")
    hits = spark.createDataFrame([("a", 0, "One Piece Film", "u0"), ("a", 1, "One Piece Sub Indo", "u1"), ("c", 0, "Naruto Other Words", "u2")], "slug string, hit_pos int, hit_title string, hit_url string")
    out = by(review.review_hits(own, hits, "slug"), "match_status", "hit_url", "needs_review", "notes")
    assert out == {"a": ("matched", "u1", False, ""), "b": ("no_match", None, False, "no search results"), "c": ("no_match", None, False, "no search results")}
    assert by(review.review_hits(own, hits, "slug"), "match_score")["c"][0] > 0


@pytest.mark.parametrize("cell", [3, 20_000])
def test_title_match_grid(spark, monkeypatch, cell):
    """Half of all titles share one word: every pair as by brute force, no cell above its share, new titles against stored sets."""
    monkeypatch.setattr(matching, "HOT_SETS", 10)
    monkeypatch.setattr(matching, "CELL", cell)
    rng = random.Random(8)
    title = lambda i: " ".join((["saga"] if i % 2 else []) + rng.sample([f"n{k}" for k in range(9)], rng.randint(1, 4)))
    left = [(i, title(i)) for i in range(60)]
    right = [(100 + i, title(i)) for i in range(60)]

    def score(a, b):
        a, b = set(a.split()), set(b.split())
        return max(0.0, min(1.0, len(a & b) / len(a | b) - 0.03 * abs(len(a) - len(b))))

    want = {}
    for i, a in left:
        best = min((-score(a, b), r) for r, b in right)
        want[i] = (best[1], -best[0]) if -best[0] >= 0.5 else (None, None)
    lf, rf = spark.createDataFrame(left, "id long, title string"), spark.createDataFrame(right, "rid long, rtitle string")

    def same(df, ids):
        got = {r.id: (r.rid, r.match_score) for r in df.collect()}
        assert set(got) == set(ids)
        for i in ids:
            assert got[i][0] == want[i][0] and (want[i][1] is None or abs(got[i][1] - want[i][1]) < 1e-9)

    same(matching.match_titles(lf, rf, left_title="title", right_id="rid", right_title="rtitle", min_score=0.5), [i for i, _ in left])
    stored = matching.add_title_sets(matching.title_sets(rf.where("rid < 130"), "rid", "rtitle"), matching.title_sets(rf.where("rid >= 130"), "rid", "rtitle"))
    new = lf.where("id >= 50")
    same(matching.match_to_sets(new, stored, left_title="title", right_id="rid", right_title="rtitle", threshold=0.5), range(50, 60))


def test_search_table_function(spark):
    """Equal to search_titles for literal and column-free arguments; the best rows are limited before they meet."""
    items = spark.createDataFrame([(f"Red bolt {i % 7}", f"red-bolt-{i}") for i in range(60)] + [("", "x"), (None, None)], "title string, slug string")
    items.createOrReplaceTempView("sl_test_titles")
    name = register.register_search(spark, "sl_test_titles", "sl_test_search")
    for q, n in (("red", "8"), ("BOLT 3 ", "NULL"), ("d-b", "3"), ("x", "5"), ("", "5"), ("red", "999"), ("red", "-4")):
        limit = None if n == "NULL" else int(n)
        got = [(r.title, r.slug, r.rank_bucket) for r in spark.sql(f"SELECT * FROM {name}('{q}', {n}) ORDER BY place").collect()]
        assert got == [(r.title, r.slug, r.rank_bucket) for r in search.search_titles(items, q, limit).collect()], (q, n)
    plan = spark.sql(f"SELECT * FROM {name}('red', 8)")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan or "Limit" in plan[plan.index("Window"):]
    keys = register.register_token_search(spark, "sl_test_titles", "slug", "title", "sl_test_tokens")
    assert {r.slug for r in spark.sql(f"SELECT * FROM {keys}('3, BOLT')").collect()} == {f"red-bolt-{i}" for i in range(60) if i % 7 == 3}
    assert spark.sql(f"SELECT * FROM {keys}('')").count() == 0


def test_pages_deep_and_beyond(spark, tmp_path, monkeypatch):
    """A page beyond the end is empty however long the result is, and a deep page equals the plain one."""
    import workloads

    orders = spark.range(2_000_100).select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.lit(T0).alias("o_orderdate"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    got = {r.part: json.loads(r.rows_json) for r in workloads.QUERIES["result_as_json"](spark, str(tmp_path)).collect()}
    assert got["beyond"] == [] and [r["o_orderkey"] for r in got["page"]] == list(range(20, 60))
    few = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(8)
    monkeypatch.setattr(ranking, "DEEP", 5)
    assert [r.v for r in ranking.page(few, [F.col("v").desc()], 4, 500).collect()] == [499, 498, 497, 496]
    assert [r.v for r in ranking.page(few, [F.col("v")], 10, 995).collect()] == [995, 996, 997, 998, 999]
