import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from showledger import rules
from showledger.functions import arrays, codes, dates, jsoncol, numbers, schedule, text, titles, urls
from showledger.functions.register import SQL_FUNCTIONS, register_functions

L = F.lit
UTC = dt.datetime


@pytest.mark.parametrize("raw,want", [("100", 100.0), ("179.2", 179.2), ("Chapter 12.5", 12.5), ("", 9.0), ("1,5", 1.5), ("x", 9.0), ("1.2.3", 1.23), (".", 9.0)])
def test_sequence_index(one, raw, want):
    assert one(numbers.sequence_index(L(raw), L(9))) == pytest.approx(want)


@pytest.mark.parametrize("raw,want", [
    ("2025-11-30", UTC(2025, 11, 30)), ("25/03/2026", UTC(2026, 3, 25)), ("5/3/2026", UTC(2026, 3, 5)), ("23 Maret 2026", UTC(2026, 3, 23)),
    ("8 Desember 2025", UTC(2025, 12, 8)), ("March 5, 2026", UTC(2026, 3, 5)), ("Mar 5, 2026", UTC(2026, 3, 5)), ("05 Mei 2026", UTC(2026, 5, 5)),
    ("2026-03-30T08:00:00+07:00", UTC(2026, 3, 30, 1)), ("3 jam lalu", None), ("", None), ("31/02/2026", None), ("5 Foo 2026", None)])
def test_localized_date(one, raw, want):
    assert one(dates.parse_localized_date(L(raw))) == want


@pytest.mark.parametrize("raw,want", [
    ("Sun, 01 Mar 2026 12:30:00 +0700", UTC(2026, 3, 1, 5, 30)), ("Sun, 01 Mar 2026 12:30:00 GMT", UTC(2026, 3, 1, 12, 30)),
    ("01 Mar 26 12:30 +0000", UTC(2026, 3, 1, 12, 30)), ("yesterday", None)])
def test_feed_date(one, raw, want):
    assert one(dates.parse_feed_date(L(raw))) == want


def test_embedded(one):
    assert one(dates.embedded_date(L("a/2024-05-06.jpg"))) == UTC(2024, 5, 6)
    assert one(dates.embedded_timestamp(L("x 2024-05-06T07:08:09Z y"))) == UTC(2024, 5, 6, 7, 8, 9)


def test_numbers(one):
    assert one(numbers.parse_smallint(L("99999"))) is None
    assert one(numbers.parse_smallint(L(" 123 "))) == 123
    assert one(numbers.parse_duration_minutes(L("1h 30m"))) == 90
    assert one(numbers.parse_duration_minutes(L("24 min"))) == 24
    assert one(numbers.parse_duration_minutes(L("x"))) is None
    assert one(numbers.format_number(L(12.0)), numbers.format_number(L(12.5)), numbers.format_number(L(12.3456))) == ("12", "12.5", "12.346")
    assert one(numbers.episode_number(L(""), L("Show Episode 12.5"))) == 12.5
    assert one(numbers.card_score(L("Score 8.25 of 10"))) == 8.25
    assert one(numbers.card_views(L("1.234,567 Views"))) == 1234567
    assert one(numbers.quality_label(L("BD 720p")), numbers.quality_label(L("1720p"))) == ("720P", "")
    assert one(numbers.to_number(L("12d"))) is None


def test_urls(one):
    assert one(urls.slug_from_url(L("https://e.org/a/b-c/?x=1"))) == "b-c"
    assert one(urls.slug_from_url(L("https://e.org"))) == ""
    assert one(urls.slug_from_url(L("/a/b%20c/"))) == "b c"
    assert one(urls.slug_from_text(L("https://e.org/a/b?x=1"))) == "b?x=1"
    assert one(urls.host_norm(L("HTTPS://WWW.E.org:8080/x"))) == "e.org"
    assert one(urls.domain(L("https://E.org:8080/x"))) == "E.org:8080"
    assert one(urls.strip_url_path(L("https://e.org/a/b"))) == "/a/b"
    assert one(urls.strip_url_path(L("https://e.org")), urls.strip_url_path(L("a/b")), urls.strip_url_path(L(" "))) == ("", "a/b", "")
    assert one(urls.youtube_id(L("https://www.youtube.com/embed/abcdefg?x"))) == "abcdefg"
    assert one(urls.resolve_url(L("https://e.org/a/b"), L("../c"))) == "https://e.org/c"


def test_text(one):
    assert one(text.slugify(L("Slice & Life!"))) == "slice-and-life"
    assert one(text.truncate_excerpt(L("aaaa bbbb cccc dddd"), 12)) == "aaaa bbbb..."
    assert one(text.truncate_excerpt(L("short"), 12)) == "short"
    m = one(text.labeled_fields(L("<p>Genre : a</p>Size:1<br>Genre: b<br>plain text without any label here")))
    assert m == {"genre": "b", "size": "1"}
    assert one(text.first_unlabeled(L("a:b<br>tiny<br>plain text without any label here"))) == "plain text without any label here"
    assert one(text.extract_urls(L('see https://a.org/x\\ and "https://a.org/x"'))) == ["https://a.org/x"]
    assert one(text.html_text(L("<style>p{}</style><p>a &amp; b</p><script>x</script><i>c</i>"))) == "a & b c"
    r = one(text.split_meta_line(L("Manga • Action  Status: Ongoing")))
    assert tuple(r) == ("Manga", "Action", "Ongoing")


def test_cut_references(one):
    html = "<p>a &amp;&amp</p> &lt;b&gt; &#39 &#x27; &nosuch; &ampx;"
    assert one(text.html_text(L(html), unended=False)) == "a &&amp <b> &#39 ' &nosuch; &ampx;"
    assert one(text.html_text(L(html))) == "a && <b> ' ' &nosuch; &x;"


def test_arrays(one):
    a = F.array(L(" B"), L("a"), L(""), L("b"), L("A"))
    assert one(arrays.compact_ci(a)) == ["B", "a"]
    assert one(arrays.distinct_trimmed_sorted(a)) == ["A", "B", "a", "b"]
    assert one(arrays.union_ordered(a, F.array(L("z"), L("a")))) == ["B", "a", "b", "A", "z"]
    assert one(arrays.drop_numeric_chips(F.array(L("2026"), L("12 eps"), L("Drama"), L("drama")))) == ["12 eps", "Drama"]


def test_json(one):
    assert one(jsoncol.merge_shallow(L('{"a":1,"b":{"x":1}}'), L('{"b":{"y":2},"c":null}'))) == '{"a":1,"b":{"y":2},"c":null}'
    assert one(jsoncol.merge_shallow(F.lit(None).cast("string"), L('{"a":1}'))) == '{"a":1}'
    merged = one(jsoncol.merge_subdoc(L('{"s":{"p":{"v":1},"q":2},"t":3}'), "s", "p", L('{"v":9}')))
    assert json.loads(merged) == {"t": 3, "s": {"q": 2, "p": {"v": 9}}}
    assert one(jsoncol.has_payload(L('{"a":{"b":{}}}'), "a.b")) is False
    left, right = F.create_map(L("a"), L("1"), L("b"), L(" ")), F.create_map(L("a"), L("2"), L("b"), L("3"))
    assert one(jsoncol.map_merge_left(left, right)) == {"a": "1", "b": "3"}
    assert one(jsoncol.text_list(L('["a","b"]')), jsoncol.text_list(L("a, b,")), jsoncol.text_list(L(""))) == (["a", "b"], ["a", "b"], [])


def test_codes(one):
    assert one(codes.encode("anime_type", L(" TV ")), codes.encode("anime_type", L("x"))) == ("t", "u")
    assert one(codes.encode("anime_status", L("is upcoming"))) == "u"
    assert one(codes.country_code(L("south korea")), codes.country_code(L("fr")), codes.country_code(L("Mars"))) == ("KR", "FR", "")
    assert one(codes.source_key(L(rules.READING_SOURCES[3])), codes.source_key(L("")), codes.source_key(L("nope"))) == (rules.READING_SOURCES[3], rules.DEFAULT_READING_SOURCE, rules.DEFAULT_READING_SOURCE)
    assert one(codes.overall_fetch_status(L("challenge_blocked"), L("fetched"))) == "primary_challenge_blocked_secondary_fetched"
    assert one(codes.overall_fetch_status(L(""), L("not_attempted"))) == "pending"
    assert one(codes.fetch_error(L("blocked"), L(""))) == "primary: blocked"


def test_title_scores(one):
    score = lambda q, c, qy=None, hy=None, p="A", **k: one(titles.hit_score(
        L(q), F.array(*[L(x) for x in c]), L(qy).cast("int"), L(hy).cast("int"), p, **k))
    assert score("Bleach", ["Bleach"], 2004, 2004) == 120
    assert score("Bleach", ["Breaking Bad"], 2004, 2008) == 0
    assert score("Bleach", ["Something"], None, None) == 0
    assert score("Bleach", ["Breaking Bad"], 2004, 2004, require_title=False) == 20
    assert score("Weathering with You", ["Tenki no Ko", "Weathering with You"], 2019, 2019, "B") == 120
    assert score("Study Group", ["Group"], None, None, "B") == 65
    assert score("", ["Group"]) == 0
    base = score("Ao no Orchestra Season 2", ["Ao no Orchestra"], None, None, "C")
    second = score("Ao no Orchestra Season 2", ["Ao no Orchestra Season 2"], None, None, "C")
    assert (base, second) == (70, 115)
    assert score("a a b", ["b x a"]) == 43  # repeated query tokens count
    assert one(titles.title_jaccard(L("One Piece Sub Indo"), L("one piece"))) == 1.0
    assert one(titles.title_jaccard(L(""), L("one piece"))) == 0.0
    assert one(titles.title_jaccard(L("a b c"), L("a b c d"))) == pytest.approx(0.75 - 0.03)


def test_title_parts(one):
    d = one(titles.decompose_labeled(L("[PV] X Episode 2")))
    assert (d["labels"], d["entry_kind"], d["episode_number"], d["series_candidate"], d["normalized_title"]) == (["PV"], "preview", 2, False, "X Episode 2")
    assert one(titles.decompose_labeled(L("X Part 3")))["entry_kind"] == "part"
    assert tuple(one(titles.decompose_numbered(L("X - Episode 12")))) == ("X", "episode", 12, True)
    assert tuple(one(titles.decompose_numbered(L("X 2")))) == ("X", "numbered", 2, False)
    assert tuple(one(titles.decompose_numbered(L("X")))) == ("X", "standalone", 0, False)
    assert one(titles.clean_title(L("Show Sub Indo (Episode 1-3) " + rules.CLEAN_TITLE["1"]["suffix"]))) == "Show"
    assert one(titles.clean_title(L("Show BD Batch Subtitle Indonesia " + rules.CLEAN_TITLE["2"]["suffix"]), "2")) == "Show"
    assert one(titles.parent_title(L("X Episode 3"), L(""))) == "X"
    assert one(titles.parent_title(L("Special"), L("https://e.org/anime/my-show/"))) == "My Show"
    assert one(titles.clean_query(L("Drama Korea Honour (2026)"), L(True))) == "Honour"


def test_weekdays(one):
    assert one(schedule.weekday_name(L("Every Friday")), schedule.weekday_name(L("Jum'at")), schedule.weekday_name(L("Fridays"))) == ("friday", "friday", "")
    assert one(schedule.weekday_name(L("Monday & Tuesday 20:50")), schedule.time_window(L("Monday & Tuesday 20:50"))) == ("monday", "20:50")


@pytest.mark.parametrize("day,window,zone,now,want", [
    ("saturday", "22:30", "Asia/Seoul", "2026-03-30 08:00:00", UTC(2026, 4, 4, 13, 30)),
    ("monday", "20:00", "Asia/Seoul", "2026-03-30 08:00:00", UTC(2026, 3, 30, 11)),      # later today
    ("monday", "16:00", "Asia/Seoul", "2026-03-30 08:00:00", UTC(2026, 4, 6, 7)),        # today, passed
    ("monday", "17:00", "Asia/Seoul", "2026-03-30 08:00:00", UTC(2026, 4, 6, 8)),        # exactly now
    ("sunday", "09:00", "America/New_York", "2026-03-06 12:00:00", UTC(2026, 3, 8, 13)),  # across the clock change
    ("sunday", "99:99", "Asia/Seoul", "2026-03-30 08:00:00", None), ("", "10:00", "Asia/Seoul", "2026-03-30 08:00:00", None),
    ("sunday", "10:00", "", "2026-03-30 08:00:00", None)])
def test_next_release(one, day, window, zone, now, want):
    assert one(schedule.next_weekly_release(L(day), L(window), L(zone), F.to_timestamp(L(now)))) == want


def test_sql_functions(spark):
    names = register_functions(spark)
    assert len(names) == len(SQL_FUNCTIONS)
    row = spark.sql("SELECT sl_slugify('A & B'), sl_item_key(' S', 'ANIME', ' x '), sl_parse_smallint('99999'), sl_parse_real('1.5'), sl_host_norm('https://www.e.org/a'), sl_distinct_trimmed(array(' b','a','b'))").first()
    assert tuple(row) == ("a-and-b", "s:anime:x", None, 1.5, "e.org", ["a", "b"])
