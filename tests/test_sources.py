import random
import datetime as dt
import gc
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from showledger import schemas
from showledger.functions import keys, text
from showledger.operators.merge import upsert_items
from showledger.plans import ingest, links, reports
from showledger.session import cut_lineage, delete_below, fits_broadcast, shared_dir, spread
from showledger.sources import dom, feeds, pages as P, sinks, snapshot, tables
from showledger.streaming import freshness, jobs

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="spark-tests-", dir="/tmp")


def page(spark, html, url="https://e.org/p/1/", page_id=1):
    return spark.createDataFrame([(page_id, url, html)], "page_id bigint, url string, html string")


def test_dom():
    root = dom.parse('<div class="a b"><p>one<p>two <b>x</b></div><ul><li>1<li>2</ul><img src="i.png"><a href="/q?x=1&amp;y=2" title="T">L</a><script>no()</script>')
    get = lambda s: [n.text() for n in dom.select(root, dom.compile_selector(s))]
    assert get("div.a.b > p") == ["one", "two x"]
    assert get("ul li") == ["1", "2"]
    assert get("p b, ul > li") == ["x", "1", "2"]
    assert get("div > b") == []
    assert dom.Source("a[title]|@href").first(root) == "/q?x=1&y=2"
    assert dom.Source("a[href^=/q]|text").first(root) == "L"
    assert dom.Source("a[href=/zz]|text").first(root) == ""
    assert "no()" not in root.text()


CATALOG = """<article><a href="https://e.org/anime/alpha/"><img src="a.jpg"><h4> Alpha  One </h4></a><div class="meta"><span class="type">TV</span> 8.25 <span class="status">Ongoing</span> 1.234 Views</div>
<p>Short text</p><div class="genres"><a>Action</a><a>Drama</a></div></article><article><h4>No link</h4></article><article><a href="/x/beta"><img alt="Beta" data-src="b.jpg"></a></article>"""


def test_cards(spark):
    rows = {r.slug: r for r in P.extract_cards(page(spark, CATALOG)).collect()}
    assert sorted(rows) == ["alpha", "beta"]
    a = rows["alpha"]
    assert (a.title, a.poster, a.type, a.status, a.score, a.views, a.excerpt, a.genres) == ("Alpha One", "a.jpg", "TV", "Ongoing", 8.25, 1234, "Short text", ["Action", "Drama"])
    assert (rows["beta"].title, rows["beta"].poster) == ("Beta", "b.jpg")


def test_ingest_catalog(spark):
    two = page(spark, CATALOG).withColumn("page_number", F.lit(1)).unionByName(page(spark, CATALOG, "https://e.org/p/2/", 2).withColumn("page_number", F.lit(2))).withColumn("source", F.lit("S1"))
    rows = {r.item_key: r for r in ingest.ingest_catalog(two).collect()}
    assert sorted(rows) == ["s1:anime:alpha", "s1:anime:beta"]
    assert json.loads(rows["s1:anime:alpha"].detail)["genres"] == ["Action", "Drama"] and rows["s1:anime:alpha"].page_number == 1


def test_detail_children_assets(spark):
    html = """<html lang="id"><head><meta property="og:image" content="o.jpg"><meta property="og:description" content="about"><link rel="canonical" href="https://e.org/c/"></head><h1>Name</h1>
    <div class="info"><span><b>Status:</b> Ongoing</span><span>stray</span><span><b>Studio Name</b>: X Y</span></div><table class="info"><tr><td>Author</td><td>Z</td></tr></table>
    <div class="eplister"><ul><li><a href="https://e.org/name-episode-12/"><span class="epl-num">12</span><span class="epl-title">Name Episode 12</span><span class="epl-date">5 Mei 2025</span></a></li></ul></div>
    <script>ts_reader.run({"sources":[{"images":["https://i.org/1.jpg"," ","https://i.org/3.jpg"]}]});</script></html>"""
    ok, bad = P.extract_detail(page(spark, html))
    r = ok.first()
    assert (r.title, r.poster, r.synopsis, r.canonical_url, r.lang, r.info) == ("Name", "o.jpg", "about", "https://e.org/c/", "id", {"status": "Ongoing", "studioname": "X Y", "author": "Z"})
    assert bad.count() == 0 and P.extract_detail(page(spark, "<p>x</p>"))[1].count() == 1
    c = P.extract_children(page(spark, html)).first()
    assert (c.slug, c.number, c.label, c.date_label) == ("name-episode-12", 12.0, "Name Episode 12", "5 Mei 2025")
    lone = P.extract_children(page(spark, "<p></p>"), synthesize=True).first()
    assert (lone.label, lone.number) == ("1", 1.0)
    assert [(a.position, a.image_url) for a in P.extract_assets(page(spark, html)).orderBy("position").collect()] == [(1, "https://i.org/1.jpg"), (3, "https://i.org/3.jpg")]
    area = '<div id="readerarea"><img src="data:x"><img src="https://i.org/asset/img/x.png"><img data-src="https://i.org/a.jpg"></div>'
    assert [(a.position, a.image_url) for a in P.extract_assets(page(spark, area)).collect()] == [(1, "https://i.org/a.jpg")]


def test_links(spark):
    html = '<a href="/batch/1">Batch</a><a href="https://o.org/batch.zip">Batch</a><a href="#batch">Batch</a><a href="javascript:batch()">b</a><a href="/daftar-batch">All batch</a><a href="https://e.org/x-batch-nav">Nav</a><a href="https://o.org/b2-batch"></a><a href="/z">Other</a>'
    out = P.extract_links(page(spark, html), ["batch"], ["/list", "/daftar"], ["download", "/batch"])
    assert [(r.label, r.href) for r in out.orderBy("pos").collect()] == [("Batch", "/batch/1"), ("Batch_2", "https://o.org/batch.zip"), ("link_3", "https://o.org/b2-batch")]


def test_flatten(spark):
    df = spark.createDataFrame([(1, '{"mp4":{"720p":{"a":"u1","b":" "},"":{"c":"u2"}}}'), (2, "{}"), (3, None)], "id int, j string")
    assert sorted(tuple(r) for r in P.flatten_links(df, "j").collect()) == [(1, "mp4", "720p", "a", "u1"), (1, "mp4", "unknown", "c", "u2")]


def test_feed(spark):
    xml = """<rss><item><title><![CDATA[[3D] Show &amp; Tell Episode 2]]></title><link>https://e.org/show-2/</link><pubDate>Sun, 01 Mar 2026 12:30:00 +0700</pubDate><category>3D Animation</category>
    <description>&lt;p&gt;plain&lt;/p&gt;</description><content:encoded><![CDATA[<p>Genre: Action / Drama, action</p><p>Duration : 20 min</p><p>A long enough line for the excerpt here</p>]]></content:encoded></item>
    <item><title>no slug</title><link>https://e.org/</link></item></rss>"""
    r = feeds.hydrate_feed(feeds.extract_feed(page(spark, xml, "https://feed.org:80/rss"))).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.title, r.slug, r.content_format, r.genres, r.duration, r.source_domain, r.published_at) == ("[3D] Show & Tell Episode 2", "show-2", "animation_3d", ["Action", "Drama"], "20 min", "feed.org", dt.datetime(2026, 3, 1, 5, 30))
    assert (r.excerpt, r.title_parts.episode_number, r.title_parts.series_candidate) == ("A long enough line for the excerpt here", 2, True)


def test_text_helpers(spark):
    r = page(spark, "<p>Score: 8.5<br>Aired: Jan &amp; Feb</p>").select(text.labeled_value("html", "Aired"), text.labeled_value("html", "None"), keys.item_key(F.lit(" S "), F.lit("Anime"), F.lit(" x "))).first()
    assert tuple(r) == ("Jan & Feb", "", "s:anime:x")


def test_exceptions_and_gap(spark, folder):
    with open(folder + "/ex.tsv", "w") as f:
        f.write("# slug\treason\n\nb\tmovie\n c \tother\n")
    ex = tables.read_exceptions(spark, folder + "/ex.tsv")
    assert sorted(tuple(r) for r in ex.collect()) == [("b", "movie"), ("c", "other")]
    items = spark.createDataFrame([("a",), ("b",), ("d",)], "slug string")
    units = spark.createDataFrame([("d",), ("d",), (" ",)], "parent_slug string")
    assert tuple(reports.gap_report(items, units, ex).first()) == (3, 1, 2, 1)
    with open(folder + "/empty.tsv", "w") as f:
        f.write("# nothing\n")
    assert tuple(reports.gap_report(items, units, tables.read_exceptions(spark, folder + "/empty.tsv")).first()) == (3, 1, 0, 2)


def test_tables(spark, folder):
    rows = spark.createDataFrame([("k", "p", "1", "matched", 5, "t", None, "{}", T0, T0)], schemas.ENRICHMENT)
    tables.write_version(rows, folder + "/enrichments")
    assert tables.read_table(spark, folder, "enrichments").first().item_key == "k"
    with pytest.raises(Exception):
        tables.write_version(rows, folder + "/enrichments")


def test_report_sinks(spark, folder):
    df = spark.createDataFrame([("a", 0.5, True, [("1", "x"), ("2", None)]), ("b", 0.0, False, [])], "slug string, score double, flag boolean, kids array<struct<n:string,own:string>>")
    sinks.write_report_csv(df, folder + "/csv", ["slug", "score", "flag"], "kids", ["n", "own"])
    back = sorted(tuple(r) for r in spark.read.csv(folder + "/csv", header=True).na.fill("").collect())
    assert back == [("a", "0.500", "true", "1", "x"), ("a", "0.500", "true", "2", ""), ("b", "0.000", "false", "", "")]
    sinks.write_report_json(df, folder + "/json")
    assert spark.read.json(folder + "/json").count() == 2


def test_snapshot_roundtrip(spark, folder):
    items = spark.createDataFrame([(f"k{i}", "d1" if i < 8 else "d2", f"s{i}", f"T {i}", T0 + dt.timedelta(days=i)) for i in range(12)], "item_key string, source string, slug string, title string, updated_at timestamp")
    units = spark.createDataFrame([("u1", "k0", "u1", T0 + dt.timedelta(days=99))], "unit_key string, item_key string, slug string, updated_at timestamp")
    m = snapshot.build_snapshot(items, units, F.col("source"), folder, hot_limit=3)
    got = {(r.domain, r.kind): (r.documents, r.touched_at) for r in m.collect()}
    assert got[("d1", "home")] == (3, "2024-04-09T00:00:00Z") and got[("d1", "catalog")][0] == 8 and got[("d1", "playback")][0] == 1
    targets = spark.createDataFrame([("d1", "s3")], "domain string, slug string")
    shape = "domain string, kind string, title_slug string, slug string, touched_at timestamp, document string"
    docs = spark.createDataFrame([("d1", "title", "s3", "s3", dt.datetime(2025, 1, 1), '{"new":1}'), ("d1", "title", "s4", "s4", T0, '{"ignored":1}')], shape)
    m = snapshot.patch_snapshot(folder, targets, docs)
    got = {(r.domain, r.kind): (r.documents, r.touched_at) for r in m.collect()}
    assert got[("d1", "title")] == (8, "2025-01-01T00:00:00Z") and got[("d1", "catalog")][0] == 8 and got[("d2", "title")][0] == 4
    pack = spark.read.parquet(folder + "/pack")
    assert {r.kind: r.document for r in pack.filter("slug = 's3'").collect()}["title"] == '{"new":1}'
    assert {r.kind for r in pack.filter("slug = 's3'").collect()} == {"catalog", "title", "search"}
    first = spark.createDataFrame([("d1", "s0")], "domain string, slug string")
    plays = spark.createDataFrame([("d1", "playback", "s0", u, T0, "{}") for u in ("u2", "u3")], shape)
    home = spark.createDataFrame([("d1", "home", "s7", "s7", T0, "{}")], shape)
    got = {(r.domain, r.kind): r.documents for r in snapshot.patch_snapshot(folder, first, plays, home).collect()}
    assert got[("d1", "playback")] == 2 and got[("d1", "home")] == 1 and got[("d2", "home")] == 3 and got[("d1", "title")] == 8


def test_patch_reads_touched_folders_only(spark, folder):
    """200 titles of two domains in 16 buckets; the scan of a patch names the files of its folders and no others."""
    items = spark.createDataFrame([(f"k{i}", "d/1" if i % 2 else "2024", f"s{i}", f"T {i}", T0) for i in range(200)], "item_key string, source string, slug string, title string, updated_at timestamp")
    units = spark.createDataFrame([], "unit_key string, item_key string, slug string, updated_at timestamp")
    snapshot.build_snapshot(items, units, F.col("source"), folder, buckets=16)
    targets = spark.createDataFrame([("d/1", "s3"), ("2024", "s4"), ("new", "s5")], "domain string, slug string")
    docs = spark.createDataFrame([(d, "title", s, s, dt.datetime(2025, 1, 1), "{}") for d, s in (("d/1", "s3"), ("2024", "s4"), ("new", "s5"))], "domain string, kind string, title_slug string, slug string, touched_at timestamp, document string")
    old = snapshot.read_locator(spark, folder)
    asked = snapshot.touched_folders(folder, targets, docs).join(old, snapshot.FOLDER, "left_semi").select(*snapshot.FOLDER).collect()
    read = {f.rsplit("/", 1)[0].split("/pack/")[1] for f in snapshot.read_folders(spark, folder, asked).inputFiles()}
    assert len(read) == len(asked) == 2 and {r.domain for r in asked} == {"d/1", "2024"}
    every = {f.rsplit("/", 1)[0] for f in spark.read.parquet(folder + "/pack").inputFiles()}
    assert len(every) > 60
    manifest = snapshot.patch_snapshot(folder, targets, docs)
    want = snapshot.manifest(spark.read.schema(snapshot._PACK).parquet(folder + "/pack"))
    assert sorted(manifest.collect()) == sorted(want.collect()) and {r.domain for r in want.collect()} == {"d/1", "2024", "new"}
    assert sorted(snapshot.read_locator(spark, folder).collect(), key=str) == sorted(snapshot._located(spark.read.schema(snapshot._PACK).parquet(folder + "/pack")).collect(), key=str)


def test_delete_below(spark, folder):
    """Only what lies below the named folder can be deleted; an empty path would be the working directory."""
    spark.range(1).write.parquet(folder + "/a/b")
    for path in ("", folder, folder + "/a", folder + "/ab", folder + "/a/../c", "/tmp"):
        with pytest.raises(ValueError):
            delete_below(spark, folder + "/a", path)
    with pytest.raises(ValueError):
        delete_below(spark, "", folder + "/a")
    delete_below(spark, folder + "/a", folder + "/a/b")
    assert not os.path.exists(folder + "/a/b") and os.path.exists(folder + "/a")


def test_link_audit(spark):
    rows = spark.createDataFrame([("s", "a", "https://x.org/2 https://x.org/1", 2), ("s", "b", "https://y.org/9", 1), ("s", "c", "none", 3), ("t", "d", "https://z.org/", 1)], "source_type string, slug string, text string, n int")
    res = spark.createDataFrame([("https://x.org/1", "https://x.org/f", "x.org", 200, "")], "url string, final_url string, final_host string, status_code int, error string")
    entries, hosts = links.link_audit(rows, res, [F.col("n").desc()], per_source=1, cap=2)
    assert sorted((r.url, r.final_host) for r in entries.collect()) == [("https://x.org/1", "x.org"), ("https://x.org/2", None)]
    assert sorted(tuple(r) for r in hosts.collect()) == [("s", "unresolved", 1), ("s", "x.org", 1)]


def test_session(spark):
    small = spark.range(10)
    assert fits_broadcast(small) and spread(small).rdd.getNumPartitions() == 8
    assert cut_lineage(small).count() == 10 and shared_dir(spark)


def test_stream_equals_batch(spark, folder):
    """Two micro-batches fold to the same table as one batch; a replay changes nothing."""
    schema = "item_key string, title string, n int, created_at timestamp, updated_at timestamp"
    typed = spark.createDataFrame([], schema).schema
    rows = lambda a, b: spark.createDataFrame([(f"k{i}", f"t{i}-{a}" if i % 3 else "", i + a, None, None) for i in range(a, b)], schema)
    rows(0, 20).coalesce(1).write.parquet(folder + "/in/a")
    rows(10, 30).coalesce(1).write.parquet(folder + "/in/b")
    now = F.lit(T0)

    def advance(old, batch):
        return upsert_items(old if old is not None else spark.createDataFrame([], schema), batch, now, order=[F.col("n").desc()])

    both = spark.readStream.schema(typed).option("maxFilesPerTrigger", 1).parquet(folder + "/in/*")
    run = lambda: jobs.run_upserts(both, folder + "/state", folder + "/ckpt", ["item_key"], advance, buckets=4)
    run()
    assert jobs.read_manifest(spark, folder + "/state")["buckets"] == 4
    got = {r.item_key: r.title for r in jobs.current_table(spark, folder + "/state").collect()}
    want = {r.item_key: r.title for r in advance(advance(None, rows(0, 20)), rows(10, 30)).collect()}
    other = {r.item_key: r.title for r in advance(advance(None, rows(10, 30)), rows(0, 20)).collect()}
    assert got in (want, other) and len(got) == 30
    run()
    assert jobs.current_table(spark, folder + "/state").count() == 30
    rows(0, 3).coalesce(1).write.parquet(folder + "/in/c")
    with pytest.raises(Exception, match="4 buckets"):
        jobs.run_upserts(both, folder + "/state", folder + "/ckpt", ["item_key"], advance, buckets=5)


def test_stream_state_is_bounded(spark, folder):
    """Old folders go, an emptied bucket is gone, the reserved name is refused."""
    schema = "k long, v string"
    typed = spark.createDataFrame([], schema).schema
    go = lambda advance, at="": jobs.run_upserts(jobs.read_stream(spark, folder + "/in", typed), folder + "/state" + at, folder + "/ckpt" + at, ["k"], advance, buckets=2)
    replace = lambda old, batch: batch if old is None else batch.unionByName(old.join(batch.select("k"), "k", "left_anti"))
    for n in range(5):
        spark.createDataFrame([(k, str(n)) for k in range(20)], schema).coalesce(1).write.mode("append").parquet(folder + "/in")
        go(replace)
    table = jobs.current_table(spark, folder + "/state")
    assert sorted(table.columns) == ["k", "v"] and {r.v for r in table.collect()} == {"4"} and table.count() == 20
    assert len(jobs._list(spark, folder + "/state/data")) == jobs.KEPT and jobs._list(spark, folder + "/state/_work") == []
    spark.createDataFrame([(1, "x")], schema).coalesce(1).write.mode("append").parquet(folder + "/in")
    go(lambda old, batch: batch.limit(0))
    left = jobs.current_table(spark, folder + "/state")
    assert 0 < left.count() < 20  # only the bucket of the touched key is emptied
    with pytest.raises(Exception, match="reserved"):
        go(lambda old, batch: batch.withColumn(jobs.BUCKET, F.lit(1)), "2")


def test_stream_touches_few_buckets(spark, folder):
    """A later batch rewrites only the buckets of its own keys."""
    schema = "item_key string, title string, created_at timestamp, updated_at timestamp"
    typed = spark.createDataFrame([], schema).schema
    advance = lambda old, batch: upsert_items(old if old is not None else spark.createDataFrame([], schema), batch, F.lit(T0))
    ingest_new = lambda: jobs.run_upserts(jobs.read_stream(spark, folder + "/in", typed), folder + "/state", folder + "/ckpt", ["item_key"], advance, buckets=16)
    spark.createDataFrame([(f"k{i}", "a", None, None) for i in range(100)], schema).coalesce(1).write.mode("append").parquet(folder + "/in")
    ingest_new()
    spark.createDataFrame([("k7", "b", None, None)], schema).coalesce(1).write.mode("append").parquet(folder + "/in")
    ingest_new()
    folders = jobs.read_manifest(spark, folder + "/state")["folders"]
    assert len(folders) == 16 and sum(p.startswith("data/1/") for p in folders.values()) == 1
    table = {r.item_key: r.title for r in jobs.current_table(spark, folder + "/state").collect()}
    assert len(table) == 100 and table["k7"] == "b" and table["k8"] == "a"


def test_bucket_directory_grows(spark, folder):
    """Begun with 8 buckets and grown to 64: equal rows, and no batch rewrites buckets that it neither touches nor splits."""
    schema = "k long, v string"
    typed = spark.createDataFrame([], schema).schema
    replace = lambda old, batch: batch if old is None else batch.unionByName(old.join(batch.select("k"), "k", "left_anti"))
    go = lambda: jobs.run_upserts(jobs.read_stream(spark, folder + "/in", typed), folder + "/state", folder + "/ckpt", ["k"], replace, buckets=8, bucket_rows=10, splits=20)
    want, counts = {}, []
    for n in range(6):
        rows = {k: str(n) for k in (range(640) if n == 0 else range(n * 7, n * 7 + 3))}
        want |= rows
        spark.createDataFrame(list(rows.items()), schema).coalesce(1).write.mode("append").parquet(folder + "/in")
        go()
        held = jobs.read_manifest(spark, folder + "/state")
        counts.append(held["buckets"])
        assert dict(jobs.current_table(spark, folder + "/state").collect()) == want
        assert sum(held["rows"].values()) == len(want) and set(held["rows"]) == set(held["folders"])
        if n and counts[-1] == counts[-2]:  # no split: only the buckets of three keys are new
            assert sum(f.startswith(f"data/{n}/") for f in held["folders"].values()) <= 3
        elif n:  # a split rewrites two buckets for each new one
            assert sum(f.startswith(f"data/{n}/") for f in held["folders"].values()) <= 3 * 2 + 2 * (counts[-1] - counts[-2])
    assert counts == [8, 28, 48, 64, 64, 64]


def test_bucket_numbers():
    for base in (1, 3, 8):
        for count in range(base, 5 * base):
            for h in range(-40, 200):
                b = jobs.bucket_number(h, base, count)
                assert 0 <= b < count
                for older in range(base, count):  # the rows of a bucket come from one older bucket
                    assert jobs.bucket_number(b, base, older) == jobs.bucket_number(h, base, older)


def test_alerts_of_a_silent_source(spark, folder):
    """The clock goes on by another source only: the silent one becomes stale and late once each, and fresh again on a touch."""
    rows = lambda found: spark.createDataFrame([(s, T0 + dt.timedelta(minutes=m)) for s, m in found], "source string, at timestamp")
    for part in ([("a", 0), ("b", 0)], [("b", 200)], [("b", 330), ("b", 331)], [("b", 560)], [("b", 700)], [("a", 710), ("b", 720)], [("b", 900)]):
        rows(part).coalesce(1).write.mode("append").parquet(folder + "/in")
    stream = jobs.read_stream(spark, folder + "/in", rows([("a", 0)]).schema, files_per_batch=1)
    jobs.run_append(freshness.freshness_alerts(stream, "at", "source", "10 minutes"), folder + "/out", folder + "/ckpt")
    minutes = lambda x: None if x is None else int((x - T0).total_seconds() // 60)
    got = sorted((r.source, minutes(r.changed_at), r.status, minutes(r.latest)) for r in spark.read.parquet(folder + "/out").collect())
    assert got == sorted([("a", 0, "fresh", None), ("b", 0, "fresh", None), ("a", 240, "stale", 0), ("a", 480, "late", 0), ("a", 710, "fresh", 0)], key=str) or got == sorted(
        [("a", 0, "fresh", None), ("a", 240, "stale", 0), ("a", 480, "late", 0), ("a", 710, "fresh", 0), ("b", 0, "fresh", None)])


def test_state_partitions_are_bounded(spark, folder):
    """A stream begins with no more state partitions than named and keeps them; the session's setting stays."""
    rows = lambda found: spark.createDataFrame([(s, T0 + dt.timedelta(hours=h)) for s, h in found], "source string, at timestamp")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for part, n in (([("a", 0), ("b", 1)], 1), ([("a", 20)], 2)):
        rows(part).coalesce(1).write.mode("append").parquet(folder + "/in")
        stream = jobs.read_stream(spark, folder + "/in", rows([("a", 0)]).schema)
        jobs.run_append(freshness.freshness_alerts(stream, "at", "source", "10 minutes"), folder + "/out", folder + "/ckpt", n)
        assert [n for n in os.listdir(folder + "/ckpt/state/0") if n.isdigit()] == ["0"] and spark.conf.get("spark.sql.shuffle.partitions") == before
    got = {(r.source, r.status, (r.changed_at - T0).total_seconds() / 3600) for r in spark.read.parquet(folder + "/out").collect()}
    assert got == {("a", "fresh", 0), ("b", "fresh", 1), ("a", "stale", 4), ("b", "stale", 5), ("a", "late", 8), ("b", "late", 9)}


def test_clock_ticks_wake_silent_sources(spark, folder):
    shape = "source string, at timestamp"
    spark.createDataFrame([("a", T0)], shape).coalesce(1).write.parquet(folder + "/in")
    spark.createDataFrame([(T0 + dt.timedelta(hours=9),)], "timestamp timestamp").coalesce(1).write.parquet(folder + "/ticks")
    changes = jobs.read_stream(spark, folder + "/in", spark.createDataFrame([], shape).schema)
    ticks = jobs.read_stream(spark, folder + "/ticks", spark.createDataFrame([], "timestamp timestamp").schema)
    jobs.run_append(freshness.freshness_alerts(freshness.with_clock(changes, ticks, "at", "source"), "at", "source"), folder + "/out", folder + "/ckpt")
    assert sorted(r.status for r in spark.read.parquet(folder + "/out").collect()) == ["fresh", "late", "stale"]


def test_judge_is_the_same_however_batches_are_cut():
    rng, hour = random.Random(3), 3_600_000_000
    for _ in range(300):
        touches = sorted(rng.sample(range(0, 100 * hour, hour // 4), rng.randint(1, 30)))
        now = rng.randint(0, 120) * hour + 1
        want, _, _, _, _ = freshness.judge(None, None, freshness.runs(touches, touches, 4 * hour), now, 4 * hour, 8 * hour)
        status, latest, waiting, got, seen = None, None, [], [], 0
        while seen < now:  # rows arrive by hours of the clock, each at most an hour after the watermark
            step = min(now, seen + rng.randint(1, 20) * hour)
            new = [t for t in touches if seen - (seen == 0) <= t < step + hour and t not in {x for x in touches if x < seen + hour and seen}]
            waiting = freshness.runs([a for a, _ in waiting] + new, [b for _, b in waiting] + new, 4 * hour)
            made, status, latest, waiting, _ = freshness.judge(status, latest, waiting, step, 4 * hour, 8 * hour)
            got, seen = got + made, step
        assert [(s, at) for s, at, _ in got] == [(s, at) for s, at, _ in want]


def test_table_in_a_folder_is_streamed(spark, folder):
    """A table may be one file or a folder of part files; either is read, and nothing beside it."""
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id long")
    rows(1, 2, 3).repartition(3).write.parquet(folder + "/in/pages.parquet")
    rows(9).write.parquet(folder + "/in/others.parquet")
    stream = jobs.read_stream(spark, folder + "/in", rows(1).schema, "pages.parquet")
    jobs.run_append(stream, folder + "/out", folder + "/ckpt")
    assert sorted(r.id for r in spark.read.parquet(folder + "/out").collect()) == [1, 2, 3]


def test_cut_references_in_a_page(spark):
    """A title that was cut within a reference: HTML5 reads `&amp` without its semicolon, a spec may ask for the semicolon."""
    html = "<h1>a &amp;&amp</h1><p>x</p><article><p>&lt;b&gt; &#39 &#x27; &nosuch; &ampx;</p></article>"
    read = lambda **k: P.extract_detail(page(spark, html), P.DETAIL_SPEC | k)[0].select("title", F.col("paragraphs")[0]).first()
    assert tuple(read(unended=False)) == ("a &&amp", "<b> &#39 ' &nosuch; &ampx;")
    assert tuple(read()) == ("a &&", "<b> ' ' &nosuch; &x;")


def test_batches_of_a_stream_are_written_by_many_tasks(spark, folder, monkeypatch):
    from workloads import base, streams

    monkeypatch.setattr(streams, "_work", lambda t: folder)
    rows, files = spark.range(1000).repartition(4), []
    for stream in streams._arrivals(base.Tables(spark, folder), rows, F.col("id") % 2, 3):
        query = jobs.run_append(stream, folder + "/out", folder + "/ckpt")
        assert query.recentProgress[0].numInputRows == 500
        files.append(len([n for n in os.listdir(folder + "/in") if n.endswith(".parquet")]))
    assert files == [4, 8] and spark.read.parquet(folder + "/out").distinct().count() == 1000


def test_alerts_of_many_sources_share_state_rows(spark, folder):
    rng, hour = random.Random(5), 3_600_000_000
    base = int(T0.replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    touches = {f"s{k}": sorted(base + m * 60_000_000 for m in rng.sample(range(3000), 6)) for k in range(60)}
    rows = [(n, a) for n, found in touches.items() for a in found]
    shape = "source string, us long"
    for lo in (0, 1000, 2000):
        part = [r for r in rows if lo <= (r[1] - base) // 60_000_000 < lo + 1000]
        spark.createDataFrame(part, shape).select("source", F.timestamp_micros("us").alias("at")).coalesce(1).write.mode("append").parquet(folder + "/in")
    stream = jobs.read_stream(spark, folder + "/in", spark.read.parquet(folder + "/in").schema, files_per_batch=1)
    query = jobs.run_append(freshness.freshness_alerts(stream, "at", "source", "10 minutes", shares=4), folder + "/out", folder + "/ckpt")
    assert query.lastProgress.stateOperators[0].numRowsTotal <= 4
    now = max(a for _, a in rows) - 600_000_000
    want = {(n, s, at) for n, found in touches.items() for s, at, _ in freshness.judge(None, None, freshness.runs(found, found, 4 * hour), now, 4 * hour, 8 * hour)[0]}
    assert {(r.source, r.status, r.us) for r in spark.read.parquet(folder + "/out").withColumn("us", F.unix_micros("changed_at")).collect()} == want


def test_pages_leave_nothing_behind(spark):
    """A page's tree goes with its rows, not when the cycle collector runs, and rows leave a task after few pages."""
    html = "<ul>" + "".join(f"<li><a href='/{i}'>{i}</a></li>" for i in range(50)) + "</ul>"
    spec = dom.Spec({"item": "li a", "fields": {"href": ["|@href"]}})
    gc.collect()
    gc.disable()
    try:
        assert len(list(spec.rows(html))) == 50 and not [o for o in gc.get_objects() if isinstance(o, dom.Node)]
    finally:
        gc.enable()
    pages = spark.range(1050).select(F.col("id").alias("page_id"), F.lit(None).cast("string").alias("url"), F.when(F.col("id") % 3 > 0, F.lit(html)).alias("html")).coalesce(1)
    raw = P.extract_raw(pages, {"item": "li a", "fields": {"href": ["|@href"]}})
    assert raw.count() == 700 * 50 and raw.where("error is not null or url is not null").count() == 0
