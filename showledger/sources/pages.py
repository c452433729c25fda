"""Spec-driven extraction from landed pages.

One distributed job (`mapInArrow`) reads the fields a spec names; everything
after that is native Columns. A spec is plain data:

    {"item": "article",                       # one row per matching node
     "fields": {"title": ["h4|text", "img|@alt"], "href": ["a[href]|@href"]},
     "lists": {"genres": ".genres a|text"}}

Field alternatives are tried in order. Without "item" the page itself is the node.
"pairs" names nodes holding a label and a value. With "unended" False, character references without a semicolon are text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.numbers import card_score, card_views, chapter_number, episode_number
from ..functions.text import contains_any, entries_last_wins, is_blank, normalize_space
from ..session import cut_lineage, spread

#: Pages read between two batches of rows.
_PAGES = 100
_RAW = "page_id long, url string, pos int, fields map<string,string>, lists map<string,array<string>>, error string"

CARD_SPEC = {
    "item": "article",
    "fields": {
        "title": ["h4|text", ".tt|text", "a[title]|@title", "img|@alt"],
        "href": ["a[href]|@href"],
        "poster": ["img|@data-src", "img|@src", "img|@data-lazy-src"],
        "meta": [".meta|text", "|text"], "type": [".type|text", ".typename|text"],
        "status": [".status|text"], "excerpt": ["p|text"],
    },
    "lists": {"genres": ".genres a|text"},
}
DETAIL_SPEC = {
    "fields": {
        "title": ["h1|text", "title|text"], "alt_title": [".alter|text"], "poster": [".thumb img|@src"],
        "synopsis": [".entry-content|text"], "canonical": ["link[rel=canonical]|@href"],
        "og_title": ["meta[property=og:title]|@content"], "og_image": ["meta[property=og:image]|@content"],
        "og_description": ["meta[property=og:description]|@content", "meta[name=description]|@content"],
        "published": ["meta[property=article:published_time]|@content"], "lang": ["html|@lang"],
    },
    "lists": {"genres": ".genres a|text", "paragraphs": "article p|text"},
    # labelled values: spans led by a bold label, and two-cell table rows
    "pairs": [[".info span", "b"], ["table.info tr", "td"]],
}
CHILD_SPEC = {
    "item": ".eplister li a",
    "fields": {"href": ["|@href"], "number": [".epl-num|text"], "title": [".epl-title|text", "|text"],
               "date_label": [".epl-date|text"]},
}
LINK_SPEC = {"item": "a[href]", "fields": {"href": ["|@href"], "label": ["|text"], "aria": ["|@aria-label"]}}
IMAGE_SPEC = {"item": "#readerarea img", "fields": {"src": ["|@data-src", "|@src"]}}


def extract_raw(pages: DataFrame, spec: dict) -> DataFrame:
    """(page_id, url, pos, fields, lists, error) for every node the spec selects, in page order.

    A page that can't be read gives one row with its error and no fields; the others are not touched by it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from . import dom

        compiled, shape = dom.Spec(spec), pa.schema([
            ("page_id", pa.int64()), ("url", pa.string()), ("pos", pa.int32()), ("fields", pa.map_(pa.string(), pa.string())),
            ("lists", pa.map_(pa.string(), pa.list_(pa.string()))), ("error", pa.string())])
        for batch in batches:
            for at in range(0, batch.num_rows, _PAGES):  # few pages and their rows are held as Python objects at once
                rows = []
                for page in batch.slice(at, _PAGES).to_pylist():
                    page_id, url = page["page_id"], page["url"]
                    try:
                        found = [(page_id, url, pos, list(fields.items()), list(lists.items()), None) for pos, (fields, lists) in enumerate(compiled.rows(page["html"]), 1)]
                    except (ValueError, AssertionError, RecursionError) as e:
                        found = [(page_id, url, 0, [], [], f"unreadable: {e}")]
                    rows += found
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(shape)], schema=shape)

    return spread(pages.select("page_id", "url", "html")).mapInArrow(run, _RAW)


def unreadable(raw: DataFrame) -> DataFrame:
    """Reject rows (page_id, url, reason) of the pages that couldn't be read."""
    return raw.filter(F.col("error").isNotNull()).select("page_id", "url", F.col("error").alias("reason"))


def _field(name: str):
    return F.coalesce(F.col("fields")[name], F.lit(""))


def extract_cards(pages: DataFrame, spec: dict = CARD_SPEC) -> DataFrame:
    """Catalog cards; a card without a link or a title is dropped."""
    raw = extract_raw(pages, spec)
    meta = _field("meta")
    cards = raw.select(
        "page_id", "url", "pos", _field("title").alias("title"), _field("href").alias("href"),
        urls.slug_from_url(_field("href")).alias("slug"), _field("poster").alias("poster"),
        _field("type").alias("type"), _field("status").alias("status"), card_score(meta).alias("score"),
        card_views(meta).alias("views"), _field("excerpt").alias("excerpt"),
        F.coalesce(F.col("lists")["genres"], F.array().cast("array<string>")).alias("genres"),
    )
    return cards.filter((F.col("href") != "") & (F.col("title") != ""))


def extract_detail(pages: DataFrame, spec: dict = DETAIL_SPEC) -> tuple[DataFrame, DataFrame]:
    """(details, rejects): one row per page; a page without a title is a reject.

    Each side runs the extraction when used. To run it once, give its saved rows:
    `split_details(cut_lineage(extract_raw(pages, spec)))`.
    """
    return split_details(extract_raw(pages, spec))


def split_details(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(details, rejects) from rows extracted with a detail spec."""
    strings = lambda n: F.coalesce(F.col("lists")[n], F.array().cast("array<string>"))
    info = F.transform(
        strings("pairs"),
        lambda x: F.struct(
            F.replace(F.lower(F.substring_index(x, "\t", 1)), F.lit(" "), F.lit("")).alias("key"), F.substring_index(x, "\t", -1).alias("value")
        ),
    )
    out = raw.select(
        "page_id", "url", _field("title").alias("title"), _field("alt_title").alias("alt_title"),
        F.coalesce(F.nullif(_field("poster"), F.lit("")), _field("og_image")).alias("poster"),
        F.coalesce(F.nullif(_field("synopsis"), F.lit("")), _field("og_description")).alias("synopsis"),
        F.coalesce(F.nullif(_field("canonical"), F.lit("")), F.col("url")).alias("canonical_url"),
        _field("published").alias("published"), _field("lang").alias("lang"), strings("genres").alias("genres"),
        strings("paragraphs").alias("paragraphs"), entries_last_wins(info).alias("info"), "error",
    )
    ok = out.filter(F.col("title") != "").drop("error")
    bad = out.filter(F.col("title") == "").select("page_id", "url", F.coalesce("error", F.lit("missing title")).alias("reason"))
    return ok, bad


def extract_children(pages: DataFrame, spec: dict = CHILD_SPEC, synthesize: bool = False) -> DataFrame:
    """Episode/chapter references in page order.

    With `synthesize`, a page without a list gets one child numbered "1".
    """
    rows = extract_raw(pages, spec).select(
        "page_id", "url", "pos", _field("href").alias("href"), urls.slug_from_url(_field("href")).alias("slug"),
        _field("title").alias("label"),
        F.coalesce(F.nullif(_field("number"), F.lit("")), chapter_number(_field("title"))).alias("number_text"),
        episode_number(_field("number"), _field("title"), _field("href")).alias("number"),
        _field("date_label").alias("date_label"),
    ).filter(F.col("href") != "")
    if not synthesize:
        return rows
    rows = cut_lineage(rows)  # pages are read once, though the rows are used twice
    lone = pages.join(rows.select("page_id").distinct(), "page_id", "left_anti").select(
        "page_id", "url", F.lit(1).alias("pos"), F.col("url").alias("href"), urls.slug_from_url("url").alias("slug"),
        F.lit("1").alias("label"), F.lit("1").alias("number_text"), F.lit(1.0).alias("number"), F.lit("").alias("date_label"),
    )
    return rows.unionByName(lone)


def extract_links(pages: DataFrame, include: list[str], exclude: list[str] = (), host_paths: list[str] = (), spec: dict = LINK_SPEC) -> DataFrame:
    """Anchors whose label or address contains a keyword, as unique label -> href.

    `exclude` drops addresses; on the page's own host an address must also
    contain one of `host_paths`. A repeated or empty label gets a number.
    """
    href, label = _field("href"), normalize_space(_field("label"))
    rows = extract_raw(pages, spec).select("page_id", "url", "pos", href.alias("href"), label.alias("label"))
    low = F.lower("href")
    rows = rows.filter((F.col("href") != "") & ~low.startswith("javascript:") & ~low.startswith("#"))
    if include:
        rows = rows.filter(contains_any("label", include) | contains_any("href", include))
    if exclude:
        rows = rows.filter(~contains_any("href", list(exclude)))
    if host_paths:
        own = (urls.host_norm("href") != "") & (urls.host_norm("href") == urls.host_norm("url"))
        rows = rows.filter(~own | contains_any("href", list(host_paths)))
    return number_labels(rows)


def number_labels(rows: DataFrame, empty_label: str = "link") -> DataFrame:
    """Make labels unique inside a page: `_n` is the link's place among the kept ones."""
    page = Window.partitionBy("page_id").orderBy("pos")
    placed = rows.withColumn("place", F.row_number().over(page))
    named = placed.withColumn("label", F.when(is_blank("label"), F.concat(F.lit(empty_label + "_"), F.col("place"))).otherwise(F.col("label")))
    again = F.row_number().over(Window.partitionBy("page_id", "label").orderBy("pos"))
    return named.withColumn("_again", again).withColumn(
        "label", F.when(F.col("_again") > 1, F.concat("label", F.lit("_"), "place")).otherwise(F.col("label"))
    ).drop("_again")


def extract_script_json(html, fn_name: str, schema: str):
    """JSON object passed to a script call -> struct; NULL when absent or malformed."""
    found = F.regexp_extract(html, r"(?s)" + re.escape(fn_name) + r"\((\{.*?\})\);", 1)
    return F.from_json(F.nullif(found, F.lit("")), schema)


def extract_assets(pages: DataFrame, spec: dict = IMAGE_SPEC, script_fn: str = "ts_reader.run", http_only: bool = True,
                   skip_paths: tuple[str, ...] = ("/asset/img/",)) -> DataFrame:
    """(page_id, position, image_url): images of the script payload, else of the page.

    Payload images keep their place in the payload's list. Page images are
    numbered after data: URIs, other schemes and site assets are dropped.
    """
    payload = extract_script_json(F.col("html"), script_fn, "struct<sources:array<struct<images:array<string>>>>")
    # one column per page, so that the script is parsed once
    listed = pages.select("page_id", "url", "html", F.get(payload["sources"], 0)["images"].alias("_images"))
    told = F.exists(F.coalesce("_images", F.array().cast("array<string>")), lambda x: ~is_blank(x))
    from_script = (
        listed.filter(told).select("page_id", F.posexplode("_images").alias("at", "raw"))
        .select("page_id", (F.col("at") + 1).alias("position"), F.trim("raw").alias("image_url"))
        .filter(~is_blank("image_url"))
    )
    found = extract_raw(listed.filter(~told), spec).select("page_id", "pos", _field("src").alias("image_url"))
    found = found.filter(~is_blank("image_url") & ~F.col("image_url").startswith("data:"))
    if http_only:
        found = found.filter(F.col("image_url").startswith("http"))
    for path in skip_paths:
        found = found.filter(~F.col("image_url").contains(path))
    page = Window.partitionBy("page_id").orderBy("pos")
    from_page = found.select("page_id", F.row_number().over(page).alias("position"), "image_url")
    return from_script.unionByName(from_page)


def flatten_links(df: DataFrame, column: str, levels: list[str] = ("container", "quality", "host")) -> DataFrame:
    """Nested JSON link maps -> one row per url; blank quality is `unknown`."""
    kind = "string"
    for _ in levels:
        kind = f"map<string,{kind}>"
    out = df.withColumn("_m", F.from_json(column, kind)).drop(column)
    for level in levels:
        keep_cols = [c for c in out.columns if c != "_m"]
        out = out.select(*keep_cols, F.explode("_m").alias(level, "_m"))
    out = out.withColumnRenamed("_m", "url").filter(~is_blank("url"))
    if "quality" in levels:
        out = out.withColumn("quality", F.when(is_blank("quality"), "unknown").otherwise(F.col("quality")))
    return out


def page_link_summary(links: DataFrame) -> DataFrame:
    """Per page: link count, distinct hosts and distinct labels in first-seen order."""
    host = urls.host_norm("href")
    ordered = F.sort_array(F.collect_list(F.struct("pos", host.alias("host"), "label")))
    firsts = lambda name: F.array_distinct(F.filter(F.transform(ordered, lambda x: x[name]), lambda v: v != ""))
    return links.groupBy("page_id").agg(
        F.count("*").alias("links"), firsts("host").alias("hosts"), firsts("label").alias("labels")
    )

