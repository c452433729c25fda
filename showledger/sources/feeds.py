"""Lenient RSS extraction, all in Columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes, dates, titles, urls
from ..functions.arrays import compact_ci, split_values
from ..functions.text import fields_of, first_present, html_text, label_pairs, unescape_html, unlabeled_of
from ..session import spread


def _unwrap(c: Column) -> Column:
    inner = F.regexp_replace(F.trim(c), r"(?s)^<!\[CDATA\[|\]\]>$", "")
    return F.trim(unescape_html(F.trim(inner)))


def _pattern(tag: str) -> str:
    return rf"(?is)<{tag}(?:\b[^>]*)?>(.*?)</{tag}>"


def _tags(block: Column, tag: str) -> Column:
    return F.transform(F.regexp_extract_all(block, F.lit(_pattern(tag)), F.lit(1)), _unwrap)


def _tag(block: Column, tag: str) -> Column:
    """First tag of its name; the scan stops there and only it is decoded."""
    return _unwrap(F.regexp_extract(block, _pattern(tag), 1))


def image_url(c: Column) -> Column:
    return F.trim(unescape_html(F.regexp_extract(c, r"""(?i)<img[^>]+src=["']([^"']+)["']""", 1)))


def extract_feed(pages: DataFrame, body: str = "html") -> DataFrame:
    """One row per feed item; items without link, slug or title are dropped."""
    blocks = F.regexp_extract_all(F.col(body), F.lit(r"(?is)<item\b[^>]*>(.*?)</item>"), F.lit(1))
    items = spread(pages.select("page_id", "url", body)).select("page_id", F.col("url").alias("feed_url"), F.posexplode(blocks).alias("pos", "block"))
    block = F.col("block")
    rows = items.select(
        "page_id", "feed_url", "pos", _tag(block, "title").alias("title"), _tag(block, "link").alias("link"),
        _tag(block, "pubDate").alias("pub_date"), _tag(block, "description").alias("description"),
        _tag(block, "content:encoded").alias("content"), compact_ci(_tags(block, "category")).alias("categories"),
    )
    rows = rows.withColumn("slug", urls.slug_from_url("link"))
    return rows.filter((F.col("link") != "") & (F.col("slug") != "") & (F.col("title") != ""))


def hydrate_feed(feed: DataFrame) -> DataFrame:
    """Feed items with format, labelled fields, excerpt, decomposed title and date."""
    source = F.when(F.col("content") != "", F.col("content")).otherwise(F.col("description"))
    field = lambda *names: F.coalesce(*[F.col("_f")[n] for n in names], F.lit(""))
    listed = lambda *names: compact_ci(split_values(field(*names), r"[,/|]"))
    return (
        feed.withColumn("_p", label_pairs(source)).withColumn("_f", fields_of(F.col("_p")))
        .withColumn("content_format", codes.content_format("categories", "title"))
        .withColumns({
            "source_domain": F.regexp_replace(urls.domain("feed_url"), r":\d+$", ""),
            "cover_url": first_present(image_url(F.col("content")), image_url(F.col("description"))),
            "excerpt": first_present(unlabeled_of(F.col("_p")), html_text("description"), html_text("content")),
            "original_title": field("originaltitle"), "duration": field("duration", "runtime"), "size": field("size"),
            "code": field("code", "nuclearcode"), "performer": field("performer", "actress"), "parody": field("parody"),
            "producers": listed("producers", "producer", "studio"), "genres": listed("genres", "genre"),
            "published_at": dates.parse_feed_date("pub_date"),
            "title_parts": titles.decompose_labeled("title", "content_format"),
        })
        .drop("_f", "_p")
    )
