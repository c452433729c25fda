"""From landed pages to catalog rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import codes, urls
from ..functions.arrays import compact_ci
from ..functions.dates import parse_localized_date
from ..functions.keys import item_key, unit_key
from ..functions.numbers import bounded_year, sequence_index
from ..functions.text import first_present
from ..operators.ranking import keep_first
from ..sources.pages import CARD_SPEC, extract_cards


def new_cards(cards: DataFrame, pages: DataFrame, crawl: str = "source") -> DataFrame:
    """Cards of a paged crawl that count, stamped with their page number.

    A page adds only addresses unseen on lower pages; the crawl ends before its
    first page that adds none, and later pages are ignored. All of it is grouped
    counting: no page list is walked.
    cards: crawl, page_number, pos, href; pages: crawl, page_number.
    """
    first = keep_first(cards.filter(F.col("href") != ""), [crawl, "href"], [F.col("page_number"), F.col("pos")])
    added = first.groupBy(crawl, "page_number").agg(F.count("*").alias("_added"))
    walked = pages.select(crawl, "page_number").distinct().join(added, [crawl, "page_number"], "left")
    ends = walked.filter(F.col("_added").isNull()).groupBy(crawl).agg(F.min("page_number").alias("_end"))
    # decided per page, so that cards join on (crawl, page) rather than on the crawl alone
    counted = walked.join(ends, crawl, "left").filter(F.col("_end").isNull() | (F.col("page_number") < F.col("_end")))
    return first.join(counted.select(crawl, "page_number"), [crawl, "page_number"], "left_semi")


def ingest_catalog(pages: DataFrame, spec: dict = CARD_SPEC) -> DataFrame:
    """Item batch from catalog pages (page_id, url, html, source, page_number)."""
    cards = extract_cards(pages, spec).join(pages.select("page_id", "source", "page_number"), "page_id")
    kept = new_cards(cards, pages)
    kind = F.when(F.lower("type") == "movie", "movie").otherwise("anime")
    detail = F.to_json(F.struct(
        F.col("href").alias("canonical_url"), urls.domain("href").alias("source_domain"), F.col("type").alias("anime_type"),
        "views", F.col("excerpt").alias("synopsis_excerpt"), "genres", "page_number",
    ))
    return kept.select(
        item_key("source", kind, "slug").alias("item_key"), "source", kind.alias("media_type"),
        "slug", "title", F.col("poster").alias("cover_url"), "status", F.col("score").cast("float").alias("score"), detail.alias("detail"),
        "page_number", "pos",
    )


def series_genres(source, genres):
    """Case-insensitively distinct genres plus the tag a source mandates."""
    mandated = F.array(codes.lookup(rules.MANDATED_TAG, source))
    return compact_ci(genres, mandated)


def ingest_series(details: DataFrame, children: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item batch, unit batch) of reading series.

    details: source, slug, title, cover_url, status, media_type, released, genres;
    children: source, series_slug, href, label, number_text, date_label, pos.
    """
    source = codes.source_key("source")
    items = details.withColumn("source", source).withColumn("media_type", codes.reading_media_type("source", "media_type")).select(
        item_key("source", "media_type", "slug").alias("item_key"), "source", "media_type", F.trim("slug").alias("slug"),
        "title", "cover_url", F.lower(F.trim(F.coalesce("status", F.lit("")))).alias("status"),
        bounded_year("released").cast("smallint").alias("release_year"),
        F.to_json(F.struct(series_genres(F.col("source"), "genres").alias("genres"))).alias("detail"),
    )
    slug = urls.slug_from_text("href")
    parents = items.select("source", F.col("slug").alias("series_slug"), "item_key")
    units = (
        children.withColumn("source", source).join(parents, ["source", "series_slug"])
        .select(
            unit_key("source", F.lit("chapter"), slug).alias("unit_key"), "item_key", "source",
            F.lit("chapter").alias("unit_type"), slug.alias("slug"), first_present("label").alias("title"),
            first_present("label").alias("label"), sequence_index("number_text", "pos").cast("float").alias("number"),
            F.col("href").alias("canonical_url"), parse_localized_date("date_label").alias("published_at"),
            F.to_json(F.struct("series_slug")).alias("detail"),
        )
        .filter(F.col("slug").isNotNull())
    )
    return items, units
