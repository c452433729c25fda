"""Read views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsoncol
from ..functions.codes import decode
from ..functions.text import is_blank
from ..operators.dims import decode_array


def _detail_view(items: DataFrame, kinds: list[str], core: list[str], texts: list[str], ints: list[str]) -> DataFrame:
    v = F.try_parse_json("detail")
    rows = items.filter(F.col("media_type").isin(kinds)).withColumn("_v", v)
    text = [F.try_variant_get("_v", "$." + k, "string").alias(k) for k in texts]
    whole = [F.try_variant_get("_v", "$." + k, "string").try_cast("int").alias(k) for k in ints]
    return rows.select(*core, *text, *whole, "updated_at")


_CORE = ["item_key", "source", "slug", "title", "cover_url", "status", "release_year", "score"]


def view_series(items: DataFrame) -> DataFrame:
    return _detail_view(items, ["anime"], _CORE + ["mal_id"], ["type_code", "season_code", "synopsis", "trailer_youtube_id"], ["episode_count"])


def view_movie(items: DataFrame) -> DataFrame:
    return _detail_view(items, ["movie"], _CORE + ["tmdb_id"], ["original_title", "overview", "trailer_youtube_id"], ["runtime_minutes"])


def view_comic(items: DataFrame) -> DataFrame:
    return _detail_view(items, ["manhwa", "komiku"], _CORE, ["author", "synopsis", "latest_chapter_label"], [])


# Columns of the plain read views
VIEW_COLUMNS = {
    "series_list": "slug source_code meta_source_code mal_id title poster_path type_code status_code season_code year score "
                   "episode_count genre_codes studio_codes batch_links_json updated_at",
    "series_detail": "slug source_code meta_source_code mal_id title poster_path type_code status_code season_code year score "
                     "episode_count genre_codes studio_codes synopsis_source synopsis_enriched batch_links_json updated_at",
    "series_meta": "slug trailer_youtube_id cast_json updated_at",
    "episodes": "episode_slug anime_slug episode_number title release_at release_label fetch_status_code stream_links_json "
                "download_links_json updated_at",
}


def view_plain(table: DataFrame, view: str) -> DataFrame:
    """One of the plain projections in VIEW_COLUMNS."""
    return table.select(*VIEW_COLUMNS[view].split())


def lookup_item(items: DataFrame, source: str, slug: str, default_type: str = "anime") -> DataFrame:
    """title, slug, canonical_url, page_number, content_type and anime_type of one item.

    The content type falls back to the media type, and that to `default_type` when blank.
    """
    v = jsoncol.variant("detail")
    text = lambda name: F.try_variant_get(v, f"$.{name}", "string")
    return items.filter((F.col("source") == source) & (F.col("slug") == slug.strip())).select(
        "item_key", "title", "slug", F.coalesce(text("canonical_url"), F.lit("")).alias("canonical_url"),
        F.coalesce(F.try_variant_get(v, "$.page_number", "int"), F.lit(0)).alias("page_number"),
        F.coalesce(text("content_type"), F.nullif("media_type", F.lit("")), F.lit(default_type)).alias("content_type"),
        F.coalesce(text("anime_type"), F.lit("")).alias("anime_type"),
    ).limit(1)


def poster_address(path: Column, page_base: str, image_base: str) -> Column:
    """`/images/...` on the image host, other absolute paths on the page host, else unchanged."""
    return (
        F.when(is_blank(path), "")
        .when(path.startswith("/images/"), F.concat(F.lit(image_base), path))
        .when(path.startswith("/"), F.concat(F.lit(page_base), path))
        .otherwise(path)
    )


def view_catalog_sync(catalog: DataFrame, genre_dim: DataFrame, page_base: str, image_base: str, source: str) -> DataFrame:
    """Catalog rows with codes as labels, rebuilt addresses and genre names."""
    names = decode_array(catalog, "slug", "genre_codes", genre_dim, "genres")
    return catalog.join(names, "slug", "left").select(
        F.lit(source).alias("source"), "slug", "title",
        F.concat(F.lit(page_base.rstrip("/") + "/anime/"), "slug", F.lit("/")).alias("canonical_url"),
        poster_address(F.col("poster_path"), page_base, image_base).alias("poster_url"),
        decode("anime_type", "type_code").alias("anime_type"), decode("anime_status", "status_code").alias("status"),
        "score", F.col("synopsis_source").alias("synopsis_excerpt"), "genres", F.col("updated_at").alias("scraped_at"),
    )


def detail_ready(catalog: DataFrame, meta: DataFrame) -> DataFrame:
    """Slugs with an id, a known season, studios, a trailer or a cast."""
    side = meta.select("slug", "trailer_youtube_id", "cast_json")
    return catalog.join(side, "slug", "left").filter(
        F.col("mal_id").isNotNull() | (F.col("season_code") != "x")
        | (F.coalesce(F.size("studio_codes"), F.lit(0)) > 0) | ~is_blank("trailer_youtube_id")
        | (F.coalesce("cast_json", F.lit("[]")) != "[]")
    ).select("slug")


def ready_parents(units: DataFrame, parent: str, links: str) -> DataFrame:
    """Parents with a unit whose link JSON has a primary address or mirrors."""
    primary = ~is_blank(F.get_json_object(links, "$.primary"))
    return units.filter(primary | jsoncol.has_payload(links, "mirrors")).select(parent).distinct()


def movie_list(movies: DataFrame) -> DataFrame:
    return movies.select("tmdb_id", "slug", "title", "poster_path", "year", "rating", "genre_codes", "updated_at")


def movie_detail(movies: DataFrame, meta: DataFrame) -> DataFrame:
    """Movies with their side row; absent lists are empty, updated_at is the later one."""
    side = meta.withColumnRenamed("updated_at", "_mu")
    joined = movies.join(side, "tmdb_id", "left")
    out = joined.withColumn("updated_at", F.greatest("updated_at", F.coalesce("_mu", "updated_at"))).drop("_mu")
    for name, empty in (("cast_json", F.lit("[]")), ("alt_titles_json", F.lit("[]")), ("director_names", F.array().cast("array<string>"))):
        if name in out.columns:
            out = out.withColumn(name, F.coalesce(F.col(name), empty))
    return out


def _active(options: DataFrame, name: str) -> DataFrame:
    return options.filter(F.col("status_code") == "a").groupBy("tmdb_id").agg(F.count("*").alias(name))


def movie_watch_summary(movies: DataFrame, watch: DataFrame, download: DataFrame) -> DataFrame:
    """Movies with their numbers of active options (aggregated before the joins)."""
    counts = ["watch_option_count", "download_option_count"]
    out = movies.join(_active(watch, counts[0]), "tmdb_id", "left").join(_active(download, counts[1]), "tmdb_id", "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counts})


def movie_route_card(records: DataFrame, movies: DataFrame) -> DataFrame:
    """Provider records of known movies."""
    m = movies.select("tmdb_id", "slug", "title", "poster_path", "year", "rating", "genre_codes", F.col("updated_at").alias("_mu"))
    out = records.withColumnRenamed("id", "provider_record_id").join(m, "tmdb_id")
    return out.withColumn("updated_at", F.greatest("updated_at", "_mu")).drop("_mu")


def movie_route_detail(records: DataFrame, movies: DataFrame, meta: DataFrame) -> DataFrame:
    """Provider records with the full movie and its side row."""
    m = movie_detail(movies, meta).withColumnRenamed("updated_at", "_mu")
    out = records.withColumnRenamed("id", "provider_record_id").join(m, "tmdb_id")
    return out.withColumn("updated_at", F.greatest("updated_at", "_mu")).drop("_mu")


def items_with_units(items: DataFrame, units: DataFrame, item_filter: Column, unit_filter: Column) -> DataFrame:
    """Inner join with both sides filtered before it."""
    mine = items.filter(item_filter)
    theirs = units.filter(unit_filter)
    dup = [c for c in theirs.columns if c in mine.columns and c != "item_key"]
    return mine.join(theirs.select(*[F.col(c).alias("unit_" + c) if c in dup else F.col(c) for c in theirs.columns]), "item_key")
