"""What to fetch next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..operators.ranking import keep_first


def plan_backfill(catalog: DataFrame, existing: DataFrame, order: list[str], include: list[str] | None = None, limit: int = 0) -> DataFrame:
    """(slug, action, reason) for every catalog row the run looks at.

    In the ascending order of the `order` columns: movies (by content_type or, where
    there is one, anime_type) are skipped; rows outside the include list or without a
    slug are not looked at; a repeated slug counts once; known slugs are skipped. With
    a limit the run ends at the first slug beyond `limit` others: what comes after it,
    movies too, is not looked at.
    catalog: slug, content_type, maybe anime_type, and the order columns; existing: slug.
    """
    says_movie = lambda c: F.lower(F.trim(F.coalesce(F.col(c), F.lit("")))) == "movie"
    movie = says_movie("content_type") | (says_movie("anime_type") if "anime_type" in catalog.columns else F.lit(False))
    place = F.struct(*order)
    placed = catalog.select(F.trim("slug").alias("slug"), movie.alias("movie"), place.alias("place"))
    rest = placed.filter(~F.col("movie") & ~is_blank("slug"))
    if include:
        rest = rest.filter(F.col("slug").isin([s.strip() for s in include if s.strip()]))
    rest = rest.groupBy("slug").agg(F.min("place").alias("place"))
    movies = placed.filter("movie")
    if limit > 0:
        first = rest.orderBy("place").limit(limit + 1)  # the run's own limit
        end = first.agg(F.when(F.count(F.lit(1)) > limit, F.max("place")).alias("end")).first()["end"]  # where the run ends
        rest = first
        if end is not None:
            kinds = dict(catalog.dtypes)
            before = F.col("place") < F.struct(*[F.lit(end[c]).cast(kinds[c]).alias(c) for c in order])
            rest, movies = first.filter(before), movies.filter(before)
    known = existing.filter(~is_blank("slug")).select(F.trim("slug").alias("slug")).distinct().withColumn("_known", F.lit(True))
    looked = rest.join(known, "slug", "left").select(
        "slug",
        F.when(F.col("_known"), "skip").otherwise("attempt").alias("action"),
        F.when(F.col("_known"), "already_backfilled").otherwise("").alias("reason"),
    )
    skipped = movies.select("slug", F.lit("skip").alias("action"), F.lit("movie_without_episode_backfill").alias("reason"))
    return skipped.unionByName(looked)


def select_slugs(df: DataFrame, slugs: list[str] | None, order: list[Column], limit: int = 0) -> DataFrame:
    """Rows on the allow-list; without one, the first `limit` rows."""
    if slugs:
        return df.filter(F.col("slug").isin(list(slugs)))
    return df.orderBy(*order).limit(limit) if limit > 0 else df


def promote_numbered(df: DataFrame, batch: list[str], parts: str = "parts") -> DataFrame:
    """Numbered titles become episodes when their number is above 1 or their base
    title is numbered more than once in the batch.

    The counts are aggregated and joined back, so one frequent base title never
    gathers in a single window.
    """
    numbered = F.col(parts)["entry_kind"] == "numbered"
    base = F.col(parts)["base_title"]
    counts = df.filter(numbered).groupBy(*batch, base.alias("_base")).agg(F.count("*").alias("_n"))
    joined = df.withColumn("_base", base).join(counts, [*batch, "_base"], "left")
    up = numbered & (F.col(parts)["episode_number"] > 0) & ((F.col(parts)["episode_number"] > 1) | (F.coalesce("_n", F.lit(0)) > 1))
    return joined.withColumns({
        "base_title": base,
        "entry_kind": F.when(up, "episode").otherwise(F.col(parts)["entry_kind"]),
        "episode_number": F.col(parts)["episode_number"],
        "series_candidate": F.col(parts)["series_candidate"] | up,
    }).drop("_base", "_n", parts)
