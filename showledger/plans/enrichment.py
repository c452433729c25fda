"""Enrichment candidates, queries, payloads and promotion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import jsoncol, people
from ..functions.arrays import compact_ci, distinct_trimmed_sorted
from ..functions.codes import country_code
from ..functions.numbers import year_from_date
from ..functions.text import first_present, is_blank
from ..functions.titles import clean_query


def _matched(enrich: DataFrame, providers: list[str]) -> DataFrame:
    """One row per item with a flag per provider that has a match."""
    hits = enrich.filter((F.col("match_status") == "matched") & F.col("provider").isin(providers))
    return hits.groupBy("item_key").agg(
        *[F.coalesce(F.bool_or(F.col("provider") == p), F.lit(False)).alias("_has_" + p) for p in providers]
    )


def _flagged(items: DataFrame, enrich: DataFrame, providers: list[str]) -> tuple[DataFrame, dict[str, Column]]:
    joined = items.join(_matched(enrich, providers), "item_key", "left")
    return joined, {p: F.coalesce(F.col("_has_" + p), F.lit(False)) for p in providers}


def candidate_order() -> list[Column]:
    return [F.col("updated_at").desc(), F.col("item_key").asc()]


def candidates_primary(items: DataFrame, enrich: DataFrame, scope: str = "all", skip_existing: bool = True,
                       series_sources: list[str] = ("drakorid",), provider: str = "tmdb") -> DataFrame:
    """Movies, and non-variety series of some sources, optionally without a match yet."""
    movie = F.col("surface_type") == "movie"
    series = (
        (F.col("surface_type") == "series") & F.col("source").isin(list(series_sources))
        & (F.coalesce("origin_type", F.lit("")) != "variety")
    )
    wanted = {"movie": movie, "series": series, "all": movie | series}[scope]
    chosen = items.filter(wanted)
    if not skip_existing:
        return chosen
    # one provider only: a left-anti join says the same with less work than a flag
    done = enrich.filter((F.col("match_status") == "matched") & (F.col("provider") == provider)).select("item_key")
    return chosen.join(done, "item_key", "left_anti").select(*items.columns)


def candidates_fallback(items: DataFrame, enrich: DataFrame, scope: str = "all", skip_existing: bool = True,
                        min_confidence: int = 70, providers: tuple[str, str, str] = ("tmdb", "jikan", "anilist")) -> DataFrame:
    """Comics and animation that are uncertain or lack their first provider's match."""
    movie_by, series_by, own = providers
    comic = F.col("surface_type") == "comic"
    video = (F.col("presentation_type") == "animation") & F.col("surface_type").isin("movie", "series")
    chosen = items.filter({"comic": comic, "video": video, "all": comic | video}[scope])
    joined, has = _flagged(chosen, enrich, list(providers))
    needy = (
        (F.col("taxonomy_confidence") < min_confidence)
        | ((F.col("surface_type") == "movie") & ~has[movie_by])
        | ((F.col("surface_type") == "series") & ~has[series_by])
    )
    out = joined.filter(needy & ~has[own]) if skip_existing else joined.filter(needy)
    return out.select(*items.columns)


def build_queries(candidates: DataFrame, aliases: list[str] = rules.ALIASES_PRIMARY, split_variants: bool = True) -> DataFrame:
    """(query_id, query_pos, query, year): aliases in order, cleaned, distinct ignoring case."""
    v = F.col("_v")
    drama = F.col("source").isin(rules.ASCII_TITLE_SOURCES)

    def values(path: str) -> Column:
        if path == "@title":
            return F.array(F.col("title"))
        if path.endswith("[]"):
            return F.coalesce(F.try_variant_get(v, "$." + path[:-2], "array<string>"), F.array().cast("array<string>"))
        return F.array(jsoncol.get_text(v, path))

    lists = [values(p) for p in aliases]
    if split_variants:
        lists.append(F.when(drama, values("native_title")).otherwise(F.array().cast("array<string>")))
    raw = F.filter(F.concat(*lists), lambda x: x.isNotNull())
    if split_variants:
        raw = F.flatten(F.transform(raw, lambda x: F.split(x, r"[,;|]")))
        raw = F.transform(raw, lambda x: clean_query(x, drama))
        raw = F.filter(raw, lambda x: ~drama | x.rlike("[A-Za-z]"))
    return (
        candidates.withColumn("_v", jsoncol.variant("detail"))
        .select(F.col("item_key").alias("query_id"), F.coalesce(F.col("release_year").cast("int"), F.lit(0)).alias("year"),
                F.posexplode(compact_ci(raw)).alias("query_pos", "query"))
        .select("query_id", "query_pos", "query", "year")
    )


def movie_payload(kind: str = "movie") -> Column:
    """Compact payload from a provider detail row (see `PROVIDER_DETAIL` column names)."""
    text = lambda c: (F.col(c), "text")
    return jsoncol.compact_payload({
        "kind": (F.lit(kind), "text"), "matched_query": text("matched_query"), "title": text("detail_title"),
        "original_title": text("original_title"), "overview": text("overview"),
        "poster_url": (people.poster_url("poster_path"), "text"),
        "backdrop_url": (people.poster_url("backdrop_path"), "text"),
        "release_year": (year_from_date("release_date"), "number"), "rating": (F.col("vote_average"), "number"),
        "runtime_minutes": (F.col("runtime"), "number"), "tagline": text("tagline"), "status": text("detail_status"),
        "original_language": text("original_language"), "genres": (F.col("genres"), "list"),
        "country_names": (
            people.country_names("countries", "original_language" if kind == "series" else F.lit("")), "list"),
        "trailer_url": (people.trailer_url("videos"), "text"), "cast": (people.cast_entries("cast", 6), "objects"),
        "directors": (people.directors("crew"), "list"),
    })


PROVIDER_DETAIL = (
    "external_id string, detail_title string, original_title string, overview string, poster_path string, "
    "backdrop_path string, release_date string, vote_average double, runtime int, tagline string, detail_status string, "
    "original_language string, genres array<string>, countries array<string>, "
    "videos array<struct<site:string,key:string,type:string,official:boolean>>, "
    "cast array<struct<name:string,character:string>>, crew array<struct<name:string,job:string>>"
)


def enrichment_rows(best: DataFrame, details: DataFrame, provider: str, kind: str, now: Column) -> DataFrame:
    """Enrichment rows of `pick_best` results, with payloads of the matched details."""
    joined = best.join(details, "external_id", "left")
    payload = F.when(F.col("match_status") == "matched", movie_payload(kind)).otherwise(
        F.to_json(F.struct(F.lit(kind).alias("kind")))
    )
    return joined.select(
        "item_key", F.lit(provider).alias("provider"), "external_id", "match_status", F.col("match_score").cast("smallint").alias("match_score"),
        first_present("detail_title", "matched_title").alias("matched_title"),
        F.coalesce(year_from_date("release_date"), "matched_year").cast("smallint").alias("matched_year"),
        payload.alias("payload"), now.alias("created_at"), now.alias("updated_at"),
    )


def fallback_payload() -> Column:
    """Compact payload of a fallback-provider hit (the columns `promote` reads back)."""
    text = lambda c: (F.col(c), "text")
    return jsoncol.compact_payload({
        "type": text("type"), "format": text("format"), "status": text("status"), "country_of_origin": text("country_of_origin"),
        "season_year": (F.col("season_year"), "number"), "average_score": (F.col("average_score"), "number"),
        "is_adult": (F.col("is_adult"), "any"), "genres": (F.col("genres"), "list"), "title_english": text("title_english"),
        "title_romaji": text("title_romaji"), "title_native": text("title_native"), "synonyms": (F.col("synonyms"), "list"),
        "description": text("description"),
        "cover_image": (first_present("cover_extra_large", "cover_large", "cover_medium"), "text"),
        "banner_image": text("banner_image"), "site_url": text("site_url"),
    })


_EMBEDDED_KEYS = ["source_title", "synopsis_enriched", "synopsis", "season", "status", "genre_names", "genres", "studio_names",
                  "mal_thumbnail_url", "mal_url"]


def embedded_enrichments(items: DataFrame, provider: str = "jikan", score: int = 95) -> DataFrame:
    """Enrichment rows of items that already carry a provider id in their own columns."""
    df = items.filter(F.col("mal_id").isNotNull()).withColumn("_f", jsoncol.text_fields("detail", _EMBEDDED_KEYS))
    f = F.col("_f")

    def names(*keys: str) -> Column:
        """Sorted distinct values of the first key that holds a JSON list."""
        found = [F.when(f[k].startswith("["), F.from_json(f[k], "array<string>")) for k in keys]
        return distinct_trimmed_sorted(F.coalesce(*found, F.array().cast("array<string>")))

    blank_free = lambda *c: F.nullif(first_present(*c), F.lit(""))
    title = first_present(f["source_title"], F.col("title"))
    payload = F.to_json(F.struct(
        title.alias("title"), blank_free(F.coalesce(f["synopsis_enriched"], f["synopsis"])).alias("synopsis"), F.col("release_year").alias("year"),
        blank_free(f["season"]).alias("season"), blank_free(F.coalesce(f["status"], F.col("status"))).alias("status"),
        F.when(F.col("score") > 0, F.col("score")).alias("score"), names("genre_names", "genres").alias("genres"),
        names("studio_names").alias("studios"), blank_free(F.coalesce(f["mal_thumbnail_url"], F.col("cover_url"))).alias("poster_url"),
        blank_free(f["mal_url"]).alias("mal_url"), F.lit(provider).alias("source"),
    ))
    return df.select(
        "item_key", F.lit(provider).alias("provider"), F.col("mal_id").cast("string").alias("external_id"), F.lit("matched").alias("match_status"),
        F.lit(score).cast("smallint").alias("match_score"), title.alias("matched_title"), F.col("release_year").cast("smallint").alias("matched_year"),
        payload.alias("payload"), "created_at", "updated_at",
    )


def lock_flag(lock_rules: list = rules.LOCK_RULES) -> Column:
    """True when source, media type and origin match a lock rule."""
    low = lambda c: F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))
    locked = F.lit(False)
    for source, kind, origin in lock_rules:
        hit = low("source") == source
        hit = hit if kind == "*" else hit & (low("media_type") == kind)
        hit = hit if origin == "*" else hit & (low("origin_type") == origin)
        locked = locked | hit
    return locked


def promote(items: DataFrame, matches: DataFrame, lock_rules: list = rules.LOCK_RULES) -> DataFrame:
    """Items improved by matched fallback-provider payloads.

    matches: item_key, match_score, payload. Type columns only move on unlocked
    items; year, score and cover only fill; the adult flag never turns off.
    """
    p = F.col("_p")
    text = lambda k: jsoncol.get_text(p, k)
    number = lambda k: F.try_variant_get(p, "$." + k, "double")
    flag = F.coalesce(F.try_variant_get(p, "$.is_adult", "boolean"), F.lit(False))
    joined = items.join(
        matches.select("item_key", F.col("match_score").alias("_ms"), F.try_parse_json("payload").alias("_p"), F.lit(True).alias("_hit")),
        "item_key", "left",
    )
    hit = F.coalesce("_hit", F.lit(False))
    locked = lock_flag(lock_rules)
    told = country_code(text("country_of_origin"))
    country = first_present(told, F.col("release_country"))
    kind = F.upper(F.coalesce(text("type"), F.lit("")))
    comic = (kind == "MANGA") | (F.col("surface_type") == "comic")
    anime = ~comic & (kind == "ANIME")
    fmt_surface = F.when(F.upper(F.coalesce(text("format"), F.lit(""))) == "MOVIE", "movie").otherwise("series")
    open_ = hit & ~locked
    unknown = F.coalesce(F.nullif(F.trim("surface_type"), F.lit("")), F.lit("unknown")) == "unknown"

    patch = {t: text(k) for k, t in rules.PROMOTION_DETAIL_KEYS.items()}
    synonyms = jsoncol.get_list(p, "synonyms")
    patch["anilist_synonyms"] = F.when(F.size(synonyms) > 0, synonyms)
    patch["anilist_is_adult"] = F.when(flag, F.lit(True))
    year = F.try_variant_get(p, "$.season_year", "int")
    points = (F.floor(number("average_score")) / 10).cast("float")
    changed = {
        "surface_type": F.when(open_ & comic, "comic").when(open_ & anime & unknown, fmt_surface),
        "presentation_type": F.when(open_ & comic, "illustrated").when(open_ & anime, "animation"),
        "origin_type": F.when(open_ & comic, F.when(country == "KR", "manhwa").when(country == "CN", "manhua").otherwise("manga"))
        .when(open_ & anime, F.when(country == "CN", "donghua").otherwise("anime")),
        "release_country": F.when(open_ & (comic | anime), F.nullif(country, F.lit("")))
        .when(hit & locked & is_blank("release_country"), F.nullif(told, F.lit(""))),
        "is_nsfw": F.when(hit, F.coalesce("is_nsfw", F.lit(False)) | flag),
        "genre_names": F.when(hit, compact_ci("genre_names", jsoncol.get_list(p, "genres"))),
        "taxonomy_confidence": F.when(
            hit, F.greatest("taxonomy_confidence", F.least(F.col("_ms"), F.lit(rules.PROMOTION_CONFIDENCE_CAP)).cast("smallint"))),
        "taxonomy_source": F.when(open_, F.lit(rules.PROMOTION_SOURCE))
        .when(hit & locked, first_present("taxonomy_source", F.lit(rules.RULE_TAXONOMY_SOURCE))),
        "release_year": F.when(hit & F.col("release_year").isNull() & (year > 0), year.cast("smallint")),
        "score": F.when(hit & (F.coalesce("score", F.lit(0.0)) <= 0) & (points > 0), points),
        "cover_url": F.when(hit & is_blank("cover_url"), text("cover_image")),
        "detail": F.when(hit, jsoncol.set_keys("detail", patch)),
    }
    types = dict(items.dtypes)
    return joined.withColumns({c: F.coalesce(e, F.col(c)).cast(types[c]) for c, e in changed.items()}).select(*items.columns)


def run_report(plan: DataFrame, action: str = "action", reason: str = "reason") -> DataFrame:
    """Rows per (action, reason)."""
    return plan.groupBy(action, reason).agg(F.count("*").alias("n"))


def run_counters(plan: DataFrame, outcome: str = "outcome") -> DataFrame:
    """One row: discovered, attempted, skipped, succeeded, failed."""
    hit = lambda a: F.count_if(F.col(outcome) == a)
    return plan.agg(
        F.count("*").alias("discovered"), (hit("success") + hit("fail")).alias("attempted"), hit("skip").alias("skipped"),
        hit("success").alias("succeeded"), hit("fail").alias("failed"),
    )


def run_failures(plan: DataFrame, outcome: str = "outcome", slug: str = "slug", error: str = "error", order: list[Column] | None = None) -> DataFrame:
    """(slug, error) of every failed slug; of repeated failures the last in `order`."""
    failed = plan.filter(F.col(outcome) == "fail").groupBy(F.col(slug).alias("slug"))
    last = F.max_by(error, F.struct(*order)) if order else F.max(error)
    return failed.agg(last.alias("error"))
