"""Classification of items and their release schedule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import dates, jsoncol, schedule
from ..functions.arrays import compact_ci
from ..functions.codes import first_country, lookup
from ..functions.text import contains_any, first_present


def _low(c) -> Column:
    return F.lower(F.trim(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))))


def _by_rule(source: Column, kind: Column, fmt: Column, table: list, pick) -> Column:
    """CASE over the source rules; `pick(rule)` gives the value of a matching rule."""
    out = None
    for rule in table:
        hit = source == rule[0]
        if rule[1] != "*":
            hit = hit & (kind == rule[1])
        if rule[2] != "*":
            hit = hit & fmt.startswith(rule[2])
        value = pick(rule)
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out if out is not None else F.lit(None)


# everything classify() reads from detail
_DETAIL_KEYS = (
    ["content_format", "cadence", "runtime", "tags"] + rules.LABEL_KEYS + rules.COUNTRY_KEYS + rules.DAY_KEYS + rules.WINDOW_KEYS
    + rules.TIMEZONE_KEYS + rules.STATUS_KEYS + rules.VARIETY_TEXT_KEYS + rules.VARIETY_LIST_KEYS
)


def variety_flag(f: Column) -> Column:
    """True when a text or list value of detail names a variety programme."""
    keys = rules.VARIETY_TEXT_KEYS + rules.VARIETY_LIST_KEYS
    return contains_any(F.concat_ws("\n", *[f[k] for k in keys]), rules.VARIETY_KEYWORDS)


def cadence(status: Column, explicit: Column, surface: Column, origin: Column, source: Column, kind: Column,
            weekly_rules: list = rules.WEEKLY_RULES) -> Column:
    """Completed wins; then an explicit value; then weekly for airing series of weekly sources."""
    weekly = F.lit(False)
    for src, wanted in weekly_rules:
        weekly = weekly | ((source == src) & (F.lit(True) if wanted == "*" else kind == wanted))
    return (
        F.when(status.isin(rules.COMPLETED_STATUSES), "completed")
        .when(explicit.isin(rules.CADENCES), explicit)
        .when((surface == "series") & (origin != "variety") & status.isin(rules.AIRING_STATUSES) & weekly, "weekly")
    )


def classify(items: DataFrame, now: Column, source_rules: list = rules.SOURCE_RULES, type_rules: dict = rules.TYPE_RULES,
             weekly_rules: list = rules.WEEKLY_RULES) -> DataFrame:
    """Items with the thirteen taxonomy and schedule columns (re)derived from
    source, media_type and detail. Blank results are NULL where the column is optional."""
    # detail is parsed once; what several rules read is computed once, in own columns
    df = items.withColumns({
        "_f": jsoncol.text_fields("detail", _DETAIL_KEYS), "_source": _low("source"), "_kind": _low("media_type"),
    })
    f, source, kind = F.col("_f"), F.col("_source"), F.col("_kind")
    first = lambda keys: first_present(*[f[k] for k in keys])
    df = df.withColumns({
        "_fmt": F.lower(F.trim(F.coalesce(f["content_format"], F.lit("")))),
        "_named": first_country(*[f[k] for k in rules.COUNTRY_KEYS]),
    })
    fmt, named = F.col("_fmt"), F.col("_named")
    by = lambda pick: _by_rule(source, kind, fmt, source_rules, pick)
    typed = lambda n: lookup({k: t[n] for k, t in type_rules.items()}, kind)
    df = df.withColumn("genre_names", compact_ci(*[jsoncol.text_list(f[k]) for k in rules.LABEL_KEYS]))
    df = df.withColumn(
        "surface_type",
        F.coalesce(
            by(lambda r: F.when(kind == "anime", "series").otherwise("movie") if r[3] == "by_type" else r[3]),
            typed(0), F.lit("unknown"),
        ),
    )
    df = df.withColumn("presentation_type", F.coalesce(by(lambda r: r[4]), typed(1), F.lit("unknown")))
    df = df.withColumn(
        "origin_type",
        F.coalesce(
            by(lambda r: F.when(variety_flag(f), "variety").otherwise("drama") if r[5] == "variety_check" else r[5]),
            typed(2), F.nullif(kind, F.lit("")), F.lit("unknown"),
        ),
    )
    df = df.withColumn(
        "release_country",
        F.nullif(
            first_present(
                by(lambda r: first_present(named, F.lit(r[6][7:])) if r[6].startswith("detail:") else r[6]),
                named, lookup(rules.COUNTRY_BY_ORIGIN, F.col("origin_type")),
            ),
            F.lit(""),
        ),
    )
    df = df.withColumn("taxonomy_confidence", F.coalesce(by(lambda r: r[7]), F.lit(rules.FALLBACK_CONFIDENCE)).cast("smallint"))
    df = df.withColumn(
        "taxonomy_source", F.coalesce(by(lambda r: rules.RULE_TAXONOMY_SOURCE), F.lit(rules.FALLBACK_TAXONOMY_SOURCE))
    )
    adult_sources = sorted({r[0] for r in source_rules if r[8] == "true"})
    told = F.exists("genre_names", lambda g: F.lower(F.trim(g)).isin(rules.ADULT_LABELS))
    df = df.withColumn("is_nsfw", source.isin(adult_sources) | told)

    df = df.withColumns({
        "release_day": F.nullif(schedule.weekday_name(first(rules.DAY_KEYS)), F.lit("")),
        "release_window": F.nullif(first_present(first(rules.WINDOW_KEYS), schedule.time_window(f["runtime"])), F.lit("")),
        "release_timezone": F.nullif(
            first_present(first(rules.TIMEZONE_KEYS), lookup(rules.TIMEZONE_BY_COUNTRY, F.col("release_country"))), F.lit("")
        ),
        "cadence": cadence(
            F.lower(first(rules.STATUS_KEYS)), F.lower(F.trim(F.coalesce(f["cadence"], F.lit("")))),
            F.col("surface_type"), F.col("origin_type"), source, kind, weekly_rules,
        ),
    })
    return with_next_release(df.drop("_f", "_source", "_kind", "_fmt", "_named"), now)


def with_next_release(df: DataFrame, now: Column) -> DataFrame:
    """next_release_at of weekly series; NULL for everything else."""
    slot = schedule.next_weekly_release("release_day", "release_window", "release_timezone", now)
    weekly = (F.col("surface_type") == "series") & (F.col("cadence") == "weekly")
    return df.withColumn("next_release_at", F.when(weekly, slot))


def refine_video(items: DataFrame, source: str = "drakorid") -> DataFrame:
    """Movies and variety programmes of one source, decided on title and detail text."""
    f = jsoncol.text_fields("detail", rules.VARIETY_TEXT_KEYS + ["country"])
    words = F.concat_ws(" ", "title", *[f[k] for k in rules.VARIETY_TEXT_KEYS])
    mine = F.lower(F.trim("source")) == source
    movie = mine & (F.col("media_type") == "movie")
    variety = mine & ~movie & contains_any(words, rules.VARIETY_KEYWORDS)
    told = F.upper(F.trim(F.coalesce(f["country"], F.lit(""))))
    country = F.coalesce(
        F.nullif("release_country", F.lit("")),
        F.when(told.isin("CHINA", "CN"), "CN").when(told.isin("JAPAN", "JP"), "JP").otherwise("KR"),
    )
    either = movie | variety
    pick = lambda c, m, s: F.when(movie, m).when(variety, s).otherwise(F.col(c))
    return items.withColumns({
        "surface_type": pick("surface_type", "movie", "series"),
        "presentation_type": pick("presentation_type", "live_action", "live_action"),
        "origin_type": pick("origin_type", "movie", "variety"),
        "release_country": F.when(either, country).otherwise(F.col("release_country")),
        "taxonomy_confidence": F.when(movie, F.greatest("taxonomy_confidence", F.lit(94)))
        .when(variety, F.greatest("taxonomy_confidence", F.lit(96))).otherwise(F.col("taxonomy_confidence")).cast("smallint"),
        "taxonomy_source": F.when(either, rules.RULE_TAXONOMY_SOURCE).otherwise(F.col("taxonomy_source")),
    })


def _modal(units: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    """Most frequent value per key, ties to the smallest; aggregated before ranking."""
    counts = units.select(key, value.alias(name)).filter(F.col(name).isNotNull()).groupBy(key, name).agg(F.count("*").alias("n"))
    best = counts.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("neg"), name)).alias("_b"))
    return best.select(key, F.col("_b." + name).alias(name), (-F.col("_b.neg")).alias("n"))


def modal_weekday(units: DataFrame, key: str = "item_key", at: str = "published_at") -> DataFrame:
    """(key, release_day, n): most frequent publishing weekday (UTC), ties alphabetical."""
    return _modal(units, key, F.lower(F.date_format(at, "EEEE")), "release_day")


def modal_time(units: DataFrame, tz: str, key: str = "item_key", at: str = "published_at") -> DataFrame:
    """(key, release_window, n): most frequent local HH:MM, ties to the earliest."""
    return _modal(units, key, F.date_format(F.from_utc_timestamp(at, tz), "HH:mm"), "release_window")


def infer_release_day(items: DataFrame, units: DataFrame) -> DataFrame:
    """Fill blank release days from the units' modal weekday."""
    found = modal_weekday(units).select("item_key", F.col("release_day").alias("_d"))
    return items.join(found, "item_key", "left").withColumn(
        "release_day", F.coalesce(F.nullif("release_day", F.lit("")), "_d")).select(*items.columns)


def infer_release_window(items: DataFrame, units: DataFrame, tz: str) -> DataFrame:
    """Overwrite release windows with the units' modal local time where there is one."""
    found = modal_time(units, tz).select("item_key", F.col("release_window").alias("_w"))
    return items.join(found, "item_key", "left").withColumn("release_window", F.coalesce("_w", "release_window")).select(*items.columns)


def infer_schedule(items: DataFrame, units: DataFrame, now: Column, tz: str | None = None) -> DataFrame:
    """Schedule of classified items as one precedence: stated in detail, found in its
    free text, modal over units, stored. updated_at moves only on a real change."""
    f = F.col("_f")
    first = lambda keys: first_present(*[f[k] for k in keys])
    stated_day = F.nullif(schedule.weekday_name(first(rules.DAY_KEYS)), F.lit(""))
    stated_window = F.nullif(first_present(first(rules.WINDOW_KEYS), schedule.time_window(f["runtime"])), F.lit(""))
    parsed = items.withColumn("_f", jsoncol.text_fields("detail", rules.DAY_KEYS + rules.WINDOW_KEYS)).withColumns(
        {"_stated_day": stated_day, "_stated_window": stated_window})
    out = parsed.join(modal_weekday(units).select("item_key", F.col("release_day").alias("_d")), "item_key", "left")
    window = F.lit(None).cast("string")
    if tz:
        out = out.join(modal_time(units, tz).select("item_key", F.col("release_window").alias("_w")), "item_key", "left")
        window = F.col("_w")
    old = {c: F.col(c) for c in ("release_day", "release_window", "release_timezone", "next_release_at")}
    out = out.withColumn("_old", F.struct(*[c.alias(n) for n, c in old.items()])).withColumns({
        "release_day": F.coalesce("_stated_day", "_d", F.nullif("release_day", F.lit(""))),
        "release_window": F.coalesce("_stated_window", window, F.nullif("release_window", F.lit(""))),
        "release_timezone": F.coalesce(F.nullif("release_timezone", F.lit("")), lookup(rules.TIMEZONE_BY_COUNTRY, F.col("release_country"))),
    })
    out = with_next_release(out, now)
    same = F.col("_old").eqNullSafe(F.struct(*[F.col(n).alias(n) for n in old]))
    return out.withColumn("updated_at", F.when(same, F.col("updated_at")).otherwise(now)).select(*items.columns)


def fill_published_at(units: DataFrame) -> DataFrame:
    """Publishing dates: an exact stamp in the page meta, stored, label, then a date in detail."""
    v = jsoncol.variant("detail")
    exact = dates.embedded_timestamp(jsoncol.get_text(v, "source_meta_json.published_at"))
    return units.withColumn(
        "published_at",
        F.coalesce(exact, F.col("published_at"), dates.parse_localized_date("label"), dates.embedded_date("detail")),
    )
