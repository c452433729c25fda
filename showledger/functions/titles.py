"""Titles: clean-up, token similarity, scores and decomposition."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from .arrays import compact_ci
from .text import col, let, normalize_space, unescape_html
from .urls import slug_from_url


def normalize_title(c, pipe_is_space: bool = True) -> Column:
    """Lower-cased title with punctuation as spaces, quotes removed, spaces collapsed."""
    marks = r"[_\-:!?,.()" + ("|" if pipe_is_space else "") + "]"
    text = F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), "['’]", "")
    return normalize_space(F.regexp_replace(text, marks, " "))


def clean_title(c, profile: str = "1") -> Column:
    """Site suffix and filler phrases removed."""
    rule = rules.CLEAN_TITLE[profile]
    text = F.regexp_replace(normalize_space(c), re.escape(rule["suffix"]) + "$", "")
    for phrase in rule["drop"]:
        text = F.replace(text, F.lit(phrase), F.lit(""))
    if rule["cut_at"]:
        at = F.instr(F.lower(text), rule["cut_at"])
        text = F.when(at > 0, F.left(text, at - 1)).otherwise(text)
    return normalize_space(text)


def title_tokens(c, profile: str = "1") -> Column:
    """Distinct ASCII letter/digit tokens of the cleaned title, stop words removed."""
    text = F.regexp_replace(F.lower(clean_title(c, profile)), "[^a-z0-9]+", " ")
    stop = [""] + rules.STOP_TOKENS[profile]
    return F.array_except(F.split(F.trim(text), " "), F.array(*[F.lit(w) for w in stop]))


def jaccard_from_sizes(shared: Column, left: Column, right: Column) -> Column:
    """Jaccard minus 0.03 per token of size difference, clamped to 0..1."""
    base = shared.cast("double") / (left + right - shared).cast("double")
    value = base - F.abs(left - right).cast("double") * F.lit(0.03)
    return F.when((left == 0) | (right == 0), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def title_jaccard(a, b, profile: str = "1") -> Column:
    left, right = title_tokens(a, profile), title_tokens(b, profile)
    return jaccard_from_sizes(F.size(F.array_intersect(left, right)), F.size(left), F.size(right))


def query_parts(query, profile: str = "A") -> Column:
    """What scoring needs of a query: the normalised text, its tokens, and the
    further occurrences of tokens it repeats."""
    def cut(text: Column) -> Column:
        words = F.filter(F.split(text, " "), lambda t: t != "")
        return F.struct(text.alias("text"), words.alias("words"))

    def add_repeats(s: Column) -> Column:
        again = F.filter(s["words"], lambda w, i: F.array_position(s["words"], w) <= i)
        return F.struct(s["text"].alias("text"), s["words"].alias("words"), again.alias("repeats"))

    # one-element lists bind an intermediate value, so it is computed once
    text = normalize_title(query, rules.SCORE_PROFILES[profile]["pipe_is_space"])
    return F.get(F.transform(F.transform(F.array(text), cut), add_repeats), 0)


def title_parts(titles, profile: str = "A") -> Column:
    """Non-blank normalised titles of a hit, each with its tokens."""
    norm = lambda c: normalize_title(c, rules.SCORE_PROFILES[profile]["pipe_is_space"])
    values = F.filter(F.transform(col(titles), norm), lambda v: v != "")
    return F.transform(values, lambda v: F.struct(v.alias("text"), F.split(v, " ").alias("words")))


def shared_tokens(query: Column, title: Column) -> Column:
    """Number of query tokens, repeats counted, that occur in the title."""
    repeats = F.when(F.size(query["repeats"]) == 0, 0).otherwise(
        F.size(F.filter(query["repeats"], lambda w: F.array_contains(title["words"], w)))
    )
    return F.size(F.array_intersect(query["words"], title["words"])) + repeats


def candidate_score(query: Column, title: Column, profile: dict) -> Column:
    """Score of one normalised candidate title against the normalised query."""
    target, value, shared = query["text"], title["text"], shared_tokens(query, title)
    by_tokens = F.get(
        F.transform(F.array(shared), lambda n: F.when(n >= profile["min_shared"], n + profile["shared_base"]).otherwise(0)), 0
    )
    score = (
        F.when(value == target, profile["exact"])
        .when(value.contains(target) | target.contains(value), profile["contains"])
        .otherwise(by_tokens)
    )
    if profile["season"]:
        same = F.lit(False)
        for phrase in rules.SEASON_PHRASES:
            same = same | (target.contains(phrase) & value.contains(phrase))
        score = score + F.when(same, profile["season"]).otherwise(0)
    return score


def prepared_score(query: Column, titles: Column, query_year, hit_year, profile: str = "A", require_title: bool = True) -> Column:
    """`hit_score` over columns made by `query_parts` and `title_parts`."""
    rule = rules.SCORE_PROFILES[profile]
    best = F.array_max(F.transform(titles, lambda t: candidate_score(query, t, rule)))
    qy, hy = F.coalesce(col(query_year), F.lit(0)), F.coalesce(col(hit_year), F.lit(0))
    bonus = (
        F.when((qy > 0) & (hy == qy), rule["year_same"])
        .when((qy > 0) & (hy > 0) & (F.abs(qy - hy) == 1), rule["year_near"])
        .otherwise(0)
    )
    total = lambda s: F.when((s > 0) if require_title else s.isNotNull(), s + bonus).otherwise(F.lit(0))
    return F.when(query["text"] == "", F.lit(0)).otherwise(F.get(F.transform(F.array(best), total), 0))


def hit_score(query, titles, query_year, hit_year, profile: str = "A", require_title: bool = True) -> Column:
    """Best score over a hit's titles plus the year bonus.

    With `require_title` the year bonus needs a title score above 0; without it a
    matching year alone scores, as the catalogs being migrated do.
    """
    return prepared_score(query_parts(query, profile), title_parts(titles, profile), query_year, hit_year, profile, require_title)


def decompose_labeled(c, fmt=None) -> Column:
    """`[LABEL] Title Episode N` -> struct of labels, kind, numbers, series flag."""
    animated = F.lit(True) if fmt is None else F.lower(F.trim(col(fmt))).startswith("animation")
    return let(F.trim(unescape_html(F.coalesce(col(c), F.lit("")))), lambda text: _decomposed(text, animated))


def _decomposed(text: Column, animated: Column) -> Column:
    block = F.regexp_extract(text, r"^((?:\s*\[[^\]]+\])*)", 1)
    labels = compact_ci(
        F.transform(F.regexp_extract_all(block, F.lit(r"\[([^\]]+)\]"), F.lit(1)), lambda x: F.upper(F.trim(x)))
    )
    title = normalize_space(F.substring(text, F.length(block) + 1, F.length(text)))
    return let(F.struct(title.alias("title"), labels.alias("labels")), lambda x: _kinds(x["title"], x["labels"], animated))


def _kinds(title: Column, labels: Column, animated: Column) -> Column:
    number = lambda word: F.coalesce(
        F.nullif(F.regexp_extract(title, r"(?i)\b" + word + r"\s+(\d{1,4})\b", 1), F.lit("")).try_cast("int"), F.lit(0)
    )
    episode, part, low = number("episode"), number("part"), F.lower(title)
    kind = (
        F.when(F.array_contains(labels, "PV") | low.contains("preview"), "preview")
        .when(low.contains("compilation"), "compilation")
        .when(episode > 0, "episode")
        .when(part > 0, "part")
        .otherwise("standalone")
    )
    return F.struct(
        title.alias("normalized_title"), labels.alias("labels"), kind.alias("entry_kind"),
        episode.alias("episode_number"), part.alias("part_number"),
        ((kind == "episode") & (episode > 0) & animated).alias("series_candidate"),
    )


def decompose_numbered(c) -> Column:
    """`<base> Episode N` is an episode; `<base> N` is only `numbered`; else standalone."""
    title = normalize_space(c)

    def split_at(pattern: str) -> tuple[Column, Column]:
        base = F.trim(F.regexp_replace(F.regexp_extract(title, pattern, 1), r"^[-: ]+|[-: ]+$", ""))
        value = F.nullif(F.regexp_extract(title, pattern, 2), F.lit("")).try_cast("int")
        return base, F.coalesce(value, F.lit(0))

    explicit, trailing = r"(?i)^(.*?)\s+episode\s+(\d{1,3})$", r"^(.*?)\s+(\d{1,3})$"
    base_e, n_e = split_at(explicit)
    base_t, n_t = split_at(trailing)
    is_explicit = title.rlike(explicit)
    ok_e = is_explicit & (base_e != "") & (n_e > 0)
    ok_t = ~is_explicit & (base_t != "") & (n_t > 0)
    return F.struct(
        F.when(ok_e, base_e).when(ok_t, base_t).otherwise(title).alias("base_title"),
        F.when(ok_e, "episode").when(ok_t, "numbered").otherwise("standalone").alias("entry_kind"),
        F.when(ok_e, n_e).when(ok_t, n_t).otherwise(0).alias("episode_number"),
        ok_e.alias("series_candidate"),
    )


def parent_title(episode_title, parent_url) -> Column:
    """Text before ` Episode ` / ` [END]`, else the URL slug in title case, else the title."""
    title = normalize_space(episode_title)
    words = F.filter(F.split(F.replace(slug_from_url(parent_url), F.lit("-"), F.lit(" ")), " "), lambda w: w != "")
    from_url = F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, 2, F.length(w)))), " "
    )

    def before(mark: str) -> Column:
        at = F.instr(title, mark)
        return F.when(at > 1, F.trim(F.left(title, at - 1)))

    return F.coalesce(before(" Episode "), before(" [END]"), F.nullif(from_url, F.lit("")), title)


def trim_episode_suffix(c) -> Column:
    return normalize_space(F.regexp_replace(F.trim(col(c)), rules.EPISODE_SUFFIX_PATTERN, ""))


def child_slug(item_slug, number) -> Column:
    """`<item>-episode-<n>`, dots as dashes."""
    return F.concat(F.trim(col(item_slug)), F.lit("-episode-"), F.replace(F.trim(col(number)), F.lit("."), F.lit("-")))


def child_title(item_title, number) -> Column:
    n = normalize_space(number)
    return F.when(n == "", F.trim(col(item_title))).otherwise(normalize_space(F.concat(col(item_title), F.lit(" Episode "), n)))


def clean_query(part: Column, drama: Column) -> Column:
    """One query variant: year suffix off; drama prefix off where `drama`."""
    text = F.regexp_replace(F.trim(part), rules.YEAR_SUFFIX_PATTERN, "")
    text = F.when(drama, F.regexp_replace(text, rules.DRAMA_PREFIX_PATTERN, "")).otherwise(text)
    return normalize_space(text)
