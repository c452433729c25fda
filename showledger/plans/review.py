"""Review of a catalog against an external one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.text import first_present
from ..functions.titles import title_jaccard
from ..operators.matching import match_titles
from ..operators.ranking import cap_children, numeric_sort_keys, top_per_group


def _verdict(df: DataFrame, threshold: float) -> DataFrame:
    ok = F.coalesce(F.col("match_score") >= threshold, F.lit(False))
    unsure = ok & (F.col("match_score") < rules.REVIEW_BELOW)
    return df.withColumns({
        "match_status": F.when(ok, "matched").otherwise("no_match"),
        "match_score": F.coalesce("match_score", F.lit(0.0)),
        "needs_review": unsure,
        "notes": F.when(unsure, "low confidence title match").when(ok, "").otherwise("no search results"),
    })


def review_titles(own: DataFrame, ext: DataFrame, *, ext_id: str, ext_title: str, ext_order: list[str], profile: str = "1",
                  min_score: float | None = None) -> DataFrame:
    """Own rows (title, optional source_title) with their best external title and a verdict."""
    threshold = rules.MIN_MATCH[profile] if min_score is None else min_score
    query = first_present("source_title", "title") if "source_title" in own.columns else first_present("title")
    matched = match_titles(
        own.withColumn("query", query), ext, left_title="query", right_id=ext_id, right_title=ext_title,
        right_order=ext_order, min_score=threshold, profile=profile,
    )
    return _verdict(matched, threshold)


def review_hits(own: DataFrame, hits: DataFrame, key: str, profile: str = "1", min_score: float | None = None) -> DataFrame:
    """The same verdict over landed search hits (key, hit_pos, hit_title, hit_url).

    The best positive score is reported even below the threshold.
    """
    threshold = rules.MIN_MATCH[profile] if min_score is None else min_score
    query = first_present("source_title", "title") if "source_title" in own.columns else first_present("title")
    base = own.withColumn("query", query)
    scored = hits.join(base.select(key, "query"), key).withColumn("match_score", title_jaccard("query", "hit_title", profile))
    best = top_per_group(scored.filter(F.col("match_score") > 0), [key], [F.col("match_score").desc(), F.col("hit_pos")])
    out = base.join(best.select(key, "hit_title", "hit_url", "match_score"), key, "left")
    judged = _verdict(out, threshold)
    ok = F.col("match_status") == "matched"
    return judged.withColumns({"hit_title": F.when(ok, F.col("hit_title")), "hit_url": F.when(ok, F.col("hit_url"))})


def review_rows(verdicts: DataFrame, children: DataFrame, parent: str) -> DataFrame:
    """Flat report: one row per child, a verdict-only row for a parent without any."""
    return verdicts.join(children, parent, "left")


def review_children(verdicts: DataFrame, children: DataFrame, parent: str, number: str, fields: list[str], cap: int = 0) -> DataFrame:
    """Verdicts with an ordered `children` array (numbers by value, then other text).

    `cap` is the report's own limit of children per parent, 0 for none: then an array
    holds all children of its parent. `review_rows` gives the same rows flat.
    """
    kept = cap_children(children, [parent], [F.col("pos")], cap)
    keys = [k.alias(f"k{i}") for i, k in enumerate(numeric_sort_keys(number))]
    listed = F.sort_array(F.collect_list(F.struct(*keys, F.col("pos"), F.struct(*fields).alias("child"))))
    lists = kept.groupBy(parent).agg(F.transform(listed, lambda x: x["child"]).alias("children"))
    return verdicts.join(lists, parent, "left")
