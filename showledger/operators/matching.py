"""Fuzzy title join, scored candidate join and best pick."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.text import first_present
from ..functions.titles import jaccard_from_sizes, prepared_score, query_parts, title_parts, title_tokens
from ..session import cut_lineage
from .ranking import cap_children, top_per_group

#: Sets from which a token counts as frequent, and the rows of either side that one cell of a frequent token holds.
HOT_SETS, CELL = 100_000, 20_000


def _signature(tokens: Column) -> Column:
    return F.array_join(F.sort_array(tokens), " ")


def match_titles(
    left: DataFrame, right: DataFrame, *, left_title: str, right_id: str, right_title: str,
    right_order: list[str] | None = None, min_score: float | None = None, profile: str = "1",
) -> DataFrame:
    """Best right title of every left row with a score of at least `min_score`.

    Adds right_id, right_title and match_score (NULL without a match). Equal
    scores keep the candidate that comes first in `right_order`.

    Exact and never a cross join. Titles with equal token sets are handled once,
    and a left set found among the right sets is done (no other score reaches 1).
    The remaining pairs are formed by prefix filtering: with tokens ordered from
    rare to frequent, a pair reaching Jaccard t shares a token among the first
    n - ceil(t n) + 1 of its larger set and the first n - ceil(2t/(1+t) n) + 1 of
    its smaller set. Sizes too far apart never meet either.
    """
    threshold = rules.MIN_MATCH[profile] if min_score is None else min_score
    if threshold <= 0:
        raise ValueError("min_score must be above 0")
    sets = title_sets(right, right_id, right_title, right_order, profile)
    return match_to_sets(left, cut_lineage(sets), left_title=left_title, right_id=right_id, right_title=right_title, threshold=threshold, profile=profile)


def title_sets(right: DataFrame, right_id: str, right_title: str, right_order: list[str] | None = None, profile: str = "1") -> DataFrame:
    """One row for each different token set of a catalog: _sig, and _first, its first title in `right_order`.

    Stored by the caller, it lets later titles be matched (`match_to_sets`) without reading the catalog's titles again.
    """
    order = right_order or [right_id]
    theirs = right.select(
        F.struct(*[F.col(c) for c in order]).alias("_ord"), F.col(right_id).alias("_rid"),
        F.col(right_title).alias("_rtitle"), title_tokens(right_title, profile).alias("_toks"),
    ).withColumn("_sig", _signature(F.col("_toks")))
    return theirs.filter(F.col("_sig") != "").groupBy("_sig").agg(F.min(F.struct("_ord", "_rid", "_rtitle")).alias("_first"))


def add_title_sets(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored sets with those of new catalog rows: one row a set, its first title."""
    return stored.select("_sig", "_first").unionByName(new.select("_sig", "_first")).groupBy("_sig").agg(F.min("_first").alias("_first"))


def match_to_sets(left: DataFrame, rsets: DataFrame, *, left_title: str, right_id: str, right_title: str, threshold: float, profile: str = "1") -> DataFrame:
    """match_titles against stored sets; only the titles of `left` are normalised."""
    mine = left.withColumn("_toks", title_tokens(left_title, profile)).withColumn("_sig", _signature(F.col("_toks")))
    # the distinct token sets are stored once; titles are read and normalised no second time for the pairs
    lsets = cut_lineage(mine.filter(F.col("_sig") != "").select("_sig").distinct())
    equal = lsets.join(rsets, "_sig").select("_sig", F.lit(1.0).alias("_score"), "_first")
    best = equal
    if threshold < 1:
        open_sets = lsets.join(rsets.select("_sig"), "_sig", "left_anti")
        scored = _similar_sets(open_sets, rsets.select("_sig"), threshold)
        named = scored.join(rsets.withColumnRenamed("_sig", "r_sig"), "r_sig").select(F.col("l_sig").alias("_sig"), "_score", "_first")
        near = top_per_group(named, ["_sig"], [F.col("_score").desc(), F.col("_first._ord").asc()])
        best = equal.unionByName(near)
    out = mine.join(best, "_sig", "left")
    return out.select(
        *[mine[c] for c in left.columns], F.col("_first._rid").alias(right_id), F.col("_first._rtitle").alias(right_title),
        F.col("_score").alias("match_score"),
    )


def _similar_sets(lsets: DataFrame, rsets: DataFrame, threshold: float) -> DataFrame:
    """(l_sig, r_sig, _score) of every pair of token sets scoring at least `threshold`."""
    # sets get numbers, fixed by the checkpoint; pairs carry numbers, sizes and the short prefixes only
    numbered = lambda d: cut_lineage(d.select("_sig", F.monotonically_increasing_id().alias("_set")))
    lsets, rsets = numbered(lsets), numbered(rsets)
    exploded = lambda d: d.select("_set", F.explode(F.split("_sig", " ")).alias("_tok"))
    weights = cut_lineage(exploded(lsets).select("_tok").unionByName(exploded(rsets).select("_tok")).groupBy("_tok").agg(
        F.count("*").alias("_df")
    ))
    # frequent tokens are few (a set has each once, so at most all tokens / HOT_SETS): their counts go to the rows
    frequent = F.broadcast(weights.filter(F.col("_df") > HOT_SETS))

    def weighed(sets: DataFrame) -> DataFrame:
        first = exploded(sets).join(frequent, "_tok", "left")
        rest = first.filter(F.col("_df").isNull()).drop("_df").join(weights, "_tok")
        return first.filter(F.col("_df").isNotNull()).unionByName(rest.select("_tok", "_set", "_df"))

    def prefixes(sets: DataFrame, tag: str, larger_when: bool) -> DataFrame:
        """One row per prefix token, for the set as the pair's larger and as its smaller one."""
        ranked = weighed(sets).groupBy("_set").agg(
            F.sort_array(F.collect_list(F.struct("_df", "_tok"))).alias("_ranked")
        )
        toks = F.transform("_ranked", lambda x: x["_tok"])
        n = F.size("_ranked")
        first = lambda share: F.slice(toks, 1, n - F.ceil(n * F.lit(share) - F.lit(1e-9)).cast("int") + 1)
        roles = F.array(
            F.struct(F.lit(larger_when).alias("left_larger"), first(threshold).alias("prefix")),
            F.struct(F.lit(not larger_when).alias("left_larger"), first(2 * threshold / (1 + threshold)).alias("prefix")),
        )
        return (
            ranked.select(F.col("_set").alias(tag + "set"), n.alias(tag + "n"), F.explode(roles).alias("_role"))
            .select(tag + "set", tag + "n", F.col("_role.left_larger").alias("left_larger"), F.col("_role.prefix").alias(tag + "prefix"))
            .select("*", F.posexplode(tag + "prefix").alias(tag + "at", "_tok"))
        )

    lp, rp = prefixes(lsets, "l_", True), prefixes(rsets, "r_", False)
    right_role = F.col("left_larger") == (F.col("l_n") >= F.col("r_n"))
    reachable = jaccard_from_sizes(F.least("l_n", "r_n"), F.col("l_n"), F.col("r_n")) >= threshold - 1e-9
    # a frequent token is a grid of cells: as many parts of either side as its counted rows ask for, every left part
    # meeting every right part once; so no task gets more than CELL rows of a side for it
    sides = lp.groupBy("_tok", "left_larger").agg(F.count("*").alias("_ln")).join(
        rp.groupBy("_tok", "left_larger").agg(F.count("*").alias("_rn")), ["_tok", "left_larger"])
    parts = lambda n: F.ceil(F.col(n) / CELL).cast("int")
    grid = F.broadcast(sides.filter(F.greatest("_ln", "_rn") > CELL).select("_tok", "left_larger", parts("_ln").alias("_lparts"), parts("_rn").alias("_rparts")))
    one = F.lit(1)
    lp = lp.join(grid, ["_tok", "left_larger"], "left").withColumn("_l", F.pmod(F.xxhash64("l_set"), F.coalesce("_lparts", one)).cast("int"))
    lp = lp.withColumn("_r", F.explode(F.sequence(F.lit(0), F.coalesce("_rparts", one) - 1))).drop("_lparts", "_rparts")
    rp = rp.join(grid, ["_tok", "left_larger"], "left").withColumn("_r", F.pmod(F.xxhash64("r_set"), F.coalesce("_rparts", one)).cast("int"))
    rp = rp.withColumn("_l", F.explode(F.sequence(F.lit(0), F.coalesce("_lparts", one) - 1))).drop("_lparts", "_rparts")
    # what lies behind the first shared token, at most, is shared too
    ahead = F.least(F.col("l_n") - F.col("l_at"), F.col("r_n") - F.col("r_at"))
    near = jaccard_from_sizes(ahead, F.col("l_n"), F.col("r_n")) >= threshold - 1e-9
    pairs = lp.join(rp, ["_tok", "left_larger", "_l", "_r"]).filter(right_role & reachable & near)
    # a pair meets once per shared prefix token: score it at the first one only
    pairs = pairs.filter(F.get(F.array_intersect("l_prefix", "r_prefix"), 0) == F.col("_tok"))
    named = lambda d, tag: d.select(F.col("_set").alias(tag + "set"), F.col("_sig").alias(tag + "sig"))
    pairs = pairs.select("l_set", "r_set", "l_n", "r_n").join(named(lsets, "l_"), "l_set").join(named(rsets, "r_"), "r_set")
    shared = F.size(F.array_intersect(F.split("l_sig", " "), F.split("r_sig", " ")))
    score = jaccard_from_sizes(shared, F.col("l_n"), F.col("r_n"))
    return pairs.select("l_sig", "r_sig", score.alias("_score")).filter(F.col("_score") >= threshold)


def score_hits(queries: DataFrame, hits: DataFrame, profile: str = "A", require_title: bool = True) -> DataFrame:
    """Every landed hit scored against its query (equi-join on query id and place).

    queries: query_id, query_pos, query, year; hits: query_id, query_pos, hit_pos,
    external_id, titles, year. Blank queries score 0.
    """
    # each text is normalised once, on its own side of the join
    q = queries.select("query_id", "query_pos", "query", F.col("year").alias("query_year"), query_parts("query", profile).alias("_q"))
    h = hits.withColumn("_t", title_parts("titles", profile))
    score = prepared_score(F.col("_q"), F.col("_t"), "query_year", "year", profile, require_title)
    return h.join(q, ["query_id", "query_pos"]).withColumn("score", score).drop("query_year", "_q", "_t")


def pick_best(
    candidates: DataFrame, queries: DataFrame, scored: DataFrame, accept_score: int, fallback_title: Column
) -> DataFrame:
    """One enrichment row per candidate, misses included.

    Queries are tried in order and the first one whose best hit reaches
    `accept_score` decides; otherwise the highest score does, the earliest query
    winning ties. Status is matched, score_rejected, search_empty or missing_query.
    candidates need item_key; queries and scored use it as query_id.
    """
    # the struct order makes max() prefer score, then the earliest hit
    top = scored.groupBy("query_id", "query_pos").agg(
        F.max(F.struct("score", (-F.col("hit_pos")).alias("neg_pos"), "external_id",
                       F.get("titles", 0).alias("title"), "year")).alias("top")
    )
    tried = queries.select("query_id", "query_pos", "query").join(top, ["query_id", "query_pos"], "left")
    score = F.coalesce(F.col("top.score"), F.lit(0))
    accepted = score >= accept_score
    decisive = tried.select(
        "query_id",
        F.struct(
            F.when(accepted, 0).otherwise(1).alias("tier"),
            F.when(accepted, F.col("query_pos")).otherwise(-score).alias("place"),
            F.col("query_pos").alias("query_pos"),
            F.when(accepted, "matched").when(F.col("top").isNull(), "search_empty").otherwise("score_rejected").alias("status"),
            score.alias("score"), "query", "top.external_id", "top.title", "top.year",
        ).alias("choice"),
    ).groupBy("query_id").agg(F.min("choice").alias("choice"))
    joined = candidates.join(decisive, candidates.item_key == decisive.query_id, "left")
    won = F.col("choice.tier") == 0
    return joined.select(
        *[candidates[c] for c in candidates.columns],
        F.coalesce("choice.status", F.lit("missing_query")).alias("match_status"),
        F.greatest(F.lit(0), F.least(F.lit(100), F.coalesce("choice.score", F.lit(0)))).alias("match_score"),
        F.when(won, F.col("choice.external_id")).alias("external_id"),
        F.when(won, first_present("choice.title", fallback_title)).otherwise(fallback_title).alias("matched_title"),
        F.when(won & (F.col("choice.year") > 0), F.col("choice.year")).alias("matched_year"),
        F.when(won, F.col("choice.query")).alias("matched_query"),
    )


def reconcile_children(ext: DataFrame, own: DataFrame, parent: str, ext_number: str, own_number: str,
                       own_columns: list[str], ext_order: list[Column], cap: int = 0) -> DataFrame:
    """External children with the own child of the same (parent, trimmed number).

    External rows without an own child stay; own numbers repeated under a parent
    count once (the greatest row); blank numbers never match.
    """
    kept = cap_children(ext, [parent], ext_order, cap)
    key = F.nullif(F.trim(F.col(own_number)), F.lit(""))
    last = own.select(parent, key.alias("_num"), F.struct(*own_columns).alias("_own")).filter(F.col("_num").isNotNull())
    last = last.groupBy(parent, "_num").agg(F.max("_own").alias("_own"))
    return (
        kept.withColumn("_num", F.trim(F.col(ext_number)))
        .join(last, [parent, "_num"], "left")
        .select(*kept.columns, *[F.col("_own." + c).alias(c) for c in own_columns])
    )
