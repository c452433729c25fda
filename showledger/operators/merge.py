"""Keyed merges with one policy per column.

A merge returns the next version of the target; the caller writes it to a new
location. Two plans give the same rows: a full outer join, and - when Catalyst's
size estimate says the batch can be broadcast - an incremental plan that never
shuffles the target. Stored rows with a NULL in their key match nothing and stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import jsoncol
from ..functions.arrays import merge_codes, union_ordered
from ..functions.codes import lookup
from ..functions.keys import item_key
from ..functions.text import first_present, is_blank
from ..functions.urls import domain
from ..session import cut_lineage, fits_broadcast
from .ranking import dense_index, keep_first

Side = Callable[[str], Column]
Policy = Callable[[Column, Column, Side, Side], Column]


# -- policies: (stored, incoming, stored row, incoming row) -> merged ----------

def keep(s, i, S, I):  # noqa: E741
    return s


def replace(s, i, S, I):  # noqa: E741
    return i


def if_present(s, i, S, I):  # noqa: E741
    """Incoming text unless it is blank."""
    return F.when(~is_blank(i), i).otherwise(s)


def if_not_null(s, i, S, I):  # noqa: E741
    return F.coalesce(i, s)


def if_positive(s, i, S, I):  # noqa: E741
    return F.when(i > 0, i).otherwise(s)


def if_nonzero(s, i, S, I):  # noqa: E741
    return F.when(F.coalesce(i, F.lit(0)) != 0, i).otherwise(s)


def fill_zero(s, i, S, I):  # noqa: E741
    """Incoming only where the stored number is still 0."""
    return F.when((s == 0) & (i != 0), i).otherwise(s)


def fill_blank(s, i, S, I):  # noqa: E741
    return F.when(is_blank(s) & ~is_blank(i), i).otherwise(s)


def shallow_json(s, i, S, I):  # noqa: E741
    return jsoncol.merge_shallow(s, i)


def union_codes(s, i, S, I):  # noqa: E741
    return merge_codes(s, i)


def latest(s, i, S, I):  # noqa: E741
    return F.greatest(s, i)


def fill_unknown(code: str) -> Policy:
    """Incoming code only while the stored one is the unknown code."""
    return lambda s, i, S, I: F.when((s == code) & (i != code), i).otherwise(s)


def if_known(code: str) -> Policy:
    """Incoming unless it is the unknown code."""
    return lambda s, i, S, I: F.when(i != code, i).otherwise(s)


def unless_empty(literal: str) -> Policy:
    """Incoming unless it is the given empty JSON literal."""
    return lambda s, i, S, I: F.when(F.coalesce(i, F.lit(literal)) != literal, i).otherwise(s)


def ranked(rank_col: str, strong: str) -> Policy:
    """Stored text stays while its row carries the strong rank and is not blank."""
    return lambda s, i, S, I: F.when((S(rank_col) == strong) & ~is_blank(s), s).when(~is_blank(i), i).otherwise(s)


def strong_if(id_col: str, strong: str) -> Policy:
    """The row takes the strong rank once the incoming row names an id."""
    return lambda s, i, S, I: F.when(I(id_col).isNotNull(), F.lit(strong)).otherwise(s)


def movie_slug(id_col: str) -> Policy:
    """An explicit stored slug survives; blanks and placeholders give way."""

    def apply(s, i, S, I):  # noqa: E741
        placeholder = F.concat(F.lit("movie-"), S(id_col).cast("string"))
        new = F.when(is_blank(i), placeholder).otherwise(F.trim(i))
        return F.when(is_blank(s) | ((s == placeholder) & (new != s)), new).otherwise(s)

    return apply


def constant(value: Column) -> Policy:
    return lambda s, i, S, I: value


# -- the merge ------------------------------------------------------------------

def last_write(batch: DataFrame, keys: list[str], order: list[Column], unique: bool = False) -> DataFrame:
    """Drop blank keys, then keep one row of every key: the first in `order` (latest
    row first). A batch without an order fails when it is run if a key repeats in it.
    `unique` says that keys do not repeat, as after an aggregation by them."""
    typed = dict(batch.dtypes)
    for k in keys:
        batch = batch.filter(~is_blank(k)) if typed[k] == "string" else batch.filter(F.col(k).isNotNull())
    if unique:
        return batch
    if order:
        return keep_first(batch, keys, order)
    rest = [c for c in batch.columns if c not in keys]
    once = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.first(F.struct(F.lit(0).alias("_none"), *rest)).alias("_row"))
    said = F.concat(F.lit("keys repeat in a batch without an order: "), F.to_json(F.struct(*keys)))
    checked = F.when(F.col("_rows") > 1, F.raise_error(said)).otherwise(F.col("_row"))
    return once.withColumn("_row", checked).select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in batch.columns])


def merge(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    policies: dict[str, Policy],
    *,
    order: list[Column] | None = None,
    inserts: dict[str, Column] | None = None,
    unique: bool = False,
    incremental: bool | None = None,
) -> DataFrame:
    """Next version of `target` after upserting `batch`.

    `order` (latest row first) resolves keys repeated inside the batch, unless they
    are known to be `unique`. `inserts`
    gives values for new rows, written over `i_<column>` names. Columns without a
    policy keep their stored value.
    """
    fresh = last_write(batch, keys, order or [], unique)
    columns = target.columns
    # the markers, not the keys, tell which side a row has: stored keys may be NULL
    old = target.select(*[F.col(c).alias("s_" + c) for c in columns], F.lit(True).alias("_old"))
    types = dict(target.dtypes)
    has = set(fresh.columns)

    stored: Side = lambda c: F.col("s_" + c)
    incoming: Side = lambda c: F.col("i_" + c) if c in has else F.lit(None).cast(types.get(c, "string"))

    def value(c: str, is_new: Column) -> Column:
        insert = (inserts or {}).get(c, incoming(c))
        if c in keys:
            return F.coalesce(stored(c), incoming(c))
        update = policies.get(c, keep)(stored(c), incoming(c), stored, incoming)
        return (
            F.when(is_new, insert)
            .when(F.col("_new").isNull(), stored(c))
            .otherwise(update)
            .cast(types[c])
        )

    on = [F.col("s_" + k) == F.col("i_" + k) for k in keys]
    small = fits_broadcast(fresh)
    use_incremental = small if incremental is None else incremental
    if use_incremental:
        fresh = cut_lineage(fresh)  # it is read three times below; the batch is ranked once
    new = fresh.select(*[F.col(c).alias("i_" + c) for c in fresh.columns], F.lit(True).alias("_new"))
    if not use_incremental:
        joined = old.join(new, on, "full_outer")
        return joined.select(*[value(c, F.col("_old").isNull()).alias(c) for c in columns])

    hint = F.broadcast if small else (lambda df: df)  # its size is checked above
    updated = old.join(hint(new), on, "left").select(*[value(c, F.lit(False)).alias(c) for c in columns])
    present = target.select(*keys).join(hint(fresh.select(*keys)), keys, "left_semi").distinct()
    unseen = fresh.join(present, keys, "left_anti")
    blank = [F.lit(None).cast(types[c]).alias("s_" + c) for c in columns]
    rows = unseen.select(*[F.col(c).alias("i_" + c) for c in fresh.columns], F.lit(True).alias("_new"), *blank)
    return updated.unionByName(rows.select(*[value(c, F.lit(True)).alias(c) for c in columns]))


def _text(c: str) -> Column:
    return F.coalesce(F.col("i_" + c), F.lit(""))


def upsert_items(target: DataFrame, batch: DataFrame, now: Column, order: list[Column] | None = None, **kw) -> DataFrame:
    """Items: present text wins, numbers and ids fill, details merge shallowly."""
    policies = {
        "title": if_present, "cover_url": if_present, "status": if_present,
        "release_year": if_not_null, "mal_id": if_not_null, "tmdb_id": if_not_null,
        "score": if_positive, "detail": shallow_json, "updated_at": constant(now),
    }
    wanted = {
        "title": _text("title"), "cover_url": _text("cover_url"), "status": _text("status"),
        "detail": F.coalesce(F.col("i_detail"), F.lit("{}")), "created_at": now, "updated_at": now,
    }
    inserts = {c: v for c, v in wanted.items() if c in batch.columns or c in ("created_at", "updated_at")}
    return merge(target, batch, ["item_key"], policies, order=order, inserts=inserts, **kw)


def upsert_units(target: DataFrame, batch: DataFrame, now: Column, order: list[Column] | None = None, **kw) -> DataFrame:
    """Units: the page address and the parent never change on a match."""
    policies = {
        "title": if_present, "label": if_present, "number": if_not_null, "published_at": if_not_null,
        "prev_slug": if_not_null, "next_slug": if_not_null, "detail": shallow_json, "updated_at": constant(now),
    }
    wanted = {
        "title": _text("title"), "label": _text("label"), "canonical_url": _text("canonical_url"),
        "detail": F.coalesce(F.col("i_detail"), F.lit("{}")), "created_at": now, "updated_at": now,
    }
    inserts = {c: v for c, v in wanted.items() if c in batch.columns or c in ("created_at", "updated_at")}
    return merge(target, batch, ["unit_key"], policies, order=order, inserts=inserts, **kw)


def clean_enrichments(batch: DataFrame) -> DataFrame:
    """Write-time defaults: status `matched`, blank id and year <= 0 as NULL."""
    return batch.withColumns({
        "external_id": F.nullif(F.trim("external_id"), F.lit("")),
        "match_status": F.coalesce(F.nullif(F.trim("match_status"), F.lit("")), F.lit("matched")),
        "matched_title": F.trim(F.coalesce("matched_title", F.lit(""))),
        "matched_year": F.when(F.col("matched_year") > 0, F.col("matched_year")),
    })


def upsert_enrichments(target: DataFrame, batch: DataFrame, now: Column, order: list[Column] | None = None, **kw) -> DataFrame:
    """Enrichments: everything is replaced but the creation time."""
    cols = ["external_id", "match_status", "match_score", "matched_title", "matched_year", "payload"]
    policies: dict[str, Policy] = {c: replace for c in cols} | {"updated_at": constant(now)}
    return merge(target, clean_enrichments(batch), ["item_key", "provider"], policies, order=order,
                 inserts={"created_at": now, "updated_at": now}, **kw)


def upsert_replace(target: DataFrame, batch: DataFrame, keys: list[str], defaults: dict[str, Column] | None = None,
                   order: list[Column] | None = None, skip: tuple[str, ...] = ("created_at",), **kw) -> DataFrame:
    """Full replace by a natural or composite key; NULLs become the given defaults."""
    for name, default in (defaults or {}).items():
        if name in batch.columns:
            batch = batch.withColumn(name, F.coalesce(F.col(name), default))
    return merge(target, batch, keys, {c: replace for c in batch.columns if c not in keys and c not in skip}, order=order, **kw)


def upsert_movies(target: DataFrame, batch: DataFrame, id_col: str = "tmdb_id", order: list[Column] | None = None, **kw) -> DataFrame:
    """Movies: everything is replaced, except that an explicit slug survives."""
    coded = batch.withColumns({
        c: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(d))
        for c, d in (("status_code", "r"), ("meta_source_code", "t")) if c in batch.columns
    })
    policies: dict[str, Policy] = {c: replace for c in coded.columns if c != id_col}
    policies["slug"] = movie_slug(id_col)
    placeholder = F.concat(F.lit("movie-"), F.col("i_" + id_col).cast("string"))
    slug = F.when(is_blank("i_slug"), placeholder).otherwise(F.trim("i_slug"))
    return merge(target, coded, [id_col], policies, order=order, inserts={"slug": slug}, **kw)


def upsert_movie_meta(target: DataFrame, batch: DataFrame, **kw) -> DataFrame:
    """Side rows of movies; absent lists become empty ones."""
    empty = {c: F.lit("[]") for c in ("cast_json", "alt_titles_json")}
    if "director_names" in batch.columns:
        empty["director_names"] = F.array().cast("array<string>")
    return upsert_replace(target, batch, ["tmdb_id"], empty, **kw)


def upsert_provider_records(target: DataFrame, batch: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """Upsert by (provider_code, provider_slug); new rows get the next ids in key order."""
    keys = ["provider_code", "provider_slug"]
    fresh = last_write(batch, keys, order or [])
    unseen = fresh.join(target.select(*keys), keys, "left_anti")
    top = target.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).first()["m"]
    numbered = dense_index(unseen, [F.col(k) for k in keys], "id", start=top)
    # with their ids given, new and known rows are one plain replace
    known = fresh.join(target.select(*keys, "id"), keys)
    rows = known.unionByName(numbered.withColumn("id", F.col("id").cast(dict(target.dtypes)["id"])))
    return merge(target, rows, keys, {c: replace for c in rows.columns if c not in keys}, unique=True)


def upsert_options(target: DataFrame, batch: DataFrame, url_col: str, default_status: str, order: list[Column] | None = None, **kw) -> DataFrame:
    """Watch / download options by (record, label, url)."""
    return upsert_replace(target, batch, ["record_id", "label", url_col], {"status_code": F.lit(default_status)}, order, **kw)


RANKED_CATALOG: dict[str, Policy] = {
    "title": ranked("meta_source_code", "m"), "poster_path": ranked("meta_source_code", "m"),
    "type_code": fill_unknown("u"), "status_code": fill_unknown("x"), "score": fill_zero,
    "genre_codes": union_codes, "synopsis_source": if_present, "updated_at": latest,
}
RANKED_DETAIL: dict[str, Policy] = {
    "meta_source_code": strong_if("mal_id", "m"), "mal_id": if_not_null, "title": if_present,
    "poster_path": if_present, "type_code": if_known("u"), "status_code": if_known("x"),
    "season_code": if_known("x"), "year": if_not_null, "score": if_nonzero, "episode_count": if_not_null,
    "genre_codes": union_codes, "studio_codes": union_codes, "synopsis_source": if_present,
    "synopsis_enriched": if_present, "batch_links_json": unless_empty("{}"), "updated_at": latest,
}


def upsert_ranked(target: DataFrame, batch: DataFrame, keys: list[str], policies: dict[str, Policy], **kw) -> DataFrame:
    """Merge under a policy table such as RANKED_CATALOG or RANKED_DETAIL."""
    return merge(target, batch, keys, {c: p for c, p in policies.items() if c in target.columns}, **kw)


# -- merges of other shapes -----------------------------------------------------------

def ensure_parents(items: DataFrame, units: DataFrame, key: str, title: str, touched: str) -> DataFrame:
    """Items plus a stub (title = key) for every parent named only by units."""
    named = units.filter(~is_blank(key)).groupBy(F.trim(key).alias(key)).agg(F.max(touched).alias(touched))
    stubs = named.join(items.select(key), key, "left_anti").withColumn(title, F.col(key))
    return items.unionByName(stubs, allowMissingColumns=True)


def prune_empty(df: DataFrame, empty: dict[str, list[str]]) -> DataFrame:
    """Drop rows whose payload columns all hold an empty value."""
    has_value = F.lit(False)
    for name, blanks in empty.items():
        has_value = has_value | ~F.coalesce(F.col(name), F.lit(blanks[0])).isin(blanks)
    return df.filter(has_value)


def diff_read_model(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows and stale target keys with an action: insert/update/delete/unchanged."""
    body = [c for c in source.columns if c not in keys]
    old = target.select(*[F.col(c).alias("s_" + c) for c in keys + body], F.lit(True).alias("_old"))
    new = source.withColumn("_new", F.lit(True))
    same = F.lit(True)
    for c in body:
        same = same & F.col(c).eqNullSafe(F.col("s_" + c))
    action = (
        F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete")
        .when(same, "unchanged").otherwise("update")
    )
    on = [F.col("s_" + k) == F.col(k) for k in keys]
    joined = old.join(new, on, "full_outer")
    pick = lambda c: F.when(F.col("_new").isNull(), F.col("s_" + c)).otherwise(F.col(c)).alias(c)
    return joined.select(*[pick(c) for c in keys + body], action.alias("action"))


def sync_read_model(target: DataFrame, source: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(next read model, rows per action)."""
    diff = diff_read_model(target, source, keys)
    model = diff.filter(F.col("action") != "delete").drop("action")
    return model, diff.groupBy("action").agg(F.count("*").alias("n"))


def rekey_items(items: DataFrame, units: DataFrame, rule: Column, new_type: str, now: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Move items meeting `rule` to `<source>:<new_type>:<slug>`.

    An item moves when it has at most one unit and its new key is free. Its unit
    is repointed and carries the parent slug. Returns (items, units, mapping).
    """
    named = items.filter(rule).select(
        F.col("item_key").alias("old_key"), item_key("source", F.lit(new_type), "slug").alias("new_key"), "slug",
    )
    children = units.groupBy("item_key").agg(F.count("*").alias("children"))
    mapping = (
        named.join(children, named.old_key == children.item_key, "left")
        .filter(F.coalesce("children", F.lit(0)) <= 1)
        .select("old_key", "new_key", "slug", F.coalesce("children", F.lit(0)).alias("children"))
        .join(items.select(F.col("item_key").alias("new_key")), "new_key", "left_anti")
    )
    moves = mapping.select(F.col("old_key").alias("item_key"), "new_key")
    out_items = (
        items.join(moves, "item_key", "left")
        .withColumn("media_type", F.when(F.col("new_key").isNotNull(), new_type).otherwise(F.col("media_type")))
        .withColumn("updated_at", F.when(F.col("new_key").isNotNull(), now).otherwise(F.col("updated_at")))
        .withColumn("item_key", F.coalesce("new_key", "item_key"))
        .select(*items.columns)
    )
    parents = mapping.select(F.col("old_key").alias("item_key"), "new_key", F.col("slug").alias("parent_slug"))
    moved = F.col("new_key").isNotNull()
    out_units = (
        units.join(parents, "item_key", "left")
        .withColumn("detail", F.when(moved, jsoncol.set_keys("detail", {"anime_slug": F.col("parent_slug")})).otherwise(F.col("detail")))
        .withColumn("updated_at", F.when(moved, now).otherwise(F.col("updated_at")))
        .withColumn("item_key", F.coalesce("new_key", "item_key"))
        .select(*units.columns)
    )
    return out_items, out_units, mapping


def dedupe_legacy(units: DataFrame, parent: str, number: str, slug: str, mark: str = rules.LEGACY_SLUG_MARK) -> DataFrame:
    """Drop a legacy-slug row when a canonical row shares (parent, number)."""
    legacy = F.col(slug).contains(mark)
    canonical = units.filter(~legacy).select(parent, number).distinct()
    return units.filter(~legacy).unionByName(units.filter(legacy).join(canonical, [parent, number], "left_anti"))


def annotate(df: DataFrame, slug: str = "slug", title: str = "title", detail: str = "detail") -> DataFrame:
    """Adaptation notes into detail: a contains rule, then exact-slug overrides."""
    rule = rules.ADAPTATION_RULE
    low_slug, low_title = F.lower(F.trim(slug)), F.lower(F.trim(title))
    adapted = low_slug.contains(rule["slug_contains"]) | low_title.contains(rule["title_contains"])
    fmt = F.coalesce(lookup(rules.ENTRY_FORMAT_OVERRIDES, low_slug), F.when(adapted, rule["entry_format"]))
    notes = {"adaptation_type": F.when(adapted, rule["adaptation_type"]), "entry_format": fmt}
    return df.withColumn(detail, jsoncol.set_keys(detail, notes))


def supplement(base: DataFrame, sources: list[DataFrame], key: str, scalars: list[str], lists: list[str],
               overriding: list[str] = ()) -> DataFrame:
    """Complete `base` from ranked sources (first is strongest).

    Scalars take the first non-blank value, base first; `overriding` scalars take
    the strongest source first. Lists become ordered unions.
    """
    out = base
    for n, src in enumerate(sources):
        have = [c for c in scalars + list(lists) if c in src.columns]
        out = out.join(src.select(key, *[F.col(c).alias(f"_{n}_{c}") for c in have]), key, "left")
    found = lambda c: [F.col(f"_{n}_{c}") for n, s in enumerate(sources) if c in s.columns]
    exprs = {}
    for c in scalars:
        others = found(c)
        exprs[c] = first_present(*others, F.col(c)) if c in overriding else first_present(F.col(c), *others)
    for c in lists:
        exprs[c] = union_ordered(F.col(c), *found(c))
    return out.withColumns(exprs).select(*base.columns)


def refill(base: DataFrame, extra: DataFrame, key: str, columns: list[str], policy: str = "fill") -> DataFrame:
    """`fill`: extra only where base is blank; `overwrite`: extra wherever it has a value."""
    joined = base.join(extra.select(key, *[F.col(c).alias("_x_" + c) for c in columns]), key, "left")
    pair = lambda c: (F.col(c), F.col("_x_" + c)) if policy == "fill" else (F.col("_x_" + c), F.col(c))
    return joined.withColumns({c: first_present(*pair(c)) for c in columns}).select(*base.columns)


def resolve_parent_keys(units: DataFrame, items: DataFrame, parent_slug: str, default_type: str = rules.EPISODE_ITEM_TYPE) -> DataFrame:
    """item_key of the newest item with the unit's (source, parent slug), else the default key."""
    newest = items.groupBy("source", F.col("slug").alias(parent_slug)).agg(F.max_by("item_key", F.struct("updated_at", "item_key")).alias("_key"))
    default = item_key("source", F.lit(default_type), parent_slug)
    return units.drop("item_key").join(newest, ["source", parent_slug], "left").withColumn("item_key", F.coalesce("_key", default)).drop("_key")


def repair_provenance(df: DataFrame, primary_prefix: str) -> DataFrame:
    """Fill blank page origins from the canonical address and settle primary/secondary.

    Rows whose canonical address is not under `primary_prefix` were read from a
    secondary page. A primary equal to its secondary is primary only.
    """
    prefix = primary_prefix.rstrip("/") + "/"
    own = F.col("canonical_url").startswith(prefix)
    home = F.concat(F.lit(prefix), F.trim(F.col("slug"), F.lit("/")), F.lit("/"))
    settled = df.withColumns({
        "primary_url": first_present("primary_url", home),
        "secondary_url": first_present("secondary_url", F.when(~own, F.col("canonical_url"))),
        "effective_url": first_present("effective_url", F.when(own, home).otherwise(F.col("canonical_url"))),
        "effective_kind": first_present("effective_kind", F.when(own, F.lit("primary")).otherwise(F.lit("secondary"))),
        "fetch_status": first_present("fetch_status", F.when(own, F.lit("pending")).otherwise(F.lit("legacy_secondary_only"))),
        "canonical_url": F.when(own, F.col("canonical_url")).otherwise(home),
    })
    demote = (
        (F.col("secondary_url") != "") & (F.col("effective_url") == F.col("primary_url")) & (F.col("effective_kind") == "primary")
    )
    demoted = settled.withColumns({
        "effective_url": F.when(demote, F.col("secondary_url")).otherwise(F.col("effective_url")),
        "effective_kind": F.when(demote, "secondary").otherwise(F.col("effective_kind")),
        "fetch_status": F.when(demote & (F.col("fetch_status") == "pending"), "legacy_secondary_only").otherwise(F.col("fetch_status")),
    })
    equal = F.col("secondary_url") == F.col("primary_url")
    both = F.col("fetch_status").isin("primary_fetched_secondary_fetched", "primary_redirected_offsite_secondary_fetched")
    return demoted.withColumns({
        "effective_url": F.when(equal, F.col("primary_url")).otherwise(F.col("effective_url")),
        "effective_kind": F.when(equal, "primary").otherwise(F.col("effective_kind")),
        "fetch_status": F.when(equal & both, "primary_fetched").otherwise(F.col("fetch_status")),
        "secondary_url": F.when(equal, "").otherwise(F.col("secondary_url")),
    }).withColumns({
        "primary_domain": domain("primary_url"),
        "secondary_domain": domain("secondary_url"),
        "effective_domain": domain("effective_url"),
    })
