"""JSON objects kept as text: path reads, shallow merges, compact builds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import compact_ci, split_values
from .text import col, first_present, none_if_blank

_MAP = "map<string,variant>"


def variant(c) -> Column:
    """Parse once; malformed text gives NULL."""
    return F.try_parse_json(col(c))


def get_text(v, path: str) -> Column:
    """Trimmed text at a dotted path of a variant, NULL when blank or absent."""
    return none_if_blank(F.try_variant_get(col(v), "$." + path, "string"))


def get_list(v, path: str) -> Column:
    """List at a path: a JSON array, or comma-separated text."""
    as_list = F.try_variant_get(col(v), "$." + path, "array<string>")
    return F.coalesce(as_list, split_values(F.try_variant_get(col(v), "$." + path, "string")))


def text_fields(c, keys: list[str]) -> Column:
    """Top-level values as text, read in a single parse; lists stay JSON text."""
    wanted = ", ".join(f"`{k}` string" for k in dict.fromkeys(keys))
    return F.from_json(F.coalesce(col(c), F.lit("{}")), f"struct<{wanted}>")


def text_list(c) -> Column:
    """List kept as text: JSON array text, or comma-separated text."""
    raw = F.trim(F.coalesce(col(c), F.lit("")))
    return F.when(raw.startswith("["), F.from_json(raw, "array<string>")).otherwise(split_values(raw))


def as_map(c) -> Column:
    """JSON object text -> map of raw JSON values ({} when NULL or not an object)."""
    return F.coalesce(F.from_json(F.coalesce(col(c), F.lit("{}")), _MAP), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>")))


def _put_all(base: Column, extra: Column) -> Column:
    """`base` with the entries of `extra` over it. A fold: both maps are evaluated
    once per row, and no session-wide rule for repeated keys is needed."""
    return F.aggregate(
        F.map_entries(extra), base,
        lambda acc, e: F.map_concat(F.map_filter(acc, lambda k, v: k != e["key"]), F.create_map(e["key"], e["value"])),
    )


def map_merge_right(a: Column, b: Column) -> Column:
    """Shallow merge, right side wins."""
    return _put_all(a, b)


def map_merge_left(a: Column, b: Column) -> Column:
    """Text maps: left side wins; blank keys and values are dropped from both."""
    clean = lambda m: F.map_filter(m, lambda k, v: (F.trim(k) != "") & (F.trim(F.coalesce(v, F.lit(""))) != ""))
    return _put_all(clean(b), clean(a))


def merge_shallow(old, new) -> Column:
    """`old || new` for JSON object text; an explicit JSON null overwrites."""
    return F.to_json(map_merge_right(as_map(old), as_map(new)))


def set_keys(old, values: dict[str, Column]) -> Column:
    """Put text values under top-level keys; a NULL value leaves its key as it was."""
    patch = F.to_json(F.struct(*[v.alias(k) for k, v in values.items()]))
    return merge_shallow(old, patch)


def merge_subdoc(doc, outer: str, provider: str, payload) -> Column:
    """Write `doc.<outer>.<provider> = payload`, keeping every sibling."""
    inner_old = F.get_json_object(F.coalesce(col(doc), F.lit("{}")), "$." + outer)
    wrapped = F.concat(F.lit('{"%s":' % provider), F.coalesce(col(payload), F.lit("null")), F.lit("}"))
    inner = merge_shallow(inner_old, wrapped)
    return merge_shallow(doc, F.concat(F.lit('{"%s":' % outer), inner, F.lit("}")))


def has_payload(c, path: str) -> Column:
    """True when the sub-object at `path` is a non-empty object."""
    sub = F.get_json_object(col(c), "$." + path)
    return F.coalesce(F.size(F.map_keys(F.from_json(sub, _MAP))) > 0, F.lit(False))


def compact_payload(fields: dict[str, tuple[Column, str]]) -> Column:
    """JSON object without blank texts, numbers <= 0, empty lists and NULLs.

    Kinds: `text`, `number`, `list` (text list), `any` (kept when not NULL).
    """
    out = []
    for name, (value, kind) in fields.items():
        if kind == "text":
            value = none_if_blank(value)
        elif kind == "number":
            value = F.when(value > 0, value)
        elif kind == "list":
            value = F.when(F.size(compact_ci(value)) > 0, compact_ci(value))
        elif kind == "objects":
            value = F.when(F.size(value) > 0, value)
        out.append(value.alias(name))
    return F.to_json(F.struct(*out))
