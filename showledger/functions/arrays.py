"""Array columns used as ordered lists and as sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, none_if_blank


def _or_empty(c, kind: str = "array<string>") -> Column:
    return F.coalesce(col(c), F.array().cast(kind))


def trimmed(c) -> Column:
    """Trimmed values without blanks and NULLs."""
    return F.filter(F.transform(_or_empty(c), none_if_blank), lambda x: x.isNotNull())


def distinct_trimmed_sorted(c) -> Column:
    return F.sort_array(F.array_distinct(trimmed(c)))


def union_ordered(*cols) -> Column:
    """First-seen order, case-sensitive."""
    return F.array_distinct(F.concat(*[trimmed(c) for c in cols]))


def compact_ci(*cols) -> Column:
    """First-seen order, case-insensitive; the first spelling is kept."""
    # a fold, so that the input lists are evaluated once per row
    return F.aggregate(
        F.concat(*[trimmed(c) for c in cols]),
        F.array().cast("array<string>"),
        lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.array_append(acc, x)),
    )


def merge_codes(a, b) -> Column:
    """Sorted set union of two code arrays."""
    kind = "array<smallint>"
    return F.sort_array(F.array_union(_or_empty(a, kind).cast(kind), _or_empty(b, kind).cast(kind)))


def drop_numeric_chips(c) -> Column:
    """Category chips without purely numeric single tokens, case-insensitively distinct."""
    words = F.filter(trimmed(c), lambda x: ~(x.rlike(r"\d") & ~x.rlike(r"\s")))
    return compact_ci(words)


def prefer_enriched(enriched, current) -> Column:
    """The enriched list when it has values, else the current one."""
    return F.when(F.size(_or_empty(enriched)) > 0, col(enriched)).otherwise(col(current))


def split_values(c, pattern: str = ",") -> Column:
    return trimmed(F.split(F.coalesce(col(c), F.lit("")), pattern))
