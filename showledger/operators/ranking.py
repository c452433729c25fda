"""First-per-key, top-k, numbering and paging.

`row_number() <= k` filters are planned with a map-side group limit, so a hot key
sends at most k rows per task into its window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col
from ..session import cut_lineage


def top_per_group(df: DataFrame, group: list, order: list[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """First `n` rows of every group in the given total order."""
    name = rank or "_rn"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col(name) <= n)
    return ranked if rank else ranked.drop(name)


def keep_first(df: DataFrame, key: list, order: list[Column]) -> DataFrame:
    """One row per key: the first to arrive."""
    return top_per_group(df, key, order, 1)


def cap_children(df: DataFrame, parent: list, order: list[Column], n: int) -> DataFrame:
    """First `n` children of every parent; all of them when n <= 0."""
    return top_per_group(df, parent, order, n) if n > 0 else df


def recent(items: DataFrame, source: str, n: int) -> DataFrame:
    """Latest `n` rows of one source, NULL timestamps last."""
    return (
        items.filter(F.col("source") == source)
        .orderBy(F.col("updated_at").desc_nulls_last(), F.col("item_key"))
        .limit(n)
    )


#: Offset beyond which a page is found by numbering rows: one task would otherwise hold all rows before it.
DEEP = 100_000


def page(df: DataFrame, order: list[Column], limit: int, offset: int = 0) -> DataFrame:
    """One page of a total order; a deep one reads the rows' numbers, so no task holds the rows before it."""
    if offset > DEEP:
        rows = dense_index(df, order, "_place")
        return rows.where(F.col("_place").between(offset + 1, offset + limit)).orderBy("_place").limit(limit).drop("_place")
    return df.orderBy(*order).offset(offset).limit(limit)


def numeric_sort_keys(c) -> list[Column]:
    """Order numbers by value before other text; equal numbers and text by text."""
    text = col(c)
    value = F.when(F.trim(text).rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"), F.trim(text).try_cast("double"))
    return [value.isNull(), F.coalesce(value, F.lit(0.0)), text]


def dense_index(df: DataFrame, order: list[Column], name: str, start: int = 0) -> DataFrame:
    """Consecutive numbers from start+1 in a global order, computed in parallel.

    Rows are range-partitioned and sorted; a row's number is its place inside its
    partition plus the sizes of the partitions before it. Only those sizes (one
    row per partition) pass through a single task. The sorted rows are
    checkpointed so that both readings see the same partition bounds.
    """
    placed = cut_lineage(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    running = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = sizes.select("_part", (F.sum("_n").over(running) - F.col("_n")).alias("_before"))
    local = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # one row per partition
        .withColumn(name, F.lit(start) + F.col("_before") + local + 1)
        .drop("_at", "_part", "_before")
    )


def work_queue(
    items: DataFrame, required: dict[str, Column], tiebreak: list[Column], limit: int = 50, missing_only: bool = True
) -> DataFrame:
    """Rows to refetch: those missing the first listed fields come first, newest first.

    `required` maps a field name to a Column that is true when the field is missing.
    """
    flagged = items
    for name, missing in required.items():
        flagged = flagged.withColumn("missing_" + name, F.coalesce(missing, F.lit(True)))
    flags = ["missing_" + n for n in required]
    if missing_only:
        any_missing = F.lit(False)
        for f in flags:
            any_missing = any_missing | F.col(f)
        flagged = flagged.filter(any_missing)
    order = [F.col(f).desc() for f in flags] + tiebreak
    return flagged.orderBy(*order).limit(limit if limit > 0 else 50)


def sample_links(
    links: DataFrame, source: str, parent_order: list[Column], per_source: int = 10, cap: int = 50
) -> DataFrame:
    """URLs of the `per_source` first parents of every source, then a global cap.

    `links` has one row per parent with an array column `urls`. URLs are sorted
    inside a parent; sources follow each other in name order.
    """
    picked = top_per_group(links, [source], parent_order, per_source, rank="parent_rank")
    rows = picked.select("*", F.posexplode(F.sort_array("urls")).alias("url_pos", "url")).drop("urls")
    return rows.orderBy(source, "parent_rank", "url_pos").limit(cap)


def rows_to_json(df: DataFrame, by: list[str], order: list[str], n: int = 0) -> DataFrame:
    """All rows of every group (the first `n` of it, when n > 0) as one ordered JSON array.

    A group without rows has no row here; `result_to_json` gives '[]' for an empty result.
    """
    body = [c for c in df.columns if c not in by]
    picked = top_per_group(df, by, [F.col(c) for c in order], n, rank="_pos") if n > 0 else df
    place = F.col("_pos") if n > 0 else F.struct(*order)
    listed = F.sort_array(F.collect_list(F.struct(place.alias("_pos"), F.struct(*body).alias("row"))))
    return picked.groupBy(*by).agg(F.to_json(F.transform(listed, lambda x: x["row"])).alias("rows_json"))


def result_to_json(df: DataFrame, order: list[Column], limit: int = 100, offset: int = 0, columns: list[str] | None = None) -> DataFrame:
    """One page of an ordered result as one JSON array; '[]' when the page is empty.

    The page is a single row, so a limit is asked for (100 as given; it must be positive).
    """
    if limit <= 0 or offset < 0:
        raise ValueError("the limit must be positive and the offset not negative")
    rows = page(df, order, limit, offset).select(F.to_json(F.struct(*(columns or df.columns)), {"ignoreNullFields": "false"}).alias("row"), F.monotonically_increasing_id().alias("_pos"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("_pos", "row"))), lambda x: x["row"])
    return rows.agg(F.concat(F.lit("["), F.array_join(listed, ","), F.lit("]")).alias("rows_json"))
