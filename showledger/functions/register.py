"""SQL surface: temporary SQL functions for use inside `spark.sql`."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .. import rules

# name(arguments) -> (result type, SQL expression)
SQL_FUNCTIONS = {
    "normalize_space(t STRING)": ("STRING", r"trim(regexp_replace(coalesce(t, ''), '[\\s\\p{Z}]+', ' '))"),
    "slugify(t STRING)": (
        "STRING", "trim(BOTH '-' FROM regexp_replace(replace(lower(trim(coalesce(t, ''))), '&', 'and'), '[^a-z0-9]+', '-'))",
    ),
    "item_key(source STRING, kind STRING, slug STRING)": (
        "STRING", "concat_ws(':', lower(trim(source)), lower(trim(kind)), trim(slug))",
    ),
    "parse_smallint(t STRING)": ("SMALLINT", "CASE WHEN trim(t) RLIKE '^[0-9]{1,5}$' THEN try_cast(trim(t) AS SMALLINT) END"),
    "parse_integer(t STRING)": ("INT", "CASE WHEN trim(t) RLIKE '^[0-9]{1,10}$' THEN try_cast(trim(t) AS INT) END"),
    "parse_real(t STRING)": (
        "DOUBLE", r"CASE WHEN trim(t) RLIKE '^[0-9]+(\\.[0-9]+)?$' THEN try_cast(trim(t) AS DOUBLE) END",
    ),
    "host_norm(u STRING)": (
        "STRING",
        r"regexp_replace(lower(regexp_extract(trim(coalesce(u, '')), '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www\\.', '')",
    ),
    "merge_codes(a ARRAY<SMALLINT>, b ARRAY<SMALLINT>)": (
        "ARRAY<SMALLINT>",
        "sort_array(array_union(coalesce(a, cast(array() as array<smallint>)), coalesce(b, cast(array() as array<smallint>))))",
    ),
    "distinct_trimmed(a ARRAY<STRING>)": (
        "ARRAY<STRING>",
        "sort_array(array_distinct(filter(transform(coalesce(a, cast(array() as array<string>)), x -> trim(x)), x -> x <> '')))",
    ),
}


def register_functions(spark: SparkSession, prefix: str = "sl_") -> list[str]:
    """Create the temporary functions; returns their names."""
    names = []
    for signature, (kind, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{signature} RETURNS {kind} RETURN {body}")
        names.append(prefix + signature.split("(")[0])
    return names


def register_search(spark: SparkSession, view: str, name: str = "sl_search", title: str = "title", slug: str = "slug") -> str:
    """Create the temporary SQL table function `name(query, limit)` over the titles of a view; returns its name.

    `SELECT * FROM sl_search('bolt', 8)` gives title, slug, rank_bucket, title_position and place as `search_titles` ranks
    them; a null limit is the default one. The best rows of each task meet in one, never all matches.
    """
    low, low_slug, q, s = f"lower({title})", f"lower({slug})", "lower(trim(query))", r"regexp_replace(lower(trim(query)), '\\s+', '-')"
    spark.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION {name}(query STRING, row_limit INT)
RETURNS TABLE (title STRING, slug STRING, rank_bucket INT, title_position INT, place INT)
RETURN SELECT * FROM (SELECT title, slug, rank_bucket, title_position, row_number() OVER (ORDER BY rank_bucket, title_position, title, slug) AS place FROM (
  SELECT title, slug, rank_bucket, title_position FROM (
    SELECT {title} AS title, {slug} AS slug, coalesce(nullif(position({q}, {low}), 0), 9999) AS title_position,
           CASE WHEN {low} = {q} THEN 0 WHEN {low_slug} = {s} THEN 1 WHEN startswith({low}, {q}) THEN 2 WHEN startswith({low_slug}, {s}) THEN 3
                WHEN contains({low}, concat(' ', {q})) THEN 4 WHEN contains({low}, {q}) THEN 5 WHEN contains({low_slug}, {s}) THEN 6 END AS rank_bucket
    FROM {view} WHERE length({q}) >= {rules.SEARCH_MIN_CHARS})
  WHERE rank_bucket IS NOT NULL ORDER BY rank_bucket, title_position, title, slug LIMIT {rules.SEARCH_MAX}))
WHERE place <= greatest(1, coalesce(row_limit, {rules.SEARCH_LIMIT}))""")
    return name


def register_token_search(spark: SparkSession, view: str, key: str, text: str, name: str = "sl_token_search") -> str:
    """Create the temporary SQL table function `name(query)`: the keys of a view whose text holds every token of the query."""
    cut = lambda t: rf"array_distinct(filter(split(lower({t}), '[^\\p{{L}}\\p{{N}}]+'), w -> w <> ''))"
    kind = spark.table(view).schema[key].dataType.simpleString()
    spark.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION {name}(query STRING) RETURNS TABLE ({key} {kind})
RETURN SELECT {key} FROM {view} WHERE size({cut('query')}) > 0 AND size(array_except({cut('query')}, {cut(text)})) = 0""")
    return name


def read_recordset(df, json_col: str, schema: str):
    """Array-of-objects JSON text -> one row per object."""
    from pyspark.sql import functions as F

    return df.select(F.inline(F.from_json(F.col(json_col), f"array<struct<{schema}>>")))
