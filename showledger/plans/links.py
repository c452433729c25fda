"""Link inventory and audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import extract_urls
from ..operators.ranking import sample_links
from .reports import host_summary


def url_inventory(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """One row per distinct URL of every row's text."""
    return df.select(*key, F.posexplode(extract_urls(text)).alias("pos", "url"))


def link_audit(rows: DataFrame, resolutions: DataFrame, order: list[Column], per_source: int = 10, cap: int = 50) -> tuple[DataFrame, DataFrame]:
    """(entries, host summary) of sampled links.

    rows: source_type, slug, text (+ ordering columns); resolutions: url,
    final_url, final_host, status_code, error.
    """
    listed = rows.withColumn("urls", extract_urls("text")).filter(F.size("urls") > 0).drop("text")
    sample = sample_links(listed, "source_type", order, per_source, cap)
    entries = sample.join(resolutions, "url", "left")
    return entries, host_summary(entries)
