"""Table and exception-list readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TABLES


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Parquet table by name; canonical tables are read with their fixed schema."""
    reader = spark.read.schema(TABLES[name]) if name in TABLES and not folder.startswith("raw:") else spark.read
    return reader.parquet(f"{folder.removeprefix('raw:').rstrip('/')}/{name}")


def read_exceptions(spark: SparkSession, path: str) -> DataFrame:
    """(slug, reason) from a TSV with `#` comments and blank lines."""
    rows = spark.read.csv(path, sep="\t", comment="#", schema="slug string, reason string")
    return rows.filter(F.trim(F.coalesce("slug", F.lit(""))) != "").select(F.trim("slug").alias("slug"), "reason")


def write_version(df: DataFrame, path: str, partition_by: list[str] | None = None, sort_by: list[str] | None = None) -> None:
    """Write the next version of a table to a new location (never the one being read)."""
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    writer = out.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
