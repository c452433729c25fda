"""Snapshot packs: JSON documents under domain/kind plus a manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import iso_z
from ..functions.text import tokens
from ..operators.ranking import top_per_group
from ..session import cut_lineage, delete_below


def touched_items(items: DataFrame, units: DataFrame, domain: Column) -> DataFrame:
    """Items with their domain and touched_at = latest of the item and its units."""
    last_unit = units.groupBy("item_key").agg(F.max("updated_at").alias("_u"), F.count("*").alias("unit_count"))
    joined = items.withColumn("domain", domain).filter(F.col("domain").isNotNull()).join(last_unit, "item_key", "left")
    return joined.withColumn("touched_at", F.greatest("updated_at", "_u")).withColumn(
        "unit_count", F.coalesce("unit_count", F.lit(0))).drop("_u")


#: Columns of a document; title_slug names the title that a document belongs to, also for its units.
DOCUMENT = ["domain", "kind", "title_slug", "slug", "touched_at", "document"]
#: Columns that name a folder of the pack.
FOLDER = ["domain", "kind", "slug_bucket"]
#: Read with these types, whatever the folders' names look like.
_PACK = "title_slug string, slug string, touched_at timestamp, document string, domain string, kind string, slug_bucket int"


def snapshot_documents(items: DataFrame, units: DataFrame, domain: Column, hot_limit: int = 8) -> DataFrame:
    """DOCUMENT rows for catalog, title, playback, home and search."""
    titles = touched_items(items, units, domain).select("item_key", "domain", F.col("slug").alias("title_slug"), "slug", "title", "touched_at", "unit_count")
    doc = lambda kind, *fields: F.struct(F.lit(kind).alias("kind"), F.to_json(F.struct(*fields)).alias("document"))
    # the three documents of a title come from one pass over the joined titles
    each = titles.select(
        "domain", "title_slug", "slug", "touched_at",
        F.inline(F.array(
            doc("catalog", "slug", "title"), doc("title", "item_key", "slug", "title", "unit_count"),
            doc("search", "slug", "title", tokens("title").alias("tokens")),
        )),
    )
    order = [F.col("touched_at").desc(), F.col("slug"), F.col("item_key")]
    hot = top_per_group(titles, ["domain"], order, hot_limit, rank="rank").select(
        "domain", "title_slug", "slug", "touched_at", F.inline(F.array(doc("home", "rank", "slug", "title"))))
    owners = items.select("item_key", F.col("slug").alias("title_slug"), domain.alias("domain")).filter(F.col("domain").isNotNull())
    plays = units.select("unit_key", "item_key", "slug", F.col("updated_at").alias("touched_at")).join(owners, "item_key").select(
        "domain", "title_slug", "slug", "touched_at", F.inline(F.array(doc("playback", "unit_key", "item_key", "slug"))))
    return each.select(*DOCUMENT).unionByName(hot.select(*DOCUMENT)).unionByName(plays.select(*DOCUMENT))


def manifest(documents: DataFrame) -> DataFrame:
    """Documents and latest touch per (domain, kind)."""
    return documents.groupBy("domain", "kind").agg(
        F.count("*").alias("documents"), iso_z(F.max("touched_at")).alias("touched_at")
    )


def _bucketed(documents: DataFrame, buckets: int) -> DataFrame:
    return documents.withColumn("slug_bucket", F.pmod(F.xxhash64("title_slug"), F.lit(buckets)).cast("int"))


def build_snapshot(items: DataFrame, units: DataFrame, domain: Column, out: str, hot_limit: int = 8, buckets: int = 64) -> DataFrame:
    """Write the pack under `out/pack` (folders by domain, kind and bucket of the title), its locator and its manifest; returns the manifest.

    Folders are written by as many tasks as their size asks for: the exchange is a rebalance, which AQE splits and joins
    by the bytes it has counted.
    """
    documents = snapshot_documents(items, units, domain, hot_limit)
    spark = documents.sparkSession
    (_bucketed(documents, buckets).hint("rebalance", *[F.col(c) for c in FOLDER]).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy(*FOLDER).parquet(out + "/pack"))
    spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(out + "/layout")
    return _publish(spark, out, _located(spark.read.schema(_PACK).parquet(out + "/pack")))


# -- the locator: one row for each folder ------------------------------------------------

def _located(pack: DataFrame) -> DataFrame:
    """Documents and latest touch of each folder."""
    return pack.groupBy(*FOLDER).agg(F.count("*").alias("documents"), F.max("touched_at").alias("touched_at"))


def _versions(spark: SparkSession, out: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(out + "/locator")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(int(n) for n in names if n.isdigit() and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{out}/locator/{n}/_SUCCESS")))


def read_locator(spark: SparkSession, out: str) -> DataFrame:
    """FOLDER, documents, touched_at of every folder of the pack."""
    versions = _versions(spark, out)
    if not versions:
        raise FileNotFoundError(f"no pack under {out}")
    return spark.read.parquet(f"{out}/locator/{versions[-1]}")


def _publish(spark: SparkSession, out: str, located: DataFrame) -> DataFrame:
    """Write the next version of the locator and the manifest that follows from it; older versions go."""
    versions = _versions(spark, out)
    number = versions[-1] + 1 if versions else 0
    located.write.mode("overwrite").parquet(f"{out}/locator/{number}")
    folders = spark.read.parquet(f"{out}/locator/{number}")
    sums = folders.groupBy("domain", "kind").agg(F.sum("documents").alias("documents"), iso_z(F.max("touched_at")).alias("touched_at"))
    sums.write.mode("overwrite").parquet(out + "/manifest")
    for old in versions:
        delete_below(spark, out + "/locator", f"{out}/locator/{old}")
    return spark.read.parquet(out + "/manifest")


def _path(spark: SparkSession, folder) -> str:
    """Where the documents of a folder lie below the pack, named as Spark names partition folders."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(names.getPartitionPathString(c, None if folder[c] is None else str(folder[c])) for c in FOLDER)


def read_folders(spark: SparkSession, out: str, folders: list) -> DataFrame | None:
    """The documents of the named folders (rows with FOLDER): only these are listed and read. None for no folders."""
    if not folders:
        return None
    return spark.read.schema(_PACK).option("basePath", out + "/pack").parquet(*[f"{out}/pack/{_path(spark, f)}" for f in folders])


def supplied(targets: DataFrame, docs: DataFrame) -> DataFrame:
    """The documents of `docs` that belong to a target (domain, slug)."""
    keys = targets.select("domain", F.col("slug").alias("title_slug")).distinct()
    return docs.select(*DOCUMENT).join(keys, ["domain", "title_slug"], "left_semi").select(*DOCUMENT)


def patched(pack: DataFrame, targets: DataFrame, docs: DataFrame, home: DataFrame | None = None) -> DataFrame:
    """The pack with the targets' documents of the supplied kinds replaced; all other documents stay.

    A title patched with title and playback documents keeps its catalog and search documents, and its playback
    documents are exactly those supplied. `home` replaces the home documents of the domains it names.
    """
    fresh = supplied(targets, docs)
    kinds = fresh.select("domain", "kind", "title_slug").distinct()
    kept = pack.select(*DOCUMENT).join(kinds, ["domain", "kind", "title_slug"], "left_anti").select(*DOCUMENT)
    if home is not None:
        named = home.select("domain", F.lit("home").alias("kind")).distinct()
        kept = kept.join(named, ["domain", "kind"], "left_anti").select(*DOCUMENT).unionByName(home.select(*DOCUMENT))
    return kept.unionByName(fresh)


def touched_folders(out: str, targets: DataFrame, docs: DataFrame, home: DataFrame | None = None) -> DataFrame:
    """FOLDER of what a patch replaces: where its documents belong, and all home folders of the domains that `home` names."""
    spark = docs.sparkSession
    buckets = spark.read.parquet(out + "/layout").first()["buckets"]
    new = supplied(targets, docs) if home is None else supplied(targets, docs).unionByName(home.select(*DOCUMENT))
    touched = _bucketed(new, buckets).select(*FOLDER).distinct()
    if home is not None:  # the old home documents of a domain may lie in any bucket
        named = home.select("domain", F.lit("home").alias("kind")).distinct()
        touched = touched.unionByName(read_locator(spark, out).select(*FOLDER).join(named, ["domain", "kind"], "left_semi")).distinct()
    return touched


def patch_snapshot(out: str, targets: DataFrame, docs: DataFrame, home: DataFrame | None = None) -> DataFrame:
    """Rewrite only the folders that hold a supplied document; returns the manifest.

    The cost follows the patch: the locator tells which of the touched folders exist, those alone are listed, read and
    rewritten, and the locator and the manifest are brought up to date by the difference. The names of the touched folders
    come to the driver (at most one for each supplied document and home folder). The affected rows are
    checkpointed before their folders are replaced, since a job must not overwrite the files it is reading.
    """
    spark = docs.sparkSession
    buckets = spark.read.parquet(out + "/layout").first()["buckets"]
    touched = cut_lineage(touched_folders(out, targets, docs, home))
    locator = cut_lineage(read_locator(spark, out))
    old = locator.join(touched, FOLDER, "left_semi").select(*FOLDER).collect()
    affected = read_folders(spark, out, old)
    if affected is None:
        affected = spark.createDataFrame([], _bucketed(docs.select(*DOCUMENT), buckets).schema)
    rows = cut_lineage(_bucketed(patched(affected, targets, docs, home), buckets))
    (rows.hint("rebalance", *[F.col(c) for c in FOLDER]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*FOLDER).parquet(out + "/pack"))
    now = cut_lineage(_located(rows))
    left = {tuple(r) for r in now.select(*FOLDER).collect()}
    for folder in old:  # folders left without documents
        if tuple(folder) not in left:
            delete_below(spark, out + "/pack", f"{out}/pack/{_path(spark, folder)}")
    return _publish(spark, out, locator.join(touched, FOLDER, "left_anti").unionByName(now))
