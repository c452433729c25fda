"""Session helpers: settings, lineage cuts and plan-size checks."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators are written for. All of them can be changed on
# a running session, so `configure` also works on a session somebody else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # pages are wide: 1,000 of 100 KB make a 100 MB batch, the default 10,000 a 1 GB one; only sessions built here get it
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def build_session(app: str = "showledger", master: str | None = None, **conf) -> SparkSession:
    """Create (or reuse) a session with the engine's settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, str(value))
    return configure(builder.getOrCreate())


def adopt(spark: SparkSession) -> SparkSession:
    """Make a session that somebody else built usable: times are read as UTC, tasks can import this package. Nothing else changes."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for each context, so that tasks can import it wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_showledger_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    made = os.path.join(tempfile.mkdtemp(prefix="spark-showledger-"), "showledger.zip")
    with zipfile.ZipFile(made, "w", zipfile.ZIP_DEFLATED) as pack:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    pack.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(made)
    context._showledger_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder (`spark.checkpoint.dir`).

    Only a local-mode session may fall back to a temporary folder; on a cluster
    a machine-local path would be lost with its executor.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or getattr(context, "_showledger_shared", None)
    if named:
        return named
    if re.fullmatch(r"local(\[.*\])?", context.master):
        context._showledger_shared = tempfile.mkdtemp(prefix="spark-showledger-", dir="/tmp")
        return context._showledger_shared
    raise RuntimeError("spark.checkpoint.dir must name a shared folder")


def delete_below(spark: SparkSession, root: str, path: str) -> None:
    """Delete `path`, which must lie below the folder `root`: anything else (an empty path is the working directory) is refused."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    if not root or not path:
        raise ValueError("root and path must be named")
    top, target = hadoop(root), hadoop(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    whole, below = fs.makeQualified(top).toString().rstrip("/"), fs.makeQualified(target).toString()
    if not below.startswith(whole + "/") or "/../" in below + "/":
        raise ValueError(f"{below} is not below {whole}")
    fs.delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives executor loss."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


@contextlib.contextmanager
def dropped_shuffles(spark: SparkSession):
    """Plans made and run inside remove their shuffle files at their end; the session's setting is put back afterwards."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's own upper estimate of the size of `df`."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    """`spark.sql.autoBroadcastJoinThreshold` in bytes (-1 when disabled)."""
    return _bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))


def _bytes(setting: str) -> int:
    """A Spark size setting such as `10485760`, `10MB` or `-1` in bytes."""
    raw = setting.strip().lower()
    units = {"kb": 1 << 10, "mb": 1 << 20, "gb": 1 << 30, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "b": 1}
    for suffix, factor in units.items():
        if raw.endswith(suffix):
            return int(raw[: -len(suffix)]) * factor
    return int(raw)


def fits_broadcast(df: DataFrame) -> bool:
    """True when the estimate of `df` is below the session's broadcast limit."""
    return estimated_bytes(df) <= broadcast_limit(df.sparkSession)


#: Estimated bytes up to which `spread` deals rows out.
SPREAD_BYTES = 64 << 20


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small input over the cores before CPU-heavy work.

    Only inputs of at most SPREAD_BYTES are dealt out, whatever the number of cores;
    larger ones are returned as they are, so no text or page column is shuffled at
    scale. The case helped is a small file that one task would process alone.
    """
    if df.isStreaming or estimated_bytes(df) > SPREAD_BYTES:
        return df
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes", "134217728"))
    few = 4 * (estimated_bytes(df) // split + 1) <= cores
    return df.repartition(cores) if few else df
