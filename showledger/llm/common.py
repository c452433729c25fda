"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from showledger.session import cut_lineage, dropped_shuffles

__all__ = ["blocks", "clean_text", "crc_mod", "cut_lineage", "dropped_shuffles", "keep_winners", "mix", "read", "unused"]

#: Bytes of text that one numpy step works on; a longer single text is a step of its own.
BLOCK_BYTES = 2 << 20


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def clean_text(name: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def crc_mod(name: str, n: int) -> Column:
    """crc32 of the id written as text, modulo n (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % n


def unused(df: DataFrame, base: str) -> str:
    """A column name that `df` does not have (names are compared without case)."""
    have = {c.lower() for c in df.columns}
    name = base
    while name.lower() in have:
        name += "_"
    return name


def keep_winners(docs: DataFrame, key: Column, winners: DataFrame) -> DataFrame:
    """Rows of `docs` named by `winners` (win_id, win_key, win_same), once each, with the columns of `docs`.

    `key` tells texts apart; a winner is one (id, text). win_same is the number of rows that share both: where it is
    above 1 the rows are collapsed by a partial aggregate, so that a huge group of repeated rows meets in no task.
    """
    mark = unused(docs, "win_mark")
    marked = docs.withColumn(mark, key)
    on = marked["doc_id"].eqNullSafe(winners["win_id"]) & (marked[mark] == winners["win_key"])
    once = marked.join(winners.where("win_same = 1"), on, "left_semi").select(*docs.columns)
    many = marked.join(winners.where("win_same > 1"), on, "left_semi")
    rest = [c for c in docs.columns if c != "doc_id"]
    first = many.groupBy("doc_id", mark).agg(F.min(F.struct(*rest)).alias("win_row") if _orderable(docs) else F.first(F.struct(*rest)).alias("win_row"))
    return once.unionByName(first.select("doc_id", "win_row.*").select(*docs.columns))


def _orderable(df: DataFrame) -> bool:
    return not any(kind.startswith(("map", "variant")) or "map<" in kind for _, kind in df.dtypes)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (the public splitmix64 constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def blocks(texts: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about BLOCK_BYTES; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    start = 0
    while start < n:
        end = max(start + 1, int(np.searchsorted(offs, offs[start] + BLOCK_BYTES, "right")) - 1)
        yield start, end, raw[offs[start] : offs[end]], offs[start : end + 1] - offs[start]
        start = end
