"""Exact deduplication against a minimal perfect hash of historical digests.

`build_index` makes, for each bucket of the digest space, a minimal perfect hash over the distinct digests seen before:
level after level, digests alone in their place of a bit array stay there, the others go on to the next level; the rank
of a digest's bit is its slot. Slots hold the full 32-byte digest and the winner's locator (its doc_id). `resolve`
looks a batch up: a row whose digest equals all bytes of its slot repeats history; the others form groups of their own.

The number of buckets follows the count of distinct digests, so each has about BUCKET_KEYS; both sides are collapsed to
one row for each digest by a partial aggregate before they are dealt out, so a text that a third of all rows hold costs
one row for each task.

Defined results: null counts as the empty text; equal means identical after each run of white space ([space, tab to CR])
becomes one space; the row with the smallest doc_id stays, null ids count as largest; rows with the same id and text
count as rows of their group (each row is returned; the pipeline keeps one of them). Very long texts are hashed
whole; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, keep_winners, mix

#: Distinct digests for each bucket of the index.
BUCKET_KEYS = 50_000
#: Places for each digest that is still without one, on each level.
GAMMA = 2
INDEX = "bucket long, n long, levels array<long>, bits binary, digests binary, winners array<long>, sizes array<long>"


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest(text: str = "text") -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def _words(digests: np.ndarray) -> np.ndarray:
    return digests.view(np.uint64).reshape(-1, 4)


def _place(words: np.ndarray, level: int, places: int) -> np.ndarray:
    seed = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    return (mix(words[:, 1] ^ (words[:, 2] + seed)) % np.uint64(places)).astype(np.int64)


def perfect_hash(words: np.ndarray) -> tuple[list[int], np.ndarray]:
    """(places on each level, all bits) of a minimal perfect hash over distinct digests."""
    left, levels, bits = words, [], []
    while len(left):
        places = max(8, GAMMA * len(left))
        at = _place(left, len(levels), places)
        alone = np.bincount(at, minlength=places) == 1
        levels.append(places)
        bits.append(alone)
        left = left[~alone[at]]
    return levels, np.concatenate(bits) if bits else np.zeros(0, bool)


def slots(words: np.ndarray, levels: list[int], bits: np.ndarray) -> np.ndarray:
    """Slot of each digest, -1 if it certainly is no member; a nonmember may get any slot."""
    rank = np.cumsum(bits) - 1
    out, open_, base = np.full(len(words), -1, np.int64), np.arange(len(words)), 0
    for level, places in enumerate(levels):
        at = base + _place(words[open_], level, places)
        hit = bits[at]
        out[open_[hit]] = rank[at[hit]]
        open_, base = open_[~hit], base + places
    return out


def _raw(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, 32)


def _bucket(n: int) -> Column:
    """Bucket of a digest, from its first 60 bits."""
    return F.pmod(F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("long"), F.lit(n))


def grouped(keyed: DataFrame) -> DataFrame:
    """One row for each digest: smallest id, rows; combined in the map tasks first."""
    return keyed.groupBy("digest").agg(F.min("doc_id").alias("winner"), F.count(F.lit(1)).alias("size"))


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """One row for each bucket over `history` (digest, winner, size), digests being distinct."""
    def build(part: pd.DataFrame) -> pd.DataFrame:
        raw = _raw(part["digest"])
        levels, bits = perfect_hash(_words(raw))
        at = slots(_words(raw), levels, bits)
        order = np.empty(len(at), np.int64)
        order[at] = np.arange(len(at))
        winners = [None if pd.isna(x) else int(x) for x in part["winner"].iloc[order]]
        return pd.DataFrame([{"bucket": int(part["bucket"].iloc[0]), "n": len(part), "levels": levels, "bits": np.packbits(bits).tobytes(), "digests": raw[order].tobytes(), "winners": winners, "sizes": part["size"].to_numpy()[order].tolist()}])

    return history.withColumn("bucket", _bucket(buckets)).groupBy("bucket").applyInPandas(build, INDEX)


def resolve(batch: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """Look the distinct digests of `batch` (digest, winner, size) up: known, old_winner, old_size are added."""
    def look(rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop(columns=["bucket"])
        rows = rows.assign(known=False, old_winner=pd.Series(pd.NA, rows.index, "Int64"), old_size=np.int64(0))
        if len(rows) and len(held):
            cell = held.iloc[0]
            levels = [int(x) for x in cell["levels"]]
            bits = np.unpackbits(np.frombuffer(cell["bits"], np.uint8), count=sum(levels)).astype(bool)
            stored, raw = np.frombuffer(cell["digests"], np.uint8).reshape(-1, 32), _raw(rows["digest"])
            at = slots(_words(raw), levels, bits)
            same = (at >= 0) & (stored[np.maximum(at, 0)] == raw).all(axis=1)  # all bytes are compared
            winners = pd.array([pd.NA if x is None or x != x else int(x) for x in cell["winners"]], "Int64")
            rows["known"] = same
            rows["old_winner"] = pd.Series(winners[np.maximum(at, 0)], rows.index).where(same)
            rows["old_size"] = np.where(same, np.asarray(cell["sizes"], np.int64)[np.maximum(at, 0)], 0)
        return rows

    return batch.withColumn("bucket", _bucket(buckets)).groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(
        look, "digest binary, winner long, size long, known boolean, old_winner long, old_size long")


def classes(keyed: DataFrame) -> DataFrame:
    """digest, keep_id, group_size over `keyed` (doc_id, digest).

    The lower half of the id range is the history that the index holds, the upper half (and null ids) the batch that is
    looked up; the winner of a class is the smaller id of both.
    """
    low, high, rows = keyed.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    cut = 0 if low is None else low + (high - low) // 2
    buckets = max(1, -(-rows // BUCKET_KEYS))  # rows bound the distinct digests
    old = F.coalesce(F.col("doc_id") <= cut, F.lit(False))
    history, batch = grouped(keyed.where(old)), grouped(keyed.where(~old))
    index = cut_lineage(build_index(history, buckets))
    looked = cut_lineage(resolve(batch, index, buckets))
    members = index.select(F.explode(F.arrays_zip(F.sequence(F.lit(0), F.col("n").cast("int") - 1).alias("i"), F.col("winners").alias("winner"), F.col("sizes").alias("size"))).alias("s"), "digests").select(
        F.substring("digests", F.col("s.i") * 32 + 1, F.lit(32)).alias("digest"), F.col("s.winner").alias("winner"), F.col("s.size").alias("size"))
    seen = looked.where("known").select("digest", F.col("winner").alias("new_winner"), F.col("size").alias("new_size"))
    kept = members.join(seen, "digest", "left").select(
        "digest", F.least("winner", "new_winner").alias("keep_id"), (F.col("size") + F.coalesce("new_size", F.lit(0))).alias("group_size"))
    return kept.unionByName(looked.where("not known").select("digest", F.col("winner").alias("keep_id"), F.col("size").alias("group_size")))


def keyed_rows(docs: DataFrame) -> DataFrame:
    """doc_id and digest of every row; written once, so that the texts are read and hashed once."""
    return cut_lineage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest().alias("digest")))


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    keyed = keyed_rows(docs)
    return keyed.join(classes(keyed), "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, one for each text, with their columns."""
    keyed = keyed_rows(docs)
    same = keyed.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("win_same"))
    won = classes(keyed).select(F.col("keep_id").alias("win_id"), F.col("digest").alias("win_key"))
    winners = cut_lineage(won.join(same, won["win_id"].eqNullSafe(same["doc_id"]) & (won["win_key"] == same["digest"])).select("win_id", "win_key", "win_same"))
    return keep_winners(docs, digest(), winners)
