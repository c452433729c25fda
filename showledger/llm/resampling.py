"""Target-distribution importance resampling over hashed n-grams.

A batch of texts is joined with a separator sentinel, one regular-expression pass over the joined bytes finds all words,
and a binary search of their places among the offsets of the documents tells which document each belongs to; runs of
words whose ends lie in different documents are masked before the buckets are counted. A feature is a run of up to
`ngrams` words, its bucket the CRC-32 of its bytes modulo `buckets`.

Counts of both corpora come from all texts: each task adds its batches up and hands on one row for each bucket, so the
shuffle is at most `buckets` rows a task, whatever a task reads. The gains (`buckets` integers) go to the tasks; a second
pass adds them up for each document. Gumbel noise from a hash of the id turns the weights into an exact draw without
replacement, and the drawn rows are numbered by a range sort of narrow rows, not in one task.

Defined results: null and empty texts have no words (weight 0, never drawn); a null id is hashed as an empty one and comes
last among equal scores; repeated rows are documents of their own; an empty target or corpus only leaves the smoothing
terms; empty tables give no rows; extra columns are not read by `report` and kept by `resample`. Texts are used whole.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showledger.operators.ranking import dense_index

from .common import blocks, clean_text, cut_lineage, unused

#: Words: digits, letters (A-Z are lower-cased first) and bytes of characters beyond ASCII.
WORD = re.compile(rb"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)")
#: Between two texts of a batch; no word holds it.
SENTINEL = b"\n"
NGRAMS, BUCKETS, SEED = 1, 10_000, 2024
#: Fewest words of a document that may be drawn, and the share drawn in percent.
MIN_WORDS, PERCENT = 20, 10


def batch_features(texts: list[bytes], ngrams: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, text of each feature, bucket of each feature)."""
    joined = SENTINEL.join(texts).lower()  # bytes: only A-Z change
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    parts = WORD.split(joined)  # gap, word, gap, word, ..., gap
    words = parts[1::2]
    places = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))[0::2][: len(words)]
    own = np.searchsorted(offsets, places, "right") - 1
    crc_of = {w: zlib.crc32(w) for w in set(words)}
    state = list(map(crc_of.__getitem__, words))
    of, found = [own], [np.array(state, np.int64) % buckets]
    for n in range(2, ngrams + 1):
        state = [zlib.crc32(w, zlib.crc32(b" ", c)) for w, c in zip(words[n - 1 :], state)]
        same = own[: len(state)] == own[n - 1 :]  # runs over a sentinel are no features
        of.append(own[: len(state)][same])
        found.append((np.array(state, np.int64) % buckets)[same])
    return np.bincount(own, minlength=len(texts)), np.concatenate(of), np.concatenate(found)


def _batches(texts: pa.Array, ngrams: int, buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    for first, end, raw, offs in blocks(texts):
        data = raw.tobytes()
        yield first, end, *batch_features([data[a:b] for a, b in zip(offs[:-1], offs[1:])], ngrams, buckets)


def bucket_counts(df: DataFrame, ngrams: int = NGRAMS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts in each bucket that has any."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, _, found in _batches(batch.column(0), ngrams, buckets):
                total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["bucket", "n"])

    return df.select(clean_text().alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, ngrams: int = NGRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket: 1000 times the log ratio of the smoothed shares, rounded down."""
    held = []
    for df in (docs, target):
        n = np.zeros(buckets, np.int64)
        for row in bucket_counts(df, ngrams, buckets).collect():  # at most `buckets` rows
            n[row[0]] = row[1]
        held.append(n)
    s, t = held
    all_s, all_t = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array([math.floor(1000 * math.log((float(b) + 1) * all_s / ((float(a) + 1) * all_t))) for a, b in zip(s.tolist(), t.tolist())], np.int64)


def weights(gain: np.ndarray, ngrams: int = NGRAMS) -> Column:
    """Struct of n_words, n_features, weight over the column `text`."""
    def of(texts: pa.Array) -> pa.Array:
        out = np.zeros((3, len(texts)), np.int64)
        for first, end, n_words, own, found in _batches(texts, ngrams, len(gain)):
            out[0, first:end] = n_words
            out[1, first:end] = np.bincount(own, minlength=end - first)
            np.add.at(out[2, first:end], own, gain[found])
        return pa.StructArray.from_arrays([pa.array(x) for x in out], ["n_words", "n_features", "weight"])

    return F.arrow_udf(of, "n_words long, n_features long, weight long")(clean_text())


def noise(seed: int = SEED) -> Column:
    """Gumbel noise of a document id, times 1000 and rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def ranked(docs: DataFrame, target: DataFrame, ngrams: int = NGRAMS, buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """Rows of `docs` without their text, with n_words, n_features, weight, score and rank (null: not drawn)."""
    gain = gains(docs, target, ngrams, buckets)
    scored = cut_lineage(docs.select(*[c for c in docs.columns if c != "text"], weights(gain, ngrams).alias("made"))
                         .select("*", "made.*").drop("made").withColumn("score", F.col("weight") + noise(seed)))
    may = scored.where(F.col("n_words") >= min_words)
    drawn = may.count() * percent // 100
    placed = dense_index(may, [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "rank")
    some = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    return some.unionByName(scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long")))


def report(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return ranked(narrow, target, **settings).select("doc_id", "n_features", "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The drawn rows of `docs`, with their columns; texts are joined by row, only those of drawn rows are kept."""
    row = unused(docs, "row_at")
    marked = cut_lineage(docs.withColumn(row, F.struct("doc_id", F.monotonically_increasing_id().alias("at"))))  # ids are fixed here
    narrow = marked.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(row).alias("row_at"))
    won = ranked(narrow, target, **settings).where("rank is not null").select(F.col("row_at.at").alias("won_at"))
    return marked.join(won, F.col(row)["at"] == F.col("won_at"), "left_semi").select(*docs.columns)
