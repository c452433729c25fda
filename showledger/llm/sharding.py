"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

1. Each source partition permutes its rows: they are sorted by a random key within the partition.
2. The driver draws how many rows each partition sends to each shard: the rows of the matrix are drawn one after another
   from the multivariate hypergeometric law of the places still free, so every shard gets its exact size and the matrix
   has the law of a uniform permutation. The matrix has one row for each source partition (none for each row).
3. Rows are exchanged: the first so many rows of a permuted partition go to shard 0, the next to shard 1, and so on.
4. Each shard is permuted again: one range shuffle on (shard, second random key) serves exchange and second permutation;
   the place of a row in that order, less the sizes of the shards before it, is its slot. A shard is spread over many
   tasks, so no task holds a whole shard.

Law: `rows` - the counts of the shards are at most one apart. The random keys depend on the seed and on the row's place
in the input; the permuted input is checkpointed before anything is drawn, so a lost executor cannot change them.

The draws are numpy's below LIBRARY free places, and by inversion of the same law above.

Defined results: a null text has size 1 and the crc of no bytes; null and repeated ids and repeated rows each take a
place of their own; an empty table gives no rows; fewer rows than shards leave shards empty; other columns are carried
along (a clash with shard or slot is refused).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import clean_text, cut_lineage, unused

SHARDS, SEED = 16, 20_240_501
#: Places from which numpy draws no hypergeometric numbers.
LIBRARY = 1_000_000_000
_LOCAL = (1 << 33) - 1  # a row's number within its partition, as monotonically_increasing_id counts


def matrix(counts: list[int], sizes: list[int], seed: int) -> np.ndarray:
    """Rows that each partition (counts) sends to each shard (sizes); both add up to the same."""
    draw, free = np.random.default_rng(seed), np.asarray(sizes, np.int64).copy()
    out = np.zeros((len(counts), len(sizes)), np.int64)
    for i, n in enumerate(counts):
        left, rest = int(n), int(free.sum())
        for j in range(len(sizes) - 1):  # one hypergeometric draw for each shard; the last takes what remains
            rest -= int(free[j])
            out[i, j] = _hypergeometric(draw, int(free[j]), rest, left)
            left -= int(out[i, j])
        out[i, -1] = left
        free -= out[i]
    return out


def _hypergeometric(draw: np.random.Generator, good: int, bad: int, n: int) -> int:
    if not n or not good:
        return 0
    if not bad:
        return n
    if good + bad < LIBRARY:
        return int(draw.hypergeometric(good, bad, n))
    return _by_inversion(draw, good, bad, n)


def _by_inversion(draw: np.random.Generator, good: int, bad: int, n: int) -> int:
    """The same law at any size: probabilities run from the mode by their exact ratios as far as doubles tell them from 0."""
    low, high = max(0, n - bad), min(good, n)
    mode = min(high, max(low, (n + 1) * (good + 1) // (good + bad + 2)))
    weights, steps = {}, {}
    for sign, end in ((1, high), (-1, low)):
        parts, at, last = [], mode, 1.0
        while at != end and last > 1e-30:
            k = np.arange(at, at + sign * min(1 << 16, abs(end - at)), sign, dtype=float)
            up = (good - k) * (n - k) / ((k + 1) * (bad - n + k + 1)) if sign > 0 else k * (bad - n + k) / ((good - k + 1) * (n - k + 1))
            parts.append(last * np.cumprod(up))
            last, at = float(parts[-1][-1]), at + sign * len(k)
        weights[sign] = np.concatenate(parts) if parts else np.zeros(0)
        steps[sign] = len(weights[sign])
    total = np.cumsum(np.concatenate([weights[-1][::-1], [1.0], weights[1]]))
    return mode - steps[-1] + int(np.searchsorted(total, draw.random() * total[-1], "right"))


def shard_rows(df: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """`df` with shard (int) and slot (long)."""
    clash = {c.lower() for c in df.columns} & {"shard", "slot"}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are there already")
    key, at, second = unused(df, "first_key"), unused(df, "row_at"), unused(df, "second_key")
    spark = df.sparkSession
    place = F.monotonically_increasing_id()
    permuted = cut_lineage(df.withColumn(key, F.xxhash64(F.lit(seed), place)).sortWithinPartitions(key).drop(key).withColumn(at, place))

    part = F.shiftright(F.col(at), 33)
    counts = sorted((r[0], r[1]) for r in permuted.groupBy(part.alias("part")).count().collect())  # one row for each partition
    total = sum(n for _, n in counts)
    sizes = [total // shards + (i < total % shards) for i in range(shards)]
    ends = np.cumsum(matrix([n for _, n in counts], sizes, seed), axis=1)
    name, bounds = unused(df, "part"), unused(df, "bounds")
    table = spark.createDataFrame([(int(p), [int(x) for x in row]) for (p, _), row in zip(counts, ends)], f"{name} long, {bounds} array<long>")
    local = F.col(at).bitwiseAND(F.lit(_LOCAL))
    sent = permuted.withColumn(name, part).join(table, name).withColumn("shard", F.size(F.filter(F.col(bounds), lambda e: e <= local))).drop(name, bounds)

    # exchange and second permutation
    mixed = sent.withColumn(second, F.xxhash64(F.lit(seed + 1), F.col(at))).drop(at)
    ordered = mixed.repartitionByRange("shard", second).sortWithinPartitions("shard", second).drop(second).withColumn(at, place)
    placed = cut_lineage(ordered)
    before, offsets = 0, []
    for p, n in sorted((r[0], r[1]) for r in placed.groupBy(part.alias("part")).count().collect()):
        offsets.append((int(p), before))
        before += n
    start = unused(df, "start")
    starts = spark.createDataFrame(offsets, f"{name} long, {start} long")
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]]).tolist()
    less = F.element_at(F.array(*[F.lit(int(x)).cast("long") for x in first]), F.col("shard") + 1)
    return placed.withColumn(name, part).join(starts, name).withColumn("slot", F.col(start) + local - less).select(*df.columns, "shard", "slot")


def report(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    rows = docs.select("doc_id", (F.octet_length(clean_text()) + 1).cast("long").alias("size"), F.crc32(clean_text().cast("binary")).alias("text_crc32"))
    return shard_rows(rows, shards, seed).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
