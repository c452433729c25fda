"""Benchmark decontamination by winnowing.

Words are runs of digits, letters a-z (A-Z is lower-cased) and characters beyond ASCII. A window is 13 consecutive words
of a benchmark item, or all words of a shorter one. For windows of L words the operator keeps, of each sliding window of
L - k + 1 hashes of k words (k = min(5, L)), the smallest (the last one on a tie). A text and an item that share L words
then share a kept hash for certain, so joining the kept hashes of both sides finds every occurrence; each hit is
extended to the windows around it, which are compared by hash and then word by word.

The fingerprints of the benchmark are joined on the map side: the items are read in blocks of at most `block_bytes` of
text, one broadcast for each, whose size is thereby bounded. A benchmark of one block needs no shuffle; more blocks are
more passes over the texts, and their hits are united for each text.

Defined results: null and empty texts have no words and are never hit; an item without words has no window; repeated
items and items with the same words are all reported; a null item_id is written as an empty string; repeated document
rows are each reported; empty tables give no rows or no hits; extra columns are not read. Texts are used whole.
"""

from __future__ import annotations

import functools
import uuid
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, clean_text, mix

#: Words of a window; words of a hashed k-gram.
WINDOW, GRAM = 13, 5
#: Benchmark text (bytes) held by one broadcast.
BLOCK_BYTES = 16 << 20

HITS = "n_words long, spans array<int>, items array<string>"
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)

_LOWER = np.zeros(256, np.uint8)
_LOWER[0x30:0x3A] = np.arange(0x30, 0x3A)
_LOWER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LOWER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LOWER[0x80:] = np.arange(0x80, 0x100)


@functools.lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    up, down = np.full(n, _BASE, np.uint64), np.full(n, _BASE_INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def words(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray = _LOWER) -> tuple[np.ndarray, ...]:
    """(hash, first byte, end byte, text) of every word, and the bytes as the table maps them (0: no word)."""
    low = table[raw]
    inside = low != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = offsets[:-1][offsets[:-1] < len(raw)]
    first[edge] = inside[edge]
    start = np.flatnonzero(first)
    if not len(start):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none, low
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = edge[edge > 0] - 1
    last[cut] = inside[cut]
    end = np.flatnonzero(last) + 1
    up, down = _powers(max(12, int(len(raw)).bit_length()))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=total[1:])
    h = (total[end] - total[start]) * down[start]
    return mix(h + (end - start).astype(np.uint64) * _STEP), start, end, np.searchsorted(offsets, start, "right") - 1, low


def gram_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on (places too near the end are left out)."""
    n = max(0, len(h) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _STEP + h[j : j + n]
    return mix(out)


def kept_places(h: np.ndarray, text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the k-grams that winnowing keeps for windows of `length` words; texts are kept apart."""
    k = min(GRAM, length)
    wide = length - k + 1
    grams = gram_hash(h, k)
    n = len(grams) - wide + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    best, at = grams[wide - 1 : wide - 1 + n].copy(), np.arange(wide - 1, wide - 1 + n)
    for j in range(wide - 2, -1, -1):  # from the right, so that the last of equal hashes stays
        other = grams[j : j + n]
        less = other < best
        best[less], at[less] = other[less], (np.arange(j, j + n))[less]
    whole = text[:n] == text[length - 1 : length - 1 + n]
    at = np.unique(at[whole])
    return at, grams[at]


class Index:
    """Windows and fingerprints of a block of items."""

    def __init__(self, items: list[tuple[str, str]]):
        self.names = [name for name, _ in items]
        self.windows: dict[int, dict[bytes, set[int]]] = defaultdict(lambda: defaultdict(set))
        prints: dict[int, list[np.ndarray]] = defaultdict(list)
        hashes: dict[int, list[np.ndarray]] = defaultdict(list)
        base = 0
        for first, end, raw, offs in blocks(pa.array([t for _, t in items], pa.string())):
            h, start, stop, text, low = words(raw, offs)
            text = text + first
            data = low.tobytes()
            for t in range(first, end):
                a, b = np.searchsorted(text, [t, t + 1])
                length = min(WINDOW, int(b - a))
                if not length:
                    continue
                prints[length].append(kept_places(h[a:b], text[a:b], length)[1])
                hashes[length].append(gram_hash(h[a:b], length))
                own = [data[start[i] : stop[i]] for i in range(a, b)]
                for i in range(len(own) - length + 1):
                    self.windows[length][b" ".join(own[i : i + length])].add(t)
            base = end
        assert base == len(items)
        self.prints = {n: np.unique(np.concatenate(x)) for n, x in prints.items()}
        self.hashes = {n: np.unique(np.concatenate(x)) for n, x in hashes.items()}


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    at = np.searchsorted(among, values)
    at[at == len(among)] = 0
    return among[at] == values


def find(index: Index, texts: pa.Array) -> pa.Array:
    """Struct of HITS for each text."""
    n_words = np.zeros(len(texts), np.int64)
    covered, items = defaultdict(list), defaultdict(set)
    for first, end, raw, offs in blocks(texts):
        h, start, stop, text, low = words(raw, offs)
        n_words[first:end] = np.bincount(text, minlength=end - first)
        begin = np.searchsorted(text, np.arange(end - first))
        for length, prints in index.prints.items():
            at, value = kept_places(h, text, length)
            at = at[_member(value, prints)]
            if not len(at):
                continue
            # all windows that contain the k-gram, within its text
            wide = length - min(GRAM, length) + 1
            starts = np.unique((at[:, None] - np.arange(wide)[None, :]).ravel())
            starts = starts[(starts >= 0) & (starts + length <= len(h))]
            starts = starts[text[starts] == text[starts + length - 1]]
            grams = np.zeros(len(starts), np.uint64)
            for j in range(length):
                grams = grams * _STEP + h[starts + j]
            starts = starts[_member(mix(grams), index.hashes[length])]
            for s in starts:
                found = index.windows[length].get(b" ".join(low[start[i] : stop[i]].tobytes() for i in range(s, s + length)))
                if found:
                    t = int(text[s])
                    covered[first + t].append((int(s - begin[t]), int(s - begin[t]) + length))
                    items[first + t] |= found
    spans = [merged(covered[i]) if i in covered else [] for i in range(len(texts))]
    names = [sorted({index.names[x] for x in items[i]}) if i in items else [] for i in range(len(texts))]
    return pa.StructArray.from_arrays(
        [pa.array(n_words), pa.array(spans, pa.list_(pa.int32())), pa.array(names, pa.list_(pa.string()))], ["n_words", "spans", "items"])


def merged(spans) -> list[int]:
    """Union of word spans as a flat list start, end, start, end, ..."""
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


_HELD: dict[str, Index] = {}


def _held(name: str, items) -> Index:
    """The index of a broadcast block, built once in each worker process."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = Index(items.value)
    return _HELD[name]


def _finder(block: DataFrame) -> Column:
    rows = [(r[0], r[1]) for r in block.collect()]  # one block: its size is bounded
    name, sent = uuid.uuid4().hex, block.sparkSession.sparkContext.broadcast(rows)
    return F.arrow_udf(lambda texts: find(_held(name, sent), texts), HITS)(clean_text())


def finders(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[Column]:
    """A column of HITS over `text` for each block of items."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), clean_text().alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    return [_finder(items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)) for i in range(n)]


def n_hit(spans: str | Column) -> Column:
    """Words covered by merged spans."""
    spans = F.col(spans) if isinstance(spans, str) else spans
    sign = F.transform(spans, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    return F.aggregate(sign, F.lit(0).cast("long"), lambda a, x: a + x)


def occurrences(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, text_key, n_words, spans, items of every row."""
    found = finders(benchmark, block_bytes)
    key = F.md5(clean_text())
    parts = [docs.select("doc_id", key.alias("text_key"), hit.alias("hit")).select("doc_id", "text_key", "hit.*") for hit in found]
    if len(parts) == 1:
        return parts[0]
    union = functools.reduce(DataFrame.unionByName, parts)
    join = F.udf(lambda lists: merged([s for x in lists for s in zip(x[::2], x[1::2])]), "array<int>", useArrow=True)
    whole = union.groupBy("doc_id", "text_key").agg(
        F.max("n_words").alias("n_words"), F.collect_set("spans").alias("all_spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        (F.count(F.lit(1)) / len(parts)).cast("int").alias("times"))
    return whole.select(
        "doc_id", "text_key", "n_words", join("all_spans").alias("spans"), "items", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("time")).drop("time")


def is_contaminated(n_words: Column, hit: Column) -> Column:
    return (hit > 0) & (hit * 20 >= n_words)


def report(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The contract's digest of `occurrences`."""
    found = occurrences(docs, benchmark, block_bytes).withColumn("n_hit", n_hit("spans"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The clean rows of `docs`, with their columns."""
    found = finders(benchmark, block_bytes)
    if len(found) == 1:
        hit = found[0]
        return docs.where(~is_contaminated(hit["n_words"], n_hit(hit["spans"])))
    bad = occurrences(docs, benchmark, block_bytes).where(is_contaminated(F.col("n_words"), n_hit("spans"))).select(
        F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.md5(clean_text()) == bad["bad_key"]), "left_anti").select(*docs.columns)
