"""Ranked lexical search by bag deduplication.

For the score of a document only its bag matters: how often it holds each term of the items, and its length term m. One pass
restricts every document to the vocabulary of the items; documents whose bags and m are identical form a class (equal
by hash, then by all bytes), each class is scored once against all items, and only the classes that can reach a result are
expanded to members by ascending doc_id. A class whose least member is not among the best k of an item has no member
there, so the k best classes (by score, then least member) suffice for each item, and k members for each class.

Items are read in blocks of at most `block_bytes` of text, which bounds the vocabulary that is sent to the tasks; every
block is one pass over the documents. Classes are scored in the map tasks, each of which keeps the k best of an item, so
at most k rows an item and task are shuffled. Scores are 64-bit integers throughout.

Defined results: null and empty texts have no terms, are not counted in N and never found; every row of the items is an
item of its own, also when ids repeat or are null; an item without known terms has no rows; repeated documents are each
found, null ids last among equal scores; empty tables give no rows; extra columns are not read. Texts are used whole.
"""

from __future__ import annotations

import functools
import math
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showledger.operators.ranking import top_per_group

from .common import blocks, clean_text, cut_lineage

#: Terms: digits, letters and bytes of characters beyond ASCII; A-Z are lower-cased first.
TERM = re.compile(rb"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)")
TOP = 10
#: Item text (bytes) whose vocabulary is sent to the tasks at once.
BLOCK_BYTES = 1 << 20
#: Cells (classes by items) and term hits worked on at a time.
CELLS, HITS = 1 << 21, 1 << 22
BAG = "n long, bag binary"
_NO_ID = np.iinfo(np.int64).max


def terms(text: bytes) -> list[bytes]:
    return TERM.split(text.lower())[1::2]


def bags(texts: pa.Array, ids: dict[bytes, int]) -> pa.Array:
    """Number of terms and bag of each text: (term id, tf) as little-endian 32-bit pairs, by ascending term id."""
    counts, bits, sizes = np.zeros(len(texts), np.int64), [], np.zeros(len(texts), np.int64)
    for first, end, raw, offs in blocks(texts):
        data = raw.tobytes()
        parts = [data[a:b] for a, b in zip(offs[:-1], offs[1:])]
        cut = TERM.split(b"\n".join(parts).lower())  # one pass over the joined texts
        words = cut[1::2]
        places = np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))[0::2][: len(words)]
        own = np.searchsorted(np.cumsum([0, *(len(p) + 1 for p in parts)])[:-1], places, "right") - 1
        counts[first:end] = np.bincount(own, minlength=end - first)
        term = np.fromiter((ids.get(w, -1) for w in words), np.int64, len(words))
        keys, tf = np.unique(own[term >= 0] * len(ids) + term[term >= 0], return_counts=True)
        pairs = np.empty((len(keys), 2), "<u4")
        pairs[:, 0], pairs[:, 1] = keys % max(1, len(ids)), tf
        sizes[first:end] = np.bincount(keys // max(1, len(ids)), minlength=end - first) * 8
        bits.append(pairs.tobytes())
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    bag = pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(b"".join(bits))])
    return pa.StructArray.from_arrays([pa.array(counts), bag.cast(pa.binary())], ["n", "bag"])


class Items:
    """Terms of a block of items, once each."""

    def __init__(self, texts: list[str]):
        self.ids: dict[bytes, int] = {}
        owners, found = [], []
        for i, text in enumerate(texts):
            for w in dict.fromkeys(terms(text.encode())):
                owners.append(i)
                found.append(self.ids.setdefault(w, len(self.ids)))
        order = np.argsort(np.array(found, np.int64), kind="stable")
        #: items of each term, one after the other, and where those of a term begin
        self.owners = np.array(owners, np.int64)[order]
        self.begin = np.searchsorted(np.array(found, np.int64)[order], np.arange(len(self.ids) + 1))
        self.n = len(texts)


_HELD: dict[str, Items] = {}


def _held(name: str, sent) -> Items:
    """The items of a block, prepared once in each worker process."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = Items(sent.value)
    return _HELD[name]


def score_classes(items: Items, weight: np.ndarray, pairs: np.ndarray, sizes: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Scores (classes by items) of bags that lie one after the other in `pairs`."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    term, tf = pairs[:, 0].astype(np.int64), pairs[:, 1].astype(np.int64)
    value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
    n = items.begin[term + 1] - items.begin[term]
    step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    item = items.owners[np.repeat(items.begin[term], n) + step]
    out = np.zeros(len(sizes) * items.n, np.int64)
    np.add.at(out, np.repeat(row, n) * items.n + item, np.repeat(value, n))
    return out.reshape(len(sizes), items.n)


class Best:
    """The k best (score, least member) classes of each item so far, with what names them."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.item, self.score, self.rep = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.names: list = []
        self.least, self.last = np.zeros(n, np.int64), np.full(n, _NO_ID)

    def add(self, scores: np.ndarray, rep: np.ndarray, names: list) -> None:
        better = (scores > self.least) | ((scores == self.least) & (scores > 0) & (rep[:, None] < self.last))
        at, item = np.nonzero(better)
        if not len(at):
            return
        items, found, reps = np.concatenate([self.item, item]), np.concatenate([self.score, scores[at, item]]), np.concatenate([self.rep, rep[at]])
        order = np.lexsort((reps, -found, items))
        place = np.arange(len(order)) - np.searchsorted(items[order], items[order])
        order = order[place < self.k]
        old = len(self.names)
        self.names = [self.names[i] if i < old else names[at[i - old]] for i in order]
        self.item, self.score, self.rep = items[order], found[order], reps[order]
        full = np.flatnonzero(np.bincount(self.item, minlength=len(self.least)) == self.k)
        end = np.searchsorted(self.item, full, "right") - 1
        self.least[full], self.last[full] = self.score[end], self.rep[end]


def _best_classes(classes: DataFrame, items, weight: np.ndarray, top: int) -> DataFrame:
    """item, score, rep, hash, bag, m of the best classes of every task; `classes` has rep, hash, m, bag."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = items()
        best = Best(own.n, top)
        count = own.begin[1:] - own.begin[:-1]
        for batch in batches:
            bag = batch.column("bag")
            sizes = np.asarray(pc.binary_length(bag)).astype(np.int64) // 8
            pairs = np.frombuffer(b"".join(bag.to_pylist()), "<u4").reshape(-1, 2)
            edge = np.concatenate([[0], np.cumsum(sizes)])
            hits = np.concatenate([[0], np.cumsum(count[pairs[:, 0]])])[edge]  # hits before each class
            rep = np.asarray(pc.fill_null(batch.column("rep"), _NO_ID))
            m, name = np.asarray(batch.column("m")), list(zip(batch.column("hash").to_pylist(), range(batch.num_rows)))
            first, wide = 0, max(1, CELLS // max(1, own.n))
            kept = {}
            while first < batch.num_rows:
                end = max(first + 1, min(first + wide, int(np.searchsorted(hits, hits[first] + HITS, "right")) - 1))
                scores = score_classes(own, weight, pairs[edge[first] : edge[end]], sizes[first:end], m[first:end])
                best.add(scores, rep[first:end], name[first:end])
                first = end
            # names of this batch become whole keys, once for each class
            for j, x in enumerate(best.names):
                if len(x) == 2:
                    if x not in kept:
                        kept[x] = (x[0], bag[x[1]].as_py(), int(m[x[1]]))
                    best.names[j] = kept[x]
        reps = pa.array([None if r == _NO_ID else int(r) for r in best.rep], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item), pa.array(best.score), reps, *[pa.array([x[i] for x in best.names], kind) for i, kind in enumerate((pa.int64(), pa.binary(), pa.int64()))]],
            ["item", "score", "rep", "hash", "bag", "m"])

    return classes.select("rep", "hash", "m", "bag").mapInArrow(run, "item long, score long, rep long, hash long, bag binary, m long")


def _document_counts(rows: DataFrame, n: int) -> np.ndarray:
    """Documents that hold each term."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4").reshape(-1, 2)[:, 0], minlength=n)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["term", "df"])

    out = np.zeros(n, np.int64)
    for row in rows.select("bag").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df")).collect():  # one row a term of the block
        out[row[0]] = row[1]
    return out


def _search(docs: DataFrame, block: DataFrame, top: int) -> DataFrame:
    spark = docs.sparkSession
    rows = block.collect()  # one block: its size is bounded
    name, sent = uuid.uuid4().hex, spark.sparkContext.broadcast([r["text"] for r in rows])
    items = functools.partial(_held, name, sent)
    made = F.arrow_udf(lambda texts: bags(texts, items().ids), BAG)(clean_text())
    found = cut_lineage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), made.alias("made")).select("doc_id", "made.*").where("n > 0"))
    n_docs, n_terms = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_vocabulary = len(Items([r["text"] for r in rows]).ids)
    df = _document_counts(found, n_vocabulary)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    m = F.expr(f"10 + (90 * n * {n_docs}L) div {max(1, n_terms)}L").cast("long")
    keyed = found.where(F.octet_length("bag") > 0).select("doc_id", "bag", m.alias("m")).withColumn("hash", F.xxhash64("bag", "m"))
    key = ["hash", "bag", "m"]  # grouping by the hash and all bytes: equal hashes alone make no class
    classes = keyed.groupBy(*key).agg(F.min("doc_id").alias("rep"))
    best = top_per_group(_best_classes(classes, items, weight, top), ["item"], [F.col("score").desc(), F.col("rep").asc_nulls_last(), *key], top)
    winners = cut_lineage(best)
    near = keyed.join(F.broadcast(winners.select("hash").distinct()), "hash", "left_semi")  # at most `top` hashes an item of the block
    members = top_per_group(near, key, [F.col("doc_id").asc_nulls_last()], top)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    placed = winners.join(members, key).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    kind = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", block.schema["item_id"].dataType)])
    ids = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], kind)
    return placed.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")  # ids of one block


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score of the `top` best documents of every item."""
    held = items.select("item_id", clean_text().alias("text"))
    size = held.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    parts = [_search(docs, held.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i), top) for i in range(n)]
    return functools.reduce(DataFrame.unionByName, parts)
