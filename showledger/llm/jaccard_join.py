"""N-gram Jaccard join by chosen paths.

Texts are sets of shingles of five words (runs of anything but white space, A-Z lower-cased); two texts are linked when
the Jaccard similarity of their sets is `THRESHOLD` or more. Equal texts are collapsed to one first.

Each set is embedded as SIZE sampled tokens (the minimum of its shingles under SIZE hash functions). A run starts with
all sets in one node. A node chooses one or two of the SIZE places by its own hash (on average 1 / THRESHOLD), and a set
goes on to the child named by its sampled token there; so a pair of similarity s shares s / THRESHOLD of the children on
average, and its trace does not die out. The first levels are computed in the map tasks without any shuffle. Nodes of
one set are dropped, nodes of up to LIMIT sets are searched by brute force over the embedded tokens, larger ones split
on; the few that are still large at DEPTH hold sets that share that many sampled tokens and are taken whole. All runs
use the same SIZE tokens, and a pair at the threshold agrees in a binomial number of them; the runs are chosen so that,
averaged over it, the pair is found with probability RECALL, even at the last level. More runs than the first ones are
made only of the sets that meet in large nodes: a pair that never meets in one is searched at the first level.

What is found makes candidate groups (components); within them every pair is compared by its exact shingle sets, in
tasks of two blocks of at most BLOCK shingles, so a group of any size meets in no single task. Links are counted there
and never written as pairs.

Defined results: null counts as the empty text; a text of one to four words is one shingle; a text without words is
linked to equal texts only; rows of equal texts are in one class (each is a link of the others); null ids are allowed
(the class id is the smallest id that is not null); repeated rows count as documents of their own; an empty table gives
no rows; very long texts are used whole; extra columns are not read.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, clean_text, cut_lineage, keep_winners, mix
from .components import components
from .winnowing import gram_hash, words

#: Similarity of a link; words of a shingle; probability of finding a link.
THRESHOLD, GRAM, RECALL = 0.8, 5, 0.999
#: Sampled tokens of a set; levels made in the map tasks; last level; sets of a node for brute force.
SIZE, FIRST, DEPTH, LIMIT = 64, 3, 10, 1024
#: Shingles of one block of a candidate group.
BLOCK = 1 << 20

_WORDS = np.arange(256, dtype=np.uint8)
_WORDS[0x41:0x5B] = np.arange(0x61, 0x7B)
_WORDS[0] = 0xFF  # a byte that UTF-8 never has stands for NUL; 0 marks white space
_WORDS[[0x20, *range(0x09, 0x0E)]] = 0


def _odd(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


# -- shingles and embedding ----------------------------------------------------

def shingles(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, shingle hashes, row of each) block by block; rows in order, repeats still there."""
    for first, end, raw, offs in blocks(texts):
        h, _, _, text, _ = words(raw, offs, _WORDS)
        grams = gram_hash(h, GRAM)
        whole = text[: len(grams)] == text[GRAM - 1 : GRAM - 1 + len(grams)] if len(grams) else np.zeros(0, bool)
        made, of = grams[whole], text[: len(grams)][whole]
        count = np.bincount(text, minlength=end - first)
        short = np.flatnonzero((count > 0) & (count < GRAM))
        if len(short):
            start = np.searchsorted(text, short)
            own = np.array([gram_hash(h[a : a + n], int(n))[0] + np.uint64(n) for a, n in zip(start, count[short])], np.uint64)
            made, of = np.concatenate([made, mix(own)]), np.concatenate([of, short])
            order = np.argsort(of, kind="stable")
            made, of = made[order], of[order]
        yield first, end, made, of


def embed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(has shingles, SIZE sampled tokens of 16 bits) of each text."""
    sig, some = np.zeros((len(texts), SIZE), np.uint16), np.zeros(len(texts), bool)
    factors, add = _odd(SIZE, 11), _odd(SIZE, 12)
    for first, _, made, of in shingles(texts):
        if not len(made):
            continue
        rows, start = np.unique(of, return_index=True)
        some[first + rows] = True
        for k in range(SIZE):
            # the minimum over the high bits of a multiply-add hash; mixed before it is cut to 16 bits
            low = np.minimum.reduceat((made * factors[k] + add[k]) >> np.uint64(16), start)
            sig[first + rows, k] = (mix(low) & np.uint64(0xFFFF)).astype(np.uint16)
    return some, sig


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        some, sig = embed(b.column("text"))
        yield pa.RecordBatch.from_arrays([b.column("key"), b.column("doc_id"), pa.array([s.tobytes() if x else None for s, x in zip(sig, some)], pa.binary())], ["key", "doc_id", "sig"])


# -- paths ---------------------------------------------------------------------

def survival(depth: int, similarity: float = THRESHOLD) -> float:
    """Probability that a pair of this similarity still shares a node after `depth` levels of one run."""
    two = 1 / THRESHOLD - 1
    gone = 0.0
    for _ in range(depth):
        lost = 1 - similarity + similarity * gone
        gone = (1 - two) * lost + two * lost * lost
    return 1 - gone


def runs_for(recall: float = RECALL, depth: int = DEPTH) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - survival(depth)))


def least_agreement(threshold: float = THRESHOLD) -> int:
    """Sampled tokens in which a pair within a node must agree to be a candidate."""
    return math.floor(SIZE * (threshold - 4 * math.sqrt(threshold * (1 - threshold) / SIZE)))


def loss(runs: float, depth: int) -> float:
    """Probability that a pair at the threshold is not found by `runs` runs to `depth`.

    The runs share the SIZE sampled tokens, in a binomial number of which the pair agrees.
    """
    law = ((k, math.comb(SIZE, k) * THRESHOLD**k * (1 - THRESHOLD) ** (SIZE - k)) for k in range(SIZE + 1))
    return sum(p * ((1 - survival(depth, k / SIZE)) ** runs if k >= least_agreement() else 1.0) for k, p in law)


def runs_within(lost: float, depth: int, first: int = 1) -> int:
    """Least number of runs, from `first` on, that lose at most the share `lost` of the pairs at the threshold."""
    if loss(math.inf, depth) >= lost:
        raise ValueError(f"{SIZE} sampled tokens are too few to lose at most {lost} of the pairs")
    return next(r for r in itertools.count(first) if loss(r, depth) <= lost)


def split(nodes: np.ndarray, rows: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Children of each (node, row)."""
    u = mix(nodes)
    one = (u & np.uint64(0xFFFF)) % np.uint64(SIZE)
    out, of = [], []
    second = ((u >> np.uint64(32)).astype(np.float64) / 2**32) < 1 / THRESHOLD - 1
    for place, mask in ((one, slice(None)), ((one + np.uint64(1) + (u >> np.uint64(16) & np.uint64(0xFFFF)) % np.uint64(SIZE - 1)) % np.uint64(SIZE), second)):
        at, row = place[mask], rows[mask]
        token = sig[row, at.astype(np.int64)].astype(np.uint64)
        out.append(mix(u[mask] + (at * np.uint64(65536) + token + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)))
        of.append(row)
    return np.concatenate(out), np.concatenate(of)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SIZE)


def _batch(nodes: np.ndarray, ids: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), ids], ["node", "id"])


def _start(batches: Iterator[pa.RecordBatch], runs: range, levels: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sig, ids = _matrix(b.column("sig")), b.column("id")
        for r in runs:
            nodes, rows = np.full(len(sig), np.uint64(r + 1)), np.arange(len(sig))
            for _ in range(levels):
                nodes, rows = split(nodes, rows, sig)
            yield _batch(nodes, ids.take(pa.array(rows)))


def _deeper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sig = _matrix(b.column("sig"))
        nodes, rows = split(b.column("node").to_numpy(zero_copy_only=False).view(np.uint64), np.arange(len(sig)), sig)
        yield _batch(nodes, b.column("id").take(pa.array(rows)))


def _least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index of each component (for the edges of one batch)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _near_pairs(node: np.ndarray, sig: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within a node that agree in at least `least` sampled tokens; small nodes of one size are done together."""
    _, start, size = np.unique(node, return_index=True, return_counts=True)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for begin, m in zip(start[size > 64], size[size > 64]):
        for a in range(begin, begin + m - 1):
            b = a + 1 + np.flatnonzero((sig[a] == sig[a + 1 : begin + m]).sum(axis=1) >= least)
            left.append(np.full(len(b), a))
            right.append(b)
    for m in np.unique(size[(size > 1) & (size <= 64)]):
        i, j = np.triu_indices(m, 1)
        begin = start[size == m]
        step = max(1, (4 << 20) // (len(i) * SIZE))
        for at in range(0, len(begin), step):
            a = (begin[at : at + step, None] + i[None, :]).ravel()
            b = (begin[at : at + step, None] + j[None, :]).ravel()
            same = (sig[a] == sig[b]).sum(axis=1) >= least
            left.append(a[same])
            right.append(b[same])
    return np.concatenate(left), np.concatenate(right)


def _brute(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) that connect what is similar within nodes; rows come sorted by node."""
    def found(node: np.ndarray, sig: np.ndarray, keys: list[bytes]) -> pa.RecordBatch:
        names, of = np.unique(np.array(keys, dtype=object), return_inverse=True)
        a, b = _near_pairs(node, sig, least)
        label = _least_labels(len(names), of[a], of[b])
        new = np.flatnonzero(label != np.arange(len(names)))
        return pa.RecordBatch.from_arrays([pa.array(names[new].tolist(), pa.binary()), pa.array(names[label[new]].tolist(), pa.binary())], ["u", "v"])

    held = (np.zeros(0, np.int64), np.zeros((0, SIZE), np.uint16), [])
    for b in batches:
        node = np.concatenate([held[0], b.column("node").to_numpy(zero_copy_only=False)])
        sig = np.concatenate([held[1], _matrix(b.column("sig"))])
        keys = held[2] + b.column("key").to_pylist()
        if not len(node):
            continue
        cut = int(np.searchsorted(node, node[-1]))  # the last node may go on in the next batch; it has LIMIT rows at most
        held = node[cut:], sig[cut:], keys[cut:]
        if cut:
            yield found(node[:cut], sig[:cut], keys[:cut])
    if len(held[0]):
        yield found(*held)


def candidate_edges(texts: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(u, v) over the keys of `texts` (key, sig): connects whatever may be linked."""
    # what never meets in a large node is lost by the first runs at FIRST, the rest by all runs at DEPTH
    first_runs = runs_within((1 - recall) / 2, FIRST, runs_for(recall))
    all_runs = runs_within(1 - recall - loss(first_runs, FIRST), DEPTH, first_runs)
    least = least_agreement(threshold)
    known = texts.where("sig is not null").select("key", "sig")
    first = known.groupBy("sig").agg(F.min("key").alias("key"))  # equal embeddings go one way
    # nodes hold 60 bits of the key; should two keys share them, both are fetched by the join below
    same = cut_lineage(first.withColumn("id", F.conv(F.substring(F.hex("key"), 1, 15), 16, 10).cast("long")))
    edges = [known.join(same.select("sig", F.col("key").alias("low")), "sig").where("key <> low").select(F.col("key").alias("u"), F.col("low").alias("v"))]

    def start(sets: DataFrame, runs: range) -> DataFrame:
        return sets.select("id", "sig").mapInArrow(functools.partial(_start, runs=runs, levels=FIRST), "node long, id long")

    def settle(rows: DataFrame) -> DataFrame | None:
        """Searches the nodes of up to LIMIT sets; gives the rows of the larger ones."""
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        hits = cut_lineage(rows.join(sizes, "node").select("node", "n", "id"))
        signed = hits.join(same, "id")
        sorted_ = signed.where(F.col("n") <= LIMIT).select("node", "key", "sig").repartition("node").sortWithinPartitions("node", "key")
        edges.append(sorted_.mapInArrow(functools.partial(_brute, least=least), "u binary, v binary"))
        return None if hits.where(F.col("n") > LIMIT).isEmpty() else signed.where(F.col("n") > LIMIT)

    big = settle(start(same, range(first_runs)))
    if big is not None and all_runs > first_runs:
        crowded = cut_lineage(same.join(big.select("id").distinct(), "id", "left_semi"))
        more = settle(start(crowded, range(first_runs, all_runs)))
        big = big if more is None else big.unionByName(more)
    for _ in range(FIRST, DEPTH):
        if big is None:
            break
        big = settle(cut_lineage(big.select("node", "id", "sig").mapInArrow(_deeper, "node long, id long")))
    if big is not None:
        low = big.groupBy("node").agg(F.min("key").alias("v"))
        edges.append(big.join(low, "node").select(F.col("key").alias("u"), "v").where("u <> v"))
    return functools.reduce(DataFrame.unionByName, edges)


# -- exact comparison within candidate groups ----------------------------------

def linked(sets: list[np.ndarray], weights: np.ndarray, side: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(linked sets, their weight, least index of the linked component) of each set.

    side: None compares all pairs; else only pairs of different sides. Frequent shingles are counted by bit operations,
    the others by their lists.
    """
    share = Fraction(threshold).limit_denominator(1000)
    up, whole = share.numerator, share.numerator + share.denominator
    m = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    _, token, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    of = np.repeat(np.arange(m), size)
    often = np.flatnonzero(df >= max(2, m // 64))
    column = np.full(len(df), -1, np.int64)
    column[often] = np.arange(len(often))
    bits = np.zeros((m, -(-len(often) // 64) or 1), np.uint64)
    at = column[token]
    hit = at >= 0
    np.bitwise_or.at(bits, (of[hit], at[hit] >> 6), np.uint64(1) << (at[hit] & 63).astype(np.uint64))
    rare = (~hit) & (df[token] > 1)
    order = np.argsort(token[rare], kind="stable")
    rare_token, rare_of = token[rare][order], of[rare][order]
    begin = np.searchsorted(rare_token, np.arange(len(df)))
    stop = np.searchsorted(rare_token, np.arange(len(df)), "right")
    cut, rare_own = np.searchsorted(of[rare], np.arange(m + 1)), token[rare]
    count, weight = np.zeros(m, np.int64), np.zeros(m, np.int64)
    left, right = [], []
    for i in range(m - 1):
        common = np.bitwise_count(bits[i] & bits[i + 1 :]).sum(axis=1, dtype=np.int64)
        if cut[i] < cut[i + 1]:
            lists = np.concatenate([rare_of[begin[t] : stop[t]] for t in rare_own[cut[i] : cut[i + 1]]])
            common += np.bincount(lists, minlength=m)[i + 1 :]
        near = common * whole >= up * (size[i] + size[i + 1 :])
        if side is not None:
            near &= side[i + 1 :] != side[i]
        j = np.flatnonzero(near) + i + 1
        if len(j):
            count[i] += len(j)
            weight[i] += weights[j].sum()
            count[j] += 1
            weight[j] += weights[i]
            left.append(np.full(len(j), i))
            right.append(j)
    if not left:
        return count, weight, np.arange(m)
    return count, weight, _least_labels(m, np.concatenate(left), np.concatenate(right))


LINKS = "key binary, n_texts long, n_docs long, near binary"


def _compare(part: pd.DataFrame, threshold: float) -> pd.DataFrame:
    part = part.sort_values("key", ignore_index=True)
    i, j = int(part["i"].iloc[0]), int(part["j"].iloc[0])
    side = None if i == j else part["block"].to_numpy()
    sets = [np.asarray(s, np.int64) for s in part["shingles"]]
    count, weight, label = linked(sets, part["copies"].to_numpy(np.int64), side, threshold)
    return pd.DataFrame({"key": part["key"], "n_texts": count, "n_docs": weight, "near": part["key"].iloc[label].to_numpy()})


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct shingles of each text."""
    for b in batches:
        for first, end, made, of in shingles(b.column("text")):
            cut = np.searchsorted(of, np.arange(end - first + 1))
            own = [np.unique(made[cut[k] : cut[k + 1]]).view(np.int64) for k in range(end - first)]
            yield pa.RecordBatch.from_arrays([b.column("key").slice(first, end - first), pa.array(own, pa.list_(pa.int64()))], ["key", "shingles"])


def _key():
    return F.unhex(F.md5(clean_text()))


def resemblance(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row for each text: key, low_id, copies, root (least key of its class), n_texts, n_docs (links)."""
    keyed = docs.select("doc_id", _key().alias("key"), clean_text().alias("text"))
    signed = keyed.mapInArrow(_signed, "key binary, doc_id long, sig binary")
    texts = cut_lineage(signed.groupBy("key").agg(F.min("doc_id").alias("low_id"), F.count(F.lit(1)).alias("copies"), F.max("sig").alias("sig")))
    groups = cut_lineage(components(candidate_edges(texts, threshold, recall)))

    # the sets of the texts in candidate groups; each text is fetched once
    members = groups.join(texts, "key").select("key", F.col("root").alias("grp"), "low_id", "copies")
    own = keyed.join(members.select(F.col("key").alias("m_key"), F.col("low_id").alias("m_id")), (F.col("key") == F.col("m_key")) & F.col("doc_id").eqNullSafe(F.col("m_id")), "left_semi")
    sets = own.groupBy("key").agg(F.min("text").alias("text")).mapInArrow(_sets, "key binary, shingles array<long>")
    held = cut_lineage(sets.join(members, "key").select("key", "grp", "copies", "shingles"))
    cells = held.groupBy("grp").agg(F.ceil(F.sum(F.size("shingles")) / BLOCK).cast("int").alias("cells")).select(F.col("grp").alias("c_grp"), "cells")
    dealt = held.join(cells, F.col("grp") == F.col("c_grp")).drop("c_grp").withColumn("block", F.pmod(F.xxhash64("key"), F.col("cells")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("cells") - 1))
    pairs = dealt.withColumn("o", other).withColumn("i", F.least("block", "o")).withColumn("j", F.greatest("block", "o"))
    links = cut_lineage(pairs.select("grp", "i", "j", "key", "copies", "block", "shingles").groupBy("grp", "i", "j").applyInPandas(lambda part: _compare(part, threshold), LINKS))

    counted = links.groupBy("key").agg(F.sum("n_texts").alias("n_texts"), F.sum("n_docs").alias("n_docs"))
    roots = components(links.where("key <> near").select(F.col("key").alias("u"), F.col("near").alias("v")))
    return texts.select("key", "low_id", "copies").join(counted, "key", "left").join(roots, "key", "left").select(
        "key", "low_id", "copies", F.coalesce("root", "key").alias("root"), F.coalesce("n_texts", F.lit(0)).alias("n_texts"),
        (F.coalesce("n_docs", F.lit(0)) + F.col("copies") - 1).alias("n_docs"))


def classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """resemblance with class_id (least id), class_key (the text that holds it) and class_size (documents)."""
    each = cut_lineage(resemblance(docs, threshold, recall))
    first = each.groupBy(F.col("root").alias("c_root")).agg(
        F.min(F.struct(F.col("low_id").isNull().alias("no_id"), "low_id", "key")).alias("first"), F.sum("copies").alias("class_size"))
    return each.join(first, F.col("root") == F.col("c_root")).select(
        "key", "low_id", "copies", "n_texts", "n_docs", F.col("first.low_id").alias("class_id"), F.col("first.key").alias("class_key"), "class_size")


def report(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, n_links (other documents linked), n_texts (other texts linked), class_size of every row."""
    found = classes(docs, threshold, recall)
    return docs.select("doc_id", _key().alias("key")).join(found, "key").select("doc_id", "class_id", F.col("n_docs").alias("n_links"), "n_texts", "class_size")


def drop_near(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row of each class (the least id), with the columns of `docs`."""
    won = classes(docs, threshold, recall).where("key = class_key").select(F.col("class_id").alias("win_id"), F.col("key").alias("win_key"))
    same = docs.select("doc_id", _key().alias("key")).groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("win_same"))
    winners = won.join(same, F.col("win_id").eqNullSafe(F.col("doc_id")) & (F.col("win_key") == F.col("key"))).select("win_id", "win_key", "win_same")
    return keep_winners(docs, _key(), cut_lineage(winners))
