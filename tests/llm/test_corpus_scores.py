"""Importance resampling, lexical search and language-model scores against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from showledger.llm import common, hash_arrays, kneser_ney, lexical_search, resampling

from .test_llm import docs_of, odd  # noqa: F401

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_TEXTS = ["The cat. The CAT\tsat", "ÀÉ the été 42", "", None, "of of of of of", "a-b c_d\ne" * 9, "the end\x00of x" * 7, "x " * 25, "cat the " * 15]


def _low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def _texts(seed, n):
    rng = random.Random(seed)
    return [rng.choice(_TEXTS) if rng.random() < 0.3 else " ".join(rng.choice(["the", "Of", "cat", "été", "x1", "dog", "z"]) for _ in range(rng.randint(0, 40))) for _ in range(n)]


# -- 11 importance resampling -----------------------------------------------------------

def _features(text, n):
    w = WORD.findall(_low(text))
    return w, [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def _brute_resampling(texts, target, n, buckets, percent, least):
    where = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(where(f) for x in side for f in _features(x, n)[1]) for side in (texts, target))
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in {*s, *t}}
    out = {}
    for i, x in enumerate(texts):
        w, f = _features(x, n)
        weight = sum(gain[where(g)] for g in f)
        h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        out[i] = [len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(w)]
    may = sorted((i for i in out if out[i][4] >= least), key=lambda i: (-out[i][2], i))
    for at, i in enumerate(may[: percent * len(may) // 100]):
        out[i][3] = at + 1
    return {i: tuple(v[:4]) for i, v in out.items()}


@pytest.mark.parametrize("n,buckets,percent", [(1, 10_000, 10), (3, 50, 60)])
def test_resampling_brute_force(spark, monkeypatch, n, buckets, percent):
    monkeypatch.setattr(common, "BLOCK_BYTES", 64)  # several batches a task
    texts, target = _texts(1, 150), _texts(2, 20)
    docs, items = docs_of(spark, texts), docs_of(spark, target).select(F.col("doc_id").alias("item_id"), "text")
    got = {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in resampling.report(docs, items, ngrams=n, buckets=buckets, percent=percent, min_words=5).collect()}
    assert got == _brute_resampling(texts, target, n, buckets, percent, 5) and any(v[3] for v in got.values())
    drawn = resampling.resample(docs.withColumn("rank", F.lit("x")), items, ngrams=n, buckets=buckets, percent=percent, min_words=5)
    assert drawn.columns == [*docs.columns, "rank"]
    assert sorted(r.doc_id for r in drawn.collect()) == sorted(i for i, v in got.items() if v[3])


def test_no_feature_crosses_documents():
    words, own, found = resampling.batch_features([b"a b", b"b c", b"", b"d"], 2, 1 << 32)
    assert words.tolist() == [2, 2, 0, 1]
    assert sorted(zip(own.tolist(), found.tolist())) == sorted((i, zlib.crc32(f)) for i, f in [(0, b"a"), (0, b"b"), (0, b"a b"), (1, b"b"), (1, b"c"), (1, b"b c"), (3, b"d")])


def test_resampling_odd(spark, odd):  # noqa: F811
    none = odd.select(F.col("id").alias("item_id"), "text").limit(0)
    got = resampling.report(odd, none, min_words=1, percent=100).collect()
    assert len(got) == odd.count() and sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 6))  # five rows hold words
    assert all(r.weight == 0 and r["rank"] is None for r in got if r.n_features == 0)
    assert resampling.report(odd.limit(0), none).count() == 0
    kept = resampling.resample(odd, none, min_words=1, percent=100)
    assert kept.columns == odd.columns and kept.count() == 5


# -- 13 lexical search -------------------------------------------------------------------

def _brute_search(texts, items, top):
    terms = [WORD.findall(_low(t)) for t in texts]
    n, total = sum(bool(w) for w in terms), sum(map(len, terms))
    df = Counter(w for x in terms for w in set(x))
    out = defaultdict(list)
    for item, text in items:
        asked, found = set(WORD.findall(_low(text))), []
        for i, w in enumerate(terms):
            m = 10 + (90 * len(w) * n) // max(1, total)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[q] + 1))) * ((10**9 * w.count(q)) // (1000 * w.count(q) + 8 * m)) for q in asked if q in w)
            if score > 0:
                found.append((-score, i))
        out[item] = [(at + 1, i, -s) for at, (s, i) in enumerate(sorted(found)[:top])]
    return out


@pytest.mark.parametrize("block_bytes,top", [(1 << 20, 10), (40, 3)])
def test_search_brute_force(spark, monkeypatch, block_bytes, top):
    monkeypatch.setattr(lexical_search, "CELLS", 16)
    monkeypatch.setattr(lexical_search, "HITS", 8)
    monkeypatch.setattr(common, "BLOCK_BYTES", 64)
    texts = _texts(3, 120) + ["the cat sat on the dog"] * 30 + ["dog cat on sat the the"] * 5
    items = [(10, "The CAT, the cat"), (11, "nothing here"), (12, ""), (13, None), (14, "été x1 sat z dog of"), (15, "of")]
    docs = docs_of(spark, texts).repartition(7)
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, rank int, hash int")
    got = defaultdict(list)
    for r in lexical_search.search(docs, asked, top, block_bytes).collect():
        got[r.item_id].append((r["rank"], r.doc_id, r.score))
    want = _brute_search(texts, items, top)
    assert {i: sorted(v) for i, v in got.items()} == {i: v for i, v in want.items() if v}


def test_search_odd(spark, odd):  # noqa: F811
    asked = spark.createDataFrame([(None, "a"), (None, "a"), (1, "b b")], "item_id long, text string")
    got = [(r.item_id, r["rank"], r.doc_id) for r in lexical_search.search(odd, asked).collect()]
    # both rows of the null item are answered; of equal scores ascending ids, null last; repeated rows are each found
    assert sorted(got, key=str) == sorted([(i, n, d) for i in (None, None, 1) for n, d in zip(range(1, 5), (3, 3, 6, None))], key=str)
    assert lexical_search.search(odd.limit(0), asked).count() == 0 and lexical_search.search(odd, asked.limit(0)).count() == 0
    assert lexical_search.search(odd, asked).columns == ["item_id", "rank", "doc_id", "score"]


def test_best_keeps_ties_by_least_member():
    best = lexical_search.Best(2, 2)
    best.add(np.array([[5, 0], [5, 1]]), np.array([9, 4]), ["a", "b"])
    best.add(np.array([[5, 0], [4, 1]]), np.array([7, 1]), ["c", "d"])
    assert list(zip(best.item.tolist(), best.score.tolist(), best.rep.tolist(), best.names)) == [(0, 5, 4, "b"), (0, 5, 7, "c"), (1, 1, 1, "d"), (1, 1, 4, "b")]


# -- 12 language model -------------------------------------------------------------------

def _brute_model(texts, order):
    """Scores of every text by dictionaries; the same model written down from its formulas."""
    cut = [[t.encode() for t in re.split("[ \t-\r]+", _low(x)) if t] + [None] for x in texts]
    train = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 7 != 2]
    raw = Counter(t for i in train for t in cut[i])
    n_all, v = sum(raw.values()), len(raw)

    def padded(i):
        return ["<"] * (order - 1) + cut[i]

    counts = {order: Counter(tuple(padded(i)[j : j + order]) for i in train for j in range(len(cut[i])))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    d = {k: kneser_ney.discounts(*(sum(c == x for c in counts[k].values()) for x in (1, 2, 3, 4))) for k in counts}
    followed = {k: defaultdict(list) for k in counts}
    for k in counts:
        for g, c in counts[k].items():
            followed[k][g[:-1]].append(c)

    def p(gram):
        k = len(gram)
        if not k:
            return 1 / (v + 1)
        low = p(gram[1:])
        seen = followed[k].get(gram[:-1])
        if not seen:
            return low
        c = counts[k].get(gram, 0)
        less = lambda x: 0 if not x else d[k][min(x, 3) - 1]
        return (c - less(c)) / sum(seen) + sum(map(less, seen)) / sum(seen) * low

    out = {}
    for i in range(len(texts)):
        own = cut[i]
        at = padded(i)
        out[i] = (len(own), sum(raw[t] > 0 for t in own), n_all, sum(math.log10((raw[t] + 1) / (n_all + v + 1)) for t in own),
                  sum(math.log10(p(tuple(at[j : j + order]))) for j in range(len(own))))
    return out, (p, [*raw, "unseen"])


@pytest.mark.parametrize("order,sizes", [(2, {}), (3, dict(bucket_bytes=300, part_bytes=200)), (4, dict(bucket_bytes=900, part_bytes=4000))])
def test_language_model_brute_force(spark, monkeypatch, order, sizes):
    monkeypatch.setattr(common, "BLOCK_BYTES", 200)
    monkeypatch.setattr(kneser_ney, "FLUSH", 50)
    texts = _texts(5, 90) + ["of the cat " * 60, "a\x00b A\x00B\x0bc", "new words only here"]
    texts += [" ".join(f"v{i} of cat u{i} of dog" for i in range(n)) for n in (254, 255, 300)] + ["of dog of cat"] * 4  # counts around one byte
    want, (p, vocabulary) = _brute_model(texts, order)
    got = {r.doc_id: r for r in kneser_ney.report(docs_of(spark, texts).repartition(5), order, **sizes).collect()}
    assert len(got) == len(texts)
    for i, w in want.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == w[:3] and r.held_out == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert r.base_score == pytest.approx(w[3], rel=1e-12) and r.score == pytest.approx(w[4], rel=1e-9)
    for context in (("<",) * (order - 1), (b"of",) * (order - 1), (b"the", b"cat", b"of")[-order + 1 :]):
        assert sum(p((*context, t)) for t in vocabulary) == pytest.approx(1)  # a distribution, the unknown word included


def test_language_model_odd(spark, odd):  # noqa: F811
    got = kneser_ney.report(odd).collect()
    assert len(got) == odd.count() and all(r.n_tokens == 1 for r in got if r.doc_id in (1, 2, 5))
    assert kneser_ney.report(odd.limit(0)).count() == 0
    untrained = kneser_ney.report(docs_of(spark, ["a b"], first=next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2))).first()
    assert (untrained.score, untrained.base_score, untrained.n_known, untrained.train_tokens) == (0, 0, 0, 0)


def test_language_model_beats_unigrams(spark):
    from showledger.llm.queries import QUERIES

    held = QUERIES["op12_lm_scoring"](spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
    assert held.score > held.base


def test_hash_arrays_round_trip(tmp_path):
    held = {"a": np.arange(5, dtype=np.uint64), "b": np.zeros(0, np.uint16), "c": np.array([1.5])}
    hash_arrays.write(f"file://{tmp_path}/x/y", held)
    got = hash_arrays.load(f"file://{tmp_path}/x/y")
    assert all((got[k] == v).all() and got[k].dtype == v.dtype for k, v in held.items()) and isinstance(got["a"].base, np.memmap)
    assert hash_arrays.load(str(tmp_path / "none"), missing=True) is None
    for columns in ([np.array([0, 255, 256]), np.array([1, 1 << 40, 3])], [np.zeros(0, np.int64)]):
        assert all((a == b).all() for a, b in zip(kneser_ney.unpack(kneser_ney.pack(columns)), columns))


def test_rows_of_a_bucket_are_scored_together():
    """However many short rows the blocks send to a bucket, it is asked once for each FLUSH grams, and a block gets one row of sums."""
    calls = []

    def logs(columns, bucket):
        calls.append((bucket, len(columns[0])))
        return -columns[-1].astype(float) - bucket

    held, want = kneser_ney.Sums(logs), {}
    for bucket in (3, 4):
        for first in range(50):
            own, word = np.array([0, 2, 2]) + first % 3, np.arange(3) + first
            held.add(first, bucket, kneser_ney.pack([own, word, word, word]))
            for o, w in zip(own.tolist(), word.tolist()):
                want[first, o] = want.get((first, o), 0.0) - w - bucket
    got = list(held.take())
    assert calls == [(3, 150), (4, 150)] and len(got) == 50
    assert {(f, int(o)): s for f, used, sums in got for o, s in zip(used, sums)} == want
    assert list(held.take()) == []
