"""Quality classifier learned from trusted positives and unlabelled text.

A linear model over features of a whole text minimises the non-negative unbiased risk
    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))
with the logistic loss. No row labelled as bad is used. The class prior is estimated first: a classifier of positives
against unlabelled rows is fitted on one half; for every set A, the share of unlabelled rows in A is at least
prior * share of positives in A, so the smallest ratio over the sets "score above t" on the other half bounds it.

Training uses at most SAMPLE positives and SAMPLE unlabelled rows, in the order of a hash of the id. Scoring reads every
whole text once, without a shuffle.

Defined results: null and empty texts have the features of no words and get a score like any other; an id with both
labels is no trusted positive; null ids are never labelled; if every document has a label, all documents stand for the
unlabelled ones; without positives or documents every score is 0.5 (prior unknown); repeated rows get equal scores; an
empty table gives no rows; lang, source, doc_id and other columns are no inputs.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import clean_text, crc_mod, cut_lineage

#: Rows of each kind used for training; least share of positives in the sets that bound the prior.
SAMPLE, LEAST_SHARE = 10_000, 0.3
#: Hashed runs of punctuation.
MARKS = 64

_MARK = re.compile(r"[^\w\s]+")


def _stable(s: str) -> int:
    h = 2166136261
    for b in s.encode():
        h = (h ^ b) * 16777619 & 0xFFFFFFFF
    return h


def features(text: str) -> np.ndarray:
    """Shares of marks, cases, repeats and lines; each as it is and on a log scale, then the kinds of punctuation runs."""
    words = text.split()
    n, chars = len(words), len(text)
    runs_of_marks = _MARK.findall(text)
    marks = Counter(m[:4] for m in runs_of_marks)  # the kind of a run is its first four marks; its length counts whole
    letters = sum(map(len, words))
    upper = sum(1 for w in words if w.isupper() and len(w) > 1)
    alone = sum(1 for w in words if not any(c.isalnum() for c in w))
    again = sum(1 for a, b in zip(words, words[1:]) if a == b)
    seen = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in text.split("\n") if x.strip()]
    d, dm = n + 5.0, chars + 20.0
    shares = np.array([
        upper / d, alone / d, again / d, max(seen.values(), default=0) / d, 1 - (pairs + 1) / (max(n - 1, 0) + 1.0),
        sum(map(len, runs_of_marks)) / dm, sum(k for m, k in marks.items() if len(m) > 1) / d,
        sum(c.isdigit() for c in text) / dm, 1 - (len(set(lines)) + 1) / (len(lines) + 1.0), sum(1 for w in words if w[-1] in ".!?") / d,
        sum(1 for w in words if w[0].isupper()) / d, sum(1 for w in words if len(w) > 20) / d])
    whole = np.array([np.log1p(n) / 5, letters / d / 5, np.log1p(n / (len(lines) + 1.0)) / 5, (len(seen) / d)])
    runs = np.zeros(MARKS)
    for m, k in marks.items():
        runs[_stable(m) % MARKS] += k
    return np.concatenate([shares, np.log1p(50 * shares), whole, np.log1p(50 * runs / d)])


WIDTH = 12 * 2 + 4 + MARKS


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def nonnegative_risk(theta: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """Risk and the direction to follow: where the negative part falls below zero, it is raised again."""
    zp, zu = p @ theta, u @ theta
    plus, minus_p, minus_u = _softplus(-zp).mean(), _softplus(zp).mean(), _softplus(zu).mean()
    gplus, gminus_p, gminus_u = -(_sigmoid(-zp) @ p) / len(p), (_sigmoid(zp) @ p) / len(p), (_sigmoid(zu) @ u) / len(u)
    negative = minus_u - prior * minus_p
    if negative < 0:
        return prior * plus, prior * gminus_p - gminus_u
    return prior * plus + negative, prior * gplus + gminus_u - prior * gminus_p


def _adam(gradient, width: int, steps: int = 400, rate: float = 0.05, ridge: float = 1e-4) -> np.ndarray:
    theta, m, v = np.zeros(width), np.zeros(width), np.zeros(width)
    for t in range(1, steps + 1):
        g = gradient(theta) + ridge * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - rate * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return theta


class Prior:
    """Bound of the share of positives among the unlabelled rows: the least ratio of their shares over sets of high scores.

    The scores come from half of the sampled rows, the sets and the share of positives from the other positives, and the
    share of unlabelled rows from whatever rows are counted against the cuts.
    """

    def __init__(self, p: np.ndarray, u: np.ndarray):
        y = np.concatenate([np.ones(len(p[::2])), np.zeros(len(u[::2]))])
        x = np.vstack([p[::2], u[::2]])
        weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
        self.theta = _adam(lambda th: ((_sigmoid(x @ th) - y) * weight) @ x, x.shape[1])
        sp = np.sort((p[1::2] if len(p) > 1 else p) @ self.theta)
        self.cuts = np.quantile(sp, np.linspace(0, 1 - LEAST_SHARE, 71))
        self.positives = len(sp)
        self.share_p = 1 - np.searchsorted(sp, self.cuts, "left") / len(sp)

    def place(self, u: np.ndarray) -> np.ndarray:
        """How many of the ascending cuts each row reaches."""
        return np.searchsorted(self.cuts, u @ self.theta, "right")

    def bound(self, above: np.ndarray, rows: int) -> float:
        share_u = above / rows
        slack = np.sqrt(share_u * (1 - share_u) / rows) + np.sqrt(self.share_p * (1 - self.share_p) / self.positives)
        return float(np.clip(((share_u + slack) / self.share_p).min(), 0.02, 0.98))


def estimate_prior(p: np.ndarray, u: np.ndarray) -> float:
    """Upper bound of the share of positives among the unlabelled rows `u`."""
    held = u[1::2] if len(u) > 1 else u
    prior = Prior(p, u)
    return prior.bound((prior.place(held)[:, None] > np.arange(len(prior.cuts))).sum(axis=0), len(held))


class Model:
    def __init__(self, theta, mean, scale, prior):
        self.theta, self.mean, self.scale, self.prior = theta, mean, scale, prior

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.theta is None:
            return np.full(len(x), 0.5)
        return _sigmoid(np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))]) @ self.theta)

    def column(self, text: Column | None = None) -> Column:
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series(self.score(np.array([features(t) for t in texts]).reshape(-1, WIDTH)))

        run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return F.pandas_udf(run, "double")(clean_text() if text is None else text)


def scaling(p: np.ndarray, u: np.ndarray):
    """(mean, scale, function that scales rows and adds the intercept)."""
    both = np.vstack([p, u])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 0.05
    return mean, scale, lambda x: np.hstack([(x - mean) / scale, np.ones((len(x), 1))])


def fit(p: np.ndarray, u: np.ndarray, prior: float | None = None) -> Model:
    mean, scale, ready = scaling(p, u)
    p, u = ready(p), ready(u)
    prior = estimate_prior(p, u) if prior is None else prior
    return Model(_adam(lambda th: nonnegative_risk(th, p, u, prior)[1], p.shape[1], ridge=1e-3), mean, scale, prior)


def train(docs: DataFrame, positives: DataFrame, labelled: DataFrame, rows: int = SAMPLE) -> Model:
    """`positives` and `labelled` hold doc_id; documents that are in neither are unlabelled."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull())
    known = positives.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    free = ids.join(labelled.select("doc_id"), "doc_id", "left_anti")
    chosen_u = free.orderBy(*order).limit(rows)
    if chosen_u.isEmpty():
        chosen_u = ids.orderBy(*order).limit(rows)
    chosen = known.orderBy(*order).limit(rows).withColumn("kind", F.lit(1)).unionByName(chosen_u.withColumn("kind", F.lit(0))).select(F.col("doc_id").alias("chosen_id"), "kind")

    def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"chosen_id": b["chosen_id"], "kind": b["kind"], "x": [features(t) for t in b["text"]]})

    # at most 2 * rows ids are broadcast; the texts of all documents are not shuffled for them
    sample = docs.select("doc_id", clean_text().alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id")).groupBy("chosen_id", "kind").agg(F.min("text").alias("text"))
    made = sample.mapInPandas(rows_of, "chosen_id long, kind int, x array<double>").collect()  # at most 2 * SAMPLE ids
    made.sort(key=lambda r: (r[0], r[1], r[2]))
    p, u = (np.array([r[2] for r in made if r[1] == k]).reshape(-1, WIDTH) for k in (1, 0))
    if not len(p) or not len(u):
        return Model(None, None, None, None)
    return fit(p, u, _prior_of_all(docs, labelled, p, u))


def _prior_of_all(docs: DataFrame, labelled: DataFrame, p: np.ndarray, u: np.ndarray) -> float:
    """The class prior from the scores of all unlabelled rows. Ids and places meet the labels, no texts."""
    _, _, ready = scaling(p, u)
    prior = Prior(ready(p), ready(u))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.array([features(t) for t in b["text"]]).reshape(-1, WIDTH)
            yield pd.DataFrame({"doc_id": b["doc_id"], "place": prior.place(ready(x)).astype(np.int32)})

    held = labelled.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    placed = docs.select(F.col("doc_id").cast("string").alias("doc_id"), clean_text().alias("text")).mapInPandas(place, "doc_id string, place int")
    free = placed.join(held.select(F.col("doc_id").cast("string").alias("doc_id")), "doc_id", "left_anti")
    found = {r[0]: r[1] for r in free.groupBy("place").count().collect()}  # a row for each cut at most
    rows = sum(found.values())
    if not rows:
        return estimate_prior(ready(p), ready(u))
    return prior.bound(np.array([sum(n for at, n in found.items() if at > i) for i in range(len(prior.cuts))]), rows)


def trusted(labels: DataFrame) -> DataFrame:
    """Ids of trusted positives among the rows that the contract lets a model learn from."""
    return labels.where((crc_mod("doc_id", 3) != 1) & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, cut_lineage(trusted(labels)), labels)
    scored = docs.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).withColumn("class_prior", F.lit(model.prior).cast("double"))
