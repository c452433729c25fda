"""Toxicity by a weighted finite-state pattern grammar.

A lexical transducer maps words to symbols: insult and threat stems (with weights), targets, negators and words of
reported speech. Small transducers for negation, reported speech, targets and threats work on symbols; `compose` joins
them into one machine that reads a clause once and tells for each match whether it is plain, aimed at a target, negated
or reported. A document is judged by its matched clauses: for each of the four kinds the summed weight, the largest
clause, and how many clauses matched; a logistic regression over these features gives the score. Its rows are weighted
back to the ratio of the labels over all labelled rows, so the score's base rate does not depend on the sample's bound.

The stems are seeds and what the labels teach: of a bounded sample of labelled rows (at most SAMPLE of each label, in
the order of a hash of the id) the word prefixes are counted by label in Spark; a prefix whose log odds are significant
becomes a stem, longer ones only where they say more than their beginning. Near copies count once, so the words of one
much-copied document teach little. Scoring reads every whole text in one pass, without a shuffle.

Defined results: null and empty texts match nothing and get the model's base score; an id with both labels counts as
toxic; a null id is never a labelled row; without labels of both kinds the seeds and fixed coefficients are used;
repeated rows get equal scores; an empty table gives no rows; lang, source, doc_id and other columns are no inputs.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import clean_text, crc_mod, cut_lineage, mix

#: Labelled rows of each label used for training; stems held by the model; score from which a text is rejected.
SAMPLE, STEMS, REJECT = 8_000, 4_000, 0.3
#: Least distinct toxic documents for a stem, least log odds and least z value.
LEAST_DOCS, LEAST_ODDS, LEAST_Z = 4, 1.5, 4.0
#: Words that a negator reaches.
REACH = 3

# Seed words by symbol, in four languages.
SEEDS = {
    "insult": "idiot moron stupid loser scum trash worthless pathetic disgusting clown dumm trottel abschaum idiota imbécil basura escoria imbécile ordure salaud",
    "threat": "kill hurt destroy murder beat töten umbringen vernichten tuer détruire frapper matar destruir golpear",
    "target": "you your yours he she they him her them du dich dein ihr euch tu toi vous ton votre tú usted ustedes ellos",
    "negation": "not no never nor without nicht kein keine nie ohne pas jamais sans nunca sin ni",
    "report": "said says saying wrote writes claimed quoted reported sagte schrieb behauptete dit disait écrit dijo dice escribió",
}
SEED_WEIGHT = 2.0

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n\"“”„«»]")
_QUOTES = frozenset("\"“”„«»")
_ENDS = frozenset(".!?;:\n")
KINDS = ("plain", "aimed", "negated", "reported")
FEATURES = 2 * len(KINDS) + 4


# -- transducers ---------------------------------------------------------------

class Transducer:
    """Deterministic: (state, symbol) -> (state, symbol, weight); what is not listed stays and passes unchanged."""

    def __init__(self, start, arcs: dict):
        self.start, self.arcs = start, arcs

    def step(self, state, symbol):
        return self.arcs.get((state, symbol), (state, symbol, 1.0))


def compose(first: Transducer, second: Transducer, symbols: list[str]) -> Transducer:
    """One machine that feeds what `first` writes to `second`; weights multiply. Built from the states that are reached."""
    start = (first.start, second.start)
    arcs, todo, seen = {}, [start], {start}
    while todo:
        a, b = state = todo.pop()
        for symbol in symbols:
            a2, middle, w1 = first.step(a, symbol)
            b2, out, w2 = second.step(b, middle)
            arcs[state, symbol] = ((a2, b2), out, w1 * w2)
            if (a2, b2) not in seen:
                seen.add((a2, b2))
                todo.append((a2, b2))
    return Transducer(start, arcs)


INPUT = ["word", "insult", "threat", "target", "negation", "report", "quote", "end"]


def grammar() -> Transducer:
    """Negation, reported speech, threats and targets as one machine; matches leave as one of KINDS."""
    negation = {}
    for left in range(REACH + 1):
        nxt = max(0, left - 1)
        negation[left, "negation"] = (REACH, "word", 1.0)
        negation[left, "end"] = (0, "end", 1.0)
        for s in ("word", "target", "report", "quote"):
            negation[left, s] = (nxt, s, 1.0)
        for s in ("insult", "threat"):
            negation[left, s] = (nxt, "not-" + s if left else s, 1.0)
    report = {}
    for state in ("own", "reported", "quoted"):
        report[state, "report"] = ("quoted" if state == "quoted" else "reported", "word", 1.0)
        report[state, "quote"] = ("own" if state == "quoted" else "quoted", "word", 1.0)
        report[state, "end"] = ("quoted" if state == "quoted" else "own", "end", 1.0)
        for s in ("insult", "threat", "not-insult", "not-threat"):
            report[state, s] = (state, s if state == "own" else "said-" + s.removeprefix("not-"), 1.0)
    threat = {}
    for state in ("open", "met"):  # a threat needs a target in its clause, before or after; else it is a plain word of half weight
        threat[state, "target"] = ("met", "target", 1.0)
        threat[state, "end"] = ("open", "end", 1.0)
        threat[state, "threat"] = (state, "insult", 1.0 if state == "met" else 0.5)
        threat[state, "not-threat"] = (state, "not-insult", 0.5)
        threat[state, "said-threat"] = (state, "said-insult", 0.5)
    target = {}
    for state in ("none", "seen"):
        target[state, "target"] = ("seen", "word", 1.0)
        target[state, "end"] = ("none", "end", 1.0)
        target[state, "insult"] = (state, "aimed" if state == "seen" else "plain", 1.0)
        target[state, "not-insult"] = (state, "negated", 1.0)
        target[state, "said-insult"] = (state, "reported", 1.0)
    machine = Transducer(0, negation)
    for start, arcs in (("own", report), ("open", threat), ("none", target)):
        machine = compose(machine, Transducer(start, arcs), INPUT)
    return machine


class Matcher:
    """Lexicon and grammar over whole texts."""

    def __init__(self, stems: dict[str, float]):
        self.stems = stems  # a stem that ends in a blank is a whole word
        self.longest = max(map(len, stems), default=0)
        self.seeds = {w: kind for kind, words in SEEDS.items() for w in words.split()}
        machine = grammar()
        number: dict = {machine.start: 0}
        for (state, _), (nxt, _, _) in machine.arcs.items():
            number.setdefault(state, len(number))
            number.setdefault(nxt, len(number))
        self.table = [[(number[machine.step(s, x)[0]], KINDS.index(o) if (o := machine.step(s, x)[1]) in KINDS else -1, machine.step(s, x)[2]) for x in INPUT] for s in number]
        self.known: dict[str, tuple[int, float]] = {}

    def symbol(self, word: str) -> tuple[int, float]:
        """(symbol, weight) of a word: the longest stem it starts with, else a seed."""
        got = self.known.get(word)
        if got is None:
            got = self._symbol(word)
            if len(self.known) > 300_000:  # a cache only
                self.known.clear()
            self.known[word] = got
        return got

    def _symbol(self, word: str) -> tuple[int, float]:
        if word in _QUOTES:
            return INPUT.index("quote"), 0.0
        if word in _ENDS:
            return INPUT.index("end"), 0.0
        whole = word + " "
        for n in range(min(self.longest, len(whole)), 0, -1):
            weight = self.stems.get(whole[:n])
            if weight is not None:
                return INPUT.index("threat" if self.seeds.get(word) == "threat" else "insult"), weight
        kind = self.seeds.get(word, "word")
        return INPUT.index(kind), SEED_WEIGHT if kind in ("insult", "threat") else 0.0

    def features(self, text: str) -> list[float]:
        tokens = _TOKEN.findall(text.lower())
        sums, most, clauses, matches, clause, state = [0.0] * len(KINDS), [0.0] * len(KINDS), 0, 0, 0.0, 0
        table, known = self.table, self.known
        for token in tokens:
            symbol, weight = known.get(token) or self.symbol(token)
            if not symbol and not state:  # a plain word in the start state changes nothing
                continue
            state, kind, factor = table[state][symbol]
            if kind >= 0:
                value = weight * factor
                matches += 1
                sums[kind] += value
                most[kind] = max(most[kind], value)
                clause += value
            if symbol == 7:
                clauses += clause > 0
                clause = 0.0
        clauses += clause > 0
        n = len(tokens)
        return [*[math.log1p(x) for x in sums], *most, math.log1p(matches), math.log1p(clauses), math.log1p(100 * matches / (n + 10)), math.log1p(sum(sums) * 10 / (n + 10))]


# -- training ------------------------------------------------------------------

def sketch(words: list[str]) -> int:
    """Smallest hash of the pairs of neighbouring words: near copies mostly share it."""
    if not words:
        return 0
    h = pd.util.hash_array(np.asarray(words, dtype=object), categorize=False)
    if len(h) > 1:
        h = mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])
    return int(h.min().astype(np.int64))


def prefixes(text: str) -> set[str]:
    words = {w for w in re.findall(r"[^\W\d_]{3,}", text.lower())}
    return {w[:n] for w in words for n in range(3, min(10, len(w)) + 1)} | {w + " " for w in words}


def known_labels(labels: DataFrame) -> DataFrame:
    """doc_id, label: one row for each labelled id."""
    return labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """label, text of at most `rows` labelled rows of each label, chosen by a hash of the id."""
    known = known_labels(labels)
    parts = [known.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for v in (0, 1)]
    chosen = parts[0].unionByName(parts[1]).select(F.col("doc_id").alias("chosen_id"), "label")
    # at most 2 * rows ids are broadcast; the texts of all documents are not shuffled for them
    return docs.select("doc_id", clean_text().alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id")).select("label", "text")


def one_of_copies(sample: DataFrame) -> DataFrame:
    """The sample without near copies: one text for each sketch and label, and the number of rows it stands for."""
    @F.pandas_udf("long")
    def sketched(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sketch(re.findall(r"[^\W\d_]+", t.lower())))

    return sample.withColumn("sketch", sketched("text")).groupBy("sketch", "label").agg(F.min("text").alias("text"), F.count(F.lit(1)).alias("copies")).select("label", "text", "copies")


def stem_counts(sample: DataFrame) -> DataFrame:
    """stem, toxic, clean: documents with the prefix; summed in each task first."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            seen = (Counter(), Counter())
            for label, text in zip(rows["label"], rows["text"]):
                seen[label].update(prefixes(text))
            stems = list(seen[0] | seen[1])
            yield pd.DataFrame({"stem": stems, "toxic": [seen[1][s] for s in stems], "clean": [seen[0][s] for s in stems]})

    return sample.mapInPandas(count, "stem string, toxic long, clean long").groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose_stems(counts: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """Stems with significant log odds; a longer one only where it says clearly more than its beginning."""
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    z = odds / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    best = counts.where(F.col("toxic") >= LEAST_DOCS).select("stem", odds.alias("odds"), (odds * F.sqrt("toxic")).alias("worth"), z.alias("z")).where(
        (F.col("odds") >= LEAST_ODDS) & ((F.col("z") >= LEAST_Z) | (F.col("worth") >= 2.5 * LEAST_Z))).orderBy(F.desc("worth"), "stem").limit(STEMS)
    found = {r["stem"]: r["odds"] for r in best.collect()}  # at most STEMS
    kept: dict[str, float] = {}
    for stem in sorted(found, key=lambda s: (len(s), s)):
        known = next((kept[stem[:n]] for n in range(len(stem) - 1, 2, -1) if stem[:n] in kept), None)
        if known is None or found[stem] > known + 0.7:
            kept[stem] = round(found[stem], 4)
    return kept


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50, weight: np.ndarray | None = None) -> np.ndarray:
    """Newton's method for ridge logistic regression with row weights; the last coefficient is the intercept."""
    weight = np.ones(len(y)) if weight is None else weight
    x = np.hstack([x, np.ones((len(x), 1))])
    beta, penalty = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (weight * (p * (1 - p) + 1e-9))[:, None]).T @ x + penalty, x.T @ (weight * (y - p)) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


class Model:
    def __init__(self, stems: dict[str, float], beta: list[float]):
        self.stems, self.beta, self.matcher = stems, beta, None

    def score(self, texts) -> np.ndarray:
        if self.matcher is None:
            self.matcher = Matcher(self.stems)
        x = np.array([self.matcher.features(t) for t in texts]).reshape(-1, FEATURES)
        beta = np.asarray(self.beta)
        return 1 / (1 + np.exp(-np.clip(x @ beta[:-1] + beta[-1], -30, 30)))

    def __getstate__(self):
        return {"stems": self.stems, "beta": self.beta, "matcher": None}

    def column(self, text: Column | None = None) -> Column:
        """Score of each text."""
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series(self.score(texts))

        run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return F.pandas_udf(run, "double")(clean_text() if text is None else text)


#: Used where there are no labels of both kinds.
DEFAULT_BETA = [1.5, 2.0, 0.3, 0.3, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, -4.0]


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> Model:
    """`labels` (doc_id, label) must hold only rows that may be learned from."""
    sample = cut_lineage(one_of_copies(labelled_sample(docs, labels, rows)))
    found = {r[0]: r for r in sample.groupBy("label").agg(F.count(F.lit(1)), F.sum("copies")).collect()}
    size = {label: r[1] for label, r in found.items()}
    if len(size) < 2:
        return Model({}, DEFAULT_BETA)
    # the ratio of the labels is that of all labelled rows: a sampled row stands for the ids of its label that were left out
    ids = {r[0]: r[1] for r in known_labels(labels).groupBy("label").count().collect()}
    all_rows = {label: r[2] * max(1.0, ids[label] / rows) for label, r in found.items()}
    even = sum(size.values()) / sum(all_rows.values())
    weight = {label: even * all_rows[label] / size[label] for label in size}
    stems = choose_stems(stem_counts(sample), size[1], size[0])
    model = Model(stems, DEFAULT_BETA)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(stems)
        for b in batches:
            yield pd.DataFrame({"label": b["label"], "x": [matcher.features(t) for t in b["text"]]})

    made = sample.mapInPandas(features, "label int, x array<double>").collect()  # at most 2 * SAMPLE rows
    model.beta = fit_logistic(np.array([r[1] for r in made]), np.array([r[0] for r in made], float), weight=np.array([weight[r[0]] for r in made])).tolist()
    return model


def trainable(labels: DataFrame) -> DataFrame:
    """Rows that the contract lets a model learn from."""
    return labels.where(crc_mod("doc_id", 4) != 2).select("doc_id", F.col("toxic").cast("int").alias("label"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    score = train(docs, trainable(labels)).column()
    return docs.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), score.alias("score")).withColumn("predicted", (F.col("score") >= REJECT).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are not rejected, with their columns."""
    return docs.where(train(docs, trainable(labels)).column() < REJECT)
