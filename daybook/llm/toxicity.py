"""Operator 8: toxicity by a weighted finite-state pattern grammar.

A text's words become symbols: insult (listed or learned), verb of harm, intent, target, negation,
reporting verb, other. Small transducers, each a table `(state, symbol) -> (state, symbol, factor)`,
rewrite the symbols of a clause; `compose` makes one table of several (pairs of states, the symbol
that the first one writes is read by the second, factors are multiplied):

* `ahead` reads a clause from its end: insults and verbs of harm that a target follows are aimed;
* `behind`, from the start on: so are insults that follow a target;
* `threat`: intent, then an aimed verb of harm, becomes a threat;
* `negation`: a match soon after a negation is no longer accepted, and its insult weighs less;
* `report`: so is a match after a reporting verb in the clause.

`ahead` runs over a clause backwards, the composition of the others over what it wrote. The grammar
accepts a clause with an aimed insult or a threat: these count with the weights of their words times
the factors. Insults that no target or threat accepts are loose. Words that match nothing score
nothing. A document's features are its best accepted clause, the total of accepted clauses, and the
total with the loose insults; a logistic curve over the three gives the score, so a loose insult has
the weight that the labels give it, and an accepted one never less.

Insults are a short list and what the labels teach: words whose share of toxic documents is far
above that of clean ones (log odds less their standard error), and beginnings of words (stems) that
have such a share and are borne out by at least `STEM_WORDS` different learned words. The curve is
fitted with the words learned from folds `LEXICON_FOLDS` on the other training rows, so that a
chance word can't vouch for itself; then words are learned from all training rows. Both take bounded
samples (`SAMPLE_ROWS` rows, by a hash of the id; `LEXICON_SIZE` entries).

Nulls: a null text is empty and gets the curve's value for no match; rows with a null id or label
aren't learned from, a null id is carried along. With no toxic or no clean training row the
default curve is used. Repeated rows are scored each for itself, a repeated label counts once per
row. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .language_id import fold_of
from .tables import chunks, id_text, written

SAMPLE_ROWS = 20_000
LEXICON_SIZE = 4096
MIN_DOCS = 3
MIN_WEIGHT = 2.0
STEMS = range(4, 8)
STEM_WORDS = 3
LEXICON_FOLDS = (1, 2, 3)
CACHE_SIZE = 500_000

# Symbols of words, and those that the transducers write.
OTHER, INSULT, HARM, INTENT, TARGET, NEGATION, REPORT, AIMED, AIMED_HARM, THREAT = range(10)
SYMBOLS = range(10)
#: What the grammar accepts.
ACCEPTED = (AIMED, THREAT)

#: Words of the grammar (fixed values; English). Weights are log odds before any learning.
WORDS = {
    INSULT: {"idiot": 3.0, "moron": 3.0, "scum": 3.0, "loser": 2.5, "stupid": 2.0, "worthless": 2.0,
             "pathetic": 2.0, "disgusting": 1.5, "trash": 1.5, "clown": 1.5, "imbecile": 3.0, "bastard": 3.0},
    HARM: {"kill": 3.0, "hurt": 2.5, "beat": 2.0, "destroy": 2.0, "murder": 3.0, "punch": 2.5, "stab": 3.0},
    INTENT: dict.fromkeys(["will", "gonna", "shall", "going", "should", "must"], 0.0),
    TARGET: dict.fromkeys(["you", "your", "yours", "you're", "he", "she", "him", "her", "they", "them",
                           "people", "everyone"], 0.0),
    NEGATION: dict.fromkeys(["not", "no", "never", "isn't", "aren't", "wasn't", "don't", "doesn't",
                             "cannot", "can't", "won't", "without"], 0.0),
    REPORT: dict.fromkeys(["said", "says", "wrote", "writes", "reported", "quoted", "quotes", "claimed",
                           "called", "calling", "according"], 0.0),
}
#: Factors of the transducers, and how many words a state lasts.
AIMED_FACTOR, NEGATED, REPORTED = 1.3, 0.5, 0.6
TARGET_REACH, NEGATION_REACH, INTENT_REACH = 5, 3, 4

#: A transducer: (state, symbol) -> (next state, symbol written, factor). It starts in state 0.
Table = dict[tuple[int, int], tuple[int, int, float]]


def within(opener: int, reach: int, writes: dict[int, tuple[int, float]]) -> Table:
    """The transducer that rewrites symbols read at most `reach` words after an `opener`. Its state is
    the number of words for which the opener still holds."""
    table = {}
    for state in range(reach + 1):
        for s in SYMBOLS:
            written, factor = writes.get(s, (s, 1.0)) if state else (s, 1.0)
            table[state, s] = (reach if s == opener else max(0, state - 1), written, factor)
    return table


def after(opener: int, writes: dict[int, tuple[int, float]]) -> Table:
    """As `within`, up to the end of the clause."""
    table = {}
    for s in SYMBOLS:
        table[0, s] = (int(s == opener), s, 1.0)
        table[1, s] = (1, *writes.get(s, (s, 1.0)))
    return table


def compose(first: Table, second: Table) -> Table:
    """The transducer that writes what `second` writes when it reads what `first` writes; of the
    pairs of states those that can be reached, numbered as they are met."""
    number, table = {(0, 0): 0}, {}
    todo = [(0, 0)]
    while todo:
        x, y = todo.pop()
        for s in SYMBOLS:
            x2, middle, f = first[x, s]
            y2, written, g = second[y, middle]
            if (x2, y2) not in number:
                number[x2, y2] = len(number)
                todo.append((x2, y2))
            table[number[x, y], s] = (number[x2, y2], written, f * g)
    return table


def _weakened(factor: float) -> dict[int, tuple[int, float]]:
    return {INSULT: (INSULT, factor), AIMED: (INSULT, factor), THREAT: (OTHER, factor)}


#: Read from a clause's end.
AHEAD = within(TARGET, TARGET_REACH, {INSULT: (AIMED, AIMED_FACTOR), HARM: (AIMED_HARM, 1.0)})
#: Read from its start on, over what AHEAD wrote.
BEHIND = within(TARGET, TARGET_REACH, {INSULT: (AIMED, AIMED_FACTOR)})
THREATENING = within(INTENT, INTENT_REACH, {AIMED_HARM: (THREAT, 1.0)})
NEGATING = within(NEGATION, NEGATION_REACH, _weakened(NEGATED))
REPORTING = after(REPORT, _weakened(REPORTED))
ONWARD = compose(compose(compose(BEHIND, THREATENING), NEGATING), REPORTING)

_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;\n]")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")


def stems_of(word: str) -> list[str]:
    return [word[:k] + "-" for k in STEMS if len(word) > k]


@dataclass
class Lexicon:
    """Word -> (symbol, weight), with learned words and stems over the fixed list."""

    learned: dict[str, float] = field(default_factory=dict)

    def __post_init__(self):
        self.fixed = {w: (s, v) for s, ws in WORDS.items() for w, v in ws.items()}

    def look_up(self, word: str) -> tuple[int, float]:
        best = max([self.learned.get(x, 0.0) for x in (word, *stems_of(word))])
        symbol, weight = self.fixed.get(word, (OTHER, 0.0))
        if best > 0 and symbol in (OTHER, INSULT):
            return INSULT, max(best, weight)
        return symbol, weight


class Reader:
    """Scores texts; words' symbols are kept in a bounded cache."""

    def __init__(self, lexicon: Lexicon, limit: int = CACHE_SIZE):
        self.lexicon, self.limit, self.known = lexicon, limit, {}

    def symbol(self, word: str) -> tuple[int, float]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= self.limit:
                self.known.clear()
            found = self.known[word] = self.lexicon.look_up(word)
        return found

    def features(self, text: str) -> tuple[float, float, float]:
        """(best accepted clause, total of these, total with loose insults); zeros if no word can match."""
        text = text.lower()
        symbol = self.symbol
        if not any(symbol(w)[0] in (INSULT, HARM) for w in set(_WORD.findall(text))):
            return 0.0, 0.0, 0.0
        scores = []
        clause: list[tuple[int, float]] = []
        for token in _TOKEN.findall(text):
            if token in ".!?;\n":
                scores.append(clause_score(clause))
                clause = []
            else:
                clause.append(symbol(token))
        scores.append(clause_score(clause))
        total = sum(x for x, _ in scores)
        return max(x for x, _ in scores), total, total + sum(x for _, x in scores)


def clause_score(clause: list[tuple[int, float]]) -> tuple[float, float]:
    """(accepted, loose) weight of one clause's (symbol, weight) pairs."""
    if not any(s in (INSULT, HARM) for s, _ in clause):
        return 0.0, 0.0
    state, marked = 0, []
    for s, weight in reversed(clause):
        state, written, factor = AHEAD[state, s]
        marked.append((written, weight * factor))
    state, accepted, loose = 0, 0.0, 0.0
    for s, weight in reversed(marked):
        state, written, factor = ONWARD[state, s]
        if written in ACCEPTED:
            accepted += weight * factor
        elif written == INSULT:
            loose += weight * factor
    return accepted, loose


# ------------------------------------------------------------------ learning


def sampled(rows: DataFrame, most: int) -> DataFrame:
    """About `most` rows, by a hash of the id (all if there are fewer)."""
    n = rows.count()
    if n <= most:
        return rows
    place = F.pmod(F.xxhash64(F.lit("toxicity"), F.col("doc_id")), F.lit(1_000_000)) / 1e6
    return rows.where(place < most / n)


def learn_lexicon(rows: DataFrame, *, size: int = LEXICON_SIZE, min_docs: int = MIN_DOCS,
                  min_weight: float = MIN_WEIGHT) -> Lexicon:
    """Words and stems of (text, toxic) rows by their log odds. Documents are counted in tasks and
    summed by a shuffle with map-side sums."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            toxic = b.column("toxic").to_pylist()
            for c in chunks(b.column("text"), 1 << 20):
                seen: dict[str, list[int]] = {}
                for i in range(c.n):
                    words = set(_WORD.findall(c.raw(i).decode().lower()))
                    for x in words | {s for w in words for s in stems_of(w)}:
                        seen.setdefault(x, [0, 0])[toxic[c.first + i]] += 1
                yield pa.RecordBatch.from_pydict({
                    "entry": pa.array(list(seen), pa.string()),
                    "clean": pa.array([x[0] for x in seen.values()], pa.int64()),
                    "toxic": pa.array([x[1] for x in seen.values()], pa.int64())})

    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return Lexicon()
    n = (rows.select("text", "toxic").mapInArrow(count, "entry string, clean long, toxic long")
         .groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
         .where(F.col("toxic") >= min_docs))
    odds = F.log((F.col("toxic") + 0.5) / (totals[1] + 1.0)) - F.log((F.col("clean") + 0.5) / (totals[0] + 1.0))
    odds -= F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))  # its standard error
    best = n.withColumn("weight", odds).where(F.col("weight") >= min_weight).orderBy(
        F.desc(F.col("weight") * F.log1p("toxic")), "entry").limit(size)
    return Lexicon(supported({r["entry"]: min(r["weight"], 8.0) for r in best.select("entry", "weight").collect()}))


def supported(entries: dict[str, float]) -> dict[str, float]:
    """The words, and the stems that at least `STEM_WORDS` of the words begin with."""
    borne = Counter(x for w in entries if not w.endswith("-") for x in stems_of(w))
    return {x: v for x, v in entries.items() if not x.endswith("-") or borne[x] >= STEM_WORDS}


#: Of a logistic curve: constant, best clause, log of 1 + total, log of 1 + total with loose insults. What
#: holds before any learning; `PRIOR` is how much it weighs against the labels' rows.
CURVE = (-3.0, 1.0, 1.0, 0.25)
PRIOR = 1.0


@dataclass
class Model:
    lexicon: Lexicon
    curve: tuple[float, float, float, float] = CURVE

    def score(self, best: float, total: float, with_loose: float) -> float:
        a, b, c, d = self.curve
        z = a + b * best + c * math.log1p(total) + d * math.log1p(with_loose)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit_curve(x: np.ndarray, y: np.ndarray, prior: float = PRIOR) -> tuple[float, float, float, float]:
    """Logistic regression by Newton steps over (best, total, total with loose), drawn to `CURVE`.
    More of a match never lowers a score: a feature whose slope would be below zero is left out and
    the rest is fitted again."""
    a = np.column_stack([np.ones(len(x)), x[:, 0], np.log1p(x[:, 1:])])
    used = list(range(a.shape[1]))
    while True:
        w = _newton(a[:, used], y, np.array(CURVE)[used], prior)
        low = min(range(1, len(used)), key=lambda k: w[k], default=0)
        if not low or w[low] >= 0:
            break
        del used[low]
    curve = np.zeros(a.shape[1])
    curve[used] = w
    return tuple(float(v) for v in curve)


def _newton(a: np.ndarray, y: np.ndarray, centre: np.ndarray, prior: float) -> np.ndarray:
    w = centre.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + prior * (w - centre)
        hess = (a * (p * (1 - p))[:, None]).T @ a + np.diag([prior + 1e-6] * len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 4.0 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _read(rows: DataFrame, lexicon: Lexicon, cache_size: int) -> DataFrame:
    """doc_id, best, total, with_loose of every row."""
    known = rows.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(known.value, cache_size)
        for b in batches:
            for c in chunks(b.column("text")):
                f = [reader.features(c.raw(i).decode()) for i in range(c.n)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": b.column("doc_id").slice(c.first, c.n),
                    "best": pa.array([x[0] for x in f], pa.float64()),
                    "total": pa.array([x[1] for x in f], pa.float64()),
                    "with_loose": pa.array([x[2] for x in f], pa.float64())})

    return id_text(rows).mapInArrow(run, "doc_id long, best double, total double, with_loose double")


def fit(docs: DataFrame, labels: DataFrame, *, folds: int = 5, held_out: int = 0, sample_rows: int = SAMPLE_ROWS,
        lexicon_size: int = LEXICON_SIZE, cache_size: int = CACHE_SIZE) -> Model:
    """A model from the labelled rows outside of the held-out fold."""
    fold = fold_of(F.col("doc_id"), folds)
    y = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
         .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold != held_out)))
    # the sample's size is the parameter's, so it can be broadcast: texts aren't shuffled for it
    rows = id_text(docs).join(F.broadcast(sampled(y, sample_rows)), "doc_id").withColumn("text", F.coalesce("text", F.lit("")))
    rows = written(rows, "toxic-sample")  # bounded; read several times
    own = fold_of(F.col("doc_id"), folds).isin(*LEXICON_FOLDS)
    lexicon = learn_lexicon(rows.where(own), size=lexicon_size)
    rest = rows.where(~own)
    f = _read(rest, lexicon, cache_size).join(rest.select("doc_id", "toxic").distinct(), "doc_id")
    data = np.array([tuple(r) for r in f.select("best", "total", "with_loose", "toxic").collect()], float).reshape(-1, 4)
    lexicon = learn_lexicon(rows, size=lexicon_size)
    if len(set(data[:, 3].tolist())) < 2:
        return Model(lexicon)
    return Model(lexicon, fit_curve(data[:, :3], data[:, 3]))


def score(docs: DataFrame, model: Model, *, cache_size: int = CACHE_SIZE) -> DataFrame:
    """doc_id, score (0 to 1), best, total, with_loose of every text."""
    a, b, c, d = model.curve
    z = F.lit(a) + F.lit(b) * F.col("best") + F.lit(c) * F.log1p("total") + F.lit(d) * F.log1p("with_loose")
    bounded = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))
    return _read(docs, model.lexicon, cache_size).withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-bounded)))
