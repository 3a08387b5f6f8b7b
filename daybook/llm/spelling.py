"""Operator 12: grouping of spelling variants by pivotal grams.

Two words are near if one inserted, deleted or replaced code point turns one into the other. Near words are
found by a similarity join on bigrams:

* All bigrams have one order, rare ones first (by the number of their places in words).
* A word's prefix are its 2 * 1 + 1 = 3 first bigrams in that order (with all that tie with the third), and
  its pivots are two of them that don't overlap, chosen by dynamic programming so that the sum of their
  frequencies is least.
* One edit destroys at most one of two disjoint bigrams. So of two near words, that whose prefix ends
  earlier in the order has a pivot that the other word holds too, in its prefix. If the edit lies behind
  the first pivot, that one is left, as far from the start as before and with the same letters ahead of it; else
  the edit lies ahead of the second one, which is left as far from the end, with the same letters behind it.
  These position limits are part of the key by which pivots meet prefixes.
* On the edit's side, either the two letters beside the bigram are left or the three at the word's other end, so the
  key takes these too, twice. Without them a rare bigram near a word's start would meet all words that start so.
* What meets is compared. That is part of the join's condition, so only near pairs come out of it.

Keys that many words share make large join groups, which Spark's sort-merge join spills and its skew join splits;
a word emits some fifteen small rows, whatever the texts repeat. Words are counted in the tasks first.

A word's form is its near word of largest count (ties: the smallest one in code-point order) if that is
`RATIO` times its own or more; its root is where the forms lead. Counts grow tenfold along forms, so 64-bit
counts end them after 19 steps at most; doubling takes five rounds.

Nulls: a null text has no words; a null doc_id is written as an empty one. Empty texts have no words, long ones
are read whole, repeated rows count each for itself. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import chunks, id_text, written
from .words import mix

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
#: An occurrence whose crc32 this divides loses a code point.
MISSPELT = 31
#: Edits between near words; the number of pivots is one more.
EDITS = 1
#: Letters beside a bigram and at the word's far end that a key asks for, one or the other.
NEXT, FAR = 2, 3
#: Words a task counts before it hands them on.
HELD_WORDS = 200_000
#: Words whose grams a task works out at once.
WORD_BATCH = 50_000
#: Pairs of letters (a-z and U+00C0 to U+00FF): bounds the table of gram counts, which is broadcast.
PAIRS = 90 * 90

#: Letters of a word: ASCII and U+00C0 to U+00FF (fixed value).
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def occurrences(doc_id: int | None, text: bytes, misspelt: int) -> Counter[str]:
    """The words of a text with their counts, those that are dealt an error without one code point."""
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter[str] = Counter()
    for run, n in Counter(RUN.findall(text.lower().decode())).items():  # of bytes: only A-Z
        h = crc32(run.encode(), start)
        if h % misspelt == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1:]
        out[run] += n
    return out


def word_counts(docs: DataFrame, *, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                misspelt: int = MISSPELT) -> DataFrame:
    """word and n of the words of `min_length` code points and `min_count` occurrences or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})
            seen.clear()
            return out

        for b in batches:
            ids = b.column("doc_id").to_pylist()
            for c in chunks(b.column("text")):
                for i in range(c.n):
                    for word, n in occurrences(ids[c.first + i], c.raw(i), misspelt).items():
                        if len(word) >= min_length:
                            seen[word] = seen.get(word, 0) + n
                if len(seen) >= HELD_WORDS:
                    yield rows()
        yield rows()

    parts = id_text(docs).mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class Grams:
    """The bigrams of some words (each of two code points or more): number, word, place."""

    def __init__(self, words: list[str]):
        self.words = words
        flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        self.lengths = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(self.lengths)
        self.firsts = ends - self.lengths
        self.flat = flat
        inner = np.ones(len(flat), bool)
        inner[ends - 1] = False
        self.start = np.flatnonzero(inner)
        owner = np.repeat(np.arange(len(words)), self.lengths)
        self.word = owner[self.start]
        self.place = self.start - self.firsts[self.word]
        #: a gram as a number: letters lie below U+0100
        self.gram = flat[self.start] * 256 + flat[self.start + 1]
        self._ends = self._sides()

    def _sides(self) -> tuple[np.ndarray, np.ndarray]:
        """For each bigram, hashes of what lies ahead of it and behind it in its word."""
        base = np.uint64(0x9E3779B97F4A7C15)
        power = np.ones(int(self.lengths.max(initial=0)) + 2, np.uint64)
        power[1:] = base
        power = np.multiply.accumulate(power)
        at = np.arange(len(self.flat)) - np.repeat(self.firsts, self.lengths)
        letters = mix(self.flat.astype(np.uint64) + np.uint64(1))
        zero = np.zeros(1, np.uint64)
        ahead = np.concatenate([zero, np.cumsum(letters * power[at], dtype=np.uint64)])
        first = self.firsts[self.word]
        from_end = np.repeat(self.lengths, self.lengths) - 1 - at
        behind = np.concatenate([zero, np.cumsum(letters * power[from_end], dtype=np.uint64)])
        end = first + self.lengths[self.word]
        return ahead[self.start] - ahead[first], behind[end] - behind[self.start + 2]

    def _letters(self, at: np.ndarray, n: int) -> np.ndarray:
        """n letters from each place on as a number."""
        out = np.zeros(len(at), np.uint64)
        for k in range(n):
            out = out << np.uint64(8) | self.flat[np.clip(at + k, 0, len(self.flat) - 1)].astype(np.uint64)
        return out

    def keys(self, rows: np.ndarray, back: bool, probe: bool) -> tuple[np.ndarray, np.ndarray]:
        """(rows, keys) of bigrams that an edit behind them (`back`: ahead of them) leaves as they are. A key
        holds the bigram, its place from the side that is left alone, and all letters there. On the edit's
        side either the `NEXT` letters beside the bigram are left alone, or the `FAR` letters at the word's
        other end; if few letters lie there, neither is asked for. A near word may have one letter more
        or less there, so that a probe asks for one kind and the index holds both around the limit."""
        first, size = self.firsts[self.word[rows]], self.lengths[self.word[rows]]
        rest = self.place[rows] if back else size - self.place[rows] - 2
        place = size - self.place[rows] if back else self.place[rows]
        side = self._ends[1 if back else 0][rows]
        stem = mix(side ^ mix((self.gram[rows] * 2 + back).astype(np.uint64)) ^ mix(mix(place.astype(np.uint64))))
        beside = self._letters(self.start[rows] + (-NEXT if back else 2), NEXT)
        beyond = self._letters(first if back else first + size - FAR, FAR)
        some = NEXT + FAR
        many = np.flatnonzero(rest >= some - (not probe))
        few = np.flatnonzero(rest < some + (not probe))
        out = [mix(stem[few]), mix(stem[many] ^ mix(beside[many] + np.uint64(1 << 40))), mix(stem[many] ^ mix(beyond[many] + np.uint64(1 << 41)))]
        return np.concatenate([rows[few], rows[many], rows[many]]), np.concatenate(out).view(np.int64)


def gram_counts(words: DataFrame) -> DataFrame:
    """gram and the number of its places in the words, counted in the tasks first. There are at most as many
    grams as pairs of letters, `PAIRS`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for b in batches:
            for k in range(0, b.num_rows, WORD_BATCH):
                total += np.bincount(Grams(b.column("word").slice(k, WORD_BATCH).to_pylist()).gram, minlength=1 << 16)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"gram": pa.array(seen, pa.int64()), "n": pa.array(total[seen], pa.int64())})

    return words.select("word").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _running_min(value: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """For rows of words, the row of the least value up to each in its word; `nth` counts a word's rows."""
    out = np.arange(len(value))
    by_nth = np.argsort(nth, kind="stable")
    ends = np.cumsum(np.bincount(nth))
    for a, b in zip(ends, ends[1:], strict=False):
        rows = by_nth[a:b]
        before = out[rows - 1]
        out[rows] = np.where(value[before] <= value[rows], before, rows)
    return out


def pivots(word: np.ndarray, place: np.ndarray, cost: np.ndarray, pieces: int = EDITS + 1) -> np.ndarray:
    """Mask of the bigrams chosen in each word: `pieces` that don't overlap and cost least together. Rows are
    sorted by word and place. Dynamic programming over the rows: with j pieces, a row is taken with the
    best choice of j - 1 pieces that ends ahead of it, or the best of the rows before it stays."""
    n, out = len(word), np.zeros(len(word), bool)
    if not n:
        return out
    first = np.flatnonzero(np.diff(word, prepend=-1))
    start = np.repeat(first, np.diff(first, append=n))
    nth = np.arange(n) - start
    line = place + word * (int(place.max()) + 3)
    free = np.searchsorted(line, line - 2, side="right") - 1  # the last row that doesn't overlap
    never = np.int64(1) << 60
    free_ok = free >= start
    value, chosen = cost.astype(np.int64), []
    for j in range(pieces):
        if j:
            value = np.where(free_ok, np.minimum(cost + best[np.maximum(free, 0)], never), never)
        row = _running_min(value, nth)
        best = value[row]
        chosen.append(row)
    at = np.append(first[1:], n) - 1
    for row in reversed(chosen):
        at = row[at]
        out[at] = True
        at = free[at]
    return out


def _signatures(words: DataFrame) -> DataFrame:
    """The keys of every word's prefix (probe false) and of its two pivots (probe true): key; word, n; last
    (the prefix's end in the order of grams)."""
    counts = {r["gram"]: r["n"] for r in gram_counts(words).collect()}  # at most PAIRS rows
    grams = sorted(counts, key=lambda g: (counts[g], g))
    order = np.zeros(1 << 16, np.int64)
    order[grams] = np.arange(len(grams))
    weight = np.zeros(1 << 16, np.int64)
    weight[grams] = [counts[g] for g in grams]
    table = words.sparkSession.sparkContext.broadcast((order, weight))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, weight = table.value
        for b in batches:
            for k in range(0, b.num_rows, WORD_BATCH):
                names, n = b.column("word").slice(k, WORD_BATCH), b.column("n").slice(k, WORD_BATCH)
                g = Grams(names.to_pylist())
                rank = order[g.gram]
                by_rank = np.lexsort((rank, g.word))
                nth = np.arange(len(rank)) - np.searchsorted(g.word, np.arange(len(g.words)))[g.word]
                third = by_rank[nth == 2 * EDITS]  # the rows of a word keep their range when sorted
                last = rank[third]
                own = np.flatnonzero(rank <= last[g.word])
                pivot = own[pivots(g.word[own], g.place[own], weight[g.gram[own]])]
                one, two = pivot[0::2], pivot[1::2]
                made = [(False, *g.keys(own, back, False)) for back in (False, True)]
                made += [(True, *g.keys(one, False, True)), (True, *g.keys(two, True, True))]
                rows = np.concatenate([r for _, r, _ in made])
                at = pa.array(g.word[rows])
                yield pa.RecordBatch.from_pydict({
                    "probe": pa.array(np.repeat([x for x, _, _ in made], [len(r) for _, r, _ in made])),
                    "key": pa.array(np.concatenate([h for _, _, h in made])),
                    "word": names.take(at), "n": n.take(at), "last": pa.array(last[g.word[rows]])})

    return words.select("word", "n").mapInArrow(sign, "probe boolean, key long, word string, n long, last long")


def near_pairs(words: DataFrame) -> DataFrame:
    """word, n, other, other_n for every pair of near words of `words` (word, n; words differ), both ways."""
    signed = written(_signatures(words), "grams")
    a = signed.where("probe").select("key", "word", "n", "last")
    b = signed.where("not probe").select("key", *(F.col(c).alias(f"other_{c}") for c in ("word", "n", "last")))
    near = F.levenshtein("word", "other_word", EDITS) == EDITS
    met = a.join(b, (a["key"] == b["key"]) & (F.col("last") <= F.col("other_last")) & near)
    pairs = met.select(F.least("word", "other_word").alias("a"), F.greatest("word", "other_word").alias("b"),
                       F.when(F.col("word") < F.col("other_word"), F.col("n")).otherwise(F.col("other_n")).alias("a_n"),
                       F.when(F.col("word") < F.col("other_word"), F.col("other_n")).otherwise(F.col("n")).alias("b_n"))
    pairs = pairs.groupBy("a", "b").agg(F.first("a_n").alias("a_n"), F.first("b_n").alias("b_n"))
    ways = F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("other"), F.col("a_n").alias("other_n"))))
    return pairs.select(ways.alias("p")).select("p.*")


def _followed(forms: DataFrame) -> DataFrame:
    """word and root: where the forms (word, form) lead, by doubling."""
    steps = written(forms.select("word", F.col("form").alias("root")), "forms")
    for _ in range(5):
        on = steps.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        met = steps.join(on, steps["root"] == F.col("_at"), "left")
        if met.where("_next is not null").limit(1).count() == 0:
            break
        steps = written(met.select("word", F.coalesce("_next", "root").alias("root")), "forms")
    return steps


def variants(words: DataFrame, *, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n, root for words (word, n), each once."""
    words = written(words.select("word", "n"), "words")
    best: Column = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other")))
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"), F.first("n").alias("own"))
    often = -F.col("best.less") >= ratio * F.col("own")
    near = written(near.select(F.col("word").alias("_word"), "n_near", F.when(often, F.col("best.other")).alias("form"),
                               F.when(often, -F.col("best.less")).alias("form_n")), "near")
    roots = _followed(near.where("form is not null").select(F.col("_word").alias("word"), "form"))
    roots = roots.select(F.col("word").alias("_word"), "root")
    known = near.join(roots, "_word", "left")
    return words.join(known, F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def spelling_variants(docs: DataFrame, *, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, misspelt: int = MISSPELT,
                      ratio: int = RATIO) -> DataFrame:
    """The words of all texts with their near words, forms and roots."""
    return variants(word_counts(docs, min_length=min_length, min_count=min_count, misspelt=misspelt), ratio=ratio)
