"""Operator 9: language identification by rank-order n-gram profiles.

A profile is the `PROFILE_SIZE` most frequent letter n-grams (1 to 3 letters, word ends marked)
of a language's training texts, by rank. A text's own most frequent n-grams are ranked alike,
and its distance to a language is the sum of how far each is out of place there (an n-gram that
the profile lacks counts `PROFILE_SIZE`). The nearest language is predicted.

Profiles are fitted on a bounded sample: about `ROWS_PER_LANGUAGE` training rows of each language,
taken by a hash of the id, counted by Spark; `PROFILE_SIZE` n-grams a language reach the driver.

Nulls: a null text, an empty one or one without letters is `und` with score 0; a null lang or
null id row isn't learned from, a null id is carried along. With no training rows every text is
`und`. Ties go to the language first in the alphabet, ties in rank to the smaller n-gram.
Repeated rows are predicted each for itself. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import chunks

PROFILE_SIZE = 400
TEXT_SIZE = 300
ROWS_PER_LANGUAGE = 2000
UNKNOWN = "und"
#: Text bytes counted at once: an n-gram takes about 50 bytes of arrays.
CHUNK = 1 << 19
#: A text that shares less than this with every profile is rejected by `accepted`.
MIN_SCORE = 0.02

_BITS = np.int64(21)  # of a code point
_EDGE = 1  # stands for a run of characters that aren't letters
_LETTER = np.array([chr(i).isalpha() if not 0xD800 <= i < 0xE000 else False for i in range(0x20000)])


def fold_of(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, n-gram) of every 1- to 3-gram. An n-gram holds code points, 21 bits each."""
    low = [x.lower() for x in texts]
    code = np.frombuffer("\n".join(low).encode("utf-32-le"), np.uint32).astype(np.int64)
    code = np.concatenate([[ord("\n")], code, [ord("\n")]])
    doc = np.zeros(len(code), np.int64)
    ends = np.cumsum([len(x) + 1 for x in low])[:-1]
    doc[ends + 1] = 1
    doc = np.cumsum(doc)
    letter = np.zeros(len(code), bool)
    small = code < len(_LETTER)
    letter[small] = _LETTER[code[small]]
    for i in np.flatnonzero(~small):
        letter[i] = chr(code[i]).isalpha()
    code = np.where(letter, code, _EDGE)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # of a run of others, the first stands for all
    keep[0] = True
    code, doc, letter = code[keep], doc[keep], letter[keep]
    out_doc, out = [doc[letter]], [code[letter]]
    # an edge belongs to either side; the text is the letter's
    pair = code[:-1] << _BITS | code[1:]
    out_doc.append(np.where(letter[:-1], doc[:-1], doc[1:]))
    out.append(pair)
    if len(code) > 2:
        mid = np.flatnonzero(letter[1:-1])
        out_doc.append(doc[1:-1][mid])
        out.append(pair[:-1][mid] << _BITS | code[2:][mid])
    return np.concatenate(out_doc), np.concatenate(out)


def counted(doc: np.ndarray, gram: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, n-gram, count) of n texts, sorted by text and n-gram. Code points are numbered
    anew so that text and n-gram fit one integer."""
    mask = (np.int64(1) << _BITS) - 1
    places = [(gram >> (_BITS * k)) & mask for k in range(3)]
    used = np.zeros(0x110000, bool)
    for p in places:
        used[p] = True
    letters = np.flatnonzero(used)
    number = np.zeros(0x110000, np.int64)
    number[letters] = np.arange(len(letters))
    base = max(2, len(letters))
    small = (number[places[2]] * base + number[places[1]]) * base + number[places[0]]
    if n * base ** 3 < 1 << 62:
        key = np.sort(doc * base ** 3 + small)
        first = np.flatnonzero(np.diff(key, prepend=-1))
        d, s = np.divmod(key[first], base ** 3)
        count = np.diff(first, append=len(key))
    else:
        order = np.lexsort((small, doc))
        d, s = doc[order], small[order]
        first = np.flatnonzero((np.diff(d, prepend=-1) != 0) | (np.diff(s, prepend=-1) != 0))
        d, s, count = d[first], s[first], np.diff(first, append=len(d))
    a, b, c = s // (base * base), s // base % base, s % base
    return d, letters[a] << (2 * _BITS) | letters[b] << _BITS | letters[c], count


def top_ranked(doc: np.ndarray, gram: np.ndarray, count: np.ndarray, n: int, size: int):
    """(text, n-gram, rank) of the `size` most frequent n-grams of each of n texts."""
    most = int(count.max(initial=0)) + 1
    order = np.argsort(doc * most - count, kind="stable")  # ties stay in n-gram order
    doc, gram = doc[order], gram[order]
    starts = np.searchsorted(doc, np.arange(n))
    rank = np.arange(len(doc)) - starts[doc]
    top = rank < size
    return doc[top], gram[top], rank[top]


class Profiles:
    """The languages, their known n-grams (sorted) and each one's rank by language."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.languages = sorted({x[0] for x in rows})
        self.size = size
        self.grams = np.array(sorted({x[1] for x in rows}), np.int64)
        self.ranks = np.full((len(self.languages), len(self.grams) + 1), -1, np.int64)
        at = {g: k for k, g in enumerate(self.grams.tolist())}
        no = {x: k for k, x in enumerate(self.languages)}
        for lang, gram, rank in rows:
            self.ranks[no[lang], at[gram]] = rank

    def predict(self, texts: list[str], text_size: int = TEXT_SIZE) -> tuple[list[str], np.ndarray]:
        n = len(texts)
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n)
        doc, gram, rank = top_ranked(*counted(*grams(texts), n), n, text_size)
        at = np.searchsorted(self.grams, gram)
        at[(at >= len(self.grams)) | (self.grams[np.minimum(at, len(self.grams) - 1)] != gram)] = len(self.grams)
        own = np.bincount(doc, minlength=n)
        worst = np.maximum(own, 1) * self.size
        distance = np.empty((len(self.languages), n))
        for k, ranks in enumerate(self.ranks):
            there = ranks[at]
            apart = np.where(there < 0, self.size, np.minimum(np.abs(there - rank), self.size))
            distance[k] = np.bincount(doc, weights=apart, minlength=n)
        best = np.argmin(distance, axis=0)
        score = np.clip(1 - distance[best, np.arange(n)] / worst, 0, 1)
        lang = [self.languages[k] if m else UNKNOWN for k, m in zip(best, own, strict=True)]
        return lang, np.where(own > 0, score, 0.0)


def fit(train: DataFrame, *, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id",
        size: int = PROFILE_SIZE, rows_per_language: int = ROWS_PER_LANGUAGE) -> Profiles:
    """Profiles of the training rows' languages (rows without id, lang or text are left out)."""
    rows = train.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                        F.col(text_col).alias("text")).where("doc_id is not null and lang is not null")
    n = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n:
        return Profiles([], size)
    share = F.create_map(*[F.lit(x) for k, v in n.items() for x in (k, min(1.0, rows_per_language / v))])
    place = F.pmod(F.xxhash64(F.lit("language"), F.col("doc_id")), F.lit(1_000_000)) / 1e6
    sample = rows.where((place < share[F.col("lang")]) & F.col("text").isNotNull()).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = b.column("lang").to_pylist()
            for c in chunks(b.column("text"), CHUNK):
                of = langs[c.first:c.last]
                names = sorted(set(of))
                number = np.array([names.index(x) for x in of], np.int64)
                doc, gram = grams([c.raw(i).decode() for i in range(c.n)])
                k, g, m = counted(number[doc], gram, len(names))
                yield pa.RecordBatch.from_pydict({"lang": pa.array([names[i] for i in k], pa.string()),
                                                  "gram": pa.array(g), "n": pa.array(m.astype(np.int64))})

    total = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # one window per language, over the distinct n-grams of its bounded sample
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")) - 1
    top = total.withColumn("rank", rank).where(F.col("rank") < size)
    return Profiles([(r["lang"], r["gram"], r["rank"]) for r in top.select("lang", "gram", "rank").collect()], size)


def predict(docs: DataFrame, profiles: Profiles, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (1: every n-gram in place; 0: none known) of every text."""
    known = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks(b.column("text"), CHUNK):
                lang, score = known.value.predict([c.raw(i).decode() for i in range(c.n)])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": b.column("doc_id").slice(c.first, c.n),
                    "lang_pred": pa.array(lang, pa.string()), "score": pa.array(score)})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def accepted(docs: DataFrame, profiles: Profiles, *, text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of `docs` whose text has a language; all their columns, nothing shuffled."""
    known = docs.sparkSession.sparkContext.broadcast(profiles)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks(b.column(place), CHUNK):
                lang, score = known.value.predict([c.raw(i).decode() for i in range(c.n)])
                keep = pa.array([x != UNKNOWN for x in lang] & (score >= min_score))
                yield b.slice(c.first, c.n).filter(keep)

    return docs.mapInArrow(run, docs.schema)
