"""Operator 3: quality rules on repetition coverage.

Rolling hashes of word n-grams of several lengths find the n-grams that occur twice or more in a
text; the measure of a length is the share of the text's word characters that lie in repeats
(occurrences after the first). Only places whose shortest n-gram is repeated can repeat a longer
one, so the longer ones are hashed there alone. Lines are measured alike: the share of characters
in lines that equal an earlier line of the text.

A text is kept if it passes the base rule (enough words, few of them in repeated 5-word windows)
and no share is above its limit. The limits are the published ones for large web corpora.

Nulls: a null text counts as empty (no words: base rule fails); a null id is carried along.
Repeated rows are judged each for itself. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .tables import Chunk, chunks, id_text
from .words import Words, covered, mix, rolling

#: n-gram length -> largest share of word characters inside repeats.
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_LIMIT = 0.20
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_BLANK = b" \t\n\r\x0b\x0c"


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the keys that occur twice or more, and of their occurrences after the first."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later, any_ = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    any_[order[1:][same]] = True
    any_[order[:-1][same]] = True
    return any_, later


def duplicate_lines(raw: bytes) -> tuple[int, int, int]:
    """(lines with a word equal to an earlier line, their characters, characters of all such)."""
    seen, n, chars, total = set(), 0, 0, 0
    for line in raw.split(b"\n"):
        if line.strip(_BLANK):
            total += len(line)
            if line in seen:
                n += 1
                chars += len(line)
            seen.add(line)
    return n, chars, total


def measure(c: Chunk, limits: dict[int, float]) -> dict[str, np.ndarray]:
    """All measures of a chunk's texts, one array each."""
    w = Words(c)
    h = w.hashes()
    size = int(c.offs[-1])
    body = c.buf[:size]
    chars = np.concatenate([[0], np.cumsum(w.solid & ((body & 0xC0) != 0x80))])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[body])])
    word_chars = chars[w.ends] - chars[w.starts]
    total = np.diff(chars[c.offs])
    out = {"n_words": w.counts, "word_chars": total, "n_symbols": np.diff(symbols[c.offs])}

    def per_text(mask: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
        part = np.concatenate([[0], np.cumsum(mask if weight is None else mask * weight)])
        return np.diff(part[w.bounds])

    own = mix(w.doc.astype(np.uint64) + np.uint64(1))
    places, shortest = None, min([WINDOW, *limits])
    for n in sorted({WINDOW, *limits}):
        at = w.window_places(n)
        if n > shortest:
            at = at[places[at]]  # of the shorter n-grams' repeats
        any_, later = repeats(rolling(h, n)[at] ^ own[at] if len(at) else np.zeros(0, np.uint64))
        if n == WINDOW:
            out["n_repeat_words"] = per_text(covered(len(h), at[any_], n))
        if n in limits:
            out[f"share_{n}"] = per_text(covered(len(h), at[later], n), word_chars) / np.maximum(total, 1)
        places = np.zeros(len(h), bool)
        places[at[any_]] = True
    lines = np.array([duplicate_lines(c.raw(i)) for i in range(c.n)], np.int64).reshape(-1, 3)
    out["n_dup_lines"] = lines[:, 0]
    out["line_share"] = lines[:, 1] / np.maximum(lines[:, 2], 1)
    return out


def quality(docs: DataFrame, *, ngram_limits: dict[int, float] | None = None, line_limit: float = LINE_LIMIT,
            min_words: int = MIN_WORDS, max_repeated_percent: int = MAX_REPEATED_PERCENT) -> DataFrame:
    """Per document: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, and the shares that decided."""
    limits = NGRAM_LIMITS if ngram_limits is None else ngram_limits
    longs = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    shares = [*(f"share_{n}" for n in sorted(limits)), "line_share"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks(b.column("text")):
                m = measure(c, limits)
                failed = (m["n_words"] < min_words) | (100 * m["n_repeat_words"] > max_repeated_percent * m["n_words"])
                fine = m["line_share"] <= line_limit
                for n, most in limits.items():
                    fine &= m[f"share_{n}"] <= most
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": b.column("doc_id").slice(c.first, c.n)}
                    | {k: pa.array(m[k].astype(np.int64)) for k in longs}
                    | {"base_failed": pa.array(failed), "kept": pa.array(~failed & fine)}
                    | {k: pa.array(m[k].astype(np.float64)) for k in shares})

    return id_text(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{k} long" for k in longs)
                                    + ", base_failed boolean, kept boolean, "
                                    + ", ".join(f"{k} double" for k in shares))
