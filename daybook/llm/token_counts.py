"""Operator 1: token counts by a map-side two-tier lookup of pre-token lengths.

Tier one is a broadcast hash table: the token counts of the most frequent pre-tokens of a
bounded sample (about `SAMPLE_ROWS` documents from all partitions, `TABLE_SIZE` entries). Tier two is a cache in each
Python worker: a miss is encoded by the library and remembered (at most `CACHE_SIZE` entries,
the older half then goes). No pre-token is shuffled but the sample's sums; both tiers only save work, the counts are
the library's for every text.

A pre-token here is a space-led piece of the text: the piece after each single space, with that
space. The tokenizer's pattern lets a space only begin a token or stand in a white-space run, so
no token crosses such a cut unless the space has white space on both sides (or white space
before it and the end behind it). Texts in which that occurs, or that hold a control character
on which pattern engines disagree, are encoded whole by the library.

Nulls: a null text counts as empty (0 bytes, 0 tokens); a null id is carried along. Repeated
rows are counted each for itself. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import chunks, id_text
from .tokenizers_io import BYTE_BPE, Pretokens, TwoGenerations, load, split_plain

SAMPLE_ROWS = 2000
TABLE_SIZE = 32768
CACHE_SIZE = 500_000

#: A space between white space (or before the end): cutting there would split a run in two.
_JOINED = re.compile(r"\s \s|\s $|^ \s|^ $|[\x1c-\x1f\x85]")

#: The tokenizer's own pattern (fixed value), where a NUL stands between pieces.
_PATTERN = regex.compile(r"\0|'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}\0]+|\s+(?![^\s\0])|\s+")


def pieces(text: str) -> list[str] | None:
    """The text cut before each space; None if only the whole text may be encoded."""
    if _JOINED.search(text):
        return None
    first, *rest = text.split(" ")
    return [x for x in (first,) if x] + [" " + x for x in rest]


class PieceCounts(TwoGenerations):
    """Piece -> number of tokens. `frequent` is tier one; then a piece that was met before; then
    its pre-tokens, each by the worker's cache or encoded."""

    def __init__(self, frequent: dict[str, int], tokenizer, limit: int = CACHE_SIZE):
        super().__init__(limit)
        self.frequent, self.tokenizer = frequent, tokenizer
        self.pretokens = Pretokens(tokenizer, limit // 2)

    def learn(self, keys: set[str]) -> None:
        """Make sure that all of `keys` are in this cache or in the frequent table."""
        simple, odd = split_plain(list(self.missing(keys.difference(self.frequent))))
        ids = self.pretokens.of_each(simple, _PATTERN)
        self.update((x, len(y) // 4) for x, y in zip(simple, ids, strict=True))
        self.update((x, len(self.tokenizer.encode(x, add_special_tokens=False))) for x in odd)

    def count(self, texts: list[str]) -> list[int]:
        cut = [pieces(x) for x in texts]
        self.learn(set().union(*(x for x in cut if x)))
        whole, often = self.tokenizer, self.frequent.get  # no piece has no tokens
        return [len(whole.encode(text, add_special_tokens=False)) if parts is None
                else sum([often(x) or self[x] for x in parts])
                for text, parts in zip(texts, cut, strict=True)]


_CACHES: dict = {}


def _counts(path: str | None, frequent: dict[str, int], limit: int, table: int) -> PieceCounts:
    """This worker's counts of a frequent table (kept from task to task, until another table comes)."""
    key = (path, limit, table)
    if key not in _CACHES:
        _CACHES.clear()
        _CACHES[key] = PieceCounts(frequent, load(path, BYTE_BPE), limit)
    return _CACHES[key]


def frequent_pieces(docs: DataFrame, path: str | None, sample_rows: int, size: int) -> dict[str, int]:
    """Token counts of the most frequent pieces of about `sample_rows` rows from all partitions, chosen by
    a hash of the id and the text's length. Tasks count their rows' pieces; the sums of this sample are all
    that is shuffled. A task keeps and hands on its `4 * size` most frequent pieces."""
    n = docs.count()
    place = F.pmod(F.xxhash64(F.lit("frequent"), "doc_id", F.octet_length("text")), F.lit(1_000_000_007)) / 1_000_000_007.0
    sample = docs if n <= sample_rows else docs.where(place < sample_rows / n)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for b in batches:
            for c in chunks(b.column(0)):
                for i in range(c.n):
                    seen.update(pieces(c.raw(i).decode()) or ())
                if len(seen) > 8 * size:  # rare pieces are the ones that misses may encode
                    seen = Counter(dict(seen.most_common(4 * size)))
        best = seen.most_common(4 * size)
        yield pa.RecordBatch.from_pydict({"piece": pa.array([x for x, _ in best], pa.string()),
                                          "times": pa.array([k for _, k in best], pa.int64())})

    total = sample.select("text").mapInArrow(count, "piece string, times long").groupBy("piece").agg(F.sum("times").alias("times"))
    best = [r["piece"] for r in total.orderBy(F.desc("times"), "piece").limit(size).collect()]
    counts = PieceCounts({}, load(path, BYTE_BPE))
    counts.learn(set(best))
    return {x: counts[x] for x in best}


def count_tokens(docs: DataFrame, *, max_tokens: int = 1024, tokenizer_path: str | None = None,
                 sample_rows: int = SAMPLE_ROWS, table_size: int = TABLE_SIZE,
                 cache_size: int = CACHE_SIZE) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > max_tokens) of every text."""
    docs = id_text(docs)
    frequent = frequent_pieces(docs, tokenizer_path, sample_rows, table_size)
    table, number = docs.sparkSession.sparkContext.broadcast(frequent), zlib.crc32(repr(frequent).encode())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(tokenizer_path, table.value, cache_size, number)
        for b in batches:
            ids = b.column("doc_id")
            for c in chunks(b.column("text")):
                texts = [c.raw(i).decode() for i in range(c.n)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids.slice(c.first, c.n), "n_bytes": pa.array(c.lengths, pa.int64()),
                    "n_tokens": pa.array(counts.count(texts), pa.int64())})

    out = docs.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > max_tokens)
