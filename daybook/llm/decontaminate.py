"""Operator 2: benchmark decontamination by spaced seeds (DataFrame functions only).

A mask names the word positions that count in a window; the others may hold any word. Windows of
the benchmark texts and of the documents are hashed under every mask, and equal hashes are hits.
A hit fixes how the two texts lie on each other. On that alignment the best stretch is looked
for (a match scores 1, a substituted word `MISMATCH`), and the document is contaminated if the
stretch has enough equal words: `MIN_MATCHED`, or `SHORT_SHARE` of a shorter benchmark text.

No mask fits in an item of fewer words than the shortest one has places. Its seed is its whole word
sequence, so it is found where a document holds it unchanged; items of fewer than `SHORT_WORDS`
words are no passages (their words stand in any text) and aren't looked for.

The benchmark's seeds are broadcast in blocks of at most `BLOCK_SEEDS` rows: their number is
counted first, and a larger benchmark takes more blocks, each one a pass over the documents. A
block takes its seeds from all items, so a long item is spread over the blocks.
Documents are hashed and probed in one stage and never shuffled; only hits are.

Words are runs of letters and digits, lower-cased. Nulls: a null text has no words, a null id is
carried along, a benchmark row's too; a benchmark row with a null text or fewer words than
`SHORT_WORDS` is never found. Rows that repeat an id give one row per benchmark item, and their own
texts are told apart, in the benchmark as well. Empty tables give an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import fresh

MASKS = ("11011011", "1110010011", "10101101001")
BLOCK_SEEDS = 1_000_000
MISMATCH = -2
MIN_MATCHED = 12
SHORT_SHARE = 0.8
SHORT_WORDS = 4


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def seeds(w: str, at: str, masks: tuple[str, ...] = MASKS) -> Column:
    """The hashes of the windows that start at a position, one per mask that fits in there."""
    each = []
    for k, mask in enumerate(masks):
        inside = F.size(w) - F.col(at) >= len(mask)
        chosen = [F.get(F.col(w), F.col(at) + i) for i, c in enumerate(mask) if c == "1"]
        each.append(F.when(inside, F.xxhash64(F.lit(k), *chosen)))
    return F.array(*each)


def whole(w: str, at: str, lengths: list[int]) -> Column:
    """The hashes of the sequences of the given lengths that start at a position."""
    each = [F.when(F.size(w) - F.col(at) >= n, F.xxhash64(F.lit(-n), *[F.get(F.col(w), F.col(at) + i) for i in range(n)])) for n in lengths]
    return F.array(*each)


def _items(benchmark: DataFrame) -> DataFrame:
    """item_key (of the id and the text), item_id, iw of the different items."""
    b = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    return b.select(F.xxhash64(F.col("item_id").isNull(), "item_id", "text").alias("item_key"), "item_id", words(F.col("text")).alias("iw"))


def _benchmark_seeds(items: DataFrame, masks: tuple[str, ...], lengths: list[int]) -> DataFrame:
    """Those of the masks, and of an item that no mask fits in the whole word sequence."""
    at = items.select("item_key", "iw", F.posexplode("iw").alias("item_at", "_w"))
    n = F.size("iw")
    own = seeds("iw", "item_at", masks)
    if lengths:
        own = F.when(n.isin(lengths), F.when(F.col("item_at") == 0, F.filter(
            whole("iw", "item_at", lengths), lambda _, k: F.element_at(F.array(*map(F.lit, lengths)), (k + 1).cast("int")) == n))).otherwise(own)
    return (at.select("item_key", n.alias("item_words"), "item_at", F.explode(own).alias("seed"))
            .where("seed is not null").distinct())


def _best_stretch(match: Column) -> Column:
    """Of an array of booleans: (score, equal, length, end) of the stretch with the best score."""
    start = F.expr("named_struct('score', 0, 'equal', 0, 'length', 0, 'at', 0, 'best', 0, 'best_equal', 0, 'best_length', 0, 'best_end', 0)")

    def step(a: Column, m: Column) -> Column:
        gain = F.when(m, 1).otherwise(MISMATCH)
        on = a["score"] + gain > 0
        score = F.when(on, a["score"] + gain).otherwise(0)
        equal = F.when(on, a["equal"] + F.when(m, 1).otherwise(0)).otherwise(0)
        length = F.when(on, a["length"] + 1).otherwise(0)
        better = score > a["best"]
        return F.struct(
            score.alias("score"), equal.alias("equal"), length.alias("length"), (a["at"] + 1).alias("at"),
            F.when(better, score).otherwise(a["best"]).alias("best"),
            F.when(better, equal).otherwise(a["best_equal"]).alias("best_equal"),
            F.when(better, length).otherwise(a["best_length"]).alias("best_length"),
            F.when(better, a["at"] + 1).otherwise(a["best_end"]).alias("best_end"))

    return F.aggregate(match, start, step)


def overlaps(docs: DataFrame, benchmark: DataFrame, *, masks: tuple[str, ...] = MASKS, min_matched: int = MIN_MATCHED,
             short_share: float = SHORT_SHARE, short_words: int = SHORT_WORDS, block_seeds: int = BLOCK_SEEDS) -> DataFrame:
    """doc_id, text_hash, item_id, matched, overlap_words, doc_start, item_start of the best
    overlap of every contaminated document with each benchmark text."""
    probe = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
                        words(F.col("text").cast("string")).alias("w"))
    probe = probe.select("doc_id", "text_hash", "w", F.posexplode("w").alias("at", "_w"))
    items = _items(benchmark)
    n = F.size("iw")
    # a few numbers below the shortest mask
    lengths = sorted(r["n"] for r in items.select(n.alias("n")).where((n >= short_words) & (n < min(map(len, masks)))).distinct().collect())
    probes = F.concat(seeds("w", "at", masks), whole("w", "at", lengths)) if lengths else seeds("w", "at", masks)
    probe = probe.select("doc_id", "text_hash", "w", "at", F.explode(probes).alias("seed"))
    known = _benchmark_seeds(items, masks, lengths)
    blocks = max(1, -(-known.count() // block_seeds))
    found = []
    for k in range(blocks):
        block = known.where(F.pmod(F.xxhash64("item_key", "item_at", "seed"), F.lit(blocks)) == k)
        hits = probe.join(F.broadcast(block), "seed")
        lag = F.col("at") - F.col("item_at")
        hits = hits.select("doc_id", "text_hash", "item_key", lag.alias("lag"),
                           F.slice("w", F.greatest(lag, F.lit(0)) + 1, F.col("item_words")).alias("there"))
        found.append(hits)
    hits = reduce(DataFrame.unionByName, found).groupBy("doc_id", "text_hash", "item_key", "lag").agg(F.first("there").alias("there"))
    there = hits.join(items, "item_key")
    own = F.slice("iw", F.greatest(-F.col("lag"), F.lit(0)) + 1, F.size("iw"))
    n = F.least(F.size("there"), F.size(own))
    match = F.zip_with(F.slice("there", F.lit(1), n), F.slice(own, F.lit(1), n), lambda x, y: x == y)
    out = there.select("doc_id", "text_hash", "item_key", "item_id", "lag", F.size("iw").alias("item_words"), _best_stretch(match).alias("s"))
    first = F.col("s.best_end") - F.col("s.best_length")
    out = out.select(
        "doc_id", "text_hash", "item_key", "item_id", "item_words", F.col("s.best_equal").alias("matched"), F.col("s.best_length").alias("overlap_words"),
        (F.greatest("lag", F.lit(0)) + first).alias("doc_start"), (F.greatest(-F.col("lag"), F.lit(0)) + first).alias("item_start"))
    enough = F.least(F.lit(min_matched), F.ceil(F.col("item_words") * short_share))
    out = out.where(F.col("matched") >= enough)
    best = F.max(F.struct("matched", (-F.col("overlap_words")).alias("less"), (-F.col("doc_start")).alias("first"), (-F.col("item_start")).alias("item_first")))
    return out.groupBy("doc_id", "text_hash", "item_key", "item_id").agg(best.alias("b")).select(
        "doc_id", "text_hash", "item_id", F.col("b.matched").alias("matched"), (-F.col("b.less")).alias("overlap_words"),
        (-F.col("b.first")).alias("doc_start"), (-F.col("b.item_first")).alias("item_start"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs` whose text holds no benchmark passage; all their columns."""
    own, text = fresh(docs, "id"), fresh(docs, "text_hash")
    bad = overlaps(docs, benchmark, **options).select(F.col("doc_id").alias(own), F.col("text_hash").alias(text)).distinct()
    same = (F.col(own).eqNullSafe(F.col("doc_id").cast("long"))
            & (F.col(text) == F.xxhash64(F.col("text").cast("string"))))
    return docs.join(bad, same, "left_anti")
