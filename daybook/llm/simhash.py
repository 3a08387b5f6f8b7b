"""Operator 10: SimHash near-duplicates by a segment-popcount embedding.

A fingerprint is cut into 16 segments of 4 bits; the vector of their bit counts is a point of a
small integer lattice, and the Manhattan distance of two points never exceeds the bit distance
of the fingerprints. So every linked pair lies within Manhattan distance d of each other, and
then some lattice point lies within ceil(d/2) of both (halfway between them). The range join is
an equi-join on these points: each distinct fingerprint is dealt to its own point and those
within ceil(d/2), and fingerprints that meet at a point are verified by their exact bit distance.

Only distinct fingerprints are dealt, so exact copies cost nothing here. A point's group is not
turned into all its pairs: the task emits a spanning forest of the verified links (no more than
one link a member), which keeps every connection. Groups over `LARGE_GROUP` are linked through
their one-bit neighbourhoods, in time linear in the group.

Nulls: a null text has no words and the fingerprint zero, linked like any other. A null id is
carried along and never is a component's id (a component of null ids only has a null id).
Repeated rows share fingerprint and component. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .components import components
from .tables import chunks, fresh, id_text, written
from .words import mix

SEED = 42
SHINGLE = 3
MAX_BITS = 2
SEGMENT_BITS = 4
LARGE_GROUP = 1024
#: Values that a large group sorts at once.
FLIP_SLICE = 1 << 21


# ------------------------------------------------------------------ fingerprints


def shingle_hashes(raw: bytes, size: int = SHINGLE) -> list[int]:
    """XXH64 of every shingle of a text's bytes, A-Z lower-cased, words joined by one space."""
    words = raw.lower().split()
    if len(words) <= size:
        return [xxh64_intdigest(b" ".join(words), SEED)] if words else []
    text = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = [0, *(ends[:-1] + 1).tolist()]
    return [xxh64_intdigest(text[a:b], SEED) for a, b in zip(first, ends[size - 1:].tolist(), strict=False)]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One fingerprint for each run of `counts` hashes: a bit is set if it is in over half."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = (np.cumsum(counts) - counts)[some]
        sums = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        set_ = (2 * sums > counts[some][:, None]).astype(np.uint8)
        out[some] = np.packbits(set_, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, fp (the 64 bits as a long) of every text. text_hash tells rows that
    share an id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks(b.column("text")):
                each = [shingle_hashes(c.raw(i), shingle) for i in range(c.n)]
                counts = np.fromiter(map(len, each), np.int64, c.n)
                flat = np.fromiter((h for x in each for h in x), np.uint64, int(counts.sum()))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": b.column("doc_id").slice(c.first, c.n),
                    "text_hash": b.column("text_hash").slice(c.first, c.n),
                    "fp": pa.array(majority(flat, counts).view(np.int64))})

    rows = id_text(docs).withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


# ------------------------------------------------------------------ lattice points


def offsets(dims: int, radius: int) -> np.ndarray:
    """All integer vectors of `dims` with Manhattan norm at most `radius`."""
    found = {(0,) * dims}
    for _ in range(radius):
        found |= {v[:k] + (v[k] + s,) + v[k + 1:] for v in found for k in range(dims) for s in (-1, 1)}
    return np.array(sorted(v for v in found if sum(map(abs, v)) <= radius), np.int64)


def points(fp: np.ndarray, max_bits: int, segment_bits: int = SEGMENT_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(index into fp, lattice point as a long) of every point within ceil(max_bits / 2)."""
    dims, width = 64 // segment_bits, segment_bits.bit_length()
    shifts = np.arange(dims, dtype=np.uint64) * np.uint64(segment_bits)
    parts = (fp[:, None] >> shifts) & np.uint64((1 << segment_bits) - 1)
    counts = np.bitwise_count(parts).astype(np.int64)
    place = np.int64(1) << (np.arange(dims, dtype=np.int64) * width)
    own = counts @ place
    at, keys = [], []
    for v in offsets(dims, -(-max_bits // 2)):
        moved = np.flatnonzero(v)
        inside = np.ones(len(fp), bool)
        for k in moved:  # halfway points lie between two counts, so inside of their range
            inside &= (counts[:, k] + v[k] >= 0) & (counts[:, k] + v[k] <= segment_bits)
        at.append(np.flatnonzero(inside))
        keys.append(own[inside] + int(v @ place))
    return np.concatenate(at), np.concatenate(keys)


# ------------------------------------------------------------------ groups at a point


class _Forest:
    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = up.get(p, p)
            x = p
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def _small_groups(key: np.ndarray, fp: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified index pairs within runs of equal keys, by distance in the sorted order."""
    i, step = np.arange(len(key)), 1
    while True:
        i = i[i + step < len(key)]
        i = i[key[i] == key[i + step]]
        if not len(i):
            return
        near = np.bitwise_count(fp[i] ^ fp[i + step]) <= max_bits
        yield i[near], i[near] + step
        step += 1


def _large_group(fp: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs that connect a large group as its links do. Two fingerprints are within an even
    distance d if and only if some value lies within d/2 bits of both; values are sorted, and
    those that share one are chained. At an odd distance each member is compared with those that
    are not reached yet."""
    half = max_bits // 2
    flips = [np.uint64(0)]
    for k in range(1, half + 1):
        flips += [np.uint64(sum(1 << b for b in bits)) for bits in combinations(range(64), k)]
    flips = np.array(flips, np.uint64)
    if max_bits % 2 == 0:
        slices = -(-len(fp) * len(flips) // FLIP_SLICE)  # by value: bounds the arrays
        for k in range(slices):
            who, values = [], []
            for v in flips:
                x = fp ^ v
                here = np.arange(len(x)) if slices == 1 else np.flatnonzero(mix(x) % np.uint64(slices) == k)
                who.append(here)
                values.append(x[here])
            who, values = np.concatenate(who), np.concatenate(values)
            order = np.argsort(values, kind="stable")
            who, values = who[order], values[order]
            same = np.flatnonzero(values[1:] == values[:-1])
            yield who[same], who[same + 1]
        return
    left = np.arange(len(fp))
    while len(left):  # breadth first: each member is compared with those not yet reached
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            x, front = front[0], front[1:]
            near = np.bitwise_count(fp[left] ^ fp[x]) <= max_bits
            yield np.full(int(near.sum()), x), left[near]
            front, left = np.concatenate([front, left[near]]), left[~near]


def group_links(key: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within runs of equal keys (keys sorted)."""
    edges = np.flatnonzero(np.diff(key, prepend=key[:1] - 1, append=key[-1:] + 1)) if len(key) else np.zeros(0, int)
    sizes = np.diff(edges)
    large = np.repeat(sizes > LARGE_GROUP, sizes)
    a, b = [], []
    pairs = [(x, y) for x, y in _small_groups(key[~large], fp[~large], max_bits)]
    small = np.flatnonzero(~large)
    pairs = [(small[x], small[y]) for x, y in pairs]
    for k in np.flatnonzero(sizes > LARGE_GROUP):
        own = np.arange(edges[k], edges[k + 1])
        pairs += [(own[x], own[y]) for x, y in _large_group(fp[own], max_bits)]
    forest = _Forest()
    for x, y in pairs:
        for i, j in zip(x.tolist(), y.tolist(), strict=True):
            if forest.join(i, j):
                a.append(i)
                b.append(j)
    return fp[a], fp[b]


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): fingerprints within max_bits, enough of them to connect all that are linked.
    `distinct` has a column fp without repeats."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_fp = batch.column("fp").to_numpy(zero_copy_only=False)
            for i in range(0, len(all_fp), 4096):
                fp = all_fp[i:i + 4096]
                at, keys = points(fp.view(np.uint64), max_bits)
                yield pa.RecordBatch.from_pydict({"point": pa.array(keys), "fp": pa.array(fp[at])})

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def out(k, f):
            a, b = group_links(k, f, max_bits)
            return pa.RecordBatch.from_pydict({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

        for batch in batches:
            key = np.concatenate([key, batch.column("point").to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
            if len(key):
                cut = int(np.searchsorted(key, key[-1]))  # the last group may go on
                if cut:
                    yield out(key[:cut], fp[:cut])
                    key, fp = key[cut:], fp[cut:]
        if len(key):
            yield out(key, fp)

    dealt = distinct.select("fp").mapInArrow(deal, "point long, fp long")
    return dealt.repartition("point").sortWithinPartitions("point").mapInArrow(verify, "a long, b long")


def members(docs: DataFrame, *, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, text_hash, fp, component_id (the least id that links reach) of every row."""
    fps = written(fingerprints(docs, shingle), "fingerprints")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(nodes, max_bits)).withColumnRenamed("node", "fp")
    nodes = nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    return fps.join(nodes.join(ids, "root").select("fp", "component_id"), "fp")


def near_duplicates(docs: DataFrame, *, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row."""
    return members(docs, shingle=shingle, max_bits=max_bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, *, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of `docs` that stand for their component (the one with the least id, once if the
    row is repeated); all their columns. Components of null ids only keep each text once."""
    rows = members(docs, shingle=shingle, max_bits=max_bits)
    own, text = fresh(docs, "id"), fresh(docs, "text_hash")
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    keep = rows.where(first).select(F.col("doc_id").alias(f"{own}_kept"), F.col("text_hash").alias(f"{text}_kept")).distinct()
    keyed = docs.withColumn(own, F.col("doc_id").cast("long")).withColumn(text, F.xxhash64(F.col("text").cast("string")))
    same = F.col(own).eqNullSafe(F.col(f"{own}_kept")) & F.col(text).eqNullSafe(F.col(f"{text}_kept"))
    return keyed.join(keep, same, "left_semi").dropDuplicates([own, text]).drop(own, text)
