"""Operator 13: byte-level BPE encoding and decoding by a two-tier lookup.

A text is split by the tokenizer's pattern; each match (pre-token) is encoded for itself. Tier one
is a minimal perfect hash of the vocabulary: a pre-token that is itself a token has that id, even
where merging would not reach it. Tier two takes the misses: their bytes are a linked list of ids, a heap
holds the mergeable neighbours by (rank, place), and the lowest is merged until the heap is empty. What
either tier found is remembered in each Python worker (`CACHE_SIZE` pre-tokens in each of two
generations, so the bound doesn't depend on the data). Nothing is shuffled.

The rank file is read by the driver once; the tables made from it (their size is the vocabulary's) are
broadcast. White space, letters and digits are those of the tokenizer library's own pattern engine, asked
once for every code point, since engines differ in newer letters.

Decoding looks up the bytes of every id and joins them. An id that isn't in the vocabulary is an error.

Nulls: a null text is empty (no ids), null ids decode to no bytes, a null doc_id is carried along.
Repeated rows are encoded each for itself, texts of any length whole. An empty table gives an empty
result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import chunks, id_text
from .tokenizers_io import TwoGenerations, default_path
from .words import mix

MULTI_BPE = "byte_bpe_multi_50k.tiktoken"
CACHE_SIZE = 200_000
#: Ids that are decoded at once (a longer list for itself).
DECODED_IDS = 1 << 19
#: Keys a bucket of the perfect hash has on average.
BUCKET = 4
#: Texts in which no character lies beyond this one take the short pattern.
_NEAR = "ɏ"
_FAR = re.compile("[ɐ-\U0010ffff]")


def read_ranks(path: str | None) -> list[bytes]:
    """The tokens of a rank file (base64 and rank a line), by rank. Ranks have no gap."""
    with open(path or default_path(MULTI_BPE), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[x] for x in tokens] != list(range(len(tokens))):
        raise ValueError("the ranks of a vocabulary must be 0, 1, 2, ...")
    return tokens


def hash_bytes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of `data` (which has 8 bytes to spare at its end)."""
    at = np.ndarray(shape=(len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    low = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
    h = mix(lengths.astype(np.uint64) + np.uint64(1))
    left, pos = lengths.astype(np.int64), 0
    more = np.flatnonzero(left > 0)
    while len(more):
        h[more] = mix(h[more] * np.uint64(3) ^ (at[starts[more] + pos] & low[np.minimum(left[more] - pos, 8)]))
        pos += 8
        more = more[left[more] > pos]
    return h


def _flat(keys: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with 8 to spare, starts, lengths) of a binary array."""
    _, offsets, data = keys.buffers()
    offs = np.frombuffer(offsets, np.int32, len(keys) + 1 + keys.offset)[keys.offset:].astype(np.int64)
    size = int(offs[-1] - offs[0])
    out = np.zeros(size + 8, np.uint8)
    if size:
        out[:size] = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]]
    return out, offs[:-1] - offs[0], np.diff(offs)


def _joined(values: pa.Array) -> tuple[bytes, np.ndarray]:
    """All bytes of a binary array that isn't a slice, and where each value starts and the last one ends."""
    if not len(values):
        return b"", np.zeros(1, np.int32)
    _, offsets, data = values.buffers()
    reach = np.frombuffer(offsets, np.int32, len(values) + 1)
    return (data.to_pybytes() if data is not None else b""), reach


class PerfectHash:
    """Keys to the places 0 .. n-1, one each and none left over. A key's hash names its bucket; the bucket
    holds the seed that spreads its keys over free places. Buckets of one key hold the place itself."""

    def __init__(self, keys: list[bytes]):
        self.n = len(keys)
        self.buckets = max(1, self.n // BUCKET)
        self.seeds = np.zeros(self.buckets, np.int64)
        self.keys = pa.array(keys, pa.binary())
        h = hash_bytes(*_flat(self.keys))
        bucket = self._bucket(h)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        ends = np.cumsum(sizes)
        free = np.ones(self.n, bool)
        self.number = np.zeros(self.n, np.int64)  # place -> which key
        by_size = np.argsort(-sizes, kind="stable").tolist()
        tries = np.arange(256)
        for b in by_size:
            size = int(sizes[b])
            if size <= 1:
                break
            own, first = order[ends[b] - size:ends[b]], 1
            while True:
                places = self._spread(h[own][:, None], (first + tries)[None, :])
                fine = free[places].all(axis=0)
                for k in np.flatnonzero(fine).tolist():
                    if len(set(places[:, k].tolist())) == size:
                        break
                else:
                    first += len(tries)
                    if first > 1 << 24:
                        raise ValueError("keys repeat or their hashes do")
                    continue
                break
            self.seeds[b] = first + k
            free[places[:, k]] = False
            self.number[places[:, k]] = own
        left = np.flatnonzero(free)
        lone = [b for b in by_size if sizes[b] == 1]
        self.seeds[lone] = -1 - left
        self.number[left] = order[ends[lone] - 1]

    def _bucket(self, h: np.ndarray) -> np.ndarray:
        return ((h >> np.uint64(32)) * np.uint64(self.buckets) >> np.uint64(32)).astype(np.int64)

    def _spread(self, h: np.ndarray, seed: np.ndarray) -> np.ndarray:
        return (mix(h ^ mix(seed.astype(np.uint64))) % np.uint64(self.n)).astype(np.int64)

    def find(self, keys: pa.Array) -> np.ndarray:
        """The number of each key (binary) in the list that this was made of; -1: not in it."""
        if not self.n or not len(keys):
            return np.full(len(keys), -1, np.int64)
        h = hash_bytes(*_flat(keys))
        seed = self.seeds[self._bucket(h)]
        place = np.where(seed < 0, -1 - seed, 0)
        some = np.flatnonzero(seed > 0)
        place[some] = self._spread(h[some], seed[some])
        number = self.number[place]
        number[seed == 0] = -1  # empty bucket
        same = pc.equal(keys, self.keys.take(pa.array(np.maximum(number, 0)))).to_numpy(zero_copy_only=False)
        return np.where(same, number, -1)


def _ranges(chars: str) -> str:
    runs: list[list[int]] = []
    for c in map(ord, chars):
        if runs and c == runs[-1][1] + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


def spelled_out(pattern: str) -> tuple[str, str]:
    """`pattern` with \\s, \\p{L} and \\p{N} as the ranges of the tokenizer library's engine: for texts up to
    U+024F, and for all."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))

    def members(kind: str) -> str:
        own = tiktoken.Encoding(kind, pat_str=kind, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        return own.decode_bytes(own.encode_ordinary(every)).decode()

    kinds = {kind: members(kind) for kind in (r"\s", r"\p{L}", r"\p{N}")}
    out = []
    for keep in (lambda c: c <= _NEAR, lambda c: True):
        classes = {kind: _ranges("".join(filter(keep, chars))) for kind, chars in kinds.items()}
        text = pattern.replace(r"\S", "[^" + classes[r"\s"] + "]")
        inside = False
        parts = re.split(r"(\[\^?|\]|\\s|\\p\{[LN]\})", text)
        for k, part in enumerate(parts):
            inside = part.startswith("[") or inside and part != "]"
            if part in classes:
                parts[k] = classes[part] if inside else f"[{classes[part]}]"
        out.append("".join(parts))
    return out[0], out[1]


class Vocabulary:
    """A rank file's tables, as they are broadcast."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.hash = PerfectHash(tokens)
        self.short, self.full = spelled_out(pattern)
        number = {x: k for k, x in enumerate(tokens)}
        self.single = [number[bytes([b])] for b in range(256)]
        self.size = len(tokens)
        #: two neighbours' ids -> the id of both together
        self.pairs = {number[x[:k]] * self.size + number[x[k:]]: i for x, i in number.items() for k in range(1, len(x))
                      if x[:k] in number and x[k:] in number}
        self.name = hashlib.sha256(b"\0".join(tokens) + self.full.encode()).hexdigest()

    def merged(self, piece: bytes) -> list[int]:
        """The ids of one pre-token: the lowest rank first, of equal ones the leftmost."""
        n, size, pair = len(piece), self.size, self.pairs.get
        single = self.single
        ids = [single[b] for b in piece]
        bits = n.bit_length()
        mask = (1 << bits) - 1
        heap = [rank << 2 * bits | i << bits | i + 2 for i in range(n - 1)
                if (rank := pair(ids[i] * size + ids[i + 1])) is not None]
        heapify(heap)
        after = list(range(1, n + 1))
        after.append(0)  # behind the end, and what a merged byte's place points to
        before = list(range(-1, n))
        while heap:
            x = heappop(heap)
            end, i = x & mask, x >> bits & mask
            j = after[i]
            if after[j] != end:  # one of the two has been merged away or is longer now
                continue
            ids[i] = rank = x >> 2 * bits
            after[i], after[j], before[end] = end, -1, i
            if end < n and (rank_after := pair(rank * size + ids[end])) is not None:
                heappush(heap, rank_after << 2 * bits | i << bits | after[end])
            j = before[i]
            if j >= 0 and (rank_before := pair(ids[j] * size + rank)) is not None:
                heappush(heap, rank_before << 2 * bits | j << bits | end)
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out


class Encoder(TwoGenerations):
    """Pre-token -> its ids, packed as little-endian 32-bit numbers."""

    def __init__(self, vocabulary: Vocabulary, limit: int = CACHE_SIZE):
        super().__init__(limit)
        self.vocabulary = vocabulary
        self.short, self.full = re.compile(vocabulary.short), re.compile(vocabulary.full)

    def learn(self, pretokens: set[str]) -> None:
        new = list(self.missing(pretokens))
        if not new:
            return
        keys = pa.array(new, pa.string()).cast(pa.binary())
        known = self.vocabulary.hash.find(keys)
        merged = self.vocabulary.merged
        self.update((x, (int(k).to_bytes(4, "little") if k >= 0 else np.array(merged(x.encode()), "<i4").tobytes()))
                    for x, k in zip(new, known.tolist(), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text."""
        cut = [(self.full if _FAR.search(x) else self.short).findall(x) for x in texts]
        self.learn(set().union(*cut))
        ids = self.__getitem__
        return [b"".join(map(ids, x)) for x in cut]


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def _encoder(vocabulary: Vocabulary, limit: int) -> Encoder:
    """This worker's encoder of a vocabulary; its cache goes on from task to task."""
    key = (vocabulary.name, limit)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary, limit)
    return _ENCODERS[key]


def vocabulary(path: str | None = None, pattern: str | None = None) -> Vocabulary:
    """The tables of the rank file at `path` (None: the installed public one) and its splitting pattern."""
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    return Vocabulary(read_ranks(path), pattern)


def encode(docs: DataFrame, own: Vocabulary, *, cache_size: int = CACHE_SIZE) -> DataFrame:
    """doc_id and ids (array of int) of every text."""
    table = docs.sparkSession.sparkContext.broadcast(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(table.value, cache_size)
        for b in batches:
            names = b.column("doc_id")
            for c in chunks(b.column("text")):
                packed = encoder.encode([c.raw(i).decode() for i in range(c.n)])
                ends = np.zeros(c.n + 1, np.int32)
                ends[1:] = np.cumsum([len(x) // 4 for x in packed])
                flat = pa.array(np.frombuffer(b"".join(packed), "<i4"), pa.int32())
                yield pa.RecordBatch.from_arrays([names.slice(c.first, c.n), pa.ListArray.from_arrays(pa.array(ends), flat)],
                                                 names=["doc_id", "ids"])

    return id_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, own: Vocabulary, *, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """`encoded` with the bytes of its ids as a last column (UTF-8, where the ids are those of a text)."""
    table = encoded.sparkSession.sparkContext.broadcast(own)
    schema = T.StructType([*encoded.schema.fields, T.StructField(out_col, T.BinaryType())])
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, size = table.value.hash.keys, table.value.size
        for b in batches:
            counts = pc.fill_null(pc.list_value_length(b.column(at)), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(counts)
            first = 0
            while first < b.num_rows:  # some rows at a time, so that a batch of long lists takes no more
                done = ends[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(ends, done + DECODED_IDS, side="right")))
                part = b.slice(first, last - first)
                flat = part.column(at).flatten()
                if len(flat) and not 0 <= pc.min(flat).as_py() <= pc.max(flat).as_py() < size:
                    raise ValueError("an id isn't in the vocabulary")
                cut = np.concatenate([np.zeros(1, np.int64), ends[first:last] - done])
                raw, reach = _joined(tokens.take(flat))
                at_bytes = reach[cut].tolist()
                decoded = pa.array([raw[x:z] for x, z in zip(at_bytes, at_bytes[1:], strict=False)], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], names=schema.names)
                first = last

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, *, path: str | None = None, pattern: str | None = None, cache_size: int = CACHE_SIZE) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids, comma-joined), decoded_sha256 (of the decoded bytes)."""
    own = vocabulary(path, pattern)
    both = decode(encode(docs, own, cache_size=cache_size), own)
    decimal = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
