"""Operator 6: bounded-space online packing of token sequences.

Every document's ids (tokenizer, then one end id) are cut into full windows and a tail. A full
window is a sequence of its own. Tails go, in the order of their partition, to one of
`open_windows` open windows: the one with the least room that still takes the tail. When none
does, the fullest is topped up with the head of the tail (if the room takes `MIN_CUT` ids or
more, so that hardly any padding is left) and emitted, and the rest is placed. At the end of a
partition its open windows are left over; leftovers of `FAN_IN` partitions are packed again by
the same rule, round by round, until one partition is left. Each round has 1/FAN_IN of the
tasks, and a task holds `open_windows` windows at a time.

Rounds are written to the shared folder before they are used twice, and later rounds read their
rows sorted, so that a task run again gives the same sequences.

Tokens: a document's ids are its pre-tokens' ids one after another. The pre-tokens of a chunk of texts are
cut and told apart in bulk; their ids come from a bounded cache of the task, misses are merged in bulk with the
tokenizer's own merges. Texts with characters beyond U+024F go word by word, and words that may be more
than their letters (marks, special tokens) through the library.

Nulls: a null text is empty and gives one piece, the end id; a null id is carried along (its
pieces cannot be told from another null id's). Repeated rows are packed each for itself. An
empty table gives an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Chunk, chunks, id_text, written
from .tokenizers_io import WORD_BPE, Bpe, Pretokens, TwoGenerations, load, split_plain

SEQUENCE = 2048
OPEN_WINDOWS = 32
END_ID = 1
MIN_CUT = 16
FAN_IN = 32
CACHE_SIZE = 400_000
#: Bytes of text whose pre-tokens are told apart at once.
CHUNK = 1 << 22

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLACED = PIECE + ", sequence_id long, offset long"
#: A leftover keeps its ids until it is placed, so that it can still be cut.
ROUND = PLACED + ", ids binary"


#: The tokenizer's own pattern (fixed value), where a NUL stands between words.
_PATTERN = regex.compile(r"\0|'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}\0]+")


class WordIds(TwoGenerations):
    """Word (bytes) -> its token ids as little-endian unsigned 32-bit."""

    def __init__(self, tokenizer, limit: int = CACHE_SIZE):
        super().__init__(limit)
        self.tokenizer = tokenizer
        self.pretokens = Pretokens(tokenizer, limit // 2)  # lower-cased, without marks: fewer

    def learn(self, words: set[bytes]) -> None:
        simple, odd = split_plain([x.decode() for x in self.missing(words)])
        ids = self.pretokens.of_each(simple if not simple else "\0".join(simple).lower().split("\0"), _PATTERN)
        self.update(zip([x.encode() for x in simple], ids, strict=True))
        for x in odd:
            own = self.tokenizer.encode(x, add_special_tokens=False).ids
            self[x.encode()] = struct.pack(f"<{len(own)}I", *own)

    def of(self, texts: list[bytes]) -> Iterator[bytes]:
        """The packed ids of each text."""
        cut = [x.split() for x in texts]
        self.learn(set().union(*cut))
        for words in cut:
            yield b"".join(map(self.__getitem__, words))


_SPACE, _LETTER, _DIGIT, _OTHER = range(4)


def _byte_kinds() -> tuple[np.ndarray, np.ndarray]:
    """Of each byte of a lower-cased text: its kind, and whether it takes the text off the fast path."""
    kind = np.full(256, _OTHER, np.uint8)
    kind[[0x09, 0x0A, 0x0D, 0x20]] = _SPACE
    kind[ord("0"):ord("9") + 1] = _DIGIT
    kind[ord("a"):ord("z") + 1] = _LETTER
    kind[0x80:] = _LETTER
    odd = np.zeros(256, bool)
    odd[:0x20] = True
    odd[[0x09, 0x0A, 0x0D]] = False
    odd[[0x7F, 0xC2]] = True
    odd[0xCA:] = True  # U+0280 and beyond
    return kind, odd


_KIND, _ODD = _byte_kinds()
_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[ord("A"):ord("Z") + 1] += 32
#: What may follow an apostrophe as a pre-token of its own (fixed values of the tokenizer's pattern).
_CONTRACTED = [b"s", b"t", b"re", b"ve", b"m", b"ll", b"d"]


def _cut(values: pa.Array) -> tuple[bytes, list[int]]:
    """All bytes of a binary array that isn't a slice, and its offsets."""
    _, offsets, data = values.buffers()
    cuts = np.frombuffer(offsets, np.int32, len(values) + 1) if len(values) else np.zeros(1, np.int32)
    return (data.to_pybytes() if data is not None else b""), cuts.tolist()


class PieceIds:
    """Pre-token (bytes, A-Z lower-cased) -> its token ids as little-endian unsigned 32-bit. The texts of
    a chunk are cut by their bytes' kinds and their different pre-tokens found all at once; a pre-token is
    looked up once a chunk. That takes texts of ASCII and of the letters up to U+024F; others go word by word.
    When `limit` entries are new, the older ones go; those that are used again come back."""

    def __init__(self, tokenizer, limit: int = CACHE_SIZE):
        self.tokenizer, self.limit = tokenizer, limit
        self.bpe, self.words = Bpe(tokenizer), None
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def look_up(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each of some different pre-tokens; white space has none."""
        if len(self.new) >= self.limit:
            self.old, self.new = self.new, {}
        out = list(map(self.new.get, pieces))
        open_ = [k for k, x in enumerate(out) if x is None]
        rest, own = [], []
        for k in open_:
            piece = pieces[k]
            out[k] = x = b"" if piece.isspace() else self.old.get(piece)
            if x is None:
                rest.append(k)
                own.append(piece if piece.isascii() else piece.decode().lower().encode())
        if rest:
            for k, x in zip(rest, self.bpe.encode(own), strict=True):
                out[k] = x
        self.new.update((pieces[k], out[k]) for k in open_)
        return out

    @staticmethod
    def odd_texts(low: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Which texts hold anything but ASCII and letters up to U+024F: control and other characters, the
        signs and the one capital there that are no letters when lower-cased, or `<|` of a special token."""
        size = int(offs[-1])
        here, after = low[:size], low[1:size + 1]
        odd = _ODD[here] | (here == 0xC3) & ((after == 0x97) | (after == 0xB7)) | (here == 0xC9) & (after >= 0x90)
        odd |= (here == 0xC4) & (after == 0xB0) | (here == ord("<")) & (after == ord("|"))
        seen = np.concatenate([np.zeros(1, np.int64), np.cumsum(odd)])
        return seen[offs[1:]] > seen[offs[:-1]]

    @staticmethod
    def starts(low: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Where the pre-tokens and the runs of white space between them start."""
        size = int(offs[-1])
        kind = _KIND[low[:size]]
        start = np.ones(size, bool)
        start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        start[offs[:-1][offs[:-1] < size]] = True
        quote = np.flatnonzero((low[:size] == ord("'")) & start)
        end = offs[np.searchsorted(offs, quote, side="right")]  # of its text
        for tail in _CONTRACTED:
            fits = quote + 1 + len(tail) <= end
            for k, letter in enumerate(tail):
                fits &= low[np.minimum(quote + 1 + k, size)] == letter
            at, quote, end = quote[fits], quote[~fits], end[~fits]
            start[at + 1] = False
            behind = at + 1 + len(tail)
            start[behind[behind < size]] = True
        return np.flatnonzero(start)

    def of_chunk(self, c: Chunk) -> list[bytes]:
        """The packed ids of each text."""
        low = _ASCII_LOWER[c.buf]
        odd = self.odd_texts(low, c.offs)
        if odd.all():
            ids, reach = b"", np.zeros(c.n + 1, np.int64)
        else:
            starts = self.starts(low, c.offs)
            size = int(c.offs[-1])
            data = pa.py_buffer(low[:size])
            edges = pa.py_buffer(np.append(starts, size).astype(np.int32))
            coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, edges, data]).dictionary_encode()
            which = coded.indices.to_numpy()
            raw, cuts = _cut(coded.dictionary)
            pieces = [raw[x:z] for x, z in zip(cuts, cuts[1:], strict=False)]
            if odd.any():  # their pieces aren't looked up
                used = np.zeros(len(pieces), bool)
                used[which[~odd[np.searchsorted(c.offs, starts, side="right") - 1]]] = True
                pieces = [x if u else b" " for x, u in zip(pieces, used.tolist(), strict=True)]
            packed = self.look_up(pieces)
            lengths = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
            flat = np.frombuffer(b"".join(packed), "<u4")
            counts = lengths[which]
            ends = np.cumsum(counts)
            shift = (np.cumsum(lengths) - lengths)[which] - (ends - counts)
            ids = flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(shift, counts)].tobytes()
            reach = np.concatenate([np.zeros(1, np.int64), 4 * ends])[np.searchsorted(starts, c.offs)]
        out = [ids[a:b] for a, b in zip(reach[:-1].tolist(), reach[1:].tolist(), strict=True)]
        if odd.any():
            self.words = self.words or WordIds(self.tokenizer, self.limit // 4)
            where = np.flatnonzero(odd).tolist()
            for i, own in zip(where, self.words.of([c.raw(i) for i in where]), strict=True):
                out[i] = own
        return out


class Packer:
    """Open windows of one task. `emit` gets (pieces, sequence number); a piece is
    (doc_id, start, ids, doc_tokens) with its ids packed."""

    def __init__(self, size: int, open_windows: int, min_cut: int):
        self.size, self.limit, self.min_cut = size, open_windows, min_cut
        self.ids: PieceIds | None = None
        self.windows: list[list] = []  # [room, pieces]
        self.done: list[list[tuple]] = []

    def document(self, doc_id, ids: bytes, doc_tokens: int, start: int = 0) -> None:
        width = 4 * self.size
        full = len(ids) // width
        for k in range(full):
            self.done.append([(doc_id, start + k * self.size, ids[k * width:(k + 1) * width], doc_tokens)])
        if len(ids) > full * width:
            self.place(doc_id, start + full * self.size, ids[full * width:], doc_tokens)

    def place(self, doc_id, start: int, ids: bytes, doc_tokens: int) -> None:
        n = len(ids) // 4
        best = min((w for w in self.windows if w[0] >= n), key=lambda w: w[0], default=None)
        if best is None and len(self.windows) >= self.limit:
            fullest = min(self.windows, key=lambda w: w[0])
            room = fullest[0]
            if room >= self.min_cut and n - room >= self.min_cut:
                fullest[1].append((doc_id, start, ids[:4 * room], doc_tokens))
                start, ids, n = start + room, ids[4 * room:], n - room
            self.windows.remove(fullest)
            self.done.append(fullest[1])
            best = min((w for w in self.windows if w[0] >= n), key=lambda w: w[0], default=None)
        if best is None:
            best = [self.size, []]
            self.windows.append(best)
        best[1].append((doc_id, start, ids, doc_tokens))
        best[0] -= n
        if best[0] == 0:
            self.windows.remove(best)
            self.done.append(best[1])

    def take(self) -> list[list[tuple]]:
        out, self.done = self.done, []
        return out


def _rows(sequences: list[list[tuple]], first_id: int | None) -> pa.RecordBatch:
    """Pieces as rows; with first_id None they are left over and keep their ids."""
    cols: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                             "sequence_id", "offset", "ids")}
    for k, pieces in enumerate(sequences):
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            n = len(ids) // 4
            cols["doc_id"].append(doc_id)
            cols["start"].append(start)
            cols["length"].append(n)
            cols["ids_crc32"].append(zlib.crc32(ids))
            cols["doc_tokens"].append(doc_tokens)
            cols["sequence_id"].append(None if first_id is None else first_id + k)
            cols["offset"].append(None if first_id is None else offset)
            cols["ids"].append(ids if first_id is None else None)
            offset += n
    return pa.RecordBatch.from_pydict({k: pa.array(v, pa.binary() if k == "ids" else pa.int64())
                                       for k, v in cols.items()})


def _packing(feed: Callable, round_no: int, last: bool, size: int, open_windows: int, min_cut: int):
    """A task: feed(packer, batch) for every batch; sequences out, then the open windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(size, open_windows, min_cut)
        # ids of sequences: round, task, count in the task
        at = (round_no << 57) + (TaskContext.get().partitionId() << 32)
        for b in batches:
            for _ in feed(packer, b):
                if len(packer.done) >= 512:
                    yield _rows(done := packer.take(), at)
                    at += len(done)
        done = packer.take() + ([w[1] for w in packer.windows] if last else [])
        if done:
            yield _rows(done, at)
        if not last and packer.windows:
            yield _rows([w[1] for w in packer.windows], None)

    return run


def pack(docs: DataFrame, *, size: int = SEQUENCE, open_windows: int = OPEN_WINDOWS,
         min_cut: int = MIN_CUT, fan_in: int = FAN_IN, tokenizer_path: str | None = None,
         cache_size: int = CACHE_SIZE) -> DataFrame:
    """Pieces of every document with their place: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset. A sequence has at most `size` ids."""
    docs = id_text(docs)

    def tokenised(packer: Packer, batch: pa.RecordBatch):
        # the cache is the task's: a worker that is kept for other work holds none of it
        if packer.ids is None:
            packer.ids = PieceIds(load(tokenizer_path, WORD_BPE), cache_size)
        end = struct.pack("<I", END_ID)
        names = batch.column("doc_id").to_pylist()
        for c in chunks(batch.column("text"), CHUNK):
            for k, packed in enumerate(packer.ids.of_chunk(c)):
                ids = packed + end
                packer.document(names[c.first + k], ids, len(ids) // 4)
                yield

    def again(packer: Packer, batch: pa.RecordBatch):
        cols = [batch.column(k).to_pylist() for k in ("doc_id", "start", "ids", "doc_tokens")]
        for doc_id, start, ids, doc_tokens in zip(*cols, strict=True):
            packer.place(doc_id, start, ids, doc_tokens)
            yield

    parts = docs.rdd.getNumPartitions()
    out, round_no, result = docs, 0, []
    while True:
        last = parts <= 1
        step = _packing(tokenised if round_no == 0 else again, round_no, last, size, open_windows, min_cut)
        if round_no == 0:
            out = docs.mapInArrow(step, ROUND)
        else:
            out = (out.withColumn("_group", (F.spark_partition_id() / fan_in).cast("int"))
                   if "_group" not in out.columns else out)
            out = (out.repartition(parts, "_group").sortWithinPartitions("_group", "doc_id", "start")
                   .drop("_group").mapInArrow(step, ROUND))
        if last:
            result.append(out.where("sequence_id is not null"))
            break
        out = written(out.withColumn("_task", F.spark_partition_id()), f"pack-{round_no}")
        result.append(out.where("sequence_id is not null"))
        parts = -(-parts // fan_in)
        out = (out.where("sequence_id is null")
               .withColumn("_group", (F.col("_task") / fan_in).cast("int")).drop("_task"))
        round_no += 1
    cols = [c.split()[0] for c in PLACED.split(", ")]
    union = result[0].select(cols)
    for r in result[1:]:
        union = union.unionByName(r.select(cols))
    return union
