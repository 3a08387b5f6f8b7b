"""Hashed places of documents, lists of places and texts, packed for a shuffle.

An entry says that some hash occurs at a place (word or line number) of a document. One row of the
shuffle holds the entries that a chunk of texts sends to one partition: the documents once, the
places as differences, and of each hash only the bytes that the partition number doesn't tell.
That takes 7 to 12 bytes an entry, where a row of columns takes about 30.

The partition is the leading part of the hash, and there are as many as
spark.sql.shuffle.partitions says, so that setting decides what a task holds at once. A hash that
occurs everywhere doesn't make a partition large: chunks send one entry for each of their hashes.

Lists of places go back to their documents the same way: `join_lists` deals packed lists and packed
texts (compressed together, many a row) by the document's id, and hands each task its texts with
their lists.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .tables import chunks
from .words import mix

PACKED = "part int, kind int, payload binary"
ENTRIES, DECIDED, LISTS, TEXTS = range(4)


def partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _runs(x: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(x, prepend=x[:1] - 1)) if len(x) else np.zeros(0, np.int64)


def pack(h: np.ndarray, doc: np.ndarray, place: np.ndarray, ids: np.ndarray, parts: int, *, hash_bytes: int,
         tag: np.ndarray | None = None, extra: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows of PACKED: entries of hash `h` at `place` of document number `doc` (ascending), whose id
    is ids[doc]; `tag` (unsigned) is kept by entry, `extra` (64 bits) by document."""
    part = ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.uint32)
    order = np.argsort(part.astype(np.uint16) if parts < 1 << 16 else part, kind="stable")
    part, h, doc, place = part[order], h[order], doc[order], place[order]
    tag = None if tag is None else tag[order]
    cuts = _runs(part.astype(np.int64))
    squeeze = zstandard.ZstdCompressor(level=1)
    rows: list[bytes] = []
    for a, b in zip(cuts, [*cuts[1:], len(h)], strict=True):
        first = _runs(doc[a:b])
        own = doc[a:b][first]
        step = np.diff(place[a:b], prepend=0).astype(np.int64)
        step[first] = place[a:b][first]
        small = [np.diff(ids[own], prepend=0).astype("<i8"), np.diff(first, append=b - a).astype("<u4")]
        if extra is not None:
            small.append(extra[own].astype("<i8"))
        small += [step.astype("<i4")]
        if tag is not None:
            small.append(tag[a:b])
        body = squeeze.compress(b"".join(x.tobytes() for x in small))
        hashes = np.ascontiguousarray(h[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :hash_bytes])
        rows.append(struct.pack("<III", b - a, len(own), len(body)) + body + hashes.tobytes())
    return pa.RecordBatch.from_pydict({
        "part": pa.array(part[cuts].astype(np.int32)), "kind": pa.array(np.zeros(len(rows), np.int32)),
        "payload": pa.array(rows, pa.binary())})


def unpack(payload: bytes, *, hash_bytes: int, tag: np.dtype | None = None, extra: bool = False) -> dict[str, np.ndarray]:
    """The columns h, doc (id), place and, if packed, tag and extra of a row's entries."""
    n, docs, size = struct.unpack_from("<III", payload)
    body, at, out = zstandard.ZstdDecompressor().decompress(payload[12:12 + size]), 0, {}

    def take(kind, count):
        nonlocal at
        x = np.frombuffer(body, kind, count, at)
        at += x.nbytes
        return x

    ids = np.cumsum(take("<i8", docs))
    counts = take("<u4", docs)
    out["doc"] = np.repeat(ids, counts)
    if extra:
        out["extra"] = np.repeat(take("<i8", docs), counts)
    total = np.cumsum(take("<i4", n).astype(np.int64))
    firsts = np.cumsum(counts) - counts
    out["place"] = total - np.repeat(np.where(firsts > 0, total[firsts - 1], 0), counts)
    if tag is not None:
        out["tag"] = take(tag, n)
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :hash_bytes] = np.frombuffer(payload, np.uint8, n * hash_bytes, 12 + size).reshape(n, hash_bytes)
    out["h"] = wide.view("<u8").ravel()
    return out


def decided(batch: dict[str, pa.Array], parts: int) -> Iterator[pa.RecordBatch]:
    """Rows of PACKED that carry result rows through the shuffle, dealt evenly."""
    rows = pa.RecordBatch.from_pydict(batch)
    if rows.num_rows:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema) as w:
            w.write_batch(rows)
        payload = sink.getvalue().to_pybytes()
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([zlib.crc32(payload) % parts], pa.int32()), "kind": pa.array([DECIDED], pa.int32()),
            "payload": pa.array([payload], pa.binary())})


def deal(packed: DataFrame, parts: int, reduce: Callable[[dict[str, np.ndarray]], Iterator[pa.RecordBatch]], schema: str,
         **kind) -> DataFrame:
    """Shuffle packed rows; reduce(columns) gets all entries of a partition at once and yields result
    rows, which join the rows that were decided before (lists stay packed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[dict[str, np.ndarray]] = []
        for b in batches:
            kinds = b.column("kind").to_numpy(zero_copy_only=False)
            if (kinds == LISTS).any():
                yield b.filter(pa.array(kinds == LISTS))
            for k, payload in zip(kinds.tolist(), b.column("payload"), strict=True):
                if k == DECIDED:
                    yield from pa.ipc.open_stream(payload.as_buffer())
                elif k == ENTRIES:
                    got.append(unpack(payload.as_py(), **kind))
        if got:
            columns = {c: np.concatenate([x.pop(c) for x in got]) for c in list(got[0])}
            yield from reduce(columns)

    return packed.repartitionById(parts, "part").mapInArrow(run, schema)


def _rows(part: list[int], kind: int, payload: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"part": pa.array(part, pa.int32()), "kind": pa.array([kind] * len(part), pa.int32()),
                                       "payload": pa.array(payload, pa.binary())})


def home(ids: np.ndarray, parts: int) -> np.ndarray:
    """The partition of documents by id."""
    return ((mix(ids.view(np.uint64)) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def pack_lists(doc: np.ndarray, place: np.ndarray, parts: int, extra: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of PACKED: places of documents (ids, any order), dealt by document. `extra` tells apart
    documents that share an id."""
    if not len(doc):
        return
    more = np.zeros(len(doc), np.int64) if extra is None else extra
    part = home(doc, parts)
    order = np.lexsort((place, more, doc, part))
    part, doc, more, place = part[order], doc[order], more[order], place[order]
    squeeze, cuts = zstandard.ZstdCompressor(level=1), _runs(part)
    payload = []
    for a, b in zip(cuts, [*cuts[1:], len(doc)], strict=True):
        first = np.flatnonzero(first_of_equal(more[a:b], doc[a:b]))
        step = np.diff(place[a:b], prepend=0)
        step[first] = place[a:b][first]
        body = squeeze.compress(b"".join(x.tobytes() for x in (
            np.diff(doc[a:b][first], prepend=0).astype("<i8"), more[a:b][first].astype("<i8"),
            np.diff(first, append=b - a).astype("<u4"), step.astype("<i4"))))
        payload.append(struct.pack("<II", b - a, len(first)) + body)
    yield _rows(part[cuts].tolist(), LISTS, payload)


def _unpack_lists(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, extra, place) by place."""
    n, docs = struct.unpack_from("<II", payload)
    body = zstandard.ZstdDecompressor().decompress(payload[8:])
    ids = np.cumsum(np.frombuffer(body, "<i8", docs))
    more = np.frombuffer(body, "<i8", docs, 8 * docs)
    counts = np.frombuffer(body, "<u4", docs, 16 * docs).astype(np.int64)
    total = np.cumsum(np.frombuffer(body, "<i4", n, 20 * docs).astype(np.int64))
    firsts = np.cumsum(counts) - counts
    return np.repeat(ids, counts), np.repeat(more, counts), total - np.repeat(np.where(firsts > 0, total[firsts - 1], 0), counts)


class Lists:
    """The lists of a partition's documents."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        empty = [np.zeros(0, np.int64)] * 3
        doc, more, place = (np.concatenate(x) for x in zip(*(parts or [empty]), strict=True))
        order = np.lexsort((place, more, doc))
        self.place, doc, more = place[order], doc[order], more[order]
        starts = np.flatnonzero(first_of_equal(more, doc)) if len(doc) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(doc))[:len(starts)]
        self.at = {k: (a, b) for k, a, b in zip(zip(doc[starts].tolist(), more[starts].tolist(), strict=True),
                                                starts.tolist(), ends.tolist(), strict=True)}

    def of(self, doc: int | None, extra: int = 0) -> np.ndarray | None:
        """The places of a document, each once; None if it has no list."""
        if (doc, extra) not in self.at:
            return None
        a, b = self.at[doc, extra]
        return np.unique(self.place[a:b])


def pack_texts(docs: DataFrame, parts: int) -> DataFrame:
    """Rows of PACKED: documents (doc_id, text) dealt by id, those without one by their text. Texts
    of a row are compressed together; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for b in batches:
            for c in chunks(b.column("text"), 1 << 22):
                ids = b.column("doc_id").slice(c.first, c.n)
                none = ids.is_null().to_numpy(zero_copy_only=False)
                number = ids.fill_null(0).to_numpy(zero_copy_only=False)
                part = home(number, parts)
                for i in np.flatnonzero(none):
                    part[i] = zlib.crc32(c.raw(i)) % parts
                order = np.argsort(part, kind="stable")
                cuts = _runs(part[order])
                payload = []
                for a, z in zip(cuts, [*cuts[1:], len(order)], strict=True):
                    own = order[a:z]
                    raw = [c.raw(i) for i in own]
                    head = b"".join(x.tobytes() for x in (
                        number[own].astype("<i8"), none[own].astype("u1"), np.array([len(x) for x in raw], "<u4")))
                    payload.append(struct.pack("<I", len(own)) + squeeze.compress(head + b"".join(raw)))
                yield _rows(part[order][cuts].tolist(), TEXTS, payload)

    return docs.mapInArrow(run, PACKED)


def _unpack_texts(payload: bytes) -> tuple[list[int | None], list[bytes]]:
    (n,) = struct.unpack_from("<I", payload)
    body = zstandard.ZstdDecompressor().decompress(payload[4:])
    ids = np.frombuffer(body, "<i8", n).tolist()
    none = np.frombuffer(body, "u1", n, 8 * n).tolist()
    ends = np.cumsum(np.frombuffer(body, "<u4", n, 9 * n).astype(np.int64)) + 13 * n
    starts = [13 * n, *ends[:-1].tolist()]
    return ([None if x else i for i, x in zip(ids, none, strict=True)],
            [body[a:b] for a, b in zip(starts, ends.tolist(), strict=True)])


def join_lists(texts: DataFrame, lists: DataFrame, parts: int,
               use: Callable[[list[int | None], list[bytes], Lists], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Bring packed texts and packed lists together by document: use(ids, texts, lists) gets some
    documents and the lists of their partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list | None = []
        lists: Lists | None = None
        for b in batches:
            for k, payload in zip(b.column("kind").to_pylist(), b.column("payload"), strict=True):
                if k == LISTS:  # sorted before the texts
                    got.append(_unpack_lists(payload.as_py()))
                else:
                    if lists is None:
                        lists, got = Lists(got), None
                    yield from use(*_unpack_texts(payload.as_py()), lists)

    both = texts.unionByName(lists)
    return both.repartitionById(parts, "part").sortWithinPartitions("kind").mapInArrow(run, schema)


def first_of_equal(*keys: np.ndarray) -> np.ndarray:
    """For keys in sorted order (the last is the main one): mask of the first of each equal run."""
    n = len(keys[0])
    out = np.zeros(n, bool)
    out[:1] = True
    for k in keys:
        out[1:] |= k[1:] != k[:-1]
    return out
