"""Operator 4: exact substring dedup by fixed-block anchors.

Every document is indexed by its non-overlapping blocks of `BLOCK` words; every rolling window of
`BLOCK` words of every document probes the index. A repeat of `WINDOW` words (20) holds a whole
block of its first occurrence (`2 * BLOCK - 1 < WINDOW`), so the other occurrence is hit there.
Around hits, the windows of `WINDOW` words that hold the hit are hashed (128 bits with the
partition's) and grouped: this extends hits word by word to the maximal exact repeats, and finds
each window's first occurrence. Words covered by a window that starts earlier elsewhere go.

Anchor hashes are short, for a false hit only costs a window that isn't repeated. A chunk of texts
sends one entry for each hash, whatever the number of its occurrences, so a passage that a third
of all documents share stays small in its partition. Texts are shuffled once to meet their hits,
compressed; only documents with hits go on.

Nulls: a null text has no words; a document with a null id loses nothing and no other document
loses words to it. Rows that repeat an id and a text are one document: neither is earlier. Rows
that share an id but not the text are told apart, and windows that start at the same word are
neither earlier. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .exchange import PACKED, Lists, deal, first_of_equal, join_lists, pack, pack_lists, pack_texts, partitions
from .tables import chunks, id_text, written
from .words import Words, covered, rolling

WINDOW = 20
BLOCK = 10
#: Text bytes of a chunk here: each hash is sent once for so much text.
CHUNK = 1 << 22
_ANCHOR = {"hash_bytes": 5}
_WINDOW = {"hash_bytes": 6, "tag": np.dtype("<u4"), "extra": True}


def anchors(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Packed lists of places by document: words at which a window of `block` words starts that is,
    or equals, a block of the index elsewhere. May hold a few more (chance equality of short hashes)."""
    parts = partitions(docs)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            for c in chunks(b.column("text"), CHUNK):
                w = Words(c)
                at = w.window_places(block)
                h = rolling(w.hashes(), block)[at] if len(at) else np.zeros(0, np.uint64)
                doc, place = w.doc[at], w.place[at]
                order = np.argsort(h, kind="stable")
                first = first_of_equal(h[order]) if len(h) else np.zeros(0, bool)
                run = np.cumsum(first) - 1
                sizes = np.bincount(run) if len(run) else np.zeros(0, np.int64)
                many = sizes[run] > 1
                chosen = first.copy()  # one entry for each hash: a block, if one of its places is one
                repeated = np.flatnonzero(many)
                if len(repeated):
                    by = repeated[np.lexsort((place[order[repeated]] % block != 0, run[repeated]))]
                    chosen[repeated] = False
                    chosen[by[first_of_equal(run[by])]] = True
                    yield from pack_lists(ids[c.first:c.last][doc[order[repeated]]], place[order[repeated]], parts)
                sent = np.sort(order[chosen])
                if len(sent):
                    yield pack(h[sent], doc[sent], place[sent], ids[c.first:c.last], parts, **_ANCHOR)

    def meet(x: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(x["h"], kind="stable")
        h = x["h"][order]
        same = h[1:] == h[:-1]
        mask = np.zeros(len(h), bool)
        mask[1:] |= same
        mask[:-1] |= same
        order, h = order[mask], h[mask]
        if not len(h):
            return
        starts = np.flatnonzero(first_of_equal(h))
        block_in = np.logical_or.reduceat(x["place"][order] % block == 0, starts)
        hit = order[np.repeat(block_in, np.diff(starts, append=len(h)))]
        yield from pack_lists(x["doc"][hit], x["place"][hit], parts)

    known = docs.where("doc_id is not null and text is not null")
    return deal(known.mapInArrow(probe, PACKED), parts, meet, PACKED, **_ANCHOR)


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


_HELD = "doc_id long, text_hash long, z binary, places binary, n_words long, kept_sha256 string"


def _hold(ids: list[int | None], texts: list[bytes], lists: Lists) -> Iterator[pa.RecordBatch]:
    """Documents without hits are done; the others keep their text and hits."""
    squeeze = zstandard.ZstdCompressor(level=3)
    cols: dict[str, list] = {k: [] for k in ("text_hash", "z", "places", "n_words", "kept_sha256")}
    for doc_id, raw in zip(ids, texts, strict=True):
        places = lists.of(doc_id)
        words = raw.split() if places is None else None
        cols["text_hash"].append(signed(xxh64_intdigest(raw)))
        cols["z"].append(squeeze.compress(raw) if words is None else None)
        cols["places"].append(places.astype("<u4").tobytes() if words is None else None)
        cols["n_words"].append(None if words is None else len(words))
        cols["kept_sha256"].append(None if words is None else _digest(words))
    yield pa.RecordBatch.from_pydict({
        "doc_id": pa.array(ids, pa.int64()), "text_hash": pa.array(cols["text_hash"], pa.int64()),
        "z": pa.array(cols["z"], pa.binary()), "places": pa.array(cols["places"], pa.binary()),
        "n_words": pa.array(cols["n_words"], pa.int64()), "kept_sha256": pa.array(cols["kept_sha256"], pa.string())})


def _earlier(x_doc: np.ndarray, x_place: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For entries in `order`, whose runs of equals begin at `first` with the least (doc, place):
    mask of those that are later than their run's first."""
    starts = np.flatnonzero(first)
    lead = np.repeat(order[starts], np.diff(starts, append=len(order)))
    return (x_doc[order] != x_doc[lead]) | (x_place[order] != x_place[lead])


def repeated_windows(held: DataFrame, parts: int, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """Packed lists by document: starts of windows around hits whose words also start earlier
    elsewhere."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            extra = b.column("text_hash").to_numpy(zero_copy_only=False)
            hits = b.column("places")
            for g in range(0, len(ids), 512):  # compressed texts: open some at a time
                raw = [zstandard.decompress(z.as_py()) for z in b.column("z").slice(g, 512)]
                for c in chunks(pa.array(raw, pa.binary()).cast(pa.string()), CHUNK):
                    w = Words(c)
                    first = g + c.first
                    near = np.zeros(len(w.starts) + 1, np.int32)  # words whose window may hold a hit
                    for i in range(c.n):
                        p = np.frombuffer(hits[first + i].as_py(), "<u4").astype(np.int64)
                        p = p[p < w.counts[i]] + w.bounds[i]
                        np.add.at(near, np.maximum(p - (window - block), w.bounds[i]), 1)
                        np.add.at(near, p + 1, -1)
                    at = w.window_places(window)
                    at = at[np.cumsum(near)[at] > 0] if len(at) else at
                    if not len(at):
                        continue
                    h = rolling(w.hashes(), window)[at]
                    tag = rolling(w.hashes(1), window)[at].astype(np.uint32)
                    doc, place = w.doc[at], w.place[at]
                    own, more = ids[first:first + c.n][doc], extra[first:first + c.n][doc]
                    order = np.lexsort((place, own, tag, h))
                    lead = first_of_equal(tag[order], h[order])
                    late = _earlier(own, place, order, lead)
                    gone = order[late]
                    yield from pack_lists(own[gone], place[gone], parts, more[gone])
                    sent = np.sort(order[~late])
                    yield pack(h[sent], doc[sent], place[sent], ids[first:first + c.n], parts, tag=tag[sent],
                               extra=extra[first:first + c.n], hash_bytes=_WINDOW["hash_bytes"])

    def settle(x: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((x["place"], x["doc"], x["tag"], x["h"]))
        late = _earlier(x["doc"], x["place"], order, first_of_equal(x["tag"][order], x["h"][order]))
        gone = order[late]
        yield from pack_lists(x["doc"][gone], x["place"][gone], parts, x["extra"][gone])

    return deal(held.mapInArrow(extend, PACKED), parts, settle, PACKED, **_WINDOW)


def dedup(docs: DataFrame, *, window: int = WINDOW, block: int = BLOCK, keep_text: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words, joined by one
    space), and with keep_text those words as `kept_text` of documents that lose any."""
    assert 2 * block - 1 < window
    docs = id_text(docs)
    parts = partitions(docs)
    held = written(join_lists(pack_texts(docs, parts), anchors(docs, block), parts, _hold, _HELD), "held")
    hit = held.where("z is not null")

    def cut(ids: list[int | None], texts: list[bytes], lists: Lists) -> Iterator[pa.RecordBatch]:
        cols: dict[str, list] = {k: [] for k in ("n_words", "n_removed", "kept_sha256", "kept_text")}
        for doc_id, raw in zip(ids, texts, strict=True):
            words, starts = raw.split(), lists.of(doc_id, signed(xxh64_intdigest(raw)))
            drop = covered(len(words), np.zeros(0, np.int64) if starts is None else starts, window)
            kept = list(compress(words, ~drop))
            cols["n_words"].append(len(words))
            cols["n_removed"].append(int(drop.sum()))
            cols["kept_sha256"].append(_digest(kept))
            cols["kept_text"].append(b" ".join(kept).decode() if keep_text else None)
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(cols["n_words"], pa.int64()),
            "n_removed": pa.array(cols["n_removed"], pa.int64()),
            "kept_sha256": pa.array(cols["kept_sha256"], pa.string()), "kept_text": pa.array(cols["kept_text"], pa.string())})

    texts = pack_texts(hit.select("doc_id", "z").mapInArrow(_opened, "doc_id long, text string"), parts)
    done = join_lists(texts, repeated_windows(hit.select("doc_id", "text_hash", "z", "places"), parts, window, block), parts, cut,
                      "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
    rest = held.where("z is null").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"),
                                          "kept_sha256", F.lit(None).cast("string").alias("kept_text"))
    out = done.unionByName(rest)
    return out if keep_text else out.drop("kept_text")


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for g in range(0, b.num_rows, 512):
            part = b.slice(g, 512)
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"),
                "text": pa.array([zstandard.decompress(z.as_py()) for z in part.column("z")], pa.binary()).cast(pa.string())})
