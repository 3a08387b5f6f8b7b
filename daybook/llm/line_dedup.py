"""Operator 5: line dedup by a deletion-neighbourhood join.

A line is its words (ASCII letters lower-cased). Two lines are equal within the edit bound if one
word inserted, removed or substituted makes them equal (if both have `near` words or more, so that four
fifths stay the same; from `least` on lines must be equal; by default every line with a word is judged). A line
goes if a line within the bound stands earlier in the corpus (smaller doc_id, or the same document,
earlier line). Lines are judged on the input, not on what is left.

The join: every line emits, as hashed keys, itself and all variants with one word deleted. Lines
with an equal variant meet; those that deleted the same place differ there alone (substitution),
and a line that equals another's variant lacks one word (insertion). So in a group of equal keys
nothing but the earliest line of each place, and of the lines themselves, is needed: no pairs are
made, however many lines share a key. The pairs found (one for a line and key at most) are verified word
by word before the earliest partner is taken.

Before that, lines are narrowed down without loss: within one edit, two lines share their first or
their last half. Only lines that share such a half with another line emit variants, and equal lines
do so once.

A document keeps its other lines as they are. Nulls: a null text stays null, a null id's
document keeps its lines and takes none from others. Rows that repeat an id and a text are one
document (neither is earlier); rows that share only the id are told apart. An empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .exchange import PACKED, Lists, deal, decided, first_of_equal, join_lists, pack, pack_lists, pack_texts, partitions
from .substring_dedup import signed
from .tables import Chunk, chunks, fresh, id_text, written
from .words import BASE, Words, mix

#: Equal lines from one word on, one edit from where four fifths of a line stay the same.
MIN_WORDS = 1
NEAR_WORDS = 5
CHUNK = 1 << 22
_HALF = {"hash_bytes": 5}
_VARIANT = {"hash_bytes": 8, "tag": np.dtype("<u4"), "extra": True}
#: Tag of a line that stands for itself; deleted places have their own numbers.
WHOLE = (1 << 32) - 1

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_INVERSE = np.uint64(pow(BASE, -1, 1 << 64))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n + 1, np.uint64)
    if n:
        out[1:] = np.uint64(base)
        out = np.multiply.accumulate(out)
    return out


class Lines:
    """The lines with words of a chunk: their words' hashes as running polynomial sums."""

    def __init__(self, c: Chunk, near: int = NEAR_WORDS):
        self.near = near
        c.buf = _LOWER[c.buf]
        w = Words(c)
        size = int(c.offs[-1])
        ends = np.flatnonzero(c.buf[:size] == 10)
        number = np.searchsorted(ends, w.starts) + w.doc  # lines counted through the chunk
        first = np.flatnonzero(first_of_equal(number)) if len(number) else np.zeros(0, np.int64)
        self.first, self.words = first, np.diff(first, append=len(number))
        self.doc = w.doc[first]
        self.place = np.searchsorted(ends, w.starts[first]) - np.searchsorted(ends, c.offs[w.doc[first]])
        most = int(self.words.max(initial=0))
        up, self.down = _powers(BASE, most), _powers(int(_INVERSE), most)
        self.at = np.arange(len(number)) - np.repeat(first, self.words)  # of each word in its line
        terms = mix(w.hashes()) * up[self.at]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])

    def span(self, line: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of words a to b (exclusive) of each line."""
        at = self.first[line]
        return mix((self.sums[at + b] - self.sums[at + a]) * self.down[a] + mix((b - a).astype(np.uint64)))

    def halves(self, least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
        """(line, key) of the halves by which lines within one edit meet; equal short lines too."""
        n = self.words
        long_ = np.flatnonzero(n >= self.near)
        short = np.flatnonzero((n >= least) & (n < self.near))
        zero = np.zeros(len(long_), np.int64)
        half, other = (n[long_] - 1) // 2, n[long_] // 2
        two = other > half
        lines = [short, long_, long_, long_[two], long_[two]]
        keys = [self.span(short, np.zeros(len(short), np.int64), n[short]),
                self.span(long_, zero, half), ~self.span(long_, n[long_] - half, n[long_]),
                self.span(long_, zero, other)[two], ~self.span(long_, n[long_] - other, n[long_])[two]]
        return np.concatenate(lines), np.concatenate(keys)

    def variants(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(line, key, tag): every line itself, and the longer ones with each word deleted."""
        every = np.arange(len(self.words))
        whole = self.sums[self.first + self.words] - self.sums[self.first]
        own = mix(whole + mix(self.words.astype(np.uint64)))
        own = np.where(self.words >= self.near, own, ~own)  # short lines meet no variants
        long_ = np.repeat(self.words >= self.near, self.words)
        word = np.flatnonzero(long_)
        line = np.repeat(every, self.words)[word]
        before = self.sums[word] - self.sums[self.first[line]]
        after = (self.sums[self.first[line] + self.words[line]] - self.sums[word + 1]) * _INVERSE
        cut = mix(before + after + mix((self.words[line] - 1).astype(np.uint64)))
        return (np.concatenate([every, line]), np.concatenate([own, cut]),
                np.concatenate([np.full(len(every), WHOLE, "<u4"), self.at[word].astype("<u4")]))


def candidates(docs: DataFrame, least: int, near: int) -> DataFrame:
    """Packed lists by document: numbers of lines that share a half (short ones: all words) with another."""
    parts = partitions(docs)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            for c in chunks(b.column("text"), CHUNK):
                x = Lines(c, near)
                line, h = x.halves(least)
                order = np.argsort(h, kind="stable")
                first = first_of_equal(h[order]) if len(h) else np.zeros(0, bool)
                run = np.cumsum(first) - 1
                many = np.bincount(run)[run] > 1 if len(run) else first
                again = np.unique(line[order[many]])
                if len(again):
                    yield from pack_lists(ids[c.first:c.last][x.doc[again]], x.place[again], parts)
                sent = order[first]
                sent = sent[np.argsort(line[sent], kind="stable")]
                if len(sent):
                    at = line[sent]
                    yield pack(h[sent], x.doc[at], x.place[at], ids[c.first:c.last], parts, **_HALF)

    def meet(x: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(x["h"], kind="stable")
        h = x["h"][order]
        hit = np.zeros(len(h), bool)
        hit[1:] |= h[1:] == h[:-1]
        hit[:-1] |= h[1:] == h[:-1]
        yield from pack_lists(x["doc"][order[hit]], x["place"][order[hit]], parts)

    known = docs.where("doc_id is not null and text is not null")
    return deal(known.mapInArrow(probe, PACKED), parts, meet, PACKED, **_HALF)


def _words_of(line: bytes) -> bytes:
    return b" ".join(line.lower().split())


def _candidate_lines(docs: DataFrame, least: int, near: int) -> DataFrame:
    """doc_id, text_hash, line_no, line (its words) of the lines that have a candidate."""
    parts = partitions(docs)

    def take(ids: list[int | None], texts: list[bytes], lists: Lists) -> Iterator[pa.RecordBatch]:
        cols: dict[str, list] = {k: [] for k in ("doc_id", "text_hash", "line_no", "line")}
        for doc_id, raw in zip(ids, texts, strict=True):
            places = lists.of(doc_id)
            if places is not None:
                key, lines = signed(xxh64_intdigest(raw)), raw.split(b"\n")
                for k in places.tolist():
                    if k < len(lines) and (line := _words_of(lines[k])):
                        cols["doc_id"].append(doc_id)
                        cols["text_hash"].append(key)
                        cols["line_no"].append(k)
                        cols["line"].append(line)
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array(cols["doc_id"], pa.int64()), "text_hash": pa.array(cols["text_hash"], pa.int64()),
            "line_no": pa.array(cols["line_no"], pa.int64()), "line": pa.array(cols["line"], pa.binary())})

    return join_lists(pack_texts(docs, parts), candidates(docs, least, near), parts, take,
                      "doc_id long, text_hash long, line_no long, line binary")


def neighbours(lines: DataFrame, near: int = NEAR_WORDS) -> DataFrame:
    """lines: id, doc_id, line_no, line, all different. Returns id and other: a line and an earlier one that
    has a variant in common, of each variant the earliest."""
    parts = partitions(lines)

    def rows(x: dict[str, np.ndarray], late: np.ndarray, lead: np.ndarray) -> dict[str, pa.Array]:
        return {"id": pa.array(x["extra"][late]), "other": pa.array(x["extra"][lead])}

    def resolve(x: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(later entries, an earlier entry for each, the first entry of each key and tag)."""
        order = np.lexsort((x["extra"], x["place"], x["doc"], x["tag"], x["h"]))
        h, tag = x["h"][order], x["tag"][order]
        first = first_of_equal(tag, h)
        starts = np.flatnonzero(first)
        lead = np.repeat(order[starts], np.diff(starts, append=len(order)))
        other = np.flatnonzero(~first)
        late, than = [order[other]], [lead[other]]
        # of each key: the line itself (at most one, and the last tag) against the earliest variant
        s = order[starts]
        key = x["h"][s]
        runs = np.flatnonzero(first_of_equal(key)) if len(key) else np.zeros(0, np.int64)
        ends = np.append(runs[1:], len(s))
        mixed = np.flatnonzero((ends - runs > 1) & (x["tag"][s[ends - 1]] == WHOLE)) if len(runs) else runs
        for k in mixed.tolist():
            whole, variants = s[ends[k] - 1], s[runs[k]:ends[k] - 1]
            where = list(zip(x["doc"][variants].tolist(), x["place"][variants].tolist(), strict=True))
            own = (int(x["doc"][whole]), int(x["place"][whole]))
            least = min(range(len(where)), key=where.__getitem__)
            if where[least] < own:
                late.append(np.array([whole]))
                than.append(variants[least:least + 1])
            behind = np.array([i for i, p in enumerate(where) if p > own], np.int64)
            late.append(variants[behind])
            than.append(np.repeat(whole, len(behind)))
        return np.concatenate(late), np.concatenate(than), s

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, docs, places = (b.column(k).to_numpy(zero_copy_only=False) for k in ("id", "doc_id", "line_no"))
            for c in chunks(b.column("line").cast(pa.string()), CHUNK):
                x = Lines(c, near)  # a line is a text here, and none is empty
                line, h, tag = x.variants()
                doc = x.doc[line]
                here = {"h": h, "tag": tag, "doc": docs[c.first:c.last][doc], "place": places[c.first:c.last][doc],
                        "extra": ids[c.first:c.last][doc]}
                late, lead, sent = resolve(here)
                if len(late):
                    yield from decided(rows(here, late, lead), parts)
                sent = sent[np.argsort(doc[sent], kind="stable")]
                yield pack(h[sent], doc[sent], here["place"][sent], docs[c.first:c.last], parts, tag=tag[sent],
                           extra=ids[c.first:c.last], hash_bytes=_VARIANT["hash_bytes"])

    def meet(x: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        late, lead, _ = resolve(x)
        if len(late):
            yield pa.RecordBatch.from_pydict(rows(x, late, lead))

    return deal(lines.mapInArrow(emit, PACKED), parts, meet, "id long, other long", **_VARIANT).distinct()


def within_one(a: bytes, b: bytes) -> bool:
    """Whether one word inserted, removed or substituted at most makes the lines equal."""
    x, y = a.split(), b.split()
    if abs(len(x) - len(y)) > 1:
        return False
    k = next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
    tail = (x[k + 1:], y[k + 1:]) if len(x) == len(y) else (x[k + 1:], y[k:]) if len(x) > len(y) else (x[k:], y[k + 1:])
    return tail[0] == tail[1]


def _verified(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """id, near_doc, near_no: of each line's partners that are within the edit bound the earliest."""
    a = lines.select("id", "line")
    b = lines.select(F.col("id").alias("other"), F.col("line").alias("other_line"), F.col("doc_id").alias("near_doc"),
                     F.col("line_no").alias("near_no"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in batches:
            fine = [within_one(x, y) for x, y in zip(p.column("line").to_pylist(), p.column("other_line").to_pylist(), strict=True)]
            yield p.select(["id", "near_doc", "near_no"]).filter(pa.array(fine, pa.bool_()))

    fine = (pairs.join(a, "id").join(b, "other").select("id", "near_doc", "near_no", "line", "other_line")
            .mapInArrow(check, "id long, near_doc long, near_no long"))
    return (fine.groupBy("id").agg(F.min(F.struct("near_doc", "near_no")).alias("m"))
            .select("id", F.col("m.near_doc").alias("near_doc"), F.col("m.near_no").alias("near_no")))


def removed_lines(docs: DataFrame, *, least: int = MIN_WORDS, near: int = NEAR_WORDS) -> DataFrame:
    """doc_id, text_hash, line_no of the lines that have an earlier line within the bound."""
    lines = written(_candidate_lines(id_text(docs), least, near), "lines")
    distinct = (lines.groupBy("line").agg(F.min(F.struct("doc_id", "line_no")).alias("first"))
                .select(F.monotonically_increasing_id().alias("id"), F.col("first.doc_id").alias("doc_id"),
                        F.col("first.line_no").alias("line_no"), "line"))
    distinct = written(distinct, "distinct-lines")
    found = _verified(neighbours(distinct, near), distinct)
    own = F.struct("doc_id", "line_no")
    other = F.struct(F.col("near_doc").alias("doc_id"), F.col("near_no").alias("line_no"))
    first = distinct.join(found, "id", "left").select(
        "line", F.when(F.col("near_doc").isNull(), own).otherwise(F.least(own, other)).alias("first"))
    first = first.select("line", F.col("first.doc_id").alias("first_doc"), F.col("first.line_no").alias("first_no"))
    later = F.struct(F.col("doc_id").alias("d"), F.col("line_no").alias("n")) > F.struct(F.col("first_doc").alias("d"), F.col("first_no").alias("n"))
    return lines.join(first, "line").where(later).select("doc_id", "text_hash", "line_no")


def _keep(raw: bytes, gone: list[int] | None) -> bytes:
    if not gone:
        return raw
    drop = set(gone)
    return b"\n".join(x for k, x in enumerate(raw.split(b"\n")) if k not in drop)


def dedup(docs: DataFrame, *, least: int = MIN_WORDS, near: int = NEAR_WORDS) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed, kept_sha256 (of the text that is left)."""
    docs = id_text(docs)
    parts = partitions(docs)

    def pack_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, key, line = (b.column(k).to_numpy(zero_copy_only=False) for k in ("doc_id", "text_hash", "line_no"))
            yield from pack_lists(doc, line, parts, key)

    def cut(ids: list[int | None], texts: list[bytes], lists: Lists) -> Iterator[pa.RecordBatch]:
        gone = [lists.of(i, signed(xxh64_intdigest(x))) for i, x in zip(ids, texts, strict=True)]
        gone = [[] if g is None else g.tolist() for g in gone]
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array(ids, pa.int64()),
            "n_lines": pa.array([x.count(b"\n") + 1 if x else 0 for x in texts], pa.int64()),
            "n_removed": pa.array([len(g) for g in gone], pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(_keep(x, g)).hexdigest() for x, g in zip(texts, gone, strict=True)], pa.string())})

    return join_lists(pack_texts(docs, parts), removed_lines(docs, least=least, near=near).mapInArrow(pack_marks, PACKED), parts, cut,
                      "doc_id long, n_lines long, n_removed long, kept_sha256 string")


def _with_marks(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """docs with a last column, by a join on the id: (hash of a text, its removed line numbers)."""
    own, gone = fresh(docs, "id"), fresh(docs, "gone")
    marks = removed.groupBy("doc_id", "text_hash").agg(F.collect_set(F.col("line_no").cast("int")).alias("lines"))
    marks = marks.groupBy(F.col("doc_id").alias(own)).agg(F.collect_list(F.struct("text_hash", "lines")).alias(gone))
    return docs.join(marks, F.col("doc_id") == F.col(own), "left").drop(own)


def _own(raw: list[bytes], gone: list) -> list[list[int]]:
    """For each text the line numbers that are marked for it."""
    out = []
    for x, marks in zip(raw, gone, strict=True):
        key = signed(xxh64_intdigest(x)) if marks else 0
        out.append([k for m in marks or () if m["text_hash"] == key for k in m["lines"]])
    return out


def without_repeated_lines(docs: DataFrame, *, size_col: str | None = "n_chars", least: int = MIN_WORDS,
                           near: int = NEAR_WORDS) -> DataFrame:
    """`docs` with the repeated lines taken out of `text` (and `size_col`, if there is one, counted
    anew). A document of which no word is left goes; one that had no word stays."""
    met = _with_marks(docs, removed_lines(docs, least=least, near=near))
    schema = docs.schema
    at = docs.columns.index("text")
    size_at = docs.columns.index(size_col) if size_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            marks = b.column(b.num_columns - 1).to_pylist()
            texts = b.column(at).to_pylist()
            raw = [(x or "").encode() for x in texts]
            gone = _own(raw, marks)
            left = [_keep(x, g) for x, g in zip(raw, gone, strict=True)]
            fine = pa.array([not g or bool(x.split()) for x, g in zip(left, gone, strict=True)], pa.bool_())
            new = [None if t is None else x.decode() for t, x in zip(texts, left, strict=True)]
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            cols[at] = pa.array(new, pa.string())
            if size_at is not None:
                sizes = pa.array([len(t) if g else None for t, g in zip(new, gone, strict=True)], pa.int64())
                changed = pa.array([bool(g) for g in gone], pa.bool_())
                cols[size_at] = pc.if_else(changed, sizes.cast(cols[size_at].type), cols[size_at])
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[:-1]).filter(fine)

    return met.mapInArrow(run, schema)
