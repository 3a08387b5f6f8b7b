"""Operators that compare documents, against versions that compare everything with everything."""

import hashlib
import itertools
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from daybook.llm import components, decontaminate, exchange, line_dedup, simhash, substring_dedup
from daybook.llm.tables import read_table

from . import brute
from .conftest import keyed


@pytest.fixture(scope="module")
def given(spark, sf):
    docs = read_table(spark, sf, "documents").cache()
    return docs, [(r["doc_id"], r["text"]) for r in docs.collect()]


# ------------------------------------------------------------------ 4


def _check_substrings(docs, rows):
    want = brute.substring_dedup(rows)
    got = keyed(substring_dedup.dedup(docs), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted([(i, *want[i, t]) for i, t in rows], key=repr)
    return sum(w[1] for w in want.values())


def test_substrings_of_odd_documents(docs, rows, none):
    assert _check_substrings(docs, rows) > 100
    assert substring_dedup.dedup(none).collect() == []


def test_substrings_of_the_given_table(given):
    assert _check_substrings(*given) > 100


def test_substring_text_that_is_left(docs, rows):
    got = {r["doc_id"]: r["kept_text"] for r in substring_dedup.dedup(docs, keep_text=True).collect() if r["n_removed"]}
    assert got[50] == "" and all("  " not in x for x in got.values())


@pytest.mark.parametrize("shift", range(0, 20, 3))
def test_a_window_is_found_at_every_offset(spark, shift):
    rng = random.Random(shift)
    run = [f"w{rng.random()}" for _ in range(20)]
    rows = [(1, " ".join([*(f"a{k}" for k in range(shift)), *run, "end"])), (2, " ".join([*(f"b{k}" for k in range(7)), *run, "fin"]))]
    _check_substrings(spark.createDataFrame(rows, "doc_id long, text string"), rows)


# ------------------------------------------------------------------ 5


def _check_lines(docs, rows):
    want = brute.line_dedup(rows)
    got = keyed(line_dedup.dedup(docs), "doc_id", "n_removed", "kept_sha256")
    left = {k: hashlib.sha256(brute.without(k[1] or "", gone).encode()).hexdigest() for k, gone in want.items()}
    assert got == sorted([(i, len(want[i, t]), left[i, t]) for i, t in rows], key=repr)
    return sum(map(len, want.values()))


def test_lines_of_odd_documents(docs, rows, none):
    assert _check_lines(docs, rows) > 20
    assert line_dedup.dedup(none).collect() == []


def test_lines_of_the_given_table(given):
    assert _check_lines(*given) > 50


def test_lines_within_one_word_by_all_pairs(spark):
    rng = random.Random(2)
    rows = [(k, "\n".join(" ".join(rng.choice("ab") for _ in range(rng.randint(6, 11))) for _ in range(4))) for k in range(60)]
    assert _check_lines(spark.createDataFrame(rows, "doc_id long, text string"), rows) > 50


def test_short_lines(spark):
    rows = [(1, "les.\nand ornd.\none two three four five"), (2, "LES.\nAnd  ornd.\none two three four six\nand"),
            (3, "and\nles.\none two three five\none three four five\n\n"), (4, "les."), (None, "les.")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    _check_lines(table, rows)
    want = brute.line_dedup(rows)
    assert [want[x] for x in rows] == [[], [0, 1, 2], [0, 1], [0], []]
    kept = keyed(line_dedup.without_repeated_lines(table), "doc_id", "text")
    assert kept == [(1, rows[0][1]), (2, "and"), (3, "one two three five\none three four five\n\n"), (None, "les.")]


@pytest.mark.parametrize("least,near", [(3, 8), (2, 2)])
def test_lines_with_other_bounds(spark, docs, rows, least, near):
    want = brute.line_dedup(rows, least, near)
    left = [(i, len(want[i, t]), hashlib.sha256(brute.without(t or "", want[i, t]).encode()).hexdigest()) for i, t in rows]
    assert keyed(line_dedup.dedup(docs, least=least, near=near), "doc_id", "n_removed", "kept_sha256") == sorted(left, key=repr)


@pytest.mark.parametrize("words,place", [(300, 256), (300, 257), (700, 511), (70_000, 65_537)])
def test_long_lines_that_differ_far_behind(spark, words, place):
    """Lines that have words in the same places modulo a power of two are told apart."""
    line = [f"w{k % 97}x{k}" for k in range(words)]

    def put(at, word):
        return " ".join([*line[:at], word, *line[at:]])

    rows = [(1, put(place, "x")), (2, put(2, "y")), (3, put(2, "z")), (4, put(place, "x"))]
    want = {1: 0, 2: 0, 3: 1, 4: 1}
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in line_dedup.dedup(table).collect()} == want
    if words < 1000:
        _check_lines(table, rows)


def test_documents_without_repeated_lines(docs, rows, none):
    want = brute.line_dedup(rows)
    out = line_dedup.without_repeated_lines(docs)
    assert out.schema == docs.schema
    left = [(i, None if t is None else brute.without(t, want[i, t]), bool(want[i, t])) for i, t in rows]
    left = [(i, t, None if t is None else len(t)) for i, t, cut in left if not cut or brute.words(t)]
    assert keyed(out, "doc_id", "text", "n_chars") == sorted(left, key=repr)
    assert line_dedup.without_repeated_lines(none).collect() == []


# ------------------------------------------------------------------ 10


def _check_simhash(docs, rows):
    fps = [(i, brute.fingerprint(t)) for i, t in rows]
    want = [(i, f"{fp:016x}", c) for (i, fp), c in zip(fps, brute.components(fps), strict=True)]
    assert keyed(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)
    return want


def test_simhash_of_odd_documents(docs, rows, none):
    _check_simhash(docs, rows)
    assert simhash.near_duplicates(none).collect() == []


def test_simhash_of_the_given_table(given):
    _check_simhash(*given)


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3])
@pytest.mark.parametrize("large", [4, 1024])
def test_links_connect_as_all_pairs_do(spark, monkeypatch, max_bits, large):
    monkeypatch.setattr(simhash, "LARGE_GROUP", large)
    rng = random.Random(max_bits)
    seeds = [rng.getrandbits(64) for _ in range(4)] + [0, 2**64 - 1]
    fps = sorted({s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for s in seeds for _ in range(60)})
    at, keys = simhash.points(np.array(fps, np.uint64), max_bits)
    order = np.argsort(keys, kind="stable")
    a, b = simhash.group_links(keys[order], np.array(fps, np.uint64)[at[order]], max_bits)
    assert all((int(x) ^ int(y)).bit_count() <= max_bits for x, y in zip(a, b, strict=True))
    forest = simhash._Forest()
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        forest.join(x, y)
    want = brute.components([(k, x) for k, x in enumerate(fps)], max_bits)
    assert [fps.index(forest.find(x)) for x in fps] == want


def test_one_of_each_stays(docs, rows):
    kept = simhash.one_of_each(docs)
    assert kept.schema == docs.schema
    fps = [(i, brute.fingerprint(t)) for i, t in rows]
    want = {(i, t) for (i, t), c in zip(rows, brute.components(fps), strict=True) if i == c}
    assert keyed(kept, "doc_id", "text") == sorted(want, key=repr)


def test_components_of_a_chain_and_a_star(spark):
    pairs = [(k, k + 1) for k in range(0, 40)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7), (200, 201), (201, 200)]
    random.Random(1).shuffle(pairs)
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {100 + k: 100 for k in range(1, 50)} | {201: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


# ------------------------------------------------------------------ 2


def test_planted_passages(spark, docs, rows, none):
    rng = random.Random(4)
    items = [" ".join(f"q{rng.randint(0, 10**6)}" for _ in range(n)) for n in (40, 25, 16, 9, 5, 4, 3)]

    def change(text, every):
        return " ".join("changed" if k % every == every - 1 else w for k, w in enumerate(text.split()))

    more = [(500, "before it " + items[0].upper() + ", after it"), (501, change(items[0], 7)), (502, items[1]), (503, change(items[1], 8)),
            (504, "x " + items[2] + " y"), (505, "x, " + items[3] + ". y"), (506, " ".join(items[0].split()[5:25])),
            (507, " ".join(items[0].split()[:8])), (508, items[4]), (None, items[1] + " tail"), (509, items[2] + " " + items[1]),
            (510, f"so {items[5]}, and {items[6]}."), (511, " ".join(items[4].split()[:4]) + " changed"), (512, items[6])]
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    benchmark = spark.createDataFrame([*enumerate(items), (90, None), (91, "")], "item_id long, text string")
    got = decontaminate.overlaps(table, benchmark)
    want = {(500, 0), (501, 0), (502, 1), (503, 1), (504, 2), (505, 3), (506, 0), (None, 1), (509, 1), (509, 2), (508, 4), (510, 5)}
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want
    blocks = decontaminate.overlaps(table, benchmark, block_seeds=40)
    cols = ("doc_id", "item_id", "matched", "overlap_words", "doc_start", "item_start")
    assert keyed(blocks, *cols) == keyed(got, *cols)
    whole = {r["doc_id"]: r for r in got.where("item_id = 0").collect()}
    assert (whole[500]["matched"], whole[500]["overlap_words"], whole[500]["doc_start"], whole[500]["item_start"]) == (40, 40, 2, 0)
    assert whole[506]["item_start"] == 5 and whole[501]["matched"] == 35
    kept = decontaminate.decontaminated(table, benchmark)
    assert keyed(kept, "doc_id", "text") == sorted([*rows, (507, more[7][1]), more[-2], more[-1]], key=repr)
    assert decontaminate.overlaps(none, benchmark).collect() == [] and decontaminate.overlaps(table, none.select(F.col("doc_id").alias("item_id"), "text")).collect() == []


def test_items_without_an_id_and_one_long_item(spark, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(f"q{rng.randint(0, 10**6)}" for _ in range(n)) for n in (30, 20, 20, 400)]
    docs = spark.createDataFrame([(k, "before " + x + " after") for k, x in enumerate(texts)] + [(9, texts[0] + " " + texts[1])], "doc_id long, text string")
    rows = [(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (7, texts[3])]
    benchmark = spark.createDataFrame(rows, "item_id long, text string")
    want = [(0, None, 30), (1, None, 20), (2, 7, 20), (3, 7, 400), (9, None, 20), (9, None, 30)]
    sizes = []
    real = F.broadcast
    monkeypatch.setattr(decontaminate.F, "broadcast", lambda x: (sizes.append(x.count()), real(x))[1])
    for size in (1_000_000, 200):
        got = decontaminate.overlaps(docs, benchmark, block_seeds=size)
        assert keyed(got, "doc_id", "item_id", "matched") == sorted(want, key=repr)
    assert sizes[0] > 1000 and max(sizes[1:]) < 300  # the long item alone has over 1000 seeds
    assert decontaminate.decontaminated(docs, benchmark).collect() == []


def test_given_benchmark_passages(spark, sf, given):
    docs, rows = given
    items = [(r["item_id"], r["text"]) for r in read_table(spark, sf, "benchmark").collect()]
    want = {(i, k) for i, t in rows for k, x in items if brute.contains(t, x)}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(docs, read_table(spark, sf, "benchmark")).collect()}
    assert want <= got and len(got) <= len(want) + 2


def test_decontamination_runs_no_python(spark, sf):
    from daybook.llm.queries import queries

    plan = queries()["op2_decontamination"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "MapInArrow" not in plan


# ------------------------------------------------------------------ the packed shuffle


@pytest.mark.parametrize("hash_bytes,tag,extra", [(5, None, False), (8, np.dtype("u1"), True), (8, np.dtype("<u4"), True), (6, np.dtype("<u4"), True)])
def test_packed_entries_come_back(hash_bytes, tag, extra):
    rng = np.random.default_rng(1)
    n, docs, parts = 5000, 60, 7
    doc = np.sort(rng.integers(0, docs, n))
    place = np.arange(n) - np.searchsorted(doc, doc)
    ids = rng.integers(-2**62, 2**62, docs)
    h = rng.integers(0, 2**64, n, dtype=np.uint64)
    tags = None if tag is None else rng.integers(0, 200, n).astype(tag)
    more = rng.integers(-2**62, 2**62, docs) if extra else None
    batch = exchange.pack(h, doc, place, ids, parts, hash_bytes=hash_bytes, tag=tags, extra=more)
    back = [exchange.unpack(x.as_py(), hash_bytes=hash_bytes, tag=tag, extra=extra) for x in batch.column("payload")]
    mask = (1 << 8 * hash_bytes) - 1
    got = sorted(itertools.chain.from_iterable(zip(*(x[c].tolist() for c in sorted(x)), strict=True) for x in back))
    cols = {"doc": ids[doc].tolist(), "h": [int(x) & mask for x in h], "place": place.tolist()}
    cols |= ({} if tag is None else {"tag": tags.tolist()}) | ({} if not extra else {"extra": more[doc].tolist()})
    assert got == sorted(zip(*(cols[c] for c in sorted(cols)), strict=True))


@pytest.mark.parametrize("parts", [1, 7])
def test_lists_and_texts_meet_by_document(spark, parts):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(50)] + [(None, "x"), (None, None), (3, "again")], "doc_id long, text string")
    doc, place = np.repeat(np.arange(0, 50, 3), 4), np.tile([5, 1, 5, 900_000], 17)

    def lists(_):
        yield from exchange.pack_lists(doc, place, parts)

    def use(ids, texts, own):
        import pyarrow as pa

        got = [own.of(i) for i in ids]
        yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "text": pa.array([x.decode() for x in texts]),
                                          "places": pa.array(["" if g is None else str(g.tolist()) for g in got])})

    out = exchange.join_lists(exchange.pack_texts(docs, parts), spark.range(1).coalesce(1).mapInArrow(lists, exchange.PACKED), parts, use,
                              "doc_id long, text string, places string")
    want = [(i, t or "", "[1, 5, 900000]" if i is not None and i % 3 == 0 else "") for i, t in [tuple(r) for r in docs.collect()]]
    assert keyed(out, "doc_id", "text", "places") == sorted(want, key=repr)
