"""Manifest, spelling variants and byte-level BPE, against plain versions and the tokenizer library."""

import hashlib
import random
import string
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from daybook.llm import byte_bpe, merkle, spelling
from daybook.llm.tables import read_table

from . import brute
from .conftest import keyed

# ------------------------------------------------------------------ 11


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(fields):
    return sha(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))


def tree(nodes, fanout):
    """(root, for each node the (left, right) siblings level by level)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, path in enumerate(paths):
            first = at[k] // fanout * fanout
            run = nodes[first:first + fanout]
            path.append((run[:at[k] - first], run[at[k] - first + 1:]))
            at[k] //= fanout
        nodes = [sha(*nodes[k:k + fanout]) for k in range(0, len(nodes), fanout)]
    return nodes[0], paths


def manifest_of(rows, fanout=8):
    """Rows (doc_id, source, lang, n_chars, text) -> the contract's rows."""
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r[2]].append(((r[0] is not None, r[0] or 0, leaf_of(r)), r))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for x in langs:
        by_lang[x].sort(key=lambda p: p[0])
        trees[x] = tree([k[2] for k, _ in by_lang[x]], fanout)
    root, upper = tree([trees[x][0] for x in langs], fanout)
    out = []
    for x, above in zip(langs, upper, strict=True):
        for ((_, _, leaf), r), path in zip(by_lang[x], trees[x][1], strict=True):
            path = path + above
            text = r[4]
            if r[0] is not None and text is not None and crc32(str(r[0]).encode()) % 3 == 0:
                text = text.translate(brute.LETTERS)
            node = leaf_of((*r[:4], text))
            for a, b in path:
                node = sha(*a, node, *b)
            out.append((r[0], leaf, trees[x][0], root, sha(*(y for a, b in path for y in a + b)), node, node == root))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _check_manifest(table, shape):
    rows = [tuple(r) for r in table.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = keyed(merkle.manifest(table, check=merkle.tampered(table), shape=shape), *COLUMNS)
    want = manifest_of(rows, shape.fanout)
    assert got == want
    return want


def test_manifest_of_odd_documents(docs, none):
    want = _check_manifest(docs, merkle.Shape())
    assert len({w[2] for w in want}) == 3 and len({w[3] for w in want}) == 1
    assert merkle.manifest(none, check=merkle.tampered(none)).collect() == []


@pytest.mark.parametrize("shape", [merkle.Shape(8, 1), merkle.Shape(2, 1), merkle.Shape(3, 2)])
def test_blocks_that_exchange(spark, sf, shape):
    """Many blocks, several rounds, ragged last runs: as if there were no blocks."""
    _check_manifest(read_table(spark, sf, "documents").repartition(5), shape)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 73, 513])
def test_trees_of_every_size(spark, n):
    rows = [(k, "s", "x", k, f"Text {k}") for k in range(n)] + [(1000 + k, None, None, None, None) for k in range(n % 5)]
    table = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    _check_manifest(table, merkle.Shape(8, 1))


def test_a_changed_row_is_found(spark, sf):
    docs = read_table(spark, sf, "documents")
    whole = merkle.manifest(docs)
    assert whole.where("not verified").count() == 0
    odd = merkle.manifest(docs, check={"n_chars": F.when(F.col("doc_id") == 7, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})
    assert keyed(odd.where("not verified"), "doc_id") == [(7,)]
    assert whole.select("root").distinct().collect() == odd.select("root").distinct().collect()


def test_many_groups(spark):
    rows = [(k, None, f"lang{k % 70}", k, "t") for k in range(300)]
    table = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    _check_manifest(table, merkle.Shape(8, 1))


# ------------------------------------------------------------------ 12


def counted(rows, min_length=7, min_count=2, misspelt=31):
    n = Counter()
    for i, text in rows:
        for run in spelling.RUN.findall((text or "").translate(brute.LETTERS)):
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            k = h % len(run)
            n[run[:k] + run[k + 1:] if h % misspelt == 0 else run] += 1
    return {w: c for w, c in n.items() if len(w) >= min_length and c >= min_count}


def variants_of(n, ratio=10):
    """Words that share a pattern with one letter left open, or one of which lacks a letter of the other."""
    near, open_ = {w: set() for w in n}, defaultdict(list)
    for w in n:
        for k in range(len(w)):
            open_[w[:k], w[k + 1:]].append(w)
            if (less := w[:k] + w[k + 1:]) in n:
                near[w].add(less)
                near[less].add(w)
    for same in open_.values():
        for w in same:
            near[w].update(x for x in same if x != w)
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


VARIANT = ("word", "form", "root", "n", "n_near", "form_n")


def test_variants_of_odd_documents(docs, rows, none):
    want = variants_of(counted(rows))
    assert keyed(spelling.spelling_variants(docs), *VARIANT) == want and sum(w[4] for w in want) > 5
    assert spelling.spelling_variants(none).collect() == []


def test_variants_of_the_given_table(spark, sf):
    docs = read_table(spark, sf, "documents")
    want = variants_of(counted([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert keyed(spelling.spelling_variants(docs), *VARIANT) == want
    assert sum(w[1] is not None for w in want) > 5 and sum(w[4] for w in want) > 1000


def test_near_words_of_few_letters(spark):
    """Words of two letters of the alphabet, of long runs and of ties: every pair is found."""
    rng = random.Random(3)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(7, 10))) for _ in range(300)}
    words |= {"".join(rng.choice("abcdéÿ") for _ in range(rng.randint(7, 9))) for _ in range(300)}
    words |= {"a" * k for k in range(7, 14)} | {"a" * 3000, "a" * 2999, "a" * 2998 + "b", "a" * 2000 + "b" + "a" * 999}
    words |= {"abcdefg", "bcdefgh", "xabcdefg", "abcdefgx", "abcdxefg", "abcdefh", "ÿbcdefg", "Àbcdefg", "àbcdefg"}
    n = {w: rng.choice([2, 3, 25, 40, 300, 5000]) for w in words}
    got = spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long").repartition(3))
    want = variants_of(n)
    assert keyed(got, *VARIANT) == want
    assert max(len(w[2]) for w in want) > 1000 and any(w[1] and w[2] != w[1] for w in want)


def test_long_chain_of_forms(spark):
    n = {"a" * 7 + "b" * k: 10**k for k in range(18)}
    got = spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long"))
    assert {r["root"] for r in got.collect()} == {"a" * 7 + "b" * 17}


def test_pivots_are_disjoint_and_cheapest():
    rng = np.random.default_rng(5)
    word, place, cost = [], [], []
    for w in range(300):
        own = np.sort(rng.choice(12, rng.integers(3, 9), replace=False))
        word += [w] * len(own)
        place += own.tolist()
        cost += rng.integers(1, 20, len(own)).tolist()
    word, place, cost = map(np.array, (word, place, cost))
    for pieces in (1, 2):
        mask = spelling.pivots(word, place, cost, pieces)
        for w in range(300):
            own = np.flatnonzero(word == w)
            chosen = own[mask[own]]
            assert len(chosen) == pieces and (pieces == 1 or place[chosen[1]] - place[chosen[0]] >= 2)
            pairs = [cost[a] if pieces == 1 else cost[a] + cost[b] for a in own for b in own
                     if (a == b if pieces == 1 else place[b] - place[a] >= 2)]
            assert cost[chosen].sum() == min(pairs)


# ------------------------------------------------------------------ 13


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    ranks = {x: k for k, x in enumerate(byte_bpe.read_ranks(None))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return byte_bpe.vocabulary()


def _check_bpe(docs, rows, library):
    def hexa(x):
        return hashlib.sha256(x).hexdigest()

    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hexa(",".join(map(str, ids)).encode()), hexa((t or "").encode())))
    got = byte_bpe.round_trip(docs)
    assert keyed(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)


def test_ids_are_the_librarys(spark, sf, docs, rows, none, library):
    _check_bpe(docs, rows, library)
    given = read_table(spark, sf, "documents")
    _check_bpe(given, [(r["doc_id"], r["text"]) for r in given.collect()], library)
    assert byte_bpe.round_trip(none).collect() == []


def test_ids_of_random_and_long_texts(own, library):
    rng = random.Random(4)
    signs = [" ", "  ", "\n", "a", "B,", "1", "'s", "'LL", "\t", "\x85", "\x1c", "é", "<|endoftext|>", "́", "!", "abab", "\0", "Σ", "漢",
             "՘", "꟎", "𐐀", "Ⅷ", "²", " ", "ẞ", "\U0010ffff"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += ["x" * 30_000, "ab" * 9_999 + "c", " " * 5_000, "\n" * 4_000 + "a", "".join(rng.choice(string.ascii_lowercase) for _ in range(40_000))]
    for limit in (7, 300_000):
        got = [np.frombuffer(x, "<i4").tolist() for x in byte_bpe.Encoder(own, limit).encode(texts)]
        assert got == [library.encode_ordinary(x) for x in texts]


def test_whole_pretokens_come_before_merges(spark):
    """A token that no pair of tokens makes has its id where it is a whole pre-token, and only there."""
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"xy"]
    own = byte_bpe.Vocabulary(tokens, r" ?\p{L}+|\s+(?!\S)|\s+")
    a, b, c, d = b"abcd"
    assert [np.frombuffer(x, "<i4").tolist() for x in byte_bpe.Encoder(own).encode(["abc", "abcd", "xy", "xyxy"])] == [
        [256], [a, b, c, d], [257], [257, 257]]
    table = spark.createDataFrame([(1, "abc"), (2, "abcd"), (None, None)], "doc_id long, text string")
    rows = byte_bpe.decode(byte_bpe.encode(table, own), own)
    assert keyed(rows, "doc_id", "ids", "decoded") == sorted([(1, [256], bytearray(b"abc")), (2, [a, b, c, d], bytearray(b"abcd")), (None, [], bytearray())], key=repr)


def test_perfect_hash_is_minimal_and_exact(own):
    tokens = own.hash.keys.to_pylist()
    assert sorted(own.hash.number.tolist()) == list(range(len(tokens)))
    assert own.hash.find(own.hash.keys).tolist() == list(range(len(tokens)))
    known, rng = set(tokens), random.Random(1)
    others = [x for x in (rng.randbytes(rng.randint(0, 9)) for _ in range(20_000)) if x not in known]
    assert set(own.hash.find(pa.array(others, pa.binary())).tolist()) == {-1}
    for few in ([], [b""], [b"a", b""]):
        assert byte_bpe.PerfectHash(few).find(pa.array([*few, b"zz"], pa.binary())).tolist() == [*range(len(few)), -1]


def test_decoding_of_nulls_and_unknown_ids(spark, own):
    table = spark.createDataFrame([(1, [72, None, 73]), (2, None), (3, [])], "n int, ids array<int>")
    want = bytes(own.hash.keys[72].as_py() + own.hash.keys[73].as_py())
    assert {r["n"]: bytes(r["decoded"]) for r in byte_bpe.decode(table, own).collect()} == {1: want, 2: b"", 3: b""}
    with pytest.raises(Exception, match="isn't in the vocabulary"):
        byte_bpe.decode(spark.createDataFrame([(1, [own.size])], "n int, ids array<int>"), own).collect()
