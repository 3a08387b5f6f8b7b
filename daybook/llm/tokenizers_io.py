"""Tokenizer files: read in each worker once, by a path that is a parameter."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def default_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@lru_cache(maxsize=4)
def load(path: str | None, name: str):
    """The tokenizer at `path`; None: the installed public file called `name`."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path or default_path(name))
    tok.no_padding()
    tok.no_truncation()
    return tok


class TwoGenerations(dict):
    """A bounded cache: when `limit` entries are new, the older generation is dropped. Entries of
    the older one come back when they are used."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.old = limit, {}

    def missing(self, keys: set) -> set:
        """The keys that are in neither generation. The others can be looked up until the next
        call (those in the older generation are renewed); `update` adds the missing ones."""
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        new = keys.difference(self)
        if self.old and new:
            self.update({k: self.old[k] for k in new if k in self.old})
            new = new.difference(self)
        return new


def _byte_chars() -> dict[int, str]:
    """Byte -> the character that stands for it in byte-level vocabularies: printable Latin-1
    characters stand for themselves, the other bytes follow from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


_BYTE_CHARS = _byte_chars()
#: Text outside of these characters, or that may hold a special token, goes to the library
#: whole: pattern engines can differ in newer letters, and marks may compose.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\u024f]*")


def plain(text: str) -> bool:
    return "<|" not in text and _PLAIN.fullmatch(text) is not None


class Bpe:
    """Pair merging of many pre-tokens at once, with the library tokenizer's own vocabulary and
    merges. In each step every unfinished pre-token merges the leftmost of its best-ranked pairs,
    as the library does one by one."""

    _NONE = np.int32(2**31 - 1)

    def __init__(self, tokenizer):
        model = json.loads(tokenizer.to_str())["model"]
        vocab, tail = model["vocab"], model["end_of_word_suffix"] or ""
        inner = np.array([vocab.get(_BYTE_CHARS[b], -1) for b in range(256)], np.int32)
        final = np.array([vocab.get(_BYTE_CHARS[b] + tail, -1) for b in range(256)], np.int32)
        self.inner, self.final, self.size = inner, final, np.int64(max(vocab.values()) + 1)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocab[a] * int(self.size) + vocab[b] for a, b in pairs], np.int64)
        into = np.array([vocab[a + b.removesuffix(tail) + tail if tail and b.endswith(tail) else a + b]
                         for a, b in pairs], np.int32)
        # hash table of pairs with linear probing: slot -> rank
        self.bits = 18
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, self._NONE, np.int32)
        self.into, self.probes = into, 1
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.slots[at] == -1
            _, one = np.unique(np.where(free, at, -1 - np.arange(len(at))), return_index=True)
            one = one[free[one]]
            self.slots[at[one]] = keys[todo[one]]
            self.ranks[at[one]] = todo[one]
            rest = np.ones(len(todo), bool)
            rest[one] = False
            todo, at = todo[rest], (at[rest] + 1) & ((1 << self.bits) - 1)
            self.probes += bool(len(todo))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _rank(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        out = np.where(self.slots[at] == keys, self.ranks[at], self._NONE)
        open_ = np.flatnonzero((out == self._NONE) & (self.slots[at] != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            there = self.slots[at[open_]]
            found = there == keys[open_]
            out[open_[found]] = self.ranks[at[open_[found]]]
            open_ = open_[~found & (there != -1)]
        return out

    def encode(self, pretokens: list[bytes]) -> list[bytes]:
        """The ids of each pre-token (none is empty), as little-endian unsigned 32-bit."""
        lens = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
        data = np.frombuffer(b"".join(pretokens), np.uint8)
        sym = self.inner[data]
        ends = np.cumsum(lens)
        sym[ends - 1] = self.final[data[ends - 1]]
        word = np.arange(len(lens))
        done_sym, done_word = [], []
        while len(word):
            starts = np.cumsum(lens) - lens
            rank = np.full(len(sym), self._NONE, np.int32)
            if len(sym) > 1:
                rank[:-1] = self._rank(sym[:-1].astype(np.int64) * self.size + sym[1:])
            rank[starts + lens - 1] = self._NONE
            best = np.minimum.reduceat(rank, starts)
            more = best != self._NONE
            owner = np.repeat(np.arange(len(lens)), lens)
            out = ~more[owner]
            done_sym.append(sym[out])
            done_word.append(word[owner[out]])
            hit = np.flatnonzero((rank == best[owner]) & ~out)
            hit = hit[np.diff(owner[hit], prepend=-1) != 0]  # the leftmost of each
            sym[hit] = self.into[rank[hit]]
            out[hit + 1] = True
            sym = sym[~out]
            word, lens = word[more], lens[more] - 1
        order = np.concatenate(done_word) if done_word else np.zeros(0, np.int64)
        flat = np.concatenate(done_sym)[np.argsort(order, kind="stable")].astype("<u4")
        ends = (4 * np.cumsum(np.bincount(order, minlength=len(pretokens)))).tolist()
        packed = flat.tobytes()
        return [packed[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class Pretokens(TwoGenerations):
    """Pre-token -> its ids, packed as little-endian unsigned 32-bit."""

    def __init__(self, tokenizer, limit: int):
        super().__init__(limit)
        self.bpe = Bpe(tokenizer)

    def learn(self, pretokens: set[str]) -> None:
        if new := list(self.missing(pretokens)):
            self.update(zip(new, self.bpe.encode([x.encode() for x in new]), strict=True))

    def of_each(self, texts: list[str], pattern) -> list[bytes]:
        """The packed ids of plain texts, their pre-tokens found by a pattern that knows NUL."""
        if not texts:
            return []
        flat = pattern.findall("\0".join(texts))
        self.learn(set(flat).difference("\0"))
        out, ids = [], b""
        for x in flat:
            if x == "\0":
                out.append(ids)
                ids = b""
            else:
                ids += self[x]
        return [*out, ids]


def split_plain(texts: list) -> tuple[list, list]:
    """(plain texts, the others); one look if all are plain."""
    if plain("".join(texts)):
        return texts, []
    return [x for x in texts if plain(x)], [x for x in texts if not plain(x)]
