"""Plain versions of the operators over a list of (doc_id, text), for small inputs."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter, defaultdict

import xxhash

LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = words(text)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    lie = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(lie)


def share_of_repeats(text, n):
    """Share of word characters in n-grams that occurred before in the text."""
    w, seen, lie = words(text), set(), set()
    for i in range(len(w) - n + 1):
        g = tuple(w[i:i + n])
        if g in seen:
            lie.update(range(i, i + n))
        seen.add(g)
    return sum(len(w[j]) for j in lie) / max(1, sum(map(len, w)))


def substring_dedup(docs, window=20):
    """(doc_id, text) -> (n_words, n_removed, kept_sha256)."""
    first = {}
    for i, text in docs:
        w = words(text)
        if i is not None:
            for s in range(len(w) - window + 1):
                g = tuple(w[s:s + window])
                first[g] = min(first.get(g, (i, s)), (i, s))
    out = {}
    for i, text in docs:
        w, drop = words(text), set()
        for s in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[s:s + window])] < (i, s):
                drop.update(range(s, s + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in drop)
        out[i, text] = (len(w), len(drop), hashlib.sha256(kept.encode()).hexdigest())
    return out


def _one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1:] == b for k in range(len(a)))


def line_dedup(docs, least=1, near=5):
    """(doc_id, text) -> the numbers of its removed lines; all pairs of lines are compared."""
    def key(line):
        return tuple(words(line.translate(LETTERS)))

    lines = [(i, k, key(x)) for i, text in docs if i is not None for k, x in enumerate((text or "").split("\n"))]
    first = {}
    for i, k, w in lines:
        if len(w) >= least:
            first[w] = min(first.get(w, (i, k)), (i, k))
    earliest = dict(first)
    long_ = defaultdict(list)
    for w in first:
        if len(w) >= near:
            long_[len(w)].append(w)
    for n in long_:
        for a, b in itertools.chain(itertools.combinations(long_[n], 2), itertools.product(long_[n], long_.get(n + 1, []))):
            if _one_edit(a, b):
                earliest[a] = min(earliest[a], first[b])
                earliest[b] = min(earliest[b], first[a])
    return {(i, text): [k for k, x in enumerate((text or "").split("\n"))
                        if i is not None and len(key(x)) >= least and earliest[key(x)] < (i, k)] for i, text in docs}


def without(text, gone):
    return "\n".join(x for k, x in enumerate(text.split("\n")) if k not in set(gone))


def fingerprint(text, size=3):
    w = words((text or "").translate(LETTERS))
    grams = [w[i:i + size] for i in range(len(w) - size + 1)] if len(w) >= size else [w] if w else []
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(fps, max_bits=2):
    """[(doc_id, fingerprint)] -> the least doc_id that each row reaches."""
    label = list(range(len(fps)))
    for a, b in itertools.combinations(range(len(fps)), 2):
        if (fps[a][1] ^ fps[b][1]).bit_count() <= max_bits and label[a] != label[b]:
            old, new = max(label[a], label[b]), min(label[a], label[b])
            label = [new if x == old else x for x in label]
    least = {}
    for x, (i, _) in zip(label, fps, strict=True):
        if i is not None:
            least[x] = min(least.get(x, i), i)
    return [least.get(x) for x in label]


def contains(text, passage):
    def norm(x):
        return " " + " ".join(re.findall(r"[^\W_]+", (x or "").lower())) + " "

    return norm(passage) in norm(text)


SECRET_ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in SECRET_ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(out))
