"""Operator 7: secret scans by dictionary-primed zstandard novelty.

Base patterns (assignments to credential names, access keys, long hexadecimal runs) are found
first. The method then looks at the other strings that could be keys (whole runs of 16 or more key
characters, however long, with letters and digits) near a sensitive word, and asks how new they are: the
bytes that the candidate adds to a zstandard frame of its surroundings, compressed with a
dictionary of code and identifier words. A name or a repeated string costs a few bytes; a random
string costs nearly its entropy. Candidates whose marginal bytes reach `MIN_NOVELTY` per
character are reported as kind `novel`. A run of more than `SLICE` characters is measured in even
slices and reported whole if one of them is new.

A sensitive word reaches `CONTEXT` characters, and from a run in its reach on through the runs that
adjoin it with no letter, digit or blank line between (the lines of a key, also quoted or escaped). What
stands between a BEGIN line with a sensitive word and its END line is sensitive throughout.

Nulls: a null text is empty and has no span; a null id is carried along. Repeated rows are
scanned each for itself. An empty table gives an empty result. Spans are code points, the end
exclusive; base spans stay, a candidate that overlaps one isn't reported again.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .tables import chunks, id_text

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs are whole: shorter ones fail
MIN_ASSIGNED, MIN_ACCESS = 8, 16

RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}")  # greedy: runs are whole
LETTER, DIGIT = re.compile("[A-Za-z]"), re.compile("[0-9]")
SLICE = 256
#: Any of these within `CONTEXT` characters before a candidate makes its context sensitive.
SENSITIVE = re.compile(r"(?ai:key|secret|token|passw|passphrase|credential|auth|bearer|private|signature|cert)")
CONTEXT = 64
#: What may stand between adjoining runs: no letter or digit but in escapes, one line end at most.
GAP = re.compile(r"(?:\\[nrt]|[^\w\n]|_)*(?:\n(?:\\[nrt]|[^\w\n]|_)*)?")
ARMOR = re.compile(r"-----(BEGIN|END)([\x20A-Z0-9]*)-----")
AROUND = 256
MIN_NOVELTY = 0.6

#: Words of code and configuration that prime the compressor (fixed values).
DICTIONARY = (
    "public static void private protected class function return import export const let var def self this "
    "true false null none undefined string integer boolean object array list map config configuration settings "
    "environment variable value name username password passwd secret token access_key secret_key api_key apikey "
    "client_id client_secret authorization bearer basic credential credentials private_key public_key ssh-rsa "
    "certificate BEGIN END RSA PRIVATE KEY http https www localhost host port database user admin root example "
    "server client request response header content-type application json xml yaml version default timeout debug "
    "production staging development test sample placeholder changeme abcdefghijklmnopqrstuvwxyz "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0123456789abcdef 00000000 11111111 ffffffff "
    "error warning info message exception handler service manager factory controller repository identifier "
)


@lru_cache(maxsize=1)
def _compressor():
    words = zstandard.ZstdCompressionDict(DICTIONARY.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=19, dict_data=words, write_checksum=False, write_content_size=False)


def novelty(candidate: str, around: str) -> float:
    """Marginal compressed bytes per character of a candidate in its surroundings."""
    c = _compressor()
    base = len(c.compress(around.encode()))
    return (len(c.compress(f"{around} {candidate}".encode())) - base) / len(candidate)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base patterns."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], x[2]))


def _armored(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of what BEGIN lines with a sensitive word and their END lines enclose."""
    begin = None
    for m in ARMOR.finditer(text):
        if m[1] == "END" and begin is not None and begin[2] == m[2]:
            yield begin.end(), m.start()
        begin = m if m[1] == "BEGIN" and SENSITIVE.search(m[2]) else None


def candidates(text: str) -> list[tuple[int, int]]:
    """(start, end) of the runs with letters and digits in a sensitive context."""
    if SENSITIVE.search(text) is None:
        return []
    runs = [m.span() for m in RUN.finditer(text)]
    starts = [a for a, _ in runs]
    near = set()
    at = 0  # runs before it are out of reach of the words to come, or near
    for word in SENSITIVE.finditer(text):
        at = max(at, bisect_left(starts, word.start()))
        while at < len(runs) and starts[at] <= word.end() + CONTEXT:
            near.add(at)
            at += 1
    for a, b in _armored(text):
        near.update(range(bisect_left(starts, a), bisect_left(starts, b)))
    for i in range(1, len(runs)):
        if i - 1 in near and i not in near and GAP.fullmatch(text, runs[i - 1][1], starts[i]):
            near.add(i)
    return [runs[i] for i in sorted(near) if LETTER.search(text, *runs[i]) and DIGIT.search(text, *runs[i])]


def is_novel(text: str, a: int, b: int, min_novelty: float) -> bool:
    """Whether a run, or a slice of a long one, doesn't compress in its surroundings."""
    n = -(-(b - a) // SLICE)
    cuts = [a + (b - a) * k // n for k in range(n + 1)]
    return any(novelty(text[x:y], text[max(0, x - AROUND):x] + text[y:y + AROUND]) >= min_novelty
               for x, y in zip(cuts, cuts[1:], strict=False))


def novel_spans(text: str, known: list[tuple[int, int, int]], min_novelty: float) -> list[tuple[int, int, int]]:
    """(start, end, kind) of candidates in a sensitive context that don't compress."""
    starts = [x for x, _, _ in known]  # sorted
    reach = list(accumulate((y for _, y, _ in known), max))
    out = []
    for a, b in candidates(text):
        before = bisect_left(starts, b)  # base spans that begin before the candidate's end
        if before and reach[before - 1] > a or out and a < out[-1][1]:
            continue
        if is_novel(text, a, b, min_novelty):
            out.append((a, b, 3))
    return out


def spans(text: str, min_novelty: float = MIN_NOVELTY) -> tuple[list, list]:
    base = base_spans(text)
    return base, novel_spans(text, base, min_novelty)


def _said(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(found, key=lambda x: (x[0], x[2])))


def scan(docs: DataFrame, *, min_novelty: float = MIN_NOVELTY) -> DataFrame:
    """Per document: n_assign, n_access, n_hex, n_novel, base_sha256, spans (kind:start:end, by
    start, then kind as in KINDS)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks(b.column("text")):
                each = [spans(c.raw(i).decode(), min_novelty) for i in range(c.n)]
                n = [[sum(x[2] == k for x in (*base, *more)) for base, more in each] for k in range(4)]
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": b.column("doc_id").slice(c.first, c.n)}
                    | {f"n_{KINDS[k]}": pa.array(n[k], pa.int64()) for k in range(4)}
                    | {"base_sha256": pa.array([hashlib.sha256(_said(x).encode()).hexdigest() for x, _ in each]),
                       "spans": pa.array([_said(x + y) for x, y in each], pa.string())})

    return id_text(docs).mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, "
                                    "base_sha256 string, spans string")
