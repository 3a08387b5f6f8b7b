"""Words `[^\\x20\\x09-\\x0D]+` of UTF-8 texts and their hashes, vectorised over a chunk of texts."""

from __future__ import annotations

import numpy as np

from .tables import Chunk

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Base of the polynomial over word hashes: odd, so that powers stay invertible.
BASE = 0x9E3779B97F4A7C15
_LOW = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


class Words:
    """Word spans of a chunk: byte starts and ends, the text each belongs to, its place there."""

    def __init__(self, chunk: Chunk):
        size = int(chunk.offs[-1])
        self.chunk = chunk
        solid = ~IS_SPACE[chunk.buf[:size]]
        start, end = solid.copy(), solid.copy()
        if size:
            start[1:] &= ~solid[:-1]
            end[:-1] &= ~solid[1:]
            inner = chunk.offs[1:-1]
            inner = inner[(inner > 0) & (inner < size)]
            start[inner] = solid[inner]
            end[inner - 1] = solid[inner - 1]
        self.solid = solid
        self.starts = np.flatnonzero(start)
        self.ends = np.flatnonzero(end) + 1
        self.bounds = np.searchsorted(self.starts, chunk.offs)  # of each text in the word arrays
        self.counts = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(chunk.n), self.counts)
        self.place = np.arange(len(self.starts)) - np.repeat(self.bounds[:-1], self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64-bit hash of each word's bytes."""
        buf = self.chunk.buf
        at = np.ndarray(shape=(len(buf) - 7,), dtype="<u8", buffer=buf, strides=(1,))
        left = self.ends - self.starts
        h = mix(left.astype(np.uint64) + np.uint64((2 * seed + 1) * BASE % (1 << 64)))
        first = at[self.starts] & _LOW[np.minimum(left, 8)]
        h = mix(h ^ first)
        more = np.flatnonzero(left > 8)
        pos = 8
        while len(more):
            part = at[self.starts[more] + pos] & _LOW[np.minimum(left[more] - pos, 8)]
            h[more] = mix(h[more] * np.uint64(3) ^ part)
            pos += 8
            more = more[left[more] > pos]
        return h

    def window_places(self, n: int) -> np.ndarray:
        """Indices of words at which a window of n words of one text starts."""
        return np.flatnonzero(self.place + n <= np.repeat(self.counts, self.counts))


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of each n consecutive word hashes (len(h) - n + 1 of them), by doubling."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out, width = None, 0
    power, span = h, 1  # hashes of `span` words
    scale = BASE
    while True:
        if n & span:
            if out is None:
                out, width = power, span
            else:  # `width` words, then `span` more
                m = len(h) - width - span + 1
                out = out[:m] * np.uint64(scale) + power[width:width + m]
                width += span
        if width == n:
            return mix(out)
        m = len(h) - 2 * span + 1
        if m <= 0:
            m = 0
        power = power[:m] * np.uint64(scale) + power[span:span + m]
        scale = scale * scale % (1 << 64)
        span *= 2


def covered(n_words: int, starts: np.ndarray, n: int) -> np.ndarray:
    """Which of n_words words lie in a window of n words that starts at one of `starts`."""
    edge = np.zeros(n_words + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + n, -1)
    return np.cumsum(edge[:-1]) > 0
