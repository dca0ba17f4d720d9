"""Vectorised hashes of words and word windows (numpy, inside Spark tasks).

Words are the maximal runs of bytes other than white space (space, tab, line
feed, vertical tab, form feed, carriage return) of a text in UTF-8.  A word's
hash is a random linear function of its bytes, a window's hash a polynomial
of its words' hashes, both modulo 2**64 and then mixed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

U = np.uint64
_GOLDEN = 0x9E3779B97F4A7C15
_WINDOW = U(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """The SplitMix64 finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U) * U(_GOLDEN)) + U(seed))


_POSITIONS = {}


def _weights(n: int, seed: int) -> np.ndarray:
    have = _POSITIONS.get(seed)
    if have is None or len(have) < n:
        have = _POSITIONS[seed] = stream(max(1024, 1 << (n - 1).bit_length()), seed) | U(1)
    return have


@dataclass
class Words:
    """The words of a batch of texts, in order: ``hashes``, and ``first``,
    where each text's words begin (one more entry than texts)."""

    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray     # byte positions in ``data``
    ends: np.ndarray
    data: bytes


def words_of(texts: list[bytes], seed: int = 1) -> Words:
    data = b"\n".join(texts) + b"\n"
    raw = np.frombuffer(data, np.uint8)
    word = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.flatnonzero(np.diff(word.astype(np.int8), prepend=np.int8(0)))
    starts, ends = edge[0::2], edge[1::2]
    begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    first = np.searchsorted(starts, begin)
    if not len(starts):
        return Words(np.empty(0, U), first, starts, ends, data)
    size = ends - starts
    at = np.flatnonzero(word)
    within = at - np.repeat(starts, size)
    with np.errstate(over="ignore"):
        part = (raw[at].astype(U) + U(1)) * _weights(int(size.max()), seed)[within]
        offsets = np.cumsum(size) - size
        hashes = mix(np.add.reduceat(part, offsets) + size.astype(U) * U(_GOLDEN))
    return Words(hashes, first, starts, ends, data)


def windows(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of ``k`` consecutive entries (across texts, too)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, U)
    with np.errstate(over="ignore"):
        out = hashes[:n] + U(seed)
        for j in range(1, k):
            out = out * _WINDOW + hashes[j:j + n]
        return mix(out + U(seed))


def grams(words: Words, i: int, k: int) -> np.ndarray:
    """The word ``k``-grams of text ``i`` with repeats; a shorter text that
    has words is one gram."""
    part = words.hashes[words.first[i]:words.first[i + 1]]
    if not len(part):
        return np.empty(0, U)
    return windows(part, min(k, len(part)), seed=min(k, len(part)))
