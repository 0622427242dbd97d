"""Word shingles of whole texts as 64-bit hashes, computed on arrays of bytes.

Words are runs of bytes other than ASCII white space, with A-Z lower-cased. A word's hash is
a polynomial in its bytes; since all words of a chunk come from one running sum, no text is
taken apart into strings. A shingle's hash mixes the hashes of its words in their order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SEED = np.random.default_rng(20240229)
_BYTES = _SEED.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTES[ord("A") : ord("Z") + 1] = _BYTES[ord("a") : ord("z") + 1]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_PLACES = _SEED.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_ABSENT = _SEED.integers(1, 1 << 63, 64, dtype=np.uint64)
#: Bytes hashed at once; a longer word is taken whole.
CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: a bijection, so it makes no equal values of different ones."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, number: int) -> np.ndarray:
    out = np.full(number, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS = _powers(_BASE, CHUNK + 1)
_INVERSES = _powers(pow(_BASE, -1, 1 << 64), CHUNK + 1)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large_string array and where each text starts and ends."""
    _, bounds, data = texts.buffers()
    ends = np.frombuffer(bounds, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(ends):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def word_bounds(
    data: np.ndarray, bounds: np.ndarray, between: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end: at bytes marked in ``between``, and at text bounds."""
    space = between[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    first = ~space
    first[1:] &= space[:-1] | edge[1:-1]
    last = ~space
    last[:-1] &= space[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each of the words, which are in order and don't overlap."""
    hashes = np.empty(len(starts), dtype=np.uint64)
    a = 0
    while a < len(starts):
        # Words that end within a chunk from this one's start.
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + CHUNK, side="right")))
        own = data[starts[a] : ends[b - 1]]
        many = len(own) > CHUNK
        up = _powers(_BASE, len(own) + 1) if many else _POWERS
        down = _powers(pow(_BASE, -1, 1 << 64), len(own) + 1) if many else _INVERSES
        sums = np.zeros(len(own) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[own] * up[: len(own)], out=sums[1:])
        s, e = starts[a:b] - starts[a], ends[a:b] - starts[a]
        hashes[a:b] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        a = b
    return hashes


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    A text of fewer words has its whole sequence as its one shingle; without words, none.
    """
    data, bounds = buffers(texts)
    starts, ends = word_bounds(data, bounds)
    words = word_hashes(data, starts, ends)
    first = np.searchsorted(starts, bounds[:-1])
    last = np.searchsorted(starts, bounds[1:])
    padded = np.concatenate([words, np.zeros(size, dtype=np.uint64)])
    sums = np.zeros(len(words), dtype=np.uint64)
    for j in range(size):
        sums += padded[j : j + len(words)] * _PLACES[j]
    hashes = mix(sums)
    sets = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if b - a >= size:
            sets.append(np.unique(hashes[a : b - size + 1]))
        elif b > a:
            parts = np.concatenate([words[a:b] * _PLACES[: b - a], _ABSENT[b - a : size]])
            sets.append(mix(parts.sum(dtype=np.uint64, keepdims=True)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets
