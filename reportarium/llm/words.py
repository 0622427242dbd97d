"""Words of whole texts as Arrow strings, cut out of the bytes of all texts of a batch at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from reportarium.llm.shingles import buffers, word_bounds

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def marked(*ranges: int | tuple[int, int]) -> np.ndarray:
    """A table of 256 flags: which bytes stand between words."""
    table = np.zeros(256, dtype=bool)
    for r in ranges:
        first, last = r if isinstance(r, tuple) else (r, r)
        table[first : last + 1] = True
    return table


def cut(
    texts: pa.Array, between: np.ndarray, breaks: np.ndarray | None = None
) -> tuple[pa.LargeStringArray, np.ndarray, np.ndarray]:
    """Words (A-Z lower-cased), where each text's words start, and which words start a piece.

    Words are runs of bytes not marked in ``between``; a piece ends at bytes marked in
    ``breaks``, which are also marked in ``between``, and at the end of a text.
    """
    data, bounds = buffers(texts)
    starts, ends = word_bounds(data, bounds, between)
    offsets = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    letters = _LOWER[data[~between[data]]]
    words = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(offsets), pa.py_buffer(letters)
    )
    first = np.searchsorted(starts, bounds)
    fresh = np.zeros(len(starts), dtype=bool)
    fresh[first[first < len(starts)]] = True
    if breaks is not None:
        seen = np.zeros(len(data) + 1, dtype=np.int32)
        np.cumsum(breaks[data], out=seen[1:])
        fresh[1:] |= seen[starts[1:]] != seen[starts[:-1]]
    return words, first, fresh
