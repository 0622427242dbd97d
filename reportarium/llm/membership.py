"""A bitmap of fixed size that tells which hashes cannot be in a table.

It is built by Spark, bounded in size whatever the table holds, and small enough to send to
every task. It may take absent hashes for present ones, the more so the fuller it is, never the
other way round: whoever asks it must confirm what it lets through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2 ** MOST_BITS bits at most: 8 MB to each task, 16 MB to the driver.
LEAST_BITS, MOST_BITS = 16, 26


class Bitmap:
    """Two bits per 64-bit hash: one by its upper, one by its lower end."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def _test(self, slot: np.ndarray) -> np.ndarray:
        return (self.words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        upper = self._test(hashes >> np.uint64(64 - self.bits))
        return upper & self._test(hashes & np.uint64((1 << self.bits) - 1))


def bitmap(hashes: DataFrame, column: str, number: int) -> Bitmap:
    """The bitmap of a column of 64-bit hashes, of which there are about ``number``."""
    bits = min(max((16 * max(number, 1)).bit_length(), LEAST_BITS), MOST_BITS)
    upper = F.shiftrightunsigned(column, 64 - bits)
    lower = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    slots = hashes.select(F.explode(F.array(upper, lower)).alias("slot"))
    parts = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS INT)))").alias("set")
    )
    found: pa.Table = parts.toArrow()  # at most 2 ** (bits - 6) rows
    words = np.zeros(1 << (bits - 6), dtype=np.uint64)
    words[found.column("word").to_numpy()] = found.column("set").to_numpy().view(np.uint64)
    return Bitmap(words, bits)
