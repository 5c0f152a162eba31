"""Bloom filters of fixed size: a broadcast whose bound does not depend on the data."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a filter: the bound of what is broadcast (8 MB), whatever the number of keys.
FILTER_BITS = 1 << 26


def filter_of(hashes: DataFrame) -> np.ndarray:
    """Filter over a column ``hash`` of 64-bit hashes; partial filters are merged in the tasks.

    Each hash sets two bits; the words of 64 bits that are not zero are or-ed by position, so the driver gets at
    most the filter's own size.
    """
    at = F.explode(F.array(*[F.shiftrightunsigned("hash", s).bitwiseAND(FILTER_BITS - 1) for s in (0, 32)]))
    words = (hashes.select(at.alias("at"))
             .groupBy(F.shiftrightunsigned("at", 6).alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("bits"))
             .toArrow())
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint8)


def probe(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each hash (unsigned)."""
    size = np.uint64(len(bits) * 8 - 1)
    found = np.ones(len(hashes), bool)
    for shift in (0, 32):
        at = (hashes >> np.uint64(shift)) & size
        found &= (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found
