"""Membership filters over 64-bit keys, sized by the number of keys."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: bits a key, and the most bits that a filter may have (128 MB)
BITS_PER_KEY = 16
MOST_BITS = 1 << 30


class Filter:
    """Keys that may be in a set; no key of the set is ever missed."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def __contains__(self, key: int) -> bool:
        return bool(self.holds(np.array([key], np.int64))[0])

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at = keys.view(np.int64) & (len(self.bits) * 8 - 1)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def size_for(keys: int) -> int:
    return 1 << max(16, (BITS_PER_KEY * max(1, keys) - 1).bit_length())


def filter_of(rows: DataFrame, column: str, keys: int | None = None, saturate: bool = False):
    """Broadcast ``Filter`` over a long column of stored rows, built by bitmap
    aggregates. Where the keys would need more than ``MOST_BITS``: None, and the
    caller joins with the rows instead; with ``saturate`` a filter of that size,
    which lets more keys through in error."""
    keys = rows.count() if keys is None else keys
    size = size_for(keys)
    if size > MOST_BITS and not saturate:
        return None
    size = min(size, MOST_BITS)
    bit = F.col(column).bitwiseAND(F.lit(size - 1)) + 1         # bitmap functions count from 1
    out = np.zeros(size // 8, np.uint8)
    for r in rows.groupBy(F.bitmap_bucket_number(bit).alias("k")) \
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).toLocalIterator():
        part = np.frombuffer(bytes(r.bits), np.uint8)[:len(out)]
        out[(r.k - 1) * 4096:r.k * 4096] = part
    return rows.sparkSession.sparkContext.broadcast(Filter(out))
