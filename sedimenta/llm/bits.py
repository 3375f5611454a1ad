"""A set of 64-bit numbers as a bitmap of fixed size: what is in the set is always found in it."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 23  # 2^23 bits, one MiB
MOST_BITS = 28  # 32 MiB


def bits_for(keys: int) -> int:
    """The size of a bitmap with 16 bits or more for each of so many keys, as a power of two, up to 32 MiB."""
    return min(MOST_BITS, max(15, (16 * max(1, keys) - 1).bit_length()))


def bitmap(rows: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """The bitmap of a long column, built by grouped aggregation: at most 2^(bits - 15) rows of 4 KiB reach the driver."""
    place = F.shiftrightunsigned(F.col(column), 64 - bits)
    parts = (
        rows.select(place.alias("p"))
        .groupBy(F.floor(F.col("p") / 32768).cast("long").alias("part"))
        .agg(F.bitmap_construct_agg(F.pmod(F.col("p"), F.lit(32768))).alias("bitmap"))
    )
    out = np.zeros(1 << bits - 3, np.uint8)
    for row in parts.collect():
        out[row.part * 4096 : (row.part + 1) * 4096] = np.frombuffer(row.bitmap, np.uint8)
    return out


def maybe(bitmap_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys (int64) may be in the set."""
    bits = len(bitmap_).bit_length() + 2
    place = keys.astype(np.int64).view(np.uint64) >> np.uint64(64 - bits)
    return bitmap_[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1 == 1
