"""Bitmaps of hash values: a set of bounded size that may hold more than was put in, never less."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits per value when there is room, and the most bits: 2 ** 30 are 128 MB.
BITS_PER_VALUE = 16
FEWEST, MOST = 20, 30
#: Bytes that reach the driver at once: each such part is a job of its own.
AT_ONCE = 1 << 22
_PART = 1 << 15  # bits of one value of bitmap_construct_agg
_SHIFT = 17  # bits between the parts of a value that its probes look at


def collect_bitmap(
    df: DataFrame, column: str, most: int = MOST, probes: int = 1
) -> np.ndarray:
    """Some bits (`probes`) for each value of a long column of hash values, by parts of the value;
    merged on the executors.

    What reaches the driver has at most 2 ** `most` bits, whatever the number of rows. Nulls are
    left out. More probes, up to three, let fewer values through that were not put in.
    """
    rows = df.where(F.col(column).isNotNull())
    count = rows.count()
    wanted = count * BITS_PER_VALUE * (1 if probes == 1 else 2)
    bits = min(most, max(FEWEST, (wanted - 1).bit_length() if count else 0))
    looked = [F.shiftrightunsigned(F.col(column), _SHIFT * k) for k in range(probes)]
    rows = rows.select(F.explode(F.array(*looked)).alias("_part")) if probes > 1 else rows.select(F.col(column).alias("_part"))
    low = F.col("_part").bitwiseAND(F.lit((1 << bits) - 1))
    parts = rows.groupBy((F.shiftright(low, 15)).alias("part")).agg(
        F.bitmap_construct_agg(low.bitwiseAND(F.lit(_PART - 1))).alias("set")
    )
    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in parts.coalesce(1 + len(out) // AT_ONCE).toLocalIterator():
        at = row["part"] * (_PART // 8)
        out[at : at + _PART // 8] = np.frombuffer(row["set"], np.uint8)
    return out


def in_bitmap(bitmap: np.ndarray, values: np.ndarray, probes: int = 1) -> np.ndarray:
    """Whether each value (uint64) may be in the set."""
    left = None  # the places of the values that no probe has ruled out yet
    for k in range(probes):
        some = values if left is None else values[left]
        at = (some >> np.uint64(_SHIFT * k)) & np.uint64(len(bitmap) * 8 - 1)
        bits = bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)
        may = (bits & 1).astype(bool)
        left = np.flatnonzero(may) if left is None else left[may]
    out = np.zeros(len(values), bool)
    out[left] = True
    return out
