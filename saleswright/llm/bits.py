"""Bitmaps of fixed size over 64-bit hashes: what they lack is not in the set; what they have may be."""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MIX = 0x9E3779B97F4A7C15


class Bitmap:
    """A broadcast bitmap; ``has`` runs in tasks."""

    def __init__(self, shared: Broadcast, n_bits: int):
        self.shared, self.n_bits = shared, n_bits

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """Which of the 64-bit ``hashes`` may be in the set."""
        table = np.frombuffer(self.shared.value, np.uint64)
        place = hashes.view(np.uint64) & np.uint64(self.n_bits - 1)
        return (table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def bitmap(hashes: DataFrame, column: str, n_bits: int) -> Bitmap:
    """The bitmap of a 64-bit ``column``. ``n_bits`` is a power of two; n_bits / 64 rows at most reach the driver."""
    place = F.col(column).bitwiseAND(F.lit(n_bits - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))
    words = hashes.select(F.shiftright(place, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    table = np.zeros(n_bits // 64, np.int64)
    for part in words.toArrow().to_batches():
        table[part.column(0).to_numpy()] = part.column(1).to_numpy()
    return Bitmap(hashes.sparkSession.sparkContext.broadcast(table.tobytes()), n_bits)
