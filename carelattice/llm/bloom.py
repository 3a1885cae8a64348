"""A bitmap of hashes of fixed size, to leave rows out of a shuffle early. It only saves work: rows
that pass it by chance are sorted out by the join that follows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from carelattice.llm.frames import fetched

BITS = 26


def bitmap(df: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """2**bits bits (8 MB by default); Spark ors the words, so the driver gets at most 2**bits / 64 rows."""
    slot = F.col(column).bitwiseAND(F.lit(2**bits - 1))
    words = fetched(df.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("b")))
    out = np.zeros(2**bits // 64, np.uint64)
    out[words["w"].to_numpy()] = words["b"].to_numpy().view(np.uint64)
    return out


def marked(bits: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Which of the hashes (uint64) have their bit set."""
    slot = hashed & np.uint64(len(bits) * 64 - 1)
    return ((bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)
