"""A fixed-size membership filter that tasks can hold: built by an aggregate, bounded whatever it is built from."""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2^26 bits: 8 MB. With more hashes than that the filter lets more through and nothing else changes.
MOST_BITS = 26
LEAST_BITS = 12


def build_filter(hashes: DataFrame, column: str = "h", most_bits: int = MOST_BITS) -> tuple[Broadcast, int]:
    """The filter's 64-bit words as a broadcast of at most 2^most_bits bits, and the number of distinct hashes.

    Two bits for a hash, taken from its lower and its upper half; about 16 bits are given to each.
    """
    distinct = hashes.select(F.col(column).alias("h")).distinct()
    n = distinct.count()
    bits = min(most_bits, max(LEAST_BITS, (16 * max(n, 1) - 1).bit_length()))
    mask = (1 << bits) - 1
    at = F.explode(
        F.array(F.col("h").bitwiseAND(F.lit(mask)), F.shiftrightunsigned(F.col("h"), 32).bitwiseAND(F.lit(mask)))
    )
    placed = distinct.select(at.alias("at")).select(
        F.shiftright("at", 6).alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63)).cast("int")).alias("bit"),
    )
    rows = placed.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    words = np.zeros(1 << (bits - 6), np.int64)
    found = rows.toArrow()  # one row per word of the filter at most
    words[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return hashes.sparkSession.sparkContext.broadcast(words.view(np.uint64)), n


def may_hold(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For unsigned 64-bit hashes, False where the filter was surely not built from it."""
    mask = np.uint64(len(words) * 64 - 1)
    out = np.ones(len(hashes), bool)
    for at in (hashes & mask, (hashes >> np.uint64(32)) & mask):
        out &= (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out
