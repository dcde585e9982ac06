"""A bit map that tells tasks which hashes are wanted: of bounded size, wrong only in saying yes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a map at least and at most; at most 16 MB reach the driver and the tasks, however many numbers there are.
BITS = (16, 27)


def bit_filter(numbers: DataFrame, column: str, each: int = 8) -> tuple[np.ndarray, int]:
    """The map of 64-bit hashes by their first bits, about `each` bits a number up to the limit, put together by Spark.

    Of hashes that are not wanted it lets one in `each` through, more of them beyond the limit; joins drop those.
    """
    bits = min(BITS[1], max(BITS[0], int(each * numbers.count()).bit_length()))
    spot = F.call_function("shiftrightunsigned", F.col(column), F.lit(64 - bits))
    rows = numbers.select(spot.alias("b")).groupBy(F.call_function("shiftright", F.col("b"), F.lit(6)).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("b").cast("int").bitwiseAND(63))).alias("bits")
    ).toPandas()
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return words, bits


def in_filter(numbers: np.ndarray, words: np.ndarray, bits: int) -> np.ndarray:
    spot = numbers >> np.uint64(64 - bits)
    return (words[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
