"""One-hot product-type columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from stocktake.model import JUNK, PRODUCT_TYPES, flag_name


def type_flags(column="product_type", vocabulary: Sequence[str] = PRODUCT_TYPES) -> list[Column]:
    """One column per type: 1 where the row has it, else null."""
    return [F.when(F.col(column) == t, F.lit(1)).alias(flag_name(t)) for t in vocabulary]


def type_presence(column="product_type", vocabulary: Sequence[str] = PRODUCT_TYPES) -> list[Column]:
    """Aggregates: 1 if any row of the group has the type, else null."""
    return [F.max(F.when(F.col(column) == t, F.lit(1))).alias(flag_name(t)) for t in vocabulary]


#: Types that one number of a packed set holds, and the name of the k-th number.
BITS, PACKED = 62, "_types_{}"


def _chunks(vocabulary: Sequence[str]) -> list[Sequence[str]]:
    return [vocabulary[k : k + BITS] for k in range(0, len(vocabulary), BITS)]


def packed_presence(column="product_type", vocabulary: Sequence[str] = PRODUCT_TYPES) -> list[Column]:
    """Aggregates: the types that any row of the group has, one bit each."""
    return [
        F.bit_or(
            reduce(lambda found, k: found.when(F.col(column) == part[k], F.lit(1 << k)), range(1, len(part)), F.when(F.col(column) == part[0], F.lit(1)))
            .otherwise(F.lit(0)).cast("long")
        ).alias(PACKED.format(n))
        for n, part in enumerate(_chunks(vocabulary))
    ]


def packed_flags(vocabulary: Sequence[str] = PRODUCT_TYPES) -> list[Column]:
    """1/null columns as the numbers of ``packed_presence``."""
    bit = lambda t, k: F.when(F.col(flag_name(t)).isNotNull(), F.lit(1 << k)).otherwise(F.lit(0)).cast("long")
    return [
        reduce(Column.bitwiseOR, [bit(t, k) for k, t in enumerate(part)]).alias(PACKED.format(n))
        for n, part in enumerate(_chunks(vocabulary))
    ]


def unpacked_flags(vocabulary: Sequence[str] = PRODUCT_TYPES) -> list[Column]:
    """The numbers of ``packed_presence`` as 1/null columns, one for each type."""
    return [
        F.when(F.col(PACKED.format(n)).bitwiseAND(F.lit(1 << k).cast("long")) != 0, F.lit(1)).alias(flag_name(t))
        for n, part in enumerate(_chunks(vocabulary)) for k, t in enumerate(part)
    ]


def packed_names(vocabulary: Sequence[str] = PRODUCT_TYPES) -> list[str]:
    return [PACKED.format(n) for n, _ in enumerate(_chunks(vocabulary))]


def type_counts(column="product_type", vocabulary: Sequence[str] = PRODUCT_TYPES) -> list[Column]:
    """Aggregates: rows of the group per type, 0 where there is none."""
    return [F.count(F.when(F.col(column) == t, F.lit(1))).alias(flag_name(t)) for t in vocabulary]


def non_junk(column="quality_flag") -> Column:
    """Not flagged as junk; an absent flag counts as good."""
    return F.col(column).isNull() | (F.col(column) != JUNK)
