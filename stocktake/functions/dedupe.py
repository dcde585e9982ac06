"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stocktake.model import CONTENT


def newest_first(prefix_columns: Sequence[str] = CONTENT) -> list[Column]:
    """Total order for listings: newest copy first, then by content."""
    return [F.col("last_modified").desc_nulls_last()] + [F.col(c).asc() for c in prefix_columns]


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key under ``order``.

    The ``= 1`` filter lets Spark keep only the first row per key in every map
    task, before the shuffle, so a key with very many copies stays cheap.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")
