"""Connected components of links that are too many for one machine: large-star and small-star steps as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.llm.common import staged


def _star(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step: every larger neighbour, then every smaller one, moves to its centre's minimum."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.where(F.col("u") != F.col("v")).distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least)
    return small.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """links (a, b), a != b -> (id, component): the smallest id of the component, for every id that is in a link and is not the
    smallest itself. Each round is staged; the number of rounds is logarithmic in the length of the longest chain, squared at worst.
    """
    seen, current = None, staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while True:
        print_of = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if print_of == seen or not print_of[0]:
            return current.select(F.col("a").alias("id"), F.col("b").alias("component"))
        seen, current = print_of, staged(_star(current), name)
