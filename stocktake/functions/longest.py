"""Which of many texts are beginnings of a row's text, by binary search over their lengths.

The beginnings a text may match have a few hundred different lengths at most, or a few depths of a path. A row asks for one beginning
of itself at a time, of the middle length first: if the index knows it, as one of the texts or as the way to a longer one, it goes
on with longer ones, else with shorter ones. So a row is looked up log2(lengths) times and stays one row, instead of becoming
one for each length. Every entry of the index also tells the longest text that it begins with, which the row keeps. All
other matches are beginnings of the longest one, so they are looked up for the texts, not for the rows.

Where the index is small it is broadcast and no row is shuffled; otherwise each look-up is a join in which only heavy keys are salted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from stocktake.functions.skew import BROADCAST_BYTES, BROADCAST_ROWS, apart, measured, owner_join

#: A beginning of a text at a level (a number of characters, a depth), null if the text has no such level.
Beginning = Callable[[Column, Column], Column]


def first_characters(text: Column, level: Column) -> Column:
    return F.when(F.length(text) >= level, F.substr(text, F.lit(1), level))


def first_elements(path: Column, level: Column) -> Column:
    """Path elements that end just before a slash."""
    slashes = F.length(path) - F.length(F.translate(path, "/", ""))
    return F.when(slashes >= level, F.call_function("substring_index", path, F.lit("/"), level))


def way_to(index: int, size: int) -> list[int]:
    """Places among `size` sorted lengths that a search for place ``index`` asks for and goes beyond."""
    low, high, passed = 0, size - 1, []
    while low <= high:
        middle = (low + high) // 2
        if middle == index:
            return passed
        if middle < index:
            passed.append(middle)
            low = middle + 1
        else:
            high = middle - 1
    raise ValueError(f"{index} is not among {size} places")


@dataclass
class PrefixIndex:
    """``entries`` (key, longest): what a search may ask for. ``chain`` (longest, text): each text that begins a text."""

    entries: DataFrame
    chain: DataFrame
    levels: list[int]
    beginning: Beginning
    small: bool

    def longest(self, rows: DataFrame, text: str, into: str = "longest") -> DataFrame:
        """The rows with the longest indexed text that begins their text, or null."""
        levels = F.array(*[F.lit(n) for n in self.levels])
        low, high, rounds = F.lit(0), F.lit(len(self.levels) - 1), len(self.levels).bit_length()
        kept = rows.columns
        found = rows.withColumns({"_low": low, "_high": high, "_best": F.lit(None).cast("string")})
        middle = F.floor((F.col("_low") + F.col("_high")) / 2).cast("int")
        entries = self.entries.select(F.col("key").alias("_key"), F.col("longest").alias("_longest"), F.lit(True).alias("_known"))
        for _ in range(rounds if self.levels else 0):
            asked = F.when(F.col("_low") <= F.col("_high"), self.beginning(F.col(f"`{text}`"), F.get(levels, middle)))
            asking = found.withColumn("_key", asked)
            if self.small:
                met = asking.join(F.broadcast(entries), "_key", "left")
            else:
                met = owner_join(asking, entries.hint("merge"), ["_key"], "left")
            known = F.col("_known").isNotNull()
            found = met.select(
                *kept, F.when(known, middle + 1).otherwise(F.col("_low")).alias("_low"),
                F.when(known, F.col("_high")).otherwise(middle - 1).alias("_high"),
                F.coalesce("_longest", "_best").alias("_best"),
            )
        return found.select(*kept, F.col("_best").alias(into))


def prefix_index(
    texts: DataFrame, column: str, beginning: Beginning, level: Callable[[Column], Column], levels: Sequence[int] | None = None,
    broadcast_rows: int = BROADCAST_ROWS, broadcast_bytes: int = BROADCAST_BYTES,
) -> PrefixIndex:
    """Index of the distinct texts of a column; ``level`` tells the level of a text that ``beginning`` gives back as a whole.

    The index has one entry for each text and for each step on the way to it.
    """
    names = texts.where(F.col(f"`{column}`").isNotNull()).select(F.col(f"`{column}`").alias("text")).distinct()
    if levels is None:
        # As many numbers as there are lengths.
        levels = sorted(r[0] for r in names.select(level(F.col("text"))).distinct().collect())
    levels = [int(n) for n in levels]
    # A text is found at its own level only.
    own = F.array_position(F.array(*[F.lit(n) for n in levels]) if levels else F.array().cast("array<int>"), level(F.col("text")).cast("int")).cast("int")
    ways = [F.array(*[F.lit(levels[k]) for k in way_to(i, len(levels))]).cast("array<int>") for i in range(len(levels))]
    on_the_way = F.element_at(F.array(*ways), own) if ways else F.array().cast("array<int>")
    steps = names.where(own > 0).select(F.explode(on_the_way).alias("level"), "text").select(beginning(F.col("text"), F.col("level")).alias("key"))
    keys = steps.unionByName(names.where(own > 0).select(F.col("text").alias("key"))).distinct()
    # Beginnings of each key at all levels; those that are texts themselves are its chain.
    every = F.transform(F.array(*[F.lit(n) for n in levels]) if levels else F.array().cast("array<int>"), lambda n: beginning(F.col("key"), n))
    # A key is its own beginning, whether or not the function counts it (a path's last element has no slash behind it).
    begins = keys.select("key", F.explode(F.array_distinct(F.array_append(F.array_compact(every), F.col("key")))).alias("text"))
    chain = begins.join(apart(names), "text", "left_semi")
    best = chain.groupBy("key").agg(F.max_by("text", F.length("text")).alias("longest"))
    entries = keys.join(apart(best), "key", "left")
    rows, size = measured(entries, broadcast_rows)
    small = rows <= broadcast_rows and size <= broadcast_bytes
    own_chain = chain.join(apart(names.select(F.col("text").alias("key"))), "key", "left_semi").select(F.col("key").alias("longest"), "text")
    return PrefixIndex(entries, own_chain, levels, beginning, small)
