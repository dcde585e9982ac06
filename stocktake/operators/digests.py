"""Reconcile two large listings that mostly agree, by digests of ranges of their keys.

Every file has a place, the hash of its key; a range is what shares the first bits of it. The digest of a range adds up a hash of each
file's key and content, so the order of rows does not matter, and every task reduces its rows to digests before anything is shuffled. Where both
sides have the same digest, they hold the same files with the same content. Ranges that differ are split again, by one more scan of their rows, until
few rows are left; these alone are joined.

Both sides must have one row for each key, as ``dedupe_first`` gives. A file with a null in its key or content is never consistent, so its
range always differs. Two different sets of files have the same digest with a probability of about 2^-96.

Digests can be kept. What did not change on either side since they were written keeps the result of that time (``reconcile_again``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stocktake import model as m
from stocktake.functions.numbers import total
from stocktake.functions.skew import BROADCAST_ROWS
from stocktake.operators.reconcile import reconcile, summarize
from stocktake.plans.stages import drop, stage

# Bits of a place that number the ranges of each level. The first level is at most 2^14 ranges of a task's rows.
LEVELS = (14, 22, 30, 38, 46)
# Rows of differing ranges, on both sides together, that are joined without splitting their ranges again.
FEW_ROWS = 2_000_000
# Ranges with no more rows than this on average are not split again either.
FEW_IN_RANGE = 8
DIGEST = ("rows", "low", "high", "other")
RANGE = "_range"


def _place(on: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in on])


def range_of(on: Sequence[str], bits: int) -> Column:
    """The range of a file's key among 2^bits."""
    return F.call_function("shiftrightunsigned", _place(on), F.lit(64 - bits))


def digests(
    listing: DataFrame, on: Sequence[str], bits: int, side: str, by: Sequence[str] = (),
    values: Sequence[str] = m.CONTENT, null_differs: bool = True, as_text: bool = False,
) -> DataFrame:
    """One row for each range and value of ``by``: rows, sums of hashes, bytes.

    With ``null_differs`` a file with a null among key and ``values`` counts as one that only this side can have. ``as_text``
    compares values by their text, for sides whose columns differ in type.
    """
    names = [*on, *values]
    # Nulls leave a hash as it is, so each value's being null is hashed along.
    known = [F.col(f"`{c}`").isNull() for c in names]
    hashed = [F.col(f"`{c}`").cast("string") if as_text else F.col(f"`{c}`") for c in names]
    mark = F.when(reduce(lambda a, b: a | b, known), F.lit(side)).otherwise(F.lit("")) if null_differs else F.lit("")
    own, other = F.xxhash64(*hashed, *known, mark), F.hash(F.lit(7), mark, *known, *reversed(hashed))
    rows = listing.select(
        *by, range_of(on, bits).alias(RANGE), own.alias("_own"), other.cast("long").alias("_other"),
        (F.col("content_length") if "content_length" in listing.columns else F.lit(0)).cast("long").alias("_bytes"),
    )
    return rows.groupBy(*by, RANGE).agg(
        F.count(F.lit(1)).alias("rows"),
        # Halves of the hash, so that no sum overflows below 2^31 rows in a range.
        F.sum(F.col("_own").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.sum(F.call_function("shiftrightunsigned", F.col("_own"), F.lit(32))).alias("high"),
        F.sum("_other").alias("other"),
        total(F.col("_bytes")).alias("bytes"),
    )


def compared(left: DataFrame, right: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Ranges of both sides with ``same``: whether their digests agree."""
    keys = [*by, RANGE]
    sides = [
        df.select(*keys, *[F.col(c).alias(f"{c}_{side}") for c in (*DIGEST, "bytes")])
        for side, df in (("left", left), ("right", right))
    ]
    joined = sides[0].join(
        sides[1], reduce(lambda a, b: a & b, (sides[0][k].eqNullSafe(sides[1][k]) for k in keys)), "full_outer"
    )
    same = reduce(lambda a, b: a & b, (F.col(f"{c}_left") == F.col(f"{c}_right") for c in DIGEST))
    return joined.select(
        *[F.coalesce(sides[0][k], sides[1][k]).alias(k) for k in keys],
        *[F.coalesce(F.col(f"{c}_{s}"), F.lit(0)).alias(f"{c}_{s}") for s in ("left", "right") for c in ("rows", "bytes")],
        F.coalesce(same, F.lit(False)).alias("same"),
    )


def in_ranges(listing: DataFrame, ranges: DataFrame, on: Sequence[str], bits: int) -> DataFrame:
    """Rows of the listing in these ranges, at most BROADCAST_ROWS numbers, which every task gets."""
    wanted = ranges.select(F.col(RANGE).alias("_wanted")).distinct()
    return listing.join(F.broadcast(wanted), range_of(on, bits) == F.col("_wanted"), "left_semi")


def _types_differ(catalog: DataFrame, inventory: DataFrame, names: Sequence[str]) -> bool:
    return any(catalog.schema[c].dataType != inventory.schema[c].dataType for c in names)


@dataclass
class Differences:
    """What is left of two listings after ranges that agree are left out."""

    catalog: DataFrame
    inventory: DataFrame
    #: Ranges of the first level: rows and bytes of both sides, for each value of ``by``.
    ranges: DataFrame
    #: Level by level: bits of the place, ranges that differ, rows in them.
    steps: list[tuple[int, int, int]]
    #: Tables in the shared folder that the listings above read.
    paths: list[str]


def differences(
    catalog: DataFrame, inventory: DataFrame, on: Sequence[str] = ("uri",), by: Sequence[str] = (),
    levels: Sequence[int] = LEVELS, few_rows: int = FEW_ROWS, most_ranges: int = BROADCAST_ROWS,
) -> Differences:
    """Both listings without ranges on which they agree.

    The digests of each level are a table in the shared folder: one row for each range that its parent's difference leaves open. The
    listings are scanned once for each level and should be stored ones. Keys must have one type on both sides.
    """
    on, steps, paths, first = list(on), [], [], None
    as_text = _types_differ(catalog, inventory, m.CONTENT)
    left, right = catalog, inventory
    for bits in levels:
        of = {s: digests(df, on, bits, s, by, as_text=as_text) for s, df in (("catalog", left), ("inventory", right))}
        found, path = stage(compared(*of.values(), by), f"digests-{bits}")
        paths.append(path)
        first = found if first is None else first
        open_ = found.where("NOT same")
        size = open_.agg(
            F.count_distinct(RANGE).alias("ranges"), F.coalesce(F.sum(F.col("rows_left") + F.col("rows_right")), F.lit(0)).alias("rows")
        ).first()
        if steps and size["ranges"] > most_ranges:
            break  # the ranges of the level above are few enough for every task
        steps.append((bits, size["ranges"], size["rows"]))
        left, right = (in_ranges(side, open_, on, bits) for side in (catalog, inventory))
        if size["rows"] <= few_rows or size["rows"] <= FEW_IN_RANGE * size["ranges"]:
            break
    return Differences(left, right, first, steps, paths)


def _changed_pairs(found: Differences, on: Sequence[str]) -> DataFrame:
    return reconcile(found.catalog, found.inventory, on).where(F.col("category") != m.CONSISTENT)


def reconcile_changes(
    catalog: DataFrame, inventory: DataFrame, on: Sequence[str] = ("uri",), **options
) -> DataFrame:
    """All of ``reconcile`` but the consistent files; rows are shuffled in ranges with differences only."""
    return _changed_pairs(differences(catalog, inventory, on, **options), on)


def reconcile_changes_summary(
    catalog: DataFrame, inventory: DataFrame, on: Sequence[str] = ("uri",), by: Sequence[str] = (), **options
) -> DataFrame:
    """The same as ``reconcile_summary``: sides are counted from the digests, consistent files are those of the catalog that differ in nothing."""
    found = differences(catalog, inventory, on, by, **options)
    pairs = _changed_pairs(found, on)
    counts = {c: f"num_{c.lower()}" for c in m.RECONCILE_CATEGORIES}
    sides = {"num_catalog": "rows_left", "catalog_bytes": "bytes_left", "num_inventory": "rows_right", "inventory_bytes": "bytes_right"}
    zero = F.lit(0).cast("long")
    of_ranges = found.ranges.groupBy(*by).agg(*[total(F.col(c)).alias(n) for n, c in sides.items()])
    of_pairs = pairs.groupBy(*by).agg(*[F.count_if(F.col("category") == c).alias(n) for c, n in counts.items()])
    parts = of_ranges.withColumns({n: zero for n in counts.values()}).unionByName(of_pairs.withColumns({n: zero for n in sides}))
    summed = parts.groupBy(*by).agg(*[total(F.col(c)).alias(c) for c in (*sides, *counts.values())])
    others = reduce(lambda a, b: a + b, (F.col(n) for c, n in counts.items() if c not in (m.CONSISTENT, m.MISSING_IN_CATALOG)))
    return summed.withColumn(counts[m.CONSISTENT], F.col("num_catalog") - others)


def summarize_changes(
    catalog: DataFrame, inventory: DataFrame, changes: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """``reconcile.summarize`` from ``reconcile_changes``: what the catalog has beside them is consistent."""
    counted = summarize(catalog, inventory, changes, by)
    others = [f"num_{c.lower()}" for c in m.RECONCILE_CATEGORIES if c not in (m.CONSISTENT, m.MISSING_IN_CATALOG)]
    rest = F.col("num_catalog") - reduce(lambda a, b: a + b, map(F.col, others))
    return counted.withColumn(f"num_{m.CONSISTENT.lower()}", rest)


# --- the same audit, day after day --------------------------------------------------------------

KEPT_BITS = 22


def _kept_digests(catalog: DataFrame, inventory: DataFrame, on: Sequence[str], bits: int) -> dict[str, DataFrame]:
    """Digests of all that the report shows, times included."""
    values = (*m.CONTENT, "last_modified")
    context = [c for c in ("collection",) if c in catalog.columns and c not in on]
    return {
        "catalog": digests(catalog, on, bits, "catalog", values=(*values, *context), null_differs=False),
        "inventory": digests(inventory, on, bits, "inventory", values=values, null_differs=False),
    }


def reconcile_again(
    catalog: DataFrame, inventory: DataFrame, state: str, previous: str | None = None,
    on: Sequence[str] = ("uri",), bits: int = KEPT_BITS, most_ranges: int = BROADCAST_ROWS,
) -> DataFrame:
    """``reconcile_changes`` that keeps its result and digests in the new folder ``state`` and takes over what it can from
    the folder ``previous`` of an earlier run with the same ``on`` and ``bits``.

    Rows of ranges that changed on either side since then are reconciled anew, all
    others are those of the earlier result. If more than ``most_ranges`` ranges changed, everything is done anew.
    """
    spark, on, paths, pairs = catalog.sparkSession, list(on), [], None
    for side, df in _kept_digests(catalog, inventory, on, bits).items():
        df.write.parquet(f"{state}/{side}")
    read = lambda folder, name: spark.read.parquet(f"{folder}/{name}")
    if previous is not None:
        moved = [compared(read(previous, s), read(state, s)).where("NOT same").select(RANGE) for s in ("catalog", "inventory")]
        moved, path = stage(moved[0].union(moved[1]).distinct(), "changed-ranges")
        paths.append(path)
        if moved.limit(most_ranges + 1).count() <= most_ranges:
            found = differences(*(in_ranges(side, moved, on, bits) for side in (catalog, inventory)), on)
            still = read(previous, "pairs").join(F.broadcast(moved), RANGE, "left_anti")
            pairs = still.unionByName(_changed_pairs(found, on).withColumn(RANGE, range_of(on, bits)))
    if pairs is None:
        found = differences(catalog, inventory, on)
        pairs = _changed_pairs(found, on).withColumn(RANGE, range_of(on, bits))
    pairs.write.parquet(f"{state}/pairs")
    for path in (*paths, *found.paths):
        drop(spark, path)
    return read(state, "pairs").drop(RANGE)
