"""URIs described more than once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stocktake.functions.flags import type_counts, type_flags
from stocktake.functions.numbers import total
from stocktake.functions.prefixes import PLACE, few_depths, match_namespaces, match_namespaces_by_depth
from stocktake.functions.skew import BROADCAST_ROWS, SALT, lookup_join, owner_join
from stocktake.model import PRODUCT_TYPES, flag_name
from stocktake.plans.stages import drop, stage, stage_large


def product_type_flags(
    artifact: DataFrame, keep: Sequence[str] = ("uri",), vocabulary: Sequence[str] = PRODUCT_TYPES
) -> DataFrame:
    """One row per artifact with a 1/null column per product type."""
    return artifact.select(*keep, *type_flags(vocabulary=vocabulary))


def artifacts_of_collections(described: DataFrame, mappings: DataFrame) -> DataFrame:
    """Artifacts under one of their own collection's namespaces, one row per match."""
    namespaces = mappings.select("collection", F.col("si_namespace").alias("namespace")).distinct()
    return match_namespaces(described, namespaces, also_on=["collection"])


def archive_artifacts_of_collections(
    observation: DataFrame, plane: DataFrame, artifact: DataFrame, mappings: DataFrame
) -> DataFrame:
    """The same from the archive's three tables.

    Where the namespaces can be broadcast, artifacts under none of them are left out before the
    tables meet; whose namespace it is is asked afterwards. More namespaces meet the artifacts once these have a
    collection, as one row each, and what large tables join to is staged on the way.
    """
    pairs = mappings.select("collection", F.col("si_namespace").alias("namespace")).distinct()
    spaces, files = pairs.select("namespace").distinct(), artifact.select("plane_id", "uri", "product_type")
    few = few_depths(spaces)
    if few is not None:
        files = match_namespaces(files, spaces, depths=few)
    owners = owner_join(plane.select("plane_id", "obs_id"), observation.select("obs_id", "collection"), ["obs_id"]).drop("obs_id")
    if few is not None:
        owned = owner_join(files, owners, ["plane_id"]).drop("plane_id")
        return lookup_join(owned, pairs, ["collection", "namespace"], spread_by=["uri"])
    owners, owners_at = stage_large(owners, "owners")
    owned = owner_join(files, owners, ["plane_id"], probe=artifact.select("plane_id")).drop("plane_id")
    owned, owned_at = stage_large(owned, "owned")
    if owners_at and owned_at:
        drop(artifact.sparkSession, owners_at)
    return match_namespaces_by_depth(owned, pairs, also_on=["collection"])


def uri_type_counts(
    artifact: DataFrame, keys: Sequence[str] = ("uri",), vocabulary: Sequence[str] = PRODUCT_TYPES
) -> DataFrame:
    """Instances of each URI by product type.

    ``n_known`` counts the types of the vocabulary; an unknown or null type
    only shows in ``n_rows``. Rows that lie together by collection and URI are not shuffled again.
    """
    lies = [c for c in (PLACE, SALT) if c in artifact.columns and {"collection", "uri"} <= {*keys}]
    counts = artifact.groupBy(*keys, *lies).agg(
        *type_counts(vocabulary=vocabulary), F.count(F.lit(1)).alias("n_rows")
    ).drop(*lies)
    known = reduce(lambda a, b: a + b, (F.col(flag_name(t)) for t in vocabulary))
    return counts.withColumn("n_known", known)


def duplicate_uris(counts: DataFrame) -> DataFrame:
    return counts.where("n_known > 1")


def duplicate_summary(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    n = F.col("n_known")
    return counts.groupBy(*by).agg(
        total(n).alias("num_uris"),
        F.count_if(n == 1).alias("num_single_uris"),
        F.count_if(n > 1).alias("num_duplicate_uris"),
        total(F.when(n > 1, n)).alias("num_duplicate_instances"),
    )


# --- most URIs occur once --------------------------------------------------------------------


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in keys])


def repeated_hashes(artifact: DataFrame, keys: Sequence[str] = ("uri",)) -> DataFrame:
    """Hashes that more than one row has: all repeated keys and, rarely, two keys of one hash. A staged table.

    Only eight bytes and a number of each row are shuffled.
    """
    counts = artifact.select(_hash(keys).alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    return stage(counts.where("n > 1").select("hash"), "repeated")[0]


def by_repetition(
    artifact: DataFrame, keys: Sequence[str] = ("uri",), broadcast_rows: int = BROADCAST_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may occur again, and rows whose key does not, without a shuffle where few hashes are repeated."""
    hashes = repeated_hashes(artifact, keys)
    few = hashes.limit(broadcast_rows + 1).count() <= broadcast_rows
    other = F.broadcast(hashes) if few else hashes.hint("merge")
    sides = (artifact.join(other, _hash(keys) == F.col("hash"), how) for how in ("left_semi", "left_anti"))
    return tuple(sides)


def duplicate_uris_of(
    artifact: DataFrame, keys: Sequence[str] = ("uri",), vocabulary: Sequence[str] = PRODUCT_TYPES, **options
) -> DataFrame:
    """``duplicate_uris`` of ``uri_type_counts``; only rows that may be repeated reach the wide aggregate."""
    repeated, _ = by_repetition(artifact, keys, **options)
    return duplicate_uris(uri_type_counts(repeated, keys, vocabulary))


def duplicate_summary_of(
    artifact: DataFrame, keys: Sequence[str], by: Sequence[str] = (), vocabulary: Sequence[str] = PRODUCT_TYPES, **options
) -> DataFrame:
    """``duplicate_summary`` of ``uri_type_counts``, for ``by`` among the keys; single rows are just counted."""
    artifact, _ = stage_large(artifact.select(*keys, "product_type"), "owned")
    repeated, _ = by_repetition(artifact, keys, **options)
    found = duplicate_summary(uri_type_counts(repeated, keys, vocabulary), by)
    known = F.count_if(F.col("product_type").isin(*vocabulary))
    zero = F.lit(0).cast("long")
    # Single rows are all but the repeated ones, so that they need not meet the hashes.
    every = artifact.groupBy(*by).agg(known.alias("num_uris")).withColumns({
        "num_single_uris": F.col("num_uris"), "num_duplicate_uris": zero, "num_duplicate_instances": zero,
    })
    sums = [c for c in found.columns if c not in by]
    rest = found.withColumns({"num_single_uris": F.col("num_single_uris") - F.col("num_uris"), "num_uris": zero})
    return every.unionByName(rest).groupBy(*by).agg(*[total(F.col(c)).alias(c) for c in sums])
