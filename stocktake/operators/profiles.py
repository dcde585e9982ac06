"""Orphaned and junk records, and which product types occur together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stocktake.functions.flags import non_junk, packed_flags, packed_names, packed_presence, type_presence, unpacked_flags
from stocktake.functions.numbers import total
from stocktake.functions.skew import apart, owner_join
from stocktake.model import JUNK, PRODUCT_TYPES, flag_name
from stocktake.plans.stages import stage_large

PROFILE = ("collection", "instrument_name", "intent", "data_product_type")
PLANE_LISTING = (
    "category", "collection", "observation_id", "plane_id", "data_product_type", "max_last_modified",
)


def no_planes(observation: DataFrame, plane: DataFrame) -> DataFrame:
    """Observations without planes."""
    return observation.join(plane.select("obs_id").distinct(), "obs_id", "left_anti").select(
        F.lit("NO_PLANES").alias("category"), "collection", "observation_id", "max_last_modified"
    )


def _plane_listing(observation: DataFrame, plane: DataFrame, category: str) -> DataFrame:
    owners = observation.select("obs_id", "collection", "observation_id")
    columns = plane.select("obs_id", "plane_id", "data_product_type", "max_last_modified")
    return owner_join(columns, owners, ["obs_id"]).withColumn("category", F.lit(category)).select(*PLANE_LISTING)


def no_artifacts(observation: DataFrame, plane: DataFrame, artifact: DataFrame) -> DataFrame:
    """Planes without artifacts."""
    bare = plane.join(artifact.select("plane_id").distinct(), "plane_id", "left_anti")
    return _plane_listing(observation, bare, "NO_ARTIFACTS")


def junk_planes(observation: DataFrame, plane: DataFrame) -> DataFrame:
    return _plane_listing(observation, plane.where(F.col("quality_flag") == JUNK), "JUNK_PLANE")


def artifact_types_by_plane(artifact: DataFrame, vocabulary: Sequence[str] = PRODUCT_TYPES) -> DataFrame:
    """One row per plane that has artifacts: a 1/null flag per type, and their number.

    Artifacts, by far the largest table, shrink to one row per plane before
    they meet any other table, and the result is already partitioned by plane.
    """
    packed = _packed(artifact, vocabulary)
    return packed.select("plane_id", *unpacked_flags(vocabulary), "num_artifacts")


def _packed(artifact: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """``artifact``, or what ``artifact_types_by_plane`` already made of it, by plane with the types as bits.

    A plane is a row of a few numbers in the memory of tasks and in shuffles, however many types there are.
    """
    if "num_artifacts" in artifact.columns:
        return artifact.select("plane_id", *packed_flags(vocabulary), "num_artifacts")
    return artifact.groupBy("plane_id").agg(*packed_presence(vocabulary=vocabulary), F.count(F.lit(1)).alias("num_artifacts"))


def plane_type_flags(
    observation: DataFrame,
    plane: DataFrame,
    artifact: DataFrame,
    vocabulary: Sequence[str] = PRODUCT_TYPES,
) -> DataFrame:
    """One row per good plane with artifacts, with its type flags. Keys are unique per table.

    ``artifact`` is the table or its ``artifact_types_by_plane``, here and below.
    """
    good = plane.where(non_junk()).select("plane_id", "obs_id", "data_product_type")
    owners = observation.select("obs_id", "collection", "instrument_name", "intent")
    types = type_presence(vocabulary=vocabulary)
    folded = artifact if "num_artifacts" in artifact.columns else artifact.groupBy("plane_id").agg(*types)
    flagged = folded.select("plane_id", *[flag_name(t) for t in vocabulary])
    planes = owner_join(flagged.join(good, "plane_id"), owners, ["obs_id"], probe=good)
    return planes.select(*PROFILE, "plane_id", *[flag_name(t) for t in vocabulary])


def type_profile(planes: DataFrame, vocabulary: Sequence[str] = PRODUCT_TYPES) -> DataFrame:
    """Planes per distinct combination of instrument, intent, data type and type flags.

    Nulls are ordinary group keys here.
    """
    flags = [flag_name(t) for t in vocabulary]
    combinations = planes.groupBy(*PROFILE, *flags).agg(F.count(F.lit(1)).alias("num_planes"))
    return combinations.select(
        F.lit("TYPE").alias("category"), *PROFILE, "num_planes", *flags
    )


def profile_order(vocabulary: Sequence[str] = PRODUCT_TYPES) -> list:
    """Report order of a type profile: nulls first in both directions."""
    ascending = [F.col(c).asc_nulls_first() for c in ("category", "collection", "instrument_name")]
    return [
        *ascending, F.col("intent").desc_nulls_first(), F.col("data_product_type").asc_nulls_first(),
        *[F.col(flag_name(t)).desc_nulls_first() for t in vocabulary],
    ]


def profile_summary(
    observation: DataFrame,
    plane: DataFrame,
    artifact: DataFrame,
    vocabulary: Sequence[str] = PRODUCT_TYPES,
) -> DataFrame:
    """All profile counts per collection.

    Planes alike within an observation fold to one row before they meet the
    observations, and alike within a collection afterwards. So one observation
    with very many planes stays small, and distinct combinations are counted
    without a wide distinct.
    """
    flags = packed_names(vocabulary)
    owners = observation.select("obs_id", "collection", "instrument_name", "intent")
    is_junk = (F.col("quality_flag") == JUNK).alias("is_junk")
    # Planes keep their number of parts; tasks that hold both sides, sorted, and their counts would else grow with the tables.
    parts = int(plane.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    listed = plane.select("plane_id", "obs_id", "data_product_type", is_junk, non_junk().alias("good"))
    planes = listed.repartition(parts, "plane_id").join(
        apart(_packed(artifact, vocabulary)), "plane_id", "left"
    )
    checked = F.col("num_artifacts").isNotNull() & F.col("good")
    alike = planes.withColumn("checked", checked).groupBy(
        "obs_id", "data_product_type", *flags, "checked"
    ).agg(
        F.count_if(F.col("num_artifacts").isNull()).alias("no_artifacts"),
        F.count_if("is_junk").alias("junk"),
        F.count(F.lit(1)).alias("planes"),
        total(F.col("num_artifacts")).alias("artifacts"),
    )
    # The shuffles that made them go before the next ones are written.
    alike, _ = stage_large(alike, "alike")
    sums = ("no_artifacts", "junk", "planes", "artifacts")
    combinations = alike.join(apart(owners), "obs_id").groupBy(*PROFILE, *flags, "checked").agg(
        *[F.sum(c).alias(c) for c in sums]
    )
    zero = F.lit(0).cast("long")
    per_collection = combinations.groupBy("collection").agg(
        F.sum("no_artifacts").alias("num_no_artifacts"),
        F.sum("junk").alias("num_junk_planes"),
        total(F.when(F.col("checked"), F.col("planes"))).alias("num_planes"),
        total(F.when(F.col("checked"), F.col("artifacts"))).alias("num_artifacts"),
        F.count_if("checked").alias("num_combinations"),
    ).withColumn("num_no_planes", zero)
    bare = no_planes(observation, plane).groupBy("collection").agg(
        F.count(F.lit(1)).alias("num_no_planes")
    )
    counts = ["num_no_planes", *[c for c in per_collection.columns if c.startswith("num_")][:-1]]
    parts = per_collection.unionByName(bare.withColumns({c: zero for c in counts[1:]}))
    return parts.groupBy("collection").agg(*[F.sum(c).alias(c) for c in counts])
