"""Planes that lack a preview or thumbnail their peers have."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stocktake import model as m
from stocktake.functions.flags import non_junk
from stocktake.functions.skew import attach_group_values, owner_join
from stocktake.operators.profiles import artifact_types_by_plane

TYPES = ("preview", "thumbnail", "this", "science", "calibration")
CONTENT_TYPES = ("this", "science", "calibration")
COMBINATION = ("collection", "instrument_name", "intent", "data_product_type", *CONTENT_TYPES)
PLANE = (
    "collection", "observation_id", "instrument_name", "intent", "plane_id", "data_product_type",
    "max_last_modified",
)


def plane_preview_flags(observation: DataFrame, plane: DataFrame, artifact: DataFrame) -> DataFrame:
    """One row per good plane with artifacts: 1/0 per type. Null keys stay null.

    ``artifact`` is the table or its ``profiles.artifact_types_by_plane``.
    """
    good = plane.where(non_junk()).select("plane_id", "obs_id", "data_product_type", "max_last_modified")
    owners = observation.select("obs_id", "collection", "observation_id", "instrument_name", "intent")
    folded = "num_artifacts" in artifact.columns
    flagged = artifact.select("plane_id", *TYPES) if folded else artifact_types_by_plane(artifact, TYPES)
    planes = owner_join(flagged.join(good, "plane_id"), owners, ["obs_id"], probe=good)
    return planes.select(*PLANE, *[F.coalesce(t, F.lit(0)).alias(t) for t in TYPES])


def with_none_text(planes: DataFrame) -> DataFrame:
    """Report form: absent keys spelled ``None``."""
    keys = ("instrument_name", "intent", "data_product_type")
    return planes.withColumns({k: F.coalesce(k, F.lit("None")) for k in keys})


def _combinations(planes: DataFrame) -> DataFrame:
    """Planes per combination, split by which of the two artifacts they have."""
    preview, thumbnail = F.col("preview") == 1, F.col("thumbnail") == 1
    return planes.groupBy(*COMBINATION).agg(
        F.count(F.lit(1)).alias("num_planes"),
        F.count_if(preview & thumbnail).alias("with_both"),
        F.count_if(preview).alias("with_preview"),
        F.count_if(thumbnail).alias("with_thumbnail"),
    )


def combinations(planes: DataFrame) -> DataFrame:
    """Planes per combination of instrument, intent, data type and content types."""
    return _combinations(planes).select(
        F.lit("PROFILE").alias("category"), *COMBINATION, "num_planes"
    )


def _class_of_combination():
    both, preview, thumbnail = m.PREVIEW_CLASSES
    return (
        F.when(F.col("with_both") > 0, both)
        .when(F.col("with_preview") > 0, preview)
        .when(F.col("with_thumbnail") > 0, thumbnail)
    )


def _category():
    both, preview, thumbnail = m.PREVIEW_CLASSES
    complete = (
        F.when(F.col("class") == both, (F.col("preview") == 1) & (F.col("thumbnail") == 1))
        .when(F.col("class") == preview, F.col("preview") == 1)
        .when(F.col("class") == thumbnail, F.col("thumbnail") == 1)
    )
    verdict = F.when(complete, "CONSISTENT_FOR_").otherwise("INCONSISTENT_FOR_")
    return F.when(F.col("class").isNull(), m.NEVER_HAD_PREVIEW).otherwise(F.concat(verdict, "class"))


def classify_planes(planes: DataFrame) -> DataFrame:
    """Each plane's category, judged by what any plane of its combination has.

    The best any peer has (both, else a preview, else a thumbnail) is what every
    plane of the combination should have. Combinations are found by one
    aggregate and joined back; a combination holding most planes is broadcast.
    """
    peers = _combinations(planes).select(
        *COMBINATION, "num_planes", _class_of_combination().alias("class")
    )
    judged = attach_group_values(planes, peers, COMBINATION, "num_planes")
    return judged.withColumn("category", _category()).select("category", *PLANE, *TYPES)


def category_counts(planes: DataFrame) -> DataFrame:
    """Planes per combination and category, from the combinations alone.

    A plane's category depends only on its combination and its own two flags, so
    counting needs no join back to the planes.
    """
    both, preview, thumbnail = m.PREVIEW_CLASSES
    complete = (
        F.when(F.col("class") == both, F.col("with_both"))
        .when(F.col("class") == preview, F.col("with_preview"))
        .when(F.col("class") == thumbnail, F.col("with_thumbnail"))
    )
    rest = F.col("num_planes") - F.coalesce(complete, F.lit(0))
    lacking = F.when(F.col("class").isNull(), m.NEVER_HAD_PREVIEW).otherwise(
        F.concat(F.lit("INCONSISTENT_FOR_"), "class")
    )
    verdicts = F.array(
        F.struct(F.concat(F.lit("CONSISTENT_FOR_"), "class").alias("category"), complete.alias("n")),
        F.struct(lacking.alias("category"), rest.alias("n")),
    )
    classed = _combinations(planes).withColumn("class", _class_of_combination())
    counts = classed.select(*COMBINATION, F.inline(verdicts))
    return counts.where("n > 0").select("category", *COMBINATION, F.col("n").alias("num_planes"))


def consistent_combinations(counts: DataFrame) -> DataFrame:
    """Combinations with planes that have all they should, from ``category_counts``."""
    return counts.where(F.col("category").startswith("CONSISTENT_FOR_"))


def inconsistent_planes(classified: DataFrame) -> DataFrame:
    """Planes that lack what a peer has."""
    return classified.where(F.col("category").startswith("INCONSISTENT_FOR_")).select(
        "category", *PLANE, *CONTENT_TYPES
    )


def never_had_preview(counts: DataFrame) -> DataFrame:
    """Combinations in which no plane ever had either, from ``category_counts``."""
    return counts.where(F.col("category") == m.NEVER_HAD_PREVIEW)


def preview_summary(counts: DataFrame) -> DataFrame:
    """Planes per collection and category, from ``category_counts``."""
    return counts.groupBy("collection").agg(
        F.sum("num_planes").alias("num_planes"),
        *[
            F.coalesce(F.sum(F.when(F.col("category") == c, F.col("num_planes"))), F.lit(0).cast("long"))
            .alias(f"num_{c.lower()}")
            for c in m.PREVIEW_CATEGORIES
        ],
    )
