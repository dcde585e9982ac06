"""Checks of the audit's own configuration tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stocktake.functions.skew import lookup_join


def collection_site(collections: DataFrame, sites: DataFrame) -> DataFrame:
    """Each collection with its site's location, null where the site is not configured."""
    locations = sites.select(F.col("site_name").alias("ams_site"), "site_url")
    located = lookup_join(collections, locations, ["ams_site"], "left", spread_by=["collection"])
    return located.select("collection", "ams_site", "site_url")


def require_site(collections: DataFrame, sites: DataFrame) -> DataFrame:
    """``collection_site``, failing when run if a collection's site is not configured."""
    error = F.raise_error(F.format_string("no site %s for collection %s", "ams_site", "collection"))
    # A filter, so that the check stays even if nobody selects the location.
    return collection_site(collections, sites).where(
        F.coalesce(F.col("site_url").isNotNull() | F.lit(None), error.cast("boolean"))
    )


def select_collections(
    collections: DataFrame,
    requested: DataFrame | None = None,
    stored_only: bool = True,
    unsupported_site: str | None = None,
) -> DataFrame:
    """The collections to audit: all, or the ``requested`` ones.

    ``stored_only`` leaves out collections the inventory does not hold. Naming a
    collection that is unknown or left out fails when run.
    """
    eligible = collections
    if unsupported_site is not None:
        eligible = eligible.where(F.col("ams_site") != unsupported_site)
    if stored_only:
        eligible = eligible.where("in_si")
    if requested is None:
        return eligible
    wanted = requested.select("collection").distinct()
    known = eligible.withColumn("_known", F.lit(True))
    error = F.raise_error(F.concat(F.lit("unknown collection: "), "collection"))
    chosen = wanted.join(known, "collection", "left").where(
        F.coalesce("_known", error.cast("boolean"))
    )
    return chosen.select(*collections.columns)
