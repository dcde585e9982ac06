"""Compare the metadata catalog with the storage inventory, file by file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stocktake import model as m
from stocktake.functions.dedupe import dedupe_first, newest_first
from stocktake.functions.numbers import total
from stocktake.functions.prefixes import match_namespaces, under
from stocktake.functions.skew import lookup_join, owner_join

FILE = ("uri", *m.CONTENT, "last_modified")
SUFFIX = "_si"


def described_artifacts(observation: DataFrame, plane: DataFrame, artifact: DataFrame) -> DataFrame:
    """Artifacts with the collection of the observation they belong to."""
    owners = owner_join(plane.select("plane_id", "obs_id"), observation.select("obs_id", "collection"), ["obs_id"])
    return owner_join(artifact, owners.select("plane_id", "collection"), ["plane_id"])


def catalog_listing(
    observation: DataFrame, plane: DataFrame, artifact: DataFrame, collection: str, namespace: str
) -> DataFrame:
    """Files of one collection under one namespace, as the catalog describes them."""
    described = described_artifacts(
        observation.where(F.col("collection") == collection),
        plane,
        artifact.where(under("uri", namespace)),
    )
    return dedupe_first(described.select("collection", *FILE), ["uri"], newest_first())


def inventory_listing(inventory: DataFrame, namespace: str) -> DataFrame:
    """Files under one namespace, as storage holds them."""
    held = inventory.where(under("uri", namespace)).select(*FILE)
    return dedupe_first(held, ["uri"], newest_first())


def _members(members: DataFrame, kind: str) -> DataFrame:
    return members.where(F.col("member_type") == kind).select("group_id", F.col("member").alias(kind))


#: What a file of an audit group is known by. A URI under nested namespaces is listed under each of them on
#: both sides; joined on all three it pairs with itself once for each, not each with each.
GROUP_FILE = ("group_id", "namespace", "uri")


def archive_listing_for_groups(
    observation: DataFrame, plane: DataFrame, artifact: DataFrame, members: DataFrame
) -> DataFrame:
    """``catalog_listing_for_groups`` from the archive's three tables.

    Artifacts are matched to the groups' namespaces and observations to their
    collections before the tables meet, so that files of other groups do not travel.
    """
    files = match_namespaces(artifact.select("plane_id", *FILE), _members(members, "namespace"))
    owners = lookup_join(
        observation.select("obs_id", "collection"), _members(members, "collection"), ["collection"], spread_by=["obs_id"]
    )
    owned = owner_join(plane.select("plane_id", "obs_id"), owners, ["obs_id"]).drop("obs_id")
    rows = owner_join(files, owned, ["plane_id", "group_id"]).select("group_id", "collection", "namespace", *FILE)
    return dedupe_first(rows, ["group_id", "collection", "namespace", "uri"], newest_first())


def catalog_listing_for_groups(described: DataFrame, members: DataFrame) -> DataFrame:
    """Catalog files of every audit group at once: its collections x its namespaces.

    ``members`` is the output of ``groups.audit_groups``. Copies are dropped
    within (collection, namespace) only, so a URI described by two collections
    stays twice.
    """
    collections, namespaces = _members(members, "collection"), _members(members, "namespace")
    files = lookup_join(described.select("collection", *FILE), collections, ["collection"], spread_by=["uri"])
    files = match_namespaces(files, namespaces, also_on=["group_id"])
    files = files.select("group_id", "collection", "namespace", *FILE)
    return dedupe_first(files, ["group_id", "collection", "namespace", "uri"], newest_first())


def inventory_listing_for_groups(inventory: DataFrame, members: DataFrame) -> DataFrame:
    """Stored files of every audit group at once."""
    namespaces = _members(members, "namespace")
    files = match_namespaces(inventory.select(*FILE), namespaces)
    files = files.select("group_id", "namespace", *FILE)
    return dedupe_first(files, ["group_id", "namespace", "uri"], newest_first())


def _content_category() -> Column:
    """Category of a URI found on both sides.

    Checksum, then length, then type; a null met on the way decides nothing.
    """
    checksum, length, kind = (
        (F.col(c) == F.col(c + SUFFIX), F.col(c) != F.col(c + SUFFIX)) for c in m.CONTENT
    )
    return (
        F.when(checksum[1], m.DIFF_CHECKSUMS)
        .when(checksum[0] & length[1], m.DIFF_LENGTHS)
        .when(checksum[0] & length[0] & kind[1], m.DIFF_TYPES)
        .when(checksum[0] & length[0] & kind[0], m.CONSISTENT)
        .otherwise(m.UNDETERMINED)
    )


def _suffixed(inventory: DataFrame, on: Sequence[str]) -> DataFrame:
    return inventory.select(
        *on, *[F.col(c).alias(c + SUFFIX) for c in (*m.CONTENT, "last_modified")]
    )


def _context(catalog: DataFrame, on: Sequence[str]) -> list[str]:
    return [c for c in ("collection",) if c in catalog.columns and c not in on]


def reconcile(catalog: DataFrame, inventory: DataFrame, on: Sequence[str] = ("uri",)) -> DataFrame:
    """Every file of either side with its category, from a single full outer join."""
    on, context = list(on), _context(catalog, on)
    left = catalog.select(*on, *context, *m.CONTENT, "last_modified", F.lit(True).alias("_in_catalog"))
    right = _suffixed(inventory, on).withColumn("_in_inventory", F.lit(True))
    category = (
        F.when(F.col("_in_inventory").isNull(), m.MISSING_IN_INVENTORY)
        .when(F.col("_in_catalog").isNull(), m.MISSING_IN_CATALOG)
        .otherwise(_content_category())
    )
    return left.join(right, on, "full_outer").select(
        category.alias("category"), *on, *context,
        *m.CONTENT, "last_modified", *[c + SUFFIX for c in (*m.CONTENT, "last_modified")],
    )


def _matched(catalog: DataFrame, inventory: DataFrame, on: Sequence[str], category: str) -> DataFrame:
    """One category of the URIs on both sides; only an inner join is needed."""
    on, context = list(on), _context(catalog, on)
    left = catalog.select(*on, *context, *m.CONTENT, "last_modified")
    pairs = left.join(_suffixed(inventory, on), on).withColumn("category", _content_category())
    return pairs.where(F.col("category") == category).select(
        "category", *on, *context,
        *m.CONTENT, "last_modified", *[c + SUFFIX for c in (*m.CONTENT, "last_modified")],
    )


def consistent(catalog: DataFrame, inventory: DataFrame, on: Sequence[str] = ("uri",)) -> DataFrame:
    """URIs whose checksum, length and type agree."""
    return _matched(catalog, inventory, on, m.CONSISTENT).select(*on)


def diff_checksums(catalog: DataFrame, inventory: DataFrame, on: Sequence[str] = ("uri",)) -> DataFrame:
    return _matched(catalog, inventory, on, m.DIFF_CHECKSUMS)


def diff_lengths(catalog: DataFrame, inventory: DataFrame, on: Sequence[str] = ("uri",)) -> DataFrame:
    """Same checksum, different length."""
    return _matched(catalog, inventory, on, m.DIFF_LENGTHS)


def diff_types(catalog: DataFrame, inventory: DataFrame, on: Sequence[str] = ("uri",)) -> DataFrame:
    """Same checksum and length, different type."""
    return _matched(catalog, inventory, on, m.DIFF_TYPES)


def _only_in(left: DataFrame, right: DataFrame, on: Sequence[str], category: str) -> DataFrame:
    context = _context(left, on)
    # distinct first: repeats of a key on the right shrink before they shuffle.
    absent = left.join(right.select(*on).distinct(), list(on), "left_anti")
    return absent.select(F.lit(category).alias("category"), *on, *context, "last_modified")


def missing_in_inventory(catalog: DataFrame, inventory: DataFrame, on: Sequence[str] = ("uri",)) -> DataFrame:
    return _only_in(catalog, inventory, on, m.MISSING_IN_INVENTORY)


def missing_in_catalog(catalog: DataFrame, inventory: DataFrame, on: Sequence[str] = ("uri",)) -> DataFrame:
    return _only_in(inventory, catalog, on, m.MISSING_IN_CATALOG)


def reconcile_summary(
    catalog: DataFrame,
    inventory: DataFrame,
    on: Sequence[str] = ("uri",),
    by: Sequence[str] = (),
) -> DataFrame:
    """Files and bytes per side and files per category, for each value of ``by``, which must be part of ``on``."""
    return summarize(catalog, inventory, reconcile(catalog, inventory, on), by)


def summarize(catalog: DataFrame, inventory: DataFrame, pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same from pairs already made.

    Each side is counted from its own listing, because a URI with several copies
    appears more than once among the pairs.
    """
    zero = F.lit(0).cast("long")

    def side(listing, name, other):
        return listing.groupBy(*by).agg(
            F.count(F.lit(1)).alias(f"num_{name}"), total(F.col("content_length")).alias(f"{name}_bytes")
        ).withColumns({f"num_{other}": zero, f"{other}_bytes": zero})

    counts = {c: f"num_{c.lower()}" for c in m.RECONCILE_CATEGORIES}
    sides = [side(catalog, "catalog", "inventory"), side(inventory, "inventory", "catalog")]
    sides = [s.withColumns({n: zero for n in counts.values()}) for s in sides]
    found = pairs.groupBy(*by).agg(*[F.count_if(F.col("category") == c).alias(n) for c, n in counts.items()])
    found = found.withColumns(
        {n: zero for n in ("num_catalog", "catalog_bytes", "num_inventory", "inventory_bytes")}
    )
    parts = sides[0].unionByName(sides[1]).unionByName(found)
    columns = ["num_catalog", "catalog_bytes", "num_inventory", "inventory_bytes", *counts.values()]
    return parts.groupBy(*by).agg(*[total(F.col(c)).alias(c) for c in columns])
