"""The complete audits: read, select, compare, write sections and summary."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from stocktake import model as m
from stocktake.functions.dedupe import dedupe_first, newest_first
from stocktake.functions.skew import lookup_join
from stocktake.operators import (
    config, copies, digests, duplicates, groups, harvest, previews, profiles, reconcile, usage,
)
from stocktake.plans.stages import kept, passing
from stocktake.sources import sinks


@dataclass
class Archive:
    """The tables of one archive; an audit needs only some of them."""

    observation: DataFrame | None = None
    plane: DataFrame | None = None
    artifact: DataFrame | None = None
    inventory: DataFrame | None = None
    mappings: DataFrame | None = None
    collections: DataFrame | None = None
    sites: DataFrame | None = None


def _selected(archive: Archive, requested: DataFrame | None, **rules) -> DataFrame:
    selected = config.select_collections(archive.collections, requested, **rules)
    if archive.sites is not None:
        selected = config.require_site(selected, archive.sites)
    return selected.select("collection")


def _only(observation: DataFrame, selected: DataFrame) -> DataFrame:
    """Observations of the selected collections."""
    return lookup_join(observation, selected, ["collection"], spread_by=["obs_id"])


def reconcile_audit(
    archive: Archive, out: str, requested: DataFrame | None = None, format: str = "tsv"
) -> None:
    """Catalog against inventory, for the audit groups of the selected collections.

    Both listings and their pairs are made once; sections and counts come from the written tables.
    """
    selected = _selected(archive, requested)
    on = list(reconcile.GROUP_FILE)
    with kept(groups.groups_with(groups.audit_groups(archive.mappings), selected), "groups") as members:
        catalog = reconcile.archive_listing_for_groups(archive.observation, archive.plane, archive.artifact, members)
        inventory = reconcile.inventory_listing_for_groups(archive.inventory, members)
        with kept(catalog, "catalog") as catalog, kept(inventory, "inventory") as inventory:
            with kept(reconcile.reconcile(catalog, inventory, on), "pairs") as pairs:
                sinks.write_sections(
                    pairs.where(F.col("category") != m.CONSISTENT), f"{out}/files", on, format
                )
                sinks.write_table(
                    sinks.section_counts(pairs, m.RECONCILE_CATEGORIES), f"{out}/counts", ["category"], format
                )
                sinks.write_table(
                    reconcile.summarize(catalog, inventory, pairs, ["group_id"]), f"{out}/summary",
                    ["group_id"], format,
                )
        sinks.write_table(members, f"{out}/groups", ["group_id", "member_type", "member"], format)


def repeated_reconcile_audit(
    archive: Archive, out: str, state: str, previous: str | None = None, requested: DataFrame | None = None, format: str = "tsv"
) -> None:
    """``reconcile_audit`` of an archive that mostly agrees with its storage, without the list of consistent files.

    Listings meet only where digests of key ranges differ, and ranges that are as they were in the run that kept ``previous`` keep its
    result. ``state`` is the new folder for this run's digests and result; groups must have the same names in both runs.
    """
    selected = _selected(archive, requested)
    on = list(reconcile.GROUP_FILE)
    with kept(groups.groups_with(groups.audit_groups(archive.mappings), selected), "groups") as members:
        catalog = reconcile.archive_listing_for_groups(archive.observation, archive.plane, archive.artifact, members)
        # A file that two collections of a group describe is listed once, as the first of them has it.
        catalog = dedupe_first(catalog, on, [*newest_first(), F.col("collection").asc()])
        inventory = reconcile.inventory_listing_for_groups(archive.inventory, members)
        with kept(catalog, "catalog") as catalog, kept(inventory, "inventory") as inventory:
            pairs = digests.reconcile_again(catalog, inventory, state, previous, on)
            sinks.write_sections(pairs, f"{out}/files", on, format)
            summary = digests.summarize_changes(catalog, inventory, pairs, ["group_id"])
            sinks.write_table(summary, f"{out}/summary", ["group_id"], format)
        sinks.write_table(members, f"{out}/groups", ["group_id", "member_type", "member"], format)


def duplicate_audit(
    archive: Archive, out: str, requested: DataFrame | None = None, format: str = "tsv"
) -> None:
    """URIs described more than once, per collection."""
    selected = _selected(archive, requested)
    with passing(archive.artifact.sparkSession):
        owned = duplicates.archive_artifacts_of_collections(
            _only(archive.observation, selected), archive.plane, archive.artifact, archive.mappings
        )
        with kept(duplicates.uri_type_counts(owned, ["collection", "uri"])) as counts:
            sinks.write_by_group(
                duplicates.duplicate_uris(counts), f"{out}/uris", ["collection"], ["uri"], format
            )
            sinks.write_table(
                duplicates.duplicate_summary(counts, ["collection"]), f"{out}/summary", ["collection"], format
            )


def profile_audit(
    archive: Archive,
    out: str,
    requested: DataFrame | None = None,
    unsupported_site: str | None = None,
    format: str = "tsv",
) -> None:
    """Orphans, junk and type combinations, per collection."""
    selected = _selected(archive, requested, stored_only=False, unsupported_site=unsupported_site)
    observation, plane, artifact = _only(archive.observation, selected), archive.plane, archive.artifact
    order = ["collection", "observation_id"]
    sinks.write_table(profiles.no_planes(observation, plane), f"{out}/no_planes", order, format)
    sinks.write_table(
        profiles.junk_planes(observation, plane), f"{out}/junk_planes", [*order, "plane_id"], format
    )
    with passing(artifact.sparkSession), kept(profiles.artifact_types_by_plane(artifact), "artifact-types") as folded:
        sinks.write_table(
            profiles.no_artifacts(observation, plane, folded), f"{out}/no_artifacts",
            [*order, "plane_id"], format,
        )
        planes = profiles.plane_type_flags(observation, plane, folded)
        sinks.write_table(
            profiles.type_profile(planes), f"{out}/types", profiles.profile_order(), format
        )
        sinks.write_table(
            profiles.profile_summary(observation, plane, folded), f"{out}/summary", ["collection"], format
        )


def preview_audit(
    archive: Archive,
    out: str,
    requested: DataFrame | None = None,
    unsupported_site: str | None = None,
    format: str = "tsv",
) -> None:
    """Planes without a preview their peers have, per collection."""
    selected = _selected(archive, requested, stored_only=False, unsupported_site=unsupported_site)
    planes = previews.plane_preview_flags(
        _only(archive.observation, selected), archive.plane, archive.artifact
    )
    with kept(planes) as planes:
        counts = previews.category_counts(planes)
        combinations = previews.consistent_combinations(counts).unionByName(
            previews.never_had_preview(counts)
        )
        sinks.write_sections(
            previews.with_none_text(combinations), f"{out}/combinations", previews.COMBINATION, format
        )
        lacking = previews.inconsistent_planes(previews.classify_planes(planes))
        sinks.write_sections(
            previews.with_none_text(lacking), f"{out}/planes",
            ["collection", "observation_id", "instrument_name", "intent", "plane_id"], format,
        )
        sinks.write_table(previews.preview_summary(counts), f"{out}/summary", ["collection"], format)


def copies_audit(
    inventory: DataFrame,
    namespaces: DataFrame,
    sites: Sequence[str],
    datestamp: str,
    out: str,
    requested: DataFrame | None = None,
    format: str = "csv",
) -> None:
    """Files per namespace and site, long and wide."""
    wanted = namespaces
    if requested is not None:
        wanted = copies.require_known_namespaces(requested, namespaces)
    counts = copies.site_counts(inventory, wanted, sites, datestamp)
    with kept(counts) as counts:
        sinks.write_table(counts, f"{out}/counts", ["namespace", "site"], format)
        sinks.write_table(
            copies.merge_site_counts(counts, sites), f"{out}/merged", ["namespace"], format
        )


def usage_audit(
    archive: Archive,
    out: str,
    start: str | None = None,
    end: str | None = None,
    format: str = "csv",
) -> None:
    """Null usage of every field at both granularities, with all roll-ups."""
    observation, plane = archive.observation, archive.plane
    all_fields = usage.field_catalog(observation, plane)
    fields = usage.field_range(all_fields, start, end)
    fine = usage.null_usage(observation, plane, fields)
    with (
        kept(fine, "usage") as fine, kept(usage.obs_totals(observation), "totals") as fine_obs,
        kept(usage.plane_totals(observation, plane), "totals") as fine_plane,
    ):
        coarse = usage.null_usage_rollup(fine).where("granularity = 'collection'").drop(
            "granularity", "instrument_name"
        )
        add = F.sum("num_instances").alias("num_instances")
        levels = {
            "collection_instrument": (fine, fine_obs, fine_plane, usage.COLLECTION_INSTRUMENT),
            "collection": (
                coarse, fine_obs.groupBy("collection").agg(add),
                fine_plane.groupBy("collection").agg(add), usage.COLLECTION,
            ),
        }
        for level, (rows, obs, planes, by) in levels.items():
            place = f"{out}/{level}"
            sinks.write_by_group(usage.with_nulls(rows), f"{place}/by_field", ["field"], by, format)
            sinks.write_by_group(
                usage.fields_by_group(rows, obs, by), f"{place}/by_group", by, ["field"], format
            )
            sinks.write_table(usage.usage_by_field(rows), f"{place}/summary_by_field", ["field"], format)
            sinks.write_table(
                usage.usage_by_group(
                    rows, fields, all_fields, by, {usage.OBSERVATION: obs, usage.PLANE: planes}
                ),
                f"{place}/summary_by_group", ["table_name", *by], format,
            )


def harvest_figures(
    archive: Archive,
    site_observation: DataFrame,
    skip: DataFrame,
    collection: str,
    source_part: str,
    sites: Sequence[str],
    namespace: str,
    asof: datetime,
    cname: str = "Observation",
) -> dict[str, DataFrame]:
    """Every daily figure of one collection by name."""
    return {
        "counts_by_site": harvest.obs_counts_by_site(site_observation, collection, sites),
        "missing_release": harvest.missing_release(archive.observation, collection),
        "harvested": harvest.harvested_since(archive.observation, collection, asof),
        "retry_queue": harvest.retry_queue(skip, cname, source_part, asof),
        "error_digest": harvest.error_digest(skip, cname, source_part),
        "errors": harvest.error_dump(skip, cname, source_part),
        "volume": harvest.prefix_volume(archive.plane, archive.artifact, namespace),
    }


def harvest_in_one_pass(
    archive: Archive,
    site_observation: DataFrame,
    skip: DataFrame,
    collection: str,
    source_part: str,
    sites: Sequence[str],
    namespace: str,
    asof: datetime,
    out: str,
    cname: str = "Observation",
    format: str = "tsv",
) -> None:
    """The report of ``harvest_figures``, with one pass over the observations and one over the skip table.

    Sizes of the queue are counted while its errors are set aside; the errors' digest and list come from there.
    """
    spark = archive.observation.sparkSession
    dump, queue = harvest.observed_errors(skip, cname, source_part, asof)
    with (
        kept(harvest.observation_figures(archive.observation, collection, asof), "harvest") as counted, kept(dump, "errors") as errors
    ):
        counts = queue.get
        figures = {
            "counts_by_site": harvest.obs_counts_by_site(site_observation, collection, sites),
            "missing_release": counted.select(F.col("num_missing_release").alias("num_observations")),
            "harvested": counted.select(F.col("num_harvested").alias("num_observations")),
            "retry_queue": spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts)),
            "error_digest": harvest.error_digest(errors, cname, source_part),
            "errors": errors,
            "volume": harvest.prefix_volume(archive.plane, archive.artifact, namespace),
        }
        harvest_audit(figures, out, format)


HARVEST_ORDER = {"error_digest": ["msg"], "errors": ["skip_id"], "counts_by_site": ["site"]}


def harvest_audit(figures: dict[str, DataFrame], out: str, format: str = "tsv") -> None:
    for name, figure in figures.items():
        sinks.write_table(figure, f"{out}/{name}", HARVEST_ORDER.get(name, ()), format)
