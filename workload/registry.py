"""The registered queries: each operator over the archive-shaped views, with its DuckDB SQL.

The SQL is written the way the audit is described, step by step and join by
join, not the way the operator computes it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from stocktake.functions.dedupe import dedupe_first, newest_first
from stocktake.functions.prefixes import match_namespaces_indexed
from stocktake.functions.skew import owner_join
from stocktake.model import EXPECTED_KINDS, OBSERVATION, PREVIEW_CATEGORIES, PRODUCT_TYPES, flag_name
from stocktake.operators import (
    config, copies, digests, duplicates, groups, harvest, manifests, previews, profiles, reconcile, reports,
    usage,
)
from stocktake.plans.session import ensure_checkpoint_dir
from stocktake.plans.stages import kept, settled, stage
from stocktake.sources import layout
from stocktake.sources.tables import conform
from workload.views import view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

ASOF = datetime(2024, 1, 15)
HARVEST_ASOF = datetime(2001, 1, 1)
SITES = ("alpha", "beta", "gamma")
SERVICES = ("origin", "mirror", "public")


def register(name: str, sql: str):
    """Add ``fn(views...)`` under ``name``; ``fn`` gets a lookup from view name to DataFrame."""

    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(lambda n: view(spark, sf_dir, n))
        ORACLE[name] = with_views(sql)
        return fn

    return add


# --- A: catalog against inventory ------------------------------------------------------------

FIRST = """ORDER BY last_modified DESC NULLS LAST, content_checksum NULLS FIRST,
           content_length NULLS FIRST, content_type NULLS FIRST"""
CONTENT = "content_checksum, content_length, content_type, last_modified"
ON = ("collection", "uri")


def _sides(v):
    keys = ["collection", "uri"]
    return (
        dedupe_first(v("catalog"), keys, newest_first()),
        dedupe_first(v("inventory"), keys, newest_first()),
    )


def _first_rows(source: str, keys: str, columns: str) -> str:
    return f"""SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} {FIRST}) AS rn
               FROM {source}) WHERE rn = 1"""


SIDES = f"""WITH cat AS ({_first_rows('{catalog}', 'collection, uri', 'collection, uri, ' + CONTENT)}),
    inv AS ({_first_rows('{inventory}', 'collection, uri', 'collection, uri, ' + CONTENT)})"""
SI = ", ".join(f"i.{c.strip()} AS {c.strip()}_si" for c in CONTENT.split(","))
PAIR = f"""c.collection, c.uri, c.content_checksum, c.content_length, c.content_type, c.last_modified, {SI}
    FROM cat c JOIN inv i ON c.uri = i.uri AND c.collection = i.collection"""


@register("catalog_listing", f"""WITH d AS (
    SELECT o.collection, a.* FROM {{observation}} o JOIN {{plane}} p ON o.obs_id = p.obs_id
    JOIN {{artifact}} a ON a.plane_id = p.plane_id
    WHERE o.collection = 'BUILDING' AND starts_with(a.uri, 'Brand#1/'))
    {_first_rows('d', 'uri', 'collection, uri, ' + CONTENT)}""")
def _(v):
    return reconcile.catalog_listing(
        v("observation"), v("plane"), v("artifact"), "BUILDING", "Brand#1"
    )


@register("inventory_listing", _first_rows(
    "(SELECT * FROM {inventory} WHERE starts_with(uri, 'nssrc6/')) h", "uri", "uri, " + CONTENT))
def _(v):
    return reconcile.inventory_listing(v("inventory"), "nssrc6")


@register("dedupe_first", _first_rows("{artifact}", "uri", "uri, " + CONTENT))
def _(v):
    return dedupe_first(v("artifact").select(*reconcile.FILE), ["uri"], newest_first())


@register("reconcile_consistent", f"""{SIDES} SELECT c.collection, c.uri FROM cat c JOIN inv i
    ON c.uri = i.uri AND c.collection = i.collection
    WHERE c.content_checksum = i.content_checksum AND c.content_length = i.content_length
      AND c.content_type = i.content_type""")
def _(v):
    return reconcile.consistent(*_sides(v), on=ON)


@register("missing_in_inventory", f"""{SIDES} SELECT 'MISSING_IN_INVENTORY' AS category, c.collection,
    c.uri, c.last_modified FROM cat c
    WHERE NOT EXISTS (SELECT 1 FROM inv i WHERE i.uri = c.uri AND i.collection = c.collection)""")
def _(v):
    return reconcile.missing_in_inventory(*_sides(v), on=ON)


@register("missing_in_catalog", f"""{SIDES} SELECT 'MISSING_IN_CATALOG' AS category, i.collection,
    i.uri, i.last_modified FROM inv i
    WHERE NOT EXISTS (SELECT 1 FROM cat c WHERE i.uri = c.uri AND i.collection = c.collection)""")
def _(v):
    return reconcile.missing_in_catalog(*_sides(v), on=ON)


DIFF_WHERE = {
    "DIFF_CHECKSUMS": "c.content_checksum <> i.content_checksum",
    "DIFF_LENGTHS": "c.content_checksum = i.content_checksum AND c.content_length <> i.content_length",
    "DIFF_TYPES": """c.content_checksum = i.content_checksum AND c.content_length = i.content_length
                     AND c.content_type <> i.content_type""",
    "CONSISTENT": """c.content_checksum = i.content_checksum AND c.content_length = i.content_length
                     AND c.content_type = i.content_type""",
}


def _diff_sql(category):
    return f"SELECT '{category}' AS category, {PAIR} WHERE {DIFF_WHERE[category]}"


for _category in ("DIFF_CHECKSUMS", "DIFF_LENGTHS", "DIFF_TYPES"):
    register(_category.lower(), f"{SIDES} {_diff_sql(_category)}")(
        lambda v, op=getattr(reconcile, _category.lower()): op(*_sides(v), on=ON)
    )

NO_SI = ", ".join(f"NULL AS {c.strip()}_si" for c in CONTENT.split(","))
NO_CAT = ", ".join(f"NULL AS {c.strip()}" for c in CONTENT.split(","))


ORACLE_RECONCILE = f"""{SIDES},
    pairs AS (SELECT {PAIR}),
    decided AS ({' UNION ALL '.join(_diff_sql(c) for c in DIFF_WHERE)})
    SELECT * FROM decided
    UNION ALL SELECT 'UNDETERMINED', p.* FROM pairs p
      WHERE NOT EXISTS (SELECT 1 FROM decided d WHERE d.uri = p.uri AND d.collection = p.collection)
    UNION ALL SELECT 'MISSING_IN_INVENTORY', c.collection, c.uri, c.content_checksum, c.content_length,
      c.content_type, c.last_modified, {NO_SI} FROM cat c
      WHERE NOT EXISTS (SELECT 1 FROM inv i WHERE i.uri = c.uri AND i.collection = c.collection)
    UNION ALL SELECT 'MISSING_IN_CATALOG', i.collection, i.uri, {NO_CAT}, {SI} FROM inv i
      WHERE NOT EXISTS (SELECT 1 FROM cat c WHERE i.uri = c.uri AND i.collection = c.collection)"""


@register("reconcile", ORACLE_RECONCILE)
def _(v):
    return reconcile.reconcile(*_sides(v), on=ON)


def _reconcile_summary_sql(key: str, *also: str) -> str:
    """Counts per ``key`` from tables ``cat`` and ``inv`` already defined."""
    same = " AND ".join(f"c.{k} = i.{k}" for k in ("uri", key, *also))
    pairs = f"(SELECT c.{key} AS k, %s FROM cat c JOIN inv i ON {same})"
    when = " ".join(f"WHEN {w} THEN '{c}'" for c, w in DIFF_WHERE.items())
    metric = "COUNT(*) FILTER (WHERE category = '{0}') AS num_{1}"
    cats = ["CONSISTENT", "MISSING_IN_INVENTORY", "MISSING_IN_CATALOG", "DIFF_CHECKSUMS",
            "DIFF_LENGTHS", "DIFF_TYPES", "UNDETERMINED"]
    return f"""keys AS (SELECT {key} AS k FROM cat UNION SELECT {key} FROM inv),
    c1 AS (SELECT {key} AS k, COUNT(*) AS n, CAST(SUM(content_length) AS BIGINT) AS b FROM cat GROUP BY 1),
    i1 AS (SELECT {key} AS k, COUNT(*) AS n, CAST(SUM(content_length) AS BIGINT) AS b FROM inv GROUP BY 1),
    cats AS (SELECT k, category FROM {pairs % f"CASE {when} ELSE 'UNDETERMINED' END AS category"}
      UNION ALL SELECT c.{key}, 'MISSING_IN_INVENTORY' FROM cat c
        WHERE NOT EXISTS (SELECT 1 FROM inv i WHERE {same})
      UNION ALL SELECT i.{key}, 'MISSING_IN_CATALOG' FROM inv i
        WHERE NOT EXISTS (SELECT 1 FROM cat c WHERE {same})),
    n1 AS (SELECT k, {', '.join(metric.format(c, c.lower()) for c in cats)} FROM cats GROUP BY k)
    SELECT keys.k AS {key}, COALESCE(c1.n, 0) AS num_catalog, COALESCE(c1.b, 0) AS catalog_bytes,
      COALESCE(i1.n, 0) AS num_inventory, COALESCE(i1.b, 0) AS inventory_bytes,
      {', '.join(f'COALESCE(num_{c.lower()}, 0) AS num_{c.lower()}' for c in cats)}
    FROM keys LEFT JOIN c1 ON c1.k = keys.k LEFT JOIN i1 ON i1.k = keys.k LEFT JOIN n1 ON n1.k = keys.k"""


RECONCILE_SUMMARY = f"{SIDES}, {_reconcile_summary_sql('collection')}"


@register("reconcile_summary", RECONCILE_SUMMARY)
def reconcile_summary(v):
    return reconcile.reconcile_summary(*_sides(v), on=ON, by=["collection"])


# Both listings stored in buckets of their key; the tables lie in the shared folder.
def _stored(v, *, of=ON):
    out = []
    for name, listing in (("catalog", v("catalog")), ("inventory", v("inventory"))):
        path = f"{ensure_checkpoint_dir(listing.sparkSession)}/stocktake-listing-{uuid.uuid4().hex}/{name}"
        layout.write_listing(listing.select("collection", *reconcile.FILE), path, of, buckets=16)
        out.append(layout.read_listing(listing.sparkSession, path))
    return out


@register("reconcile_stored", ORACLE_RECONCILE)
def _(v):
    return reconcile.reconcile(*_stored(v), on=ON)


@register("reconcile_changes", f"SELECT * FROM ({ORACLE_RECONCILE}) WHERE category <> 'CONSISTENT'")
def _(v):
    return digests.reconcile_changes(*_stored(v), on=ON)


@register("reconcile_changes_summary", RECONCILE_SUMMARY)
def _(v):
    return digests.reconcile_changes_summary(*_stored(v), on=ON, by=["collection"])


# Of the catalog before its last changes every fifth file was not there, every seventh had another length.
@register("reconcile_again", f"SELECT * FROM ({ORACLE_RECONCILE}) WHERE category <> 'CONSISTENT'")
def _(v):
    catalog, inventory = _stored(v)
    changed = F.when(F.col("content_length") % 7 == 0, F.col("content_length") + 1).otherwise(F.col("content_length"))
    earlier = catalog.where("content_length % 5 <> 0 OR content_length IS NULL").withColumn("content_length", changed)
    state = f"{ensure_checkpoint_dir(catalog.sparkSession)}/stocktake-again-{uuid.uuid4().hex}"
    digests.reconcile_again(earlier, inventory, f"{state}/first", on=ON)
    return digests.reconcile_again(catalog, inventory, f"{state}/second", f"{state}/first", on=ON)


@register("listing_with_changes", f"""WITH stored AS ({_first_rows('{catalog}', 'collection, uri', 'collection, uri, ' + CONTENT)}),
    changes AS (SELECT collection, uri, {CONTENT}, content_length % 3 = 0 AS gone FROM {{inventory}}),
    every AS (SELECT *, false AS gone FROM stored UNION ALL SELECT * FROM changes)
    SELECT * EXCLUDE (gone) FROM ({_first_rows('every', 'collection, uri', 'collection, uri, ' + CONTENT + ', gone')}) WHERE NOT gone""")
def _(v):
    stored, _ = _stored(v)
    changes = v("inventory").withColumn("gone", F.col("content_length") % 3 == 0)
    return layout.with_changes(stored, changes, ON, deleted="gone")


def _groups_sql(mappings: str) -> str:
    return f"""RECURSIVE reach(collection, other) AS (
      SELECT DISTINCT collection, collection FROM {{{mappings}}}
      UNION
      SELECT r.collection, b.collection FROM reach r JOIN {{{mappings}}} a ON a.collection = r.other
      JOIN {{{mappings}}} b ON b.si_namespace = a.si_namespace),
    grp AS (SELECT collection, MIN(other) AS group_id FROM reach GROUP BY collection),
    members AS (SELECT group_id, 'collection' AS member_type, collection AS member FROM grp
      UNION SELECT group_id, 'namespace', si_namespace FROM grp JOIN {{{mappings}}} USING (collection))"""


@register("audit_groups", _groups_sql("mapping_graph") + " SELECT * FROM members")
def _(v):
    return groups.audit_groups(v("mapping_graph"))


GROUP_LISTINGS = f"""{_groups_sql("mappings")},
    cat AS ({_first_rows('''(SELECT c.group_id, f.collection, n.member AS namespace, f.uri,
        f.content_checksum, f.content_length, f.content_type, f.last_modified
        FROM {catalog} f JOIN members c ON c.member_type = 'collection' AND c.member = f.collection
        JOIN members n ON n.member_type = 'namespace' AND n.group_id = c.group_id
          AND starts_with(f.uri, concat(n.member, '/'))) x''', 'group_id, collection, namespace, uri',
        'group_id, collection, namespace, uri, ' + CONTENT)}),
    inv AS ({_first_rows('''(SELECT n.group_id, n.member AS namespace, f.uri,
        f.content_checksum, f.content_length, f.content_type, f.last_modified
        FROM {inventory} f JOIN members n ON n.member_type = 'namespace'
          AND starts_with(f.uri, concat(n.member, '/'))) x''', 'group_id, namespace, uri',
        'group_id, namespace, uri, ' + CONTENT)})"""


@register("group_listing", f"{GROUP_LISTINGS} SELECT * FROM cat")
def _(v):
    members = groups.audit_groups(v("mappings"))
    return reconcile.catalog_listing_for_groups(v("catalog"), members)


@register("group_reconcile_summary", f"{GROUP_LISTINGS}, {_reconcile_summary_sql('group_id', 'namespace')}")
def _(v):
    members = groups.audit_groups(v("mappings"))
    return reconcile.reconcile_summary(
        reconcile.catalog_listing_for_groups(v("catalog"), members),
        reconcile.inventory_listing_for_groups(v("inventory"), members),
        on=reconcile.GROUP_FILE, by=["group_id"],
    )


ARCHIVE_LISTINGS = f"""{_groups_sql("archive_mappings")},
    cat AS ({_first_rows('''(SELECT c.group_id, o.collection, n.member AS namespace, a.uri,
        a.content_checksum, a.content_length, a.content_type, a.last_modified
        FROM {artifact} a JOIN {plane} p ON p.plane_id = a.plane_id JOIN {observation} o ON o.obs_id = p.obs_id
        JOIN members c ON c.member_type = 'collection' AND c.member = o.collection
        JOIN members n ON n.member_type = 'namespace' AND n.group_id = c.group_id
          AND starts_with(a.uri, concat(n.member, '/'))) x''', 'group_id, collection, namespace, uri',
        'group_id, collection, namespace, uri, ' + CONTENT)}),
    inv AS ({_first_rows('''(SELECT n.group_id, n.member AS namespace, f.uri,
        f.content_checksum, f.content_length, f.content_type, f.last_modified
        FROM {archive_inventory} f JOIN members n ON n.member_type = 'namespace'
          AND starts_with(f.uri, concat(n.member, '/'))) x''', 'group_id, namespace, uri',
        'group_id, namespace, uri, ' + CONTENT)})"""


@register("archive_reconcile_summary", f"{ARCHIVE_LISTINGS}, {_reconcile_summary_sql('group_id', 'namespace')}")
def _(v):
    members = groups.audit_groups(v("archive_mappings"))
    return reconcile.reconcile_summary(
        reconcile.archive_listing_for_groups(v("observation"), v("plane"), v("artifact"), members),
        reconcile.inventory_listing_for_groups(v("archive_inventory"), members),
        on=reconcile.GROUP_FILE, by=["group_id"],
    )


OWNED = """SELECT o.collection, a.plane_id, COUNT(*) AS num_files FROM {observation} o
    JOIN {plane} p ON o.obs_id = p.obs_id JOIN {artifact} a ON a.plane_id = p.plane_id GROUP BY o.collection, a.plane_id"""


@register("owned_files", OWNED)
def _(v):
    # However small the tables, the heavy keys are looked for here.
    owners = owner_join(v("plane").select("plane_id", "obs_id"), v("observation").select("obs_id", "collection"), ["obs_id"], probe_bytes=0)
    owned = owner_join(v("artifact").select("plane_id"), owners.select("plane_id", "collection"), ["plane_id"], probe_bytes=0)
    return owned.groupBy("collection", "plane_id").agg(F.count(F.lit(1)).alias("num_files"))


@register("files_by_namespace", """WITH n AS (SELECT DISTINCT si_namespace FROM {brand_mappings}),
    u AS (SELECT uri, COUNT(*) AS c FROM {artifact} GROUP BY uri)
    SELECT si_namespace, CAST(SUM(c) AS BIGINT) AS num_files FROM n JOIN u ON starts_with(uri, concat(si_namespace, '/')) GROUP BY si_namespace""")
def _(v):
    spaces = v("brand_mappings").select("si_namespace").distinct()
    found = match_namespaces_indexed(v("artifact").select("uri"), spaces, namespace="si_namespace")
    return found.groupBy("si_namespace").agg(F.count(F.lit(1)).alias("num_files"))


# --- B: duplicates ---------------------------------------------------------------------------

FLAGS = [(t, flag_name(t)) for t in PRODUCT_TYPES]
FLAG_SQL = ", ".join(f"CASE WHEN product_type = '{t}' THEN 1 END AS {f}" for t, f in FLAGS)
COUNT_SQL = ", ".join(f"COUNT(*) FILTER (WHERE product_type = '{t}') AS {f}" for t, f in FLAGS)
FLAG_NAMES = ", ".join(f for _, f in FLAGS)
KNOWN_SQL = " + ".join(f for _, f in FLAGS)


def _uri_counts_sql(source: str, keys: str) -> str:
    return f"""counts AS (SELECT *, {KNOWN_SQL} AS n_known
        FROM (SELECT {keys}, {COUNT_SQL}, COUNT(*) AS n_rows FROM {source} GROUP BY {keys}))"""


@register("product_type_flags", f"SELECT plane_id, uri, {FLAG_SQL} FROM {{artifact}}")
def _(v):
    return duplicates.product_type_flags(v("artifact"), keep=["plane_id", "uri"])


@register("uri_type_counts", f"WITH {_uri_counts_sql('{artifact}', 'uri')} SELECT * FROM counts")
def _(v):
    return duplicates.uri_type_counts(v("artifact"))


@register("duplicate_uris",
          f"WITH {_uri_counts_sql('{artifact}', 'uri')} SELECT * FROM counts WHERE n_known > 1")
def _(v):
    return duplicates.duplicate_uris(duplicates.uri_type_counts(v("artifact")))


DUPLICATE_SUMMARY = f"""WITH owned AS (
    SELECT o.collection, a.uri, a.product_type FROM {{observation}} o
    JOIN {{plane}} p ON o.obs_id = p.obs_id JOIN {{artifact}} a ON a.plane_id = p.plane_id
    JOIN {{brand_mappings}} m ON m.collection = o.collection
      AND starts_with(a.uri, concat(m.si_namespace, '/'))),
    {_uri_counts_sql('owned', 'collection, uri')}
    SELECT collection, CAST(SUM(n_known) AS BIGINT) AS num_uris,
      COUNT(*) FILTER (WHERE n_known = 1) AS num_single_uris,
      COUNT(*) FILTER (WHERE n_known > 1) AS num_duplicate_uris,
      CAST(COALESCE(SUM(n_known) FILTER (WHERE n_known > 1), 0) AS BIGINT) AS num_duplicate_instances
    FROM counts GROUP BY collection"""


@register("duplicate_summary", DUPLICATE_SUMMARY)
def duplicate_summary(v):
    owned = duplicates.archive_artifacts_of_collections(
        v("observation"), v("plane"), v("artifact"), v("brand_mappings")
    )
    counts = duplicates.uri_type_counts(owned, ["collection", "uri"])
    return duplicates.duplicate_summary(counts, ["collection"])


@register("duplicate_uris_by_hash", ORACLE["duplicate_uris"])
def _(v):
    return duplicates.duplicate_uris_of(v("artifact"))


@register("duplicate_summary_by_hash", DUPLICATE_SUMMARY)
def _(v):
    owned = duplicates.archive_artifacts_of_collections(
        v("observation"), v("plane"), v("artifact"), v("brand_mappings")
    )
    return duplicates.duplicate_summary_of(owned, ["collection", "uri"], ["collection"])


@register("namespaces_per_collection",
          "SELECT DISTINCT collection, si_namespace AS namespace FROM {mapping_graph}")
def _(v):
    return groups.namespaces_per_collection(v("mapping_graph"))


# --- C: type profiles ------------------------------------------------------------------------

NO_PLANES = """SELECT 'NO_PLANES' AS category, collection, observation_id, max_last_modified FROM {observation} o
    WHERE NOT EXISTS (SELECT 1 FROM {plane} p WHERE p.obs_id = o.obs_id)"""


@register("no_planes", NO_PLANES)
def _(v):
    return profiles.no_planes(v("observation"), v("plane"))


# Planes with the words their listings use for their observation.
LISTED = """SELECT p.*, (SELECT collection FROM {observation} o WHERE o.obs_id = p.obs_id) AS collection,
      (SELECT observation_id FROM {observation} o WHERE o.obs_id = p.obs_id) AS observation_id
    FROM {plane} p WHERE EXISTS (SELECT 1 FROM {observation} o WHERE o.obs_id = p.obs_id)"""


def _listed_sql(category: str, condition: str) -> str:
    return f"""SELECT '{category}' AS category, collection, observation_id, plane_id, data_product_type,
      max_last_modified FROM ({LISTED}) x WHERE {condition}"""


NO_ARTIFACTS = _listed_sql("NO_ARTIFACTS", "NOT EXISTS (SELECT 1 FROM {artifact} a WHERE a.plane_id = x.plane_id)")


@register("no_artifacts", NO_ARTIFACTS)
def _(v):
    return profiles.no_artifacts(v("observation"), v("plane"), v("artifact"))


JUNK = _listed_sql("JUNK_PLANE", "quality_flag = 'junk'")


@register("junk_planes", JUNK)
def _(v):
    return profiles.junk_planes(v("observation"), v("plane"))


# A good plane has a type if any of its artifacts is of it.
PLANE_TYPES = f"""has AS (SELECT plane_id, COUNT(*) AS num_artifacts,
      {', '.join(f"CASE WHEN bool_or(product_type = '{t}') THEN 1 END AS {f}" for t, f in FLAGS)}
    FROM {{artifact}} GROUP BY plane_id),
  planes AS (SELECT (SELECT collection FROM {{observation}} o WHERE o.obs_id = p.obs_id) AS collection,
      (SELECT instrument_name FROM {{observation}} o WHERE o.obs_id = p.obs_id) AS instrument_name,
      (SELECT intent FROM {{observation}} o WHERE o.obs_id = p.obs_id) AS intent,
      p.data_product_type, has.*
    FROM has JOIN {{plane}} p USING (plane_id)
    WHERE coalesce(p.quality_flag, '') <> 'junk' AND p.obs_id IN (SELECT obs_id FROM {{observation}}))"""


def _plane_types(v):
    return profiles.plane_type_flags(v("observation"), v("plane"), v("artifact"))


@register("plane_type_flags", f"WITH {PLANE_TYPES} SELECT * EXCLUDE (num_artifacts) FROM planes")
def _(v):
    return _plane_types(v)


@register("type_profile", f"""WITH {PLANE_TYPES} SELECT 'TYPE' AS category, collection,
    instrument_name, intent, data_product_type, COUNT(*) AS num_planes, {FLAG_NAMES} FROM planes
    GROUP BY collection, instrument_name, intent, data_product_type, {FLAG_NAMES}""")
def _(v):
    return profiles.type_profile(_plane_types(v))


PROFILE_SUMMARY = f"""WITH {PLANE_TYPES}, keys AS (SELECT DISTINCT collection FROM {{observation}}),
    combos AS (SELECT DISTINCT collection, instrument_name, intent, data_product_type, {FLAG_NAMES}
      FROM planes)
    SELECT collection,
      (SELECT COUNT(*) FROM ({NO_PLANES}) x WHERE x.collection = keys.collection) AS num_no_planes,
      (SELECT COUNT(*) FROM ({NO_ARTIFACTS}) x WHERE x.collection = keys.collection)
        AS num_no_artifacts,
      (SELECT COUNT(*) FROM ({JUNK}) x WHERE x.collection = keys.collection) AS num_junk_planes,
      (SELECT COUNT(*) FROM planes x WHERE x.collection = keys.collection) AS num_planes,
      (SELECT CAST(COALESCE(SUM(num_artifacts), 0) AS BIGINT) FROM planes x WHERE x.collection = keys.collection)
        AS num_artifacts,
      (SELECT COUNT(*) FROM combos x WHERE x.collection = keys.collection) AS num_combinations
    FROM keys"""


@register("profile_summary", PROFILE_SUMMARY)
def profile_summary(v):
    return profiles.profile_summary(v("observation"), v("plane"), v("artifact"))


# --- D: previews -----------------------------------------------------------------------------

COMBO = ("collection", "instrument_name", "intent", "data_product_type", "this", "science", "calibration")
COMBO_SQL = ", ".join(COMBO)
PLANE_KEYS = """collection, observation_id, instrument_name, intent, plane_id, data_product_type,
    max_last_modified"""
PREVIEW_TYPES = ("preview", "thumbnail", "this", "science", "calibration")
# A plane is judged by what exists among its peers, the planes of its combination: one with both, else one
# with a preview, else one with a thumbnail.
PEERS = ", ".join(COMBO)
WATERFALL = f"""has AS (SELECT plane_id, {', '.join(
      f"CAST(coalesce(bool_or(product_type = '{t}'), false) AS INTEGER) AS {t}" for t in PREVIEW_TYPES)}
    FROM {{artifact}} GROUP BY plane_id),
  p0 AS (SELECT o.collection, o.observation_id, coalesce(o.instrument_name, 'None') AS instrument_name,
      coalesce(o.intent, 'None') AS intent, x.plane_id, coalesce(x.data_product_type, 'None') AS data_product_type,
      x.max_last_modified, {', '.join('x.' + t for t in PREVIEW_TYPES)}
    FROM (SELECT * FROM {{plane}} JOIN has USING (plane_id) WHERE quality_flag IS DISTINCT FROM 'junk') x
    JOIN {{observation}} o USING (obs_id)),
  known AS (SELECT *, bool_or(preview + thumbnail = 2) OVER peers AS any_both, bool_or(preview = 1) OVER peers AS any_preview,
      bool_or(thumbnail = 1) OVER peers AS any_thumbnail FROM p0 WINDOW peers AS (PARTITION BY {PEERS})),
  due AS (SELECT *, CASE WHEN any_both THEN 'BOTH' WHEN any_preview THEN 'PREVIEW_ONLY'
      WHEN any_thumbnail THEN 'THUMBNAIL_ONLY' END AS class FROM known),
  labelled AS (SELECT {PLANE_KEYS}, {', '.join(PREVIEW_TYPES)}, CASE WHEN class IS NULL THEN 'NEVER_HAD_PREVIEW'
      ELSE CASE WHEN (preview = 1 OR class = 'THUMBNAIL_ONLY') AND (thumbnail = 1 OR class = 'PREVIEW_ONLY')
        THEN 'CONSISTENT_FOR_' ELSE 'INCONSISTENT_FOR_' END || class END AS category FROM due)"""


def _preview_planes(v):
    return previews.plane_preview_flags(v("observation"), v("plane"), v("artifact"))


@register("plane_preview_flags", f"WITH {WATERFALL} SELECT * FROM p0")
def _(v):
    return previews.with_none_text(_preview_planes(v))


@register("preview_combinations", f"""WITH {WATERFALL} SELECT 'PROFILE' AS category, {COMBO_SQL},
    COUNT(*) AS num_planes FROM p0 GROUP BY {COMBO_SQL}""")
def _(v):
    return previews.with_none_text(previews.combinations(_preview_planes(v)))


@register("preview_classify", f"WITH {WATERFALL} SELECT * FROM labelled")
def _(v):
    return previews.with_none_text(previews.classify_planes(_preview_planes(v)))


@register("preview_consistent", f"""WITH {WATERFALL} SELECT category, {COMBO_SQL},
    COUNT(*) AS num_planes FROM labelled WHERE starts_with(category, 'CONSISTENT')
    GROUP BY category, {COMBO_SQL}""")
def _(v):
    counts = previews.category_counts(_preview_planes(v))
    return previews.with_none_text(previews.consistent_combinations(counts))


@register("preview_inconsistent", f"""WITH {WATERFALL} SELECT category, {PLANE_KEYS}, this, science,
    calibration FROM labelled WHERE starts_with(category, 'INCONSISTENT')""")
def _(v):
    classified = previews.classify_planes(_preview_planes(v))
    return previews.with_none_text(previews.inconsistent_planes(classified))


@register("never_had_preview", f"""WITH {WATERFALL} SELECT category, {COMBO_SQL},
    COUNT(*) AS num_planes FROM labelled WHERE category = 'NEVER_HAD_PREVIEW'
    GROUP BY category, {COMBO_SQL}""")
def _(v):
    counts = previews.category_counts(_preview_planes(v))
    return previews.with_none_text(previews.never_had_preview(counts))


PREVIEW_SUMMARY = f"""WITH {WATERFALL} SELECT collection, COUNT(*) AS num_planes,
    {', '.join(f"COUNT(*) FILTER (WHERE category = '{c}') AS num_{c.lower()}"
               for c in PREVIEW_CATEGORIES)}
    FROM labelled GROUP BY collection"""


@register("preview_summary", PREVIEW_SUMMARY)
def preview_summary(v):
    return previews.preview_summary(previews.category_counts(_preview_planes(v)))


@register("preview_all_classified", f"""WITH {WATERFALL} SELECT collection, COUNT(*) AS num_planes,
    COUNT(*) FILTER (WHERE category IN ({', '.join(repr(c) for c in PREVIEW_CATEGORIES)})) AS num_classified
    FROM labelled GROUP BY collection""")
def _(v):
    """Every plane gets one of the categories."""
    classified = previews.classify_planes(_preview_planes(v))
    return classified.groupBy("collection").agg(
        F.count(F.lit(1)).alias("num_planes"), F.count_if(F.col("category").isin(*PREVIEW_CATEGORIES)).alias("num_classified")
    )


# --- E: copies -------------------------------------------------------------------------------

SITE_VALUES = "(VALUES ('alpha'), ('beta'), ('gamma')) s(site)"


@register("site_counts", f"""SELECT '2024-01-15' AS datestamp, n.namespace, s.site,
    COUNT(f.uri) AS count FROM {{namespaces}} n CROSS JOIN {SITE_VALUES}
    LEFT JOIN {{site_inventory}} f ON f.site = s.site AND starts_with(f.uri, concat(n.namespace, '/'))
    GROUP BY n.namespace, s.site""")
def _(v):
    return copies.site_counts(v("site_inventory"), v("namespaces"), SITES, "2024-01-15")


@register("site_counts_wide", f"""SELECT '2024-01-15' AS datestamp, n.namespace,
    {', '.join(f"COUNT(*) FILTER (WHERE f.site = '{s}') AS {s}_count" for s in SITES)}
    FROM {{namespaces}} n LEFT JOIN {{site_inventory}} f ON starts_with(f.uri, concat(n.namespace, '/'))
    GROUP BY n.namespace""")
def _(v):
    counts = copies.site_counts(v("site_inventory"), v("namespaces"), SITES, "2024-01-15")
    return copies.merge_site_counts(counts, SITES)


@register("known_namespaces", "SELECT DISTINCT concat('ns', source) AS namespace FROM {documents}")
def _(v):
    requested = v("documents").select(F.concat(F.lit("ns"), "source").alias("namespace")).distinct()
    return copies.require_known_namespaces(requested, v("namespaces"))


@register("timed_counts_wide", f"""SELECT datestamp, namespace,
    {', '.join(f"max(CASE WHEN site = '{x}' THEN {c} END) AS {x}_{c}" for x in ('en', 'de', 'xx') for c in ('count', 'duration'))}
    FROM {{timed_counts}} GROUP BY datestamp, namespace""")
def _(v):
    return copies.merge_site_counts(v("timed_counts"), ["en", "de", "xx"])


# --- F: null usage ---------------------------------------------------------------------------

OBS_FIELDS = ("collection", "instrument_name", "intent", "max_last_modified", "meta_release", "obs_id",
              "observation_id")
PLANE_FIELDS = ("data_product_type", "max_last_modified", "obs_id", "plane_id", "quality_flag")
USABLE = "instrument_name IS NOT NULL AND instrument_name <> 'NULL'"
OBS_ROWS = f"(SELECT * FROM {{observation}} WHERE {USABLE})"
PLANE_ROWS = f"""(SELECT o.collection, o.instrument_name, p.* FROM {{observation}} o
    JOIN {{plane}} p ON o.obs_id = p.obs_id WHERE {USABLE})"""


def _null_sql(by: str, obs_fields=OBS_FIELDS, plane_fields=PLANE_FIELDS) -> str:
    """One query per field, as the reports are described."""
    parts = [
        f"""SELECT '{table}' AS table_name, '{table}.{f}' AS field, {by},
            COUNT(*) FILTER (WHERE x.{f} IS NULL) AS num_null, COUNT(*) AS num_instances
            FROM {rows} x GROUP BY {by}"""
        for table, rows, fields in (
            ("Observation", OBS_ROWS, obs_fields), ("Plane", PLANE_ROWS, plane_fields))
        for f in fields
    ]
    return " UNION ALL ".join(parts)


PCT = "ROUND(100.0::DOUBLE * num_null / num_instances, 2) AS percentage_null"
CI = "collection, instrument_name"


@register("obs_totals",
          f"SELECT {CI}, COUNT(*) AS num_instances FROM {{observation}} WHERE {USABLE} GROUP BY {CI}")
def _(v):
    return usage.obs_totals(v("observation"))


@register("plane_totals", f"SELECT {CI}, COUNT(*) AS num_instances FROM {PLANE_ROWS} GROUP BY {CI}")
def _(v):
    return usage.plane_totals(v("observation"), v("plane"))


@register("null_usage_obs", f"""SELECT *, {PCT} FROM ({_null_sql(CI, plane_fields=())})
    WHERE num_null > 0""")
def _(v):
    fields = usage.field_catalog(v("observation"), v("plane"))
    return usage.with_nulls(usage.null_usage_obs(v("observation"), fields))


@register("null_usage_plane", f"""SELECT *, {PCT} FROM ({_null_sql(CI, obs_fields=())})
    WHERE num_null > 0""")
def _(v):
    fields = usage.field_catalog(v("observation"), v("plane"))
    return usage.with_nulls(usage.null_usage_plane(v("observation"), v("plane"), fields))


def _usage(v, start=None, end=None, by=usage.COLLECTION_INSTRUMENT):
    fields = usage.field_range(usage.field_catalog(v("observation"), v("plane")), start, end)
    return usage.null_usage(v("observation"), v("plane"), fields, by)


@register("null_usage_collection", f"SELECT *, {PCT} FROM ({_null_sql('collection')}) WHERE num_null > 0")
def _(v):
    return usage.with_nulls(_usage(v, by=usage.COLLECTION))


@register("null_usage_footers", f"SELECT *, {PCT} FROM ({_null_sql('collection')}) WHERE num_null > 0")
def _(v):
    observation, plane = v("observation"), v("plane")
    path = f"{ensure_checkpoint_dir(observation.sparkSession)}/stocktake-footers-{uuid.uuid4().hex}"
    usage.write_for_footers(observation, plane, path)
    fields = usage.field_catalog(observation, plane)
    return usage.with_nulls(usage.null_usage_from_footers(observation, plane, path, fields, usage.COLLECTION))


@register("null_usage_rollup", f"""SELECT granularity, table_name, field, collection, instrument_name,
    num_null, num_instances, {PCT} FROM (
      SELECT 'collection_instrument' AS granularity, * FROM ({_null_sql(CI)})
      UNION ALL BY NAME
      SELECT 'collection' AS granularity, *, NULL AS instrument_name FROM ({_null_sql('collection')}))""")
def _(v):
    return usage.null_usage_rollup(_usage(v))


@register("null_usage_range", f"""SELECT *, {PCT} FROM ({_null_sql(
    CI, obs_fields=OBS_FIELDS[2:], plane_fields=PLANE_FIELDS[:2])}) WHERE num_null > 0""")
def _(v):
    return usage.with_nulls(_usage(v, "Observation.intent", "Plane.max_last_modified"))


SPELLED = ("accMetaChecksum", "collection", "instrument_name", "intent", "maxLastModified", "metaRelease", "obsID")


@register("null_usage_spelled", f"""SELECT *, {PCT} FROM ({' UNION ALL '.join(
    f"SELECT 'Observation' AS table_name, 'Observation.{f}' AS field, {CI}, COUNT(*) - COUNT(\"{f}\") AS num_null, COUNT(*) AS num_instances FROM {{source_observation}} WHERE {USABLE} GROUP BY {CI}"
    for f in SPELLED)}) WHERE num_null > 0""")
def _(v):
    """Fields and the ends of their range as the source spells them."""
    observation = conform(v("source_observation"), StructType([f for f in OBSERVATION if f.name != "observation_id"]), extra=True)
    fields = usage.field_catalog(observation, v("plane"))
    fields = usage.field_range(fields, "Observation.accMetaChecksum", "Observation.obsID")
    return usage.with_nulls(usage.null_usage_obs(observation, fields))


@register("fields_by_group", f"""WITH nulls AS (SELECT *, {PCT} FROM ({_null_sql(CI)}) WHERE num_null > 0),
    groups AS (SELECT DISTINCT {CI} FROM {OBS_ROWS})
    SELECT {CI}, field, num_null, num_instances, percentage_null
    FROM groups LEFT JOIN nulls USING ({CI})""")
def _(v):
    return usage.fields_by_group(_usage(v), usage.obs_totals(v("observation")))


def _by_field_sql(by):
    return f"""SELECT field, COUNT(*) AS num_groups,
    COUNT(*) FILTER (WHERE num_null > 0) AS groups_with_null,
    ROUND(100.0::DOUBLE * COUNT(*) FILTER (WHERE num_null > 0) / COUNT(*), 2) AS percentage_groups,
    CAST(SUM(num_instances) AS BIGINT) AS num_instances,
    CAST(SUM(num_null) AS BIGINT) AS instances_with_null,
    ROUND(100.0::DOUBLE * CAST(SUM(num_null) AS BIGINT) / CAST(SUM(num_instances) AS BIGINT), 2)
      AS percentage_instances
    FROM ({_null_sql(by)}) GROUP BY field"""


@register("usage_by_field", _by_field_sql(CI))
def _(v):
    return usage.usage_by_field(_usage(v))


@register("usage_by_field_collection", _by_field_sql("collection"))
def _(v):
    return usage.usage_by_field(_usage(v, by=usage.COLLECTION))


def _by_group_sql(by):
    return f"""SELECT table_name, {by}, COUNT(*) AS num_fields,
    COUNT(*) FILTER (WHERE num_null > 0) AS fields_with_null,
    ROUND(100.0::DOUBLE * COUNT(*) FILTER (WHERE num_null > 0) / COUNT(*), 2) AS percentage_fields,
    CAST(SUM(num_instances) AS BIGINT) AS num_instances,
    CAST(SUM(num_null) AS BIGINT) AS instances_with_null,
    ROUND(100.0::DOUBLE * CAST(SUM(num_null) AS BIGINT) / CAST(SUM(num_instances) AS BIGINT), 2)
      AS percentage_instances
    FROM ({_null_sql(by)}) GROUP BY table_name, {by}"""


def _by_group(v, by):
    fields = usage.field_catalog(v("observation"), v("plane"))
    return usage.usage_by_group(usage.null_usage(v("observation"), v("plane"), fields, by), fields, fields, by)


@register("usage_by_group", _by_group_sql(CI))
def _(v):
    return _by_group(v, usage.COLLECTION_INSTRUMENT)


@register("usage_by_group_collection", _by_group_sql("collection"))
def _(v):
    return _by_group(v, usage.COLLECTION)


# --- G: harvest monitoring -------------------------------------------------------------------

@register("obs_counts_by_site", """SELECT s.site, COUNT(o.site) AS num_observations
    FROM (VALUES ('origin'), ('mirror'), ('public')) s(site)
    LEFT JOIN {site_observation} o ON o.site = s.site AND o.collection = 'BUILDING' GROUP BY s.site""")
def _(v):
    return harvest.obs_counts_by_site(v("site_observation"), "BUILDING", SERVICES)


@register("missing_release", """SELECT COUNT(*) AS num_observations FROM {observation}
    WHERE collection = 'BUILDING' AND meta_release IS NULL""")
def _(v):
    return harvest.missing_release(v("observation"), "BUILDING")


@register("harvested_since", """SELECT COUNT(*) AS num_observations FROM {observation}
    WHERE collection = 'BUILDING'
      AND max_last_modified >= TIMESTAMP '2001-01-01 00:00:00' - INTERVAL 24 HOURS""")
def _(v):
    return harvest.harvested_since(v("observation"), "BUILDING", HARVEST_ASOF)


TODO = "FROM {harvest_skip} WHERE cname = 'Observation' AND source LIKE '%SKY%'"


@register("retry_queue", f"""SELECT (SELECT COUNT(*) {TODO}) AS num_todo,
    (SELECT COUNT(*) {TODO} AND try_after <= TIMESTAMP '2024-01-15 00:00:00') AS num_due,
    (SELECT COUNT(*) {TODO} AND try_after > TIMESTAMP '2024-01-15 00:00:00') AS num_future,
    (SELECT COUNT(*) {TODO} AND error_message IS NOT NULL) AS num_error""")
def _(v):
    return harvest.retry_queue(v("harvest_skip"), "Observation", "SKY", ASOF)


@register("error_digest", f"""SELECT substring(error_message, 1, 40) AS msg, COUNT(*) AS num_failed,
    MIN(skip_id) AS example, MIN(try_after) AS min_try_after, MAX(try_after) AS max_try_after
    {TODO} AND error_message IS NOT NULL GROUP BY 1""")
def _(v):
    return harvest.error_digest(v("harvest_skip"), "Observation", "SKY")


@register("error_dump", f"SELECT * {TODO} AND error_message IS NOT NULL")
def _(v):
    return harvest.error_dump(v("harvest_skip"), "Observation", "SKY")


@register("prefix_volume", """SELECT COUNT(*) AS num_files,
    CAST(SUM(content_length) AS DOUBLE) / POW(1024.0, 4) AS tib
    FROM {plane} p JOIN {artifact} a ON p.plane_id = a.plane_id WHERE starts_with(a.uri, 'Brand#1/')""")
def _(v):
    return harvest.prefix_volume(v("plane"), v("artifact"), "Brand#1")


# --- H, X: reports and configuration ---------------------------------------------------------

SUMMARIES = {
    "reconcile": (reconcile_summary, RECONCILE_SUMMARY,
                  ["num_catalog", "catalog_bytes", "num_inventory", "inventory_bytes", "num_consistent",
                   "num_missing_in_inventory", "num_missing_in_catalog", "num_diff_checksums",
                   "num_diff_lengths", "num_diff_types", "num_undetermined"]),
    "duplicates": (duplicate_summary, DUPLICATE_SUMMARY,
                   ["num_uris", "num_single_uris", "num_duplicate_uris", "num_duplicate_instances"]),
    "profiles": (profile_summary, PROFILE_SUMMARY,
                 ["num_no_planes", "num_no_artifacts", "num_junk_planes", "num_planes",
                  "num_artifacts", "num_combinations"]),
    "previews": (preview_summary, PREVIEW_SUMMARY,
                 ["num_planes", *[f"num_{c.lower()}" for c in PREVIEW_CATEGORIES]]),
}


def _audit_summary_sql() -> str:
    tables = ", ".join(f"s_{a} AS ({with_views(sql)})" for a, (_, sql, _) in SUMMARIES.items())
    rows = " UNION ".join(
        f"SELECT '{a}' AS audit, collection AS scope, '{m}' AS metric, CAST({m} AS BIGINT) AS value FROM s_{a}"
        for a, (_, _, metrics) in SUMMARIES.items() for m in metrics
    )
    return f"WITH {tables} {rows}"


@register("audit_summary", _audit_summary_sql())
def _(v):
    # Two of the audits need the artifacts folded by plane; that happens once. One audit runs after the other, so that what one
    # puts on disk is gone when the next begins.
    with kept(profiles.artifact_types_by_plane(v("artifact")), "artifact-types") as folded:
        known, spark = {"artifact": folded}, folded.sparkSession
        summaries = {
            a: (settled(spark, partial(fn, v if a == "duplicates" else lambda n: known.get(n) or v(n)), f"summary-{a}"), "collection")
            for a, (fn, _, _) in SUMMARIES.items()
        }
    return reports.audit_summary(summaries)


@register("collection_site", """SELECT c.collection, c.ams_site, s.site_url
    FROM {collections} c LEFT JOIN {ams_sites} s ON s.site_name = c.ams_site""")
def _(v):
    return config.collection_site(v("collections"), v("ams_sites"))


@register("select_collections", """SELECT collection, in_si, ams_site FROM {collections}
    WHERE in_si AND ams_site <> 'S3' AND collection IN (SELECT collection FROM {requested})""")
def _(v):
    return config.select_collections(v("collections"), v("requested"), unsupported_site="S3")


@register("select_all_collections", """SELECT collection, in_si, ams_site FROM {collections}
    WHERE ams_site <> 'S3'""")
def _(v):
    return config.select_collections(v("collections"), stored_only=False, unsupported_site="S3")


# --- M: manifests ----------------------------------------------------------------------------

@register("newest_upload", r"""WITH f AS (
    SELECT *, regexp_matches(name, '\.(tar\.gz|tar|zip|rar|7z)$') AS b,
      row_number() OVER (PARTITION BY dir ORDER BY modified DESC NULLS LAST, name) AS rn
    FROM (SELECT DISTINCT * FROM {upload_listing}) u),
    w AS (SELECT *, first_value(b) OVER (PARTITION BY dir ORDER BY rn) AS top FROM f)
    SELECT dir, name, modified, owner,
      CASE WHEN top AND rn = 1 THEN 'BUNDLE_TAKEN' WHEN top AND b THEN 'OLDER_BUNDLE'
           WHEN top THEN 'OLDER_FILE' WHEN b THEN 'ORPHAN_BUNDLE' ELSE 'FILE_TAKEN' END AS outcome
    FROM w""")
def _(v):
    return manifests.newest_upload(v("upload_listing"))


@register("listing_filter", """SELECT dir, split_part(name, ' ', -1) AS name, modified, owner
    FROM {upload_listing}
    WHERE owner <> 'service' AND name NOT LIKE '%.pptx%' AND name NOT LIKE '%.mp4%'
      AND name NOT LIKE '%.avi%' AND name NOT ILIKE '%slides%' AND name NOT ILIKE '%sliides%'
      AND name NOT ILIKE '%poster%' AND name NOT ILIKE '%lightning%'
      AND NOT contains(name, concat(dir, '.pdf'))""")
def _(v):
    return manifests.listing_filter(v("upload_listing"), owner="service")


@register("manifest_diff", """WITH s AS (SELECT * FROM {source_manifest} WHERE NOT
      (concat(dir, '/', name) LIKE '%tar%' OR name LIKE '%.rar' OR name LIKE '%.zip'))
    SELECT s.dir, s.name, CASE WHEN t.name IS NULL THEN 'COPY' WHEN s.checksum = t.checksum THEN 'SAME'
      ELSE 'DIFFERS' END AS action
    FROM s LEFT JOIN {target_manifest} t ON s.dir = t.dir AND s.name = t.name
    UNION ALL
    SELECT t.dir, t.name, 'STALE' FROM {target_manifest} t
    WHERE t.dir IN (SELECT dir FROM {source_manifest})
      AND NOT EXISTS (SELECT 1 FROM {source_manifest} x WHERE x.dir = t.dir AND x.name = t.name)""")
def _(v):
    return manifests.manifest_diff(v("source_manifest"), v("target_manifest"))


@register("not_listed", """SELECT DISTINCT d.name FROM {contributions} d
    WHERE substring(d.name, 1, 1) IN ('B', 'C', 'F', 'I', 'P', 'T')
      AND NOT EXISTS (SELECT 1 FROM {contents} t WHERE contains(t.line, d.name))""")
def _(v):
    return manifests.not_listed(v("contributions"), v("contents"))


UNEXPECTED = "SELECT * FROM {upload_listing} WHERE " + " AND ".join(
    f"NOT regexp_matches(concat(dir, '/', name), '{kind}')" for kind in EXPECTED_KINDS
)


@register("unexpected_files", UNEXPECTED)
def _(v):
    return manifests.unexpected_files(v("upload_listing"))


@register("unexpected_extensions", f"""SELECT DISTINCT split_part(name, '.', -1) AS extension
    FROM ({UNEXPECTED}) WHERE contains(name, '.')""")
def _(v):
    return manifests.unexpected_extensions(v("upload_listing"))
