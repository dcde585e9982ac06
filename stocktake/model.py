"""Table schemas, vocabularies and category names shared by all audits.

Operators work on the canonical snake_case columns below. ``sources.conform``
renames and casts whatever a source calls them.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _schema(**fields) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields.items()])


_STR, _LONG, _TS, _BOOL = StringType(), LongType(), TimestampNTZType(), BooleanType()

OBSERVATION = _schema(
    obs_id=_STR, observation_id=_STR, collection=_STR, instrument_name=_STR, intent=_STR,
    meta_release=_TS, max_last_modified=_TS,
)
PLANE = _schema(
    plane_id=_STR, obs_id=_STR, data_product_type=_STR, quality_flag=_STR, max_last_modified=_TS,
)
ARTIFACT = _schema(
    artifact_id=_STR, plane_id=_STR, uri=_STR, product_type=_STR, content_checksum=_STR,
    content_length=_LONG, content_type=_STR, last_modified=_TS,
)
INVENTORY = _schema(
    site=_STR, uri=_STR, content_checksum=_STR, content_length=_LONG, content_type=_STR,
    last_modified=_TS,
)
HARVEST_SKIP = _schema(
    skip_id=_LONG, cname=_STR, source=_STR, try_after=_TS, error_message=_STR,
)
MAPPINGS = _schema(collection=_STR, si_namespace=_STR)
COLLECTIONS = _schema(collection=_STR, in_si=_BOOL, ams_site=_STR)
AMS_SITES = _schema(site_name=_STR, site_url=_STR)
NAMESPACES = _schema(namespace=_STR)
SI_SITES = _schema(site_name=_STR, url=_STR)
SITE_COUNTS = _schema(datestamp=_STR, namespace=_STR, site=_STR, count=_LONG, duration=DoubleType())
MANIFEST = _schema(dir=_STR, name=_STR, modified=_TS, owner=_STR, length=_LONG, checksum=_STR)

# Column names the archive services use -> canonical names.
ARCHIVE_NAMES = {
    "obsID": "obs_id",
    "observationID": "observation_id",
    "metaRelease": "meta_release",
    "maxLastModified": "max_last_modified",
    "planeID": "plane_id",
    "dataProductType": "data_product_type",
    "artifactID": "artifact_id",
    "productType": "product_type",
    "contentChecksum": "content_checksum",
    "contentLength": "content_length",
    "contentType": "content_type",
    "lastModified": "last_modified",
    "skipID": "skip_id",
    "tryAfter": "try_after",
    "errorMessage": "error_message",
}

# The inventory carries two times; the one audited is that of the content.
INVENTORY_NAMES = {old: new for old, new in ARCHIVE_NAMES.items() if new != "last_modified"}
INVENTORY_NAMES["contentLastModified"] = "last_modified"


def names_for(schema: StructType) -> dict[str, str]:
    """The source names of a table with this schema: files without a plane are the inventory's."""
    held = "uri" in schema.names and "plane_id" not in schema.names
    return INVENTORY_NAMES if held else ARCHIVE_NAMES


# The archive's product-type vocabulary, in report order.
PRODUCT_TYPES = (
    "this", "science", "calibration", "preview", "thumbnail", "auxiliary", "bias", "coderived",
    "dark", "documentation", "error", "flat", "info", "noise", "preview-image", "preview-plot",
    "weight",
)

# Archive endings that make an upload a bundle.
BUNDLE_ENDINGS = (".tar.gz", ".tar", ".zip", ".rar", ".7z")

# Uploads never copied, case-sensitive and case-insensitive name parts.
UNWANTED_PARTS = (".pptx", ".mp4", ".avi")
UNWANTED_PARTS_ANY_CASE = ("slides", "sliides", "poster", "lightning")

# Regular expressions of the file kinds a paper directory may hold.
EXPECTED_KINDS = (
    ".tex", ".bib", ".eps", r"\bmakedefs\b", "(?i)copyright", ".tar*", ".zip", ".rar",
)

# First letters of a contribution's directory name.
CONTRIBUTION_LETTERS = ("B", "C", "F", "I", "P", "T")

# Names of a file's content columns, in the order they are compared.
CONTENT = ("content_checksum", "content_length", "content_type")

JUNK = "junk"

CONSISTENT = "CONSISTENT"
MISSING_IN_INVENTORY = "MISSING_IN_INVENTORY"
MISSING_IN_CATALOG = "MISSING_IN_CATALOG"
DIFF_CHECKSUMS = "DIFF_CHECKSUMS"
DIFF_LENGTHS = "DIFF_LENGTHS"
DIFF_TYPES = "DIFF_TYPES"
UNDETERMINED = "UNDETERMINED"
RECONCILE_CATEGORIES = (
    CONSISTENT, MISSING_IN_INVENTORY, MISSING_IN_CATALOG, DIFF_CHECKSUMS, DIFF_LENGTHS, DIFF_TYPES,
    UNDETERMINED,
)

PREVIEW_CLASSES = ("BOTH", "PREVIEW_ONLY", "THUMBNAIL_ONLY")
NEVER_HAD_PREVIEW = "NEVER_HAD_PREVIEW"
PREVIEW_CATEGORIES = tuple(
    f"{verdict}_FOR_{cls}" for cls in PREVIEW_CLASSES for verdict in ("CONSISTENT", "INCONSISTENT")
) + (NEVER_HAD_PREVIEW,)


def flag_name(product_type: str) -> str:
    """Column name of a product type: ``preview-image`` -> ``preview_image``."""
    return product_type.replace("-", "_")
