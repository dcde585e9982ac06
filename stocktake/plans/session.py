"""Session settings the audits rely on."""

from __future__ import annotations

import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime re-planning does the per-size decisions: broadcast or not, skewed joins, partition counts.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Null counts of wide tables aggregate hundreds of columns; they stay in generated code.
    "spark.sql.codegen.maxFields": "2000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which all executors share.

    Where it is unset, a local session, which is one process, makes one of its own;
    on a cluster leaving it out is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="stocktake-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Shuffle files of what runs inside go as soon as it has run, not when the driver next collects garbage.

    Only for frames that are made inside and run once, as a write makes its own.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
