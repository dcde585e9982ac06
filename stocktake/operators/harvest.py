"""Daily figures on the harvesting of one collection."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, functions as F

from stocktake.functions.numbers import tebibytes
from stocktake.functions.prefixes import under


def _moment(at: datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def obs_counts_by_site(observation: DataFrame, collection: str, sites: Sequence[str]) -> DataFrame:
    """Observations of the collection at each service, 0 where it has none."""
    counts = observation.where(F.col("collection") == collection).agg(
        *[F.count_if(F.col("site") == s).alias(f"_at_{i}") for i, s in enumerate(sites)]
    )
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(s).alias("site"), F.col(f"_at_{i}").alias("num_observations"))
        for i, s in enumerate(sites)
    ])))


def missing_release(observation: DataFrame, collection: str) -> DataFrame:
    """Observations of the collection without a release date."""
    return observation.where(
        (F.col("collection") == collection) & F.col("meta_release").isNull()
    ).agg(F.count(F.lit(1)).alias("num_observations"))


def harvested_since(
    observation: DataFrame, collection: str, asof: datetime, hours: int = 24
) -> DataFrame:
    """Observations of the collection changed in the ``hours`` before ``asof`` or later."""
    return observation.where(
        (F.col("collection") == collection)
        & (F.col("max_last_modified") >= _moment(asof - timedelta(hours=hours)))
    ).agg(F.count(F.lit(1)).alias("num_observations"))


def observation_figures(observation: DataFrame, collection: str, asof: datetime, hours: int = 24) -> DataFrame:
    """``missing_release`` and ``harvested_since`` in one row, from one pass: num_missing_release, num_harvested."""
    since = F.col("max_last_modified") >= _moment(asof - timedelta(hours=hours))
    return observation.where(F.col("collection") == collection).agg(
        F.count_if(F.col("meta_release").isNull()).alias("num_missing_release"), F.count_if(since).alias("num_harvested")
    )


def _queue(skip: DataFrame, cname: str, source_part: str) -> DataFrame:
    return skip.where((F.col("cname") == cname) & F.col("source").contains(source_part))


def retry_queue(skip: DataFrame, cname: str, source_part: str, asof: datetime) -> DataFrame:
    """Size of the retry queue: all, due, not yet due, failed. An entry without a time is only in all."""
    return _queue(skip, cname, source_part).agg(*_queue_counts(asof))


def _queue_counts(asof: datetime) -> list[Column]:
    at = _moment(asof)
    return [
        F.count(F.lit(1)).alias("num_todo"),
        F.count_if(F.col("try_after") <= at).alias("num_due"),
        F.count_if(F.col("try_after") > at).alias("num_future"),
        F.count("error_message").alias("num_error"),
    ]


def observed_errors(skip: DataFrame, cname: str, source_part: str, asof: datetime) -> tuple[DataFrame, Observation]:
    """``error_dump``, and the counts of ``retry_queue`` as what Spark observes while the dump is first computed.

    The counts are there once the dump was written; it must not be sorted on the way, which would read it twice.
    """
    counts = Observation("retry queue")
    queue = _queue(skip, cname, source_part).observe(counts, *_queue_counts(asof))
    return queue.where(F.col("error_message").isNotNull()), counts


def error_digest(skip: DataFrame, cname: str, source_part: str, width: int = 40) -> DataFrame:
    """Failures by the first ``width`` characters of their message."""
    failed = _queue(skip, cname, source_part).where(F.col("error_message").isNotNull())
    return failed.groupBy(F.substring("error_message", 1, width).alias("msg")).agg(
        F.count(F.lit(1)).alias("num_failed"),
        F.min("skip_id").alias("example"),
        F.min("try_after").alias("min_try_after"),
        F.max("try_after").alias("max_try_after"),
    )


def error_dump(skip: DataFrame, cname: str, source_part: str) -> DataFrame:
    """Every failed entry; order by ``skip_id`` when writing it."""
    return _queue(skip, cname, source_part).where(F.col("error_message").isNotNull())


def prefix_volume(plane: DataFrame, artifact: DataFrame, namespace: str) -> DataFrame:
    """Files and TiB the planes hold under a namespace.

    Files are counted per plane before they meet the planes. The sum runs over
    decimals, so it is exact and the same in any order.
    """
    files = artifact.where(under("uri", namespace)).groupBy("plane_id").agg(
        F.count(F.lit(1)).alias("files"), F.sum(F.col("content_length").cast("decimal(20,0)")).alias("size")
    )
    held = files.join(plane.select("plane_id"), "plane_id")
    return held.agg(
        F.coalesce(F.sum("files"), F.lit(0).cast("long")).alias("num_files"), tebibytes(F.sum("size")).alias("tib")
    )
