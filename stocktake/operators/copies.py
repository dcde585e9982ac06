"""Files held per namespace at every storage site."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stocktake.functions.prefixes import match_namespaces


def site_counts(
    inventory: DataFrame,
    namespaces: DataFrame,
    sites: Sequence[str],
    datestamp: str | None = None,
) -> DataFrame:
    """(datestamp, namespace, site, count) for all namespaces and sites, 0 where nothing is held."""
    known = namespaces.select("namespace").distinct()
    files = match_namespaces(inventory.select("site", "uri"), known)
    held = files.groupBy("namespace").agg(
        *[F.count_if(F.col("site") == s).alias(f"_at_{i}") for i, s in enumerate(sites)]
    )
    per_site = F.array(*[
        F.struct(
            F.lit(s).alias("site"),
            F.coalesce(F.col(f"_at_{i}"), F.lit(0).cast("long")).alias("count"),
        )
        for i, s in enumerate(sites)
    ])
    return known.join(held, "namespace", "left").select(
        F.lit(datestamp).cast("string").alias("datestamp"), "namespace", F.inline(per_site)
    )


def merge_site_counts(
    counts: DataFrame, sites: Sequence[str], namespaces: DataFrame | None = None
) -> DataFrame:
    """One row per namespace with ``{site}_count`` (and ``{site}_duration``) columns.

    With ``namespaces`` given, a namespace no site reported keeps a row of nulls.
    """
    values = [c for c in ("count", "duration") if c in counts.columns]
    # A site reports a namespace once, so max only picks that value. Two aggregates make
    # Spark name the columns {site}_{value}; one alone would be named {site}.
    wide = counts.groupBy("datestamp", "namespace").pivot("site", list(sites)).agg(
        *[F.max(v).alias(v) for v in values]
    )
    if len(values) == 1:
        wide = wide.withColumnsRenamed({s: f"{s}_{values[0]}" for s in sites})
    if namespaces is not None:
        wide = namespaces.select("namespace").distinct().join(wide, "namespace", "left")
    return wide.select("datestamp", "namespace", *[f"{s}_{v}" for s in sites for v in values])


def require_known_namespaces(requested: DataFrame, namespaces: DataFrame) -> DataFrame:
    """``requested``, failing when run if one of them is not configured."""
    known = namespaces.select("namespace").distinct().withColumn("_known", F.lit(True))
    error = F.raise_error(F.concat(F.lit("unknown namespace: "), "namespace"))
    return requested.join(known, "namespace", "left").where(
        F.coalesce("_known", error.cast("boolean"))
    ).drop("_known")
