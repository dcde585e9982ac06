"""Write reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _save(df: DataFrame, path: str, format: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if format == "tsv":
        writer.options(header=True, sep="\t").csv(path)
    elif format == "csv":
        writer.options(header=True).csv(path)
    else:
        writer.format(format).save(path)


def write_sections(
    df: DataFrame, path: str, order: Sequence[str | Column] = (), format: str = "tsv"
) -> None:
    """One folder per category, its rows in ``order``.

    The sort is a distributed range sort over category and order, so a large
    section spans many ordered files instead of passing through one task.
    """
    rows = df.orderBy("category", *order) if order else df
    _save(rows, path, format, ["category"])


def write_by_group(
    df: DataFrame, path: str, by: Sequence[str], order: Sequence[str | Column] = (), format: str = "csv"
) -> None:
    """One folder per group."""
    rows = df.orderBy(*by, *order) if order else df
    _save(rows, path, format, by)


def write_table(
    df: DataFrame, path: str, order: Sequence[str | Column] = (), format: str = "tsv"
) -> None:
    _save(df.orderBy(*order) if order else df, path, format)


def section_counts(df: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Rows per category, 0 for a section that stays empty."""
    counts = df.agg(*[F.count_if(F.col("category") == c).alias(c) for c in categories])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("category"), F.col(c).alias("num_rows")) for c in categories
    ])))
