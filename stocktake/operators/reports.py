"""One summary from many audits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def collect_summaries(reports: Sequence[DataFrame]) -> DataFrame:
    """All summary rows of reports of one kind, repeats dropped."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), reports).distinct()


def summary_metrics(summary: DataFrame, audit: str, scope: str) -> DataFrame:
    """A summary as (audit, scope, metric, value) rows, so that different audits stack."""
    metrics = [c for c in summary.columns if c != scope]
    values = F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("long").alias("value")) for c in metrics
    ])
    return summary.select(F.lit(audit).alias("audit"), F.col(scope).alias("scope"), F.inline(values))


def audit_summary(summaries: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Summaries of different audits, given as ``{audit: (summary, scope column)}``, in one table."""
    return collect_summaries([summary_metrics(df, audit, scope) for audit, (df, scope) in summaries.items()])
