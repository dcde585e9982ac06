"""The corpus pipeline: stages over documents, each written and read again as the next one's input.

Documents that score as toxic go; of each group of near copies one document stays; documents that hold benchmark items go; the rest is
taken as often as the mix of sources asks and put into training order; the last stage deals it into shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stocktake.llm import decontaminate, jaccard, mixing, sharding, toxicity
from stocktake.llm.common import staged, table

#: SQL has no expression for the classifier, the random walks or the components.
ORACLE_SQL = None


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half by the model fitted on the labelled ones among them."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    return jaccard.one_of_each(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return mixing.mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard of every document."""
    return sharding.shards(docs)


STAGES = [
    ("toxicity", not_toxic),
    ("n-gram Jaccard join", no_near_copies),
    ("benchmark decontamination", no_benchmark),
    ("mixing sources to target weights", mixed),
    ("sharding", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards of the documents that pass all stages."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.split(" ")[0])
    return STAGES[-1][1](spark, docs, sf_dir)
