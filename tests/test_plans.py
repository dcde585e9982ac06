"""The physical plans the operators must keep."""

import re

import pytest
from pyspark.sql import functions as F

from stocktake.functions.dedupe import dedupe_first, newest_first
from stocktake.functions.prefixes import match_namespaces
from stocktake.operators import manifests, reconcile, usage
from stocktake.plans.session import configure
from workload.registry import QUERIES

SMALL = "/root/testdata/sf0.001"


def plan(df, run=False):
    if run:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def count(text, word):
    return len(re.findall(word, text))


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are for large tables on both sides."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _listing(spark, tmp_path, name):
    path = str(tmp_path / name)
    spark.range(100).select(
        F.concat(F.lit("n/"), F.col("id")).alias("uri"), F.lit("c").alias("content_checksum"),
        F.col("id").alias("content_length"), F.lit("t").alias("content_type"),
        F.lit("m").alias("last_modified"), F.lit("never used").alias("other"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_copies_are_dropped_before_the_shuffle(spark, tmp_path):
    text = plan(dedupe_first(_listing(spark, tmp_path, "a"), ["uri"], newest_first()))
    limits = re.findall(r"WindowGroupLimit.*?(Partial|Final)", text)
    assert sorted(limits) == ["Final", "Partial"] and count(text, "Exchange") == 1
    assert text.index("Exchange") < text.index("Partial")


def test_reconcile_has_one_join_and_one_shuffle_per_side(spark, tmp_path, no_broadcast):
    sides = [dedupe_first(_listing(spark, tmp_path, n), ["uri"], newest_first()) for n in "ab"]
    text = plan(reconcile.reconcile(*sides))
    assert count(text, "Join") == 1 and count(text, "Exchange") == 2
    assert "other" not in text
    summary = plan(reconcile.reconcile_summary(*sides), run=True)
    assert count(summary, "FileScan") == 2 and count(summary, "ReusedExchange") == 2


def test_fixed_namespace_reaches_the_scan(spark, tmp_path):
    text = plan(reconcile.inventory_listing(_listing(spark, tmp_path, "a"), "n"))
    assert "StringStartsWith(uri,n/)" in text


def test_namespace_match_is_a_hash_join(spark, tmp_path):
    listing = _listing(spark, tmp_path, "a")
    text = plan(match_namespaces(listing, spark.createDataFrame([("n",)], "namespace string")))
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text


def test_all_fields_take_one_scan(spark, tmp_path):
    path = str(tmp_path / "obs")
    spark.range(10).select(
        F.col("id").alias("obs_id"), F.lit("A").alias("collection"), F.lit("i").alias("instrument_name"),
        *[F.lit(1).alias(f"f{i}") for i in range(150)],
    ).write.parquet(path)
    obs = spark.read.parquet(path)
    fields = [f"Observation.f{i}" for i in range(150)]
    text = plan(usage.null_usage_obs(obs, fields))
    assert count(text, "FileScan") == 1 and count(text, "Exchange") == 1
    configure(spark)
    assert "*(1) HashAggregate" in plan(usage.null_usage_obs(obs, fields), run=True)
    few = plan(usage.null_usage_obs(obs, fields[:2]))
    assert "ReadSchema: struct<collection:string,instrument_name:string,f0:int,f1:int>" in few


def test_planes_travel_as_bits(spark, tmp_path, no_broadcast):
    path = str(tmp_path / "plane")
    spark.range(10).select(
        F.col("id").alias("plane_id"), F.col("id").alias("obs_id"),
        *[F.lit("long text").alias(f"f{i}") for i in range(70)],
    ).write.parquet(path)
    obs = spark.createDataFrame([(1, "A", "i")], "obs_id long, collection string, instrument_name string")
    counts = usage.null_usage_plane(obs, spark.read.parquet(path), [f"Plane.f{i}" for i in range(70)])
    below = [line for line in plan(counts).splitlines() if "_word_1" in line and "Project" in line]
    assert below and all("f69#" not in line.split(" AS ")[-1] for line in below)


def test_artifacts_shuffle_once(spark, no_broadcast):
    text = plan(QUERIES["plane_type_flags"](spark, SMALL))
    partial = text.index("partial_max")
    assert "hashpartitioning(plane_id" in text[:partial]
    assert text[:partial].count("SortMergeJoin") == 2


def test_previews_are_counted_without_a_join_back(spark, no_broadcast):
    text = plan(QUERIES["preview_summary"](spark, SMALL))
    assert count(text, "SortMergeJoin") == 4  # two in the views, two of the audit
    both = plan(QUERIES["preview_classify"](spark, SMALL), run=True)
    # The planes are made once for their combinations and once as rows.
    assert count(both, "FileScan") <= 6
    assert count(both, "SortMergeJoin") <= 9


def test_groups_are_found_once(spark, tmp_path):
    path = str(tmp_path / "uploads")
    spark.range(6000).select(
        (F.col("id") % 3000).cast("string").alias("dir"), F.col("id").cast("string").alias("name"),
        F.col("id").alias("modified"),
    ).write.parquet(path)
    text = plan(manifests.newest_upload(spark.read.parquet(path)), run=True)
    assert count(text, "FileScan") <= 2


def test_files_meet_once(spark, no_broadcast):
    text = plan(QUERIES["manifest_diff"](spark, SMALL))
    assert count(text, "FullOuter") == 1


def test_artifacts_are_matched_before_they_meet_planes(spark, no_broadcast):
    text = plan(QUERIES["archive_reconcile_summary"](spark, SMALL))
    # Below the exchange by plane stands the match with the namespaces.
    below = text[text.index("hashpartitioning(plane_id"):]
    assert "namespace" in below.split("FileScan")[0] and "Generate explode" in below
