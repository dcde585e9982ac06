"""Null usage, site copies, harvest figures, configuration and reports."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from stocktake.operators import config, copies, harvest, reports, usage

CI = usage.COLLECTION_INSTRUMENT


@pytest.fixture
def tables(frame):
    obs = frame([
        (1, "A", "cam", "x", None), (2, "A", "cam", None, None), (3, "A", "NULL", None, None),
        (4, "A", None, None, None), (5, "A", "spec", "x", None), (6, "B", "cam", "x", None),
    ], "obs_id int, collection string, instrument_name string, target string, never_set string")
    plane = frame([(10, 1, "i"), (11, 1, None), (20, 2, "i"), (30, 3, None), (60, 6, "i")],
                  "plane_id int, obs_id int, kind string")
    return obs, plane


def test_null_usage_counts_and_denominators(tables):
    obs, plane = tables
    fields = usage.field_catalog(obs, plane)
    full = usage.null_usage(obs, plane, fields)
    found = usage.with_nulls(full)
    assert rows(found, "field", *CI, "num_null", "num_instances", "percentage_null") == [
        ("Observation.never_set", "A", "cam", 2, 2, 100.0),
        ("Observation.never_set", "A", "spec", 1, 1, 100.0),
        ("Observation.never_set", "B", "cam", 1, 1, 100.0),
        ("Observation.target", "A", "cam", 1, 2, 50.0),
        ("Plane.kind", "A", "cam", 1, 3, 33.33),
    ]
    assert rows(usage.obs_totals(obs)) == [("A", "cam", 2), ("A", "spec", 1), ("B", "cam", 1)]
    assert rows(usage.plane_totals(obs, plane)) == [("A", "cam", 3), ("B", "cam", 1)]
    assert rows(usage.plane_totals(obs, plane, ["collection"])) == [("A", 3), ("B", 1)]
    both = usage.null_usage_rollup(full)
    coarse = both.where("granularity = 'collection'").select("field", "collection", "num_null", "num_instances")
    direct = usage.null_usage(obs, plane, fields, usage.COLLECTION).select(*coarse.columns)
    assert rows(coarse) == rows(direct)
    assert both.where("percentage_null < 0 or percentage_null > 100").count() == 0


def test_null_counts_from_footers(spark, frame, tables, tmp_path):
    obs, plane = tables
    obs = obs.unionAll(frame([(9, None, "cam", None, None)], obs.schema))
    plane = plane.unionAll(frame([(90, 9, None), (99, 77, None)], plane.schema))
    usage.write_for_footers(obs, plane, str(tmp_path / "stored"))
    fields = usage.field_catalog(obs, plane)
    for by in (CI, usage.COLLECTION):
        found = usage.null_usage_from_footers(obs, plane, str(tmp_path / "stored"), fields, by)
        want = usage.null_usage(obs, plane, fields, by)
        assert found.columns == want.columns and rows(found) == rows(want)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    with usage.footers_count(spark):
        for table in (usage.OBSERVATION, usage.PLANE):
            counts = usage.counts_by_folder(spark.read.parquet(str(tmp_path / "stored" / table)))
            scan = counts._jdf.queryExecution().executedPlan().toString()
            pushed = scan[scan.index("PushedAggregation: [") :].split("]")[0]
            assert pushed.count("COUNT(") == len(counts.columns) - 2 and "PushedGroupBy: [" in scan
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_usage_reports(tables):
    obs, plane = tables
    fields = usage.field_catalog(obs, plane)
    full = usage.null_usage(obs, plane, fields)
    by_field = usage.usage_by_field(full)
    assert [r for r in rows(by_field) if r[0] in ("Observation.obs_id", "Plane.kind")] == [
        ("Observation.obs_id", 3, 0, 0.0, 4, 0, 0.0), ("Plane.kind", 2, 1, 50.0, 4, 1, 25.0)]
    by_group = usage.usage_by_group(full, fields, fields)
    assert rows(by_group) == [
        ("Observation", "A", "cam", 5, 2, 40.0, 10, 3, 30.0),
        ("Observation", "A", "spec", 5, 1, 20.0, 5, 1, 20.0),
        ("Observation", "B", "cam", 5, 1, 20.0, 5, 1, 20.0),
        ("Plane", "A", "cam", 3, 1, 33.33, 9, 1, 11.11),
        ("Plane", "B", "cam", 3, 0, 0.0, 3, 0, 0.0),
    ]
    lists = usage.fields_by_group(usage.null_usage(obs, plane, ["Plane.kind"]), usage.obs_totals(obs))
    assert rows(lists, *CI, "field", "num_null") == [
        ("A", "cam", "Plane.kind", 1), ("A", "spec", None, None), ("B", "cam", None, None)]


def test_field_names(frame):
    listed = frame([("Plane", "b"), ("Observation", "a"), ("Chunk", "c")], "table_name string, column_name string")
    assert rows(usage.field_names(listed)) == [("Observation.a",), ("Plane.b",)]


def test_field_ranges(tables):
    fields = usage.field_catalog(*tables)
    assert fields[0] == "Observation.collection" and fields[-1] == "Plane.plane_id"
    assert usage.field_range(fields, "Observation.target", "Plane.kind") == ["Observation.target", "Plane.kind"]
    assert usage.field_range(fields, "OBSERVATION.Target", "plane.KIND") == ["Observation.target", "Plane.kind"]
    for unknown in (("nope", "Plane.kind"), (None, "Plane.nope")):
        with pytest.raises(ValueError, match="unknown field"):
            usage.field_range(fields, *unknown)
    assert usage.field_range(fields, "Plane.kind", "Observation.target") == []
    assert usage.field_range(fields) == fields
    with pytest.raises(ValueError):
        usage.null_usage(*tables, ["Elsewhere.kind"])
    assert usage.null_usage(*tables, []).count() == 0
    totals = {"Observation": usage.obs_totals(tables[0]), "Plane": usage.plane_totals(*tables)}
    none = usage.usage_by_group(usage.null_usage(*tables, ["Plane.kind"]), ["Plane.kind"], fields, totals=totals)
    assert none.where("table_name = 'Observation' and fields_with_null = 0").count() == 3


def test_many_plane_fields_span_several_words(spark, tables):
    obs, plane = tables
    wide = plane.select("obs_id", *[
        F.when(F.col("plane_id") % (i + 2) == 0, F.lit(1)).alias(f"f{i}") for i in range(130)])
    fields = [f"Plane.f{i}" for i in range(130)]
    got = {r.field: r.num_null for r in usage.null_usage_plane(obs, wide, fields, ["collection"])
           .where("collection = 'A'").collect()}
    assert got == {f"Plane.f{i}": sum(p % (i + 2) != 0 for p in (10, 11, 20)) for i in range(130)}


def test_site_counts(frame):
    inventory = frame([("s1", "n/1"), ("s1", "n/deep/2"), ("s2", "n/1"), ("s9", "n/1"), ("s2", "nn/1")],
                      "site string, uri string")
    namespaces = frame([("n",), ("n/deep",), ("none",), ("n",)], "namespace string")
    counts = copies.site_counts(inventory, namespaces, ["s1", "s2"], "d")
    assert rows(counts) == [
        ("d", "n", "s1", 2), ("d", "n", "s2", 1), ("d", "n/deep", "s1", 1), ("d", "n/deep", "s2", 0),
        ("d", "none", "s1", 0), ("d", "none", "s2", 0)]
    wide = copies.merge_site_counts(counts, ["s1", "s2"])
    assert wide.columns == ["datestamp", "namespace", "s1_count", "s2_count"]
    assert rows(wide) == [("d", "n", 2, 1), ("d", "n/deep", 1, 0), ("d", "none", 0, 0)]
    timed = counts.where("namespace = 'n' and site = 's1'").withColumn("duration", F.lit(1.5))
    merged = copies.merge_site_counts(timed, ["s1", "s2"], namespaces)
    assert merged.columns == ["datestamp", "namespace", "s1_count", "s1_duration", "s2_count", "s2_duration"]
    assert rows(merged) == [(None, "n/deep", None, None, None, None), (None, "none", None, None, None, None),
                            ("d", "n", 2, 1.5, None, None)]


def test_unknown_namespace_fails(frame):
    namespaces = frame([("n",)], "namespace string")
    assert rows(copies.require_known_namespaces(frame([("n",)], "namespace string"), namespaces)) == [("n",)]
    with pytest.raises(Exception, match="unknown namespace: m"):
        copies.require_known_namespaces(frame([("m",)], "namespace string"), namespaces).collect()


ASOF = datetime(2024, 1, 15)


def test_retry_queue_and_errors(frame):
    long = "x" * 40
    skip = frame([
        (1, "Observation", "a/S/1", "2024-01-15 00:00:00", long + "1"), (2, "Observation", "S", None, long + "2"),
        (3, "Observation", "S", "2024-01-15 00:00:01", None), (4, "Plane", "S", "2024-01-01 00:00:00", "e"),
        (5, "Observation", "T", "2024-01-01 00:00:00", "e"), (6, "Observation", "S", "2024-01-14 00:00:00", "b"),
    ], "skip_id long, cname string, source string, t string, error_message string")
    skip = skip.withColumn("try_after", F.col("t").cast("timestamp_ntz")).drop("t")
    assert rows(harvest.retry_queue(skip, "Observation", "S", ASOF)) == [(4, 2, 1, 3)]
    digest = harvest.error_digest(skip, "Observation", "S")
    at = datetime(2024, 1, 15)
    assert rows(digest) == [("b", 1, 6, datetime(2024, 1, 14), datetime(2024, 1, 14)), (long, 2, 1, at, at)]
    assert rows(harvest.error_dump(skip, "Observation", "S"), "skip_id") == [(1,), (2,), (6,)]


def test_observation_figures(frame):
    obs = frame([("A", "s1", None, "2024-01-14 00:00:00"), ("A", "s1", "2024-01-01", "2024-01-13 23:59:59"),
                 ("B", "s2", None, "2024-01-14 12:00:00")],
                "collection string, site string, r string, t string")
    obs = obs.withColumn("meta_release", F.col("r").cast("timestamp_ntz"))
    obs = obs.withColumn("max_last_modified", F.col("t").cast("timestamp_ntz"))
    assert rows(harvest.obs_counts_by_site(obs, "A", ["s1", "s2"])) == [("s1", 2), ("s2", 0)]
    assert rows(harvest.missing_release(obs, "A")) == [(1,)]
    assert rows(harvest.harvested_since(obs, "A", ASOF)) == [(1,)]
    plane = frame([(1,), (2,)], "plane_id int")
    art = frame([(1, "m/S/1", 2**40), (2, "m/S/2", 2**39), (3, "m/S/3", 1), (1, "m/T/1", 1), (1, "m/S/4", None)],
                "plane_id int, uri string, content_length long")
    assert rows(harvest.prefix_volume(plane, art, "m/S")) == [(3, 1.5)]
    assert rows(harvest.prefix_volume(plane, art, "q")) == [(0, None)]


COLLECTIONS = "collection string, in_si boolean, ams_site string"


def test_collection_selection(frame):
    collections = frame([("a", True, "s"), ("b", False, "s"), ("c", True, "q"), ("d", True, None)], COLLECTIONS)
    want = lambda *names: frame([(n,) for n in names], "collection string")
    pick = lambda *args, **kw: [r[0] for r in rows(config.select_collections(collections, *args, **kw))]
    assert pick() == ["a", "c", "d"]
    assert pick(stored_only=False) == ["a", "b", "c", "d"]
    assert pick(stored_only=False, unsupported_site="q") == ["a", "b"]
    assert pick(want("a", "a")) == ["a"]
    for bad in ("b", "zz"):
        with pytest.raises(Exception, match=f"unknown collection: {bad}"):
            pick(want("a", bad))
    assert pick(want("b"), stored_only=False) == ["b"]


def test_sites(frame):
    collections = frame([("a", True, "s"), ("c", True, "q"), ("d", True, None)], COLLECTIONS)
    sites = frame([("s", "/s")], "site_name string, site_url string")
    assert rows(config.collection_site(collections, sites)) == [
        ("a", "s", "/s"), ("c", "q", None), ("d", None, None)]
    assert rows(config.require_site(collections.where("collection = 'a'"), sites)) == [("a", "s", "/s")]
    with pytest.raises(Exception, match="no site q for collection c"):
        config.require_site(collections.where("collection <> 'd'"), sites).select("collection").collect()


def test_summaries(frame):
    one = frame([("a", 1), ("a", 1)], "collection string, n long")
    two = frame([("a", 1), ("b", 2)], "collection string, n long")
    assert rows(reports.collect_summaries([one, two])) == [("a", 1), ("b", 2)]
    assert rows(reports.audit_summary({"x": (one, "collection"), "y": (two, "collection")})) == [
        ("x", "a", "n", 1), ("y", "a", "n", 1), ("y", "b", "n", 2)]
