"""What large tables leave on disk: few shuffles of rows, none run twice, none kept."""

import random
import time
from pathlib import Path

import pytest

from conftest import rows
from stocktake.functions import prefixes, skew
from stocktake.operators import duplicates
from stocktake.plans import stages
from stocktake.plans.session import SHUFFLE_CLEANUP
from test_plans import count, no_broadcast, plan  # noqa: F401
from workload import registry

PIECES = ["a", "b", "c", "ab", "", "x_y", "%"]


def _pairs(seed, n=60):
    rng = random.Random(seed)
    path = lambda most: "/".join(rng.choice(PIECES) for _ in range(rng.randint(1, most)))
    uris = [(k, rng.choice(["A", "B", None]), rng.choice([path(5), path(5), path(5), None])) for k in range(150)]
    spaces = sorted({(rng.choice("ABC"), path(3)) for _ in range(n)}) + [("A", None), (None, "a")]
    expected = sorted((k, c, u, s) for k, c, u in uris if u is not None for d, s in spaces if c is not None and c == d and s is not None and u.startswith(s + "/"))
    return uris, spaces, expected


@pytest.mark.parametrize("seed, most, probe", [(0, 0, 0), (1, 5, 1 << 62), (2, 30, 0), (3, 30, 1 << 64), (4, 1000, 0)])
def test_matches_by_depth_are_all_matches(frame, monkeypatch, seed, most, probe):
    uris, spaces, expected = _pairs(seed)
    monkeypatch.setattr(prefixes, "BROADCAST_ROWS", most)
    monkeypatch.setattr(prefixes, "SHUFFLED_DEPTHS", 3)
    monkeypatch.setattr(skew, "PROBE_BYTES", probe)
    real = skew.heavy_keys
    monkeypatch.setattr(skew, "heavy_keys", lambda r, on, parts, **k: real(r, on, parts * 16))
    table, names = frame(uris, "k long, collection string, uri string"), frame(spaces, "collection string, namespace string")
    found = prefixes.match_namespaces_by_depth(table, names, also_on=["collection"])
    assert rows(found, "k", "collection", "uri", "namespace") == rows(frame(expected, "k long, collection string, uri string, namespace string"))
    # What says where rows lie follows from collection and URI.
    lies = [c for c in (prefixes.PLACE, skew.SALT) if c in found.columns]
    assert found.select("collection", "uri", *lies).distinct().count() == found.select("collection", "uri").distinct().count()


def test_rows_matched_by_depth_are_not_shuffled_again(spark, monkeypatch, no_broadcast):  # noqa: F811
    uris, spaces, _ = _pairs(0)
    monkeypatch.setattr(prefixes, "BROADCAST_ROWS", 20)
    names = spark.createDataFrame(spaces, "collection string, namespace string").where("size(split(namespace, '/')) < 3")
    table = spark.createDataFrame(uris, "k long, collection string, uri string").selectExpr("collection", "uri", "'science' AS product_type")
    owned = prefixes.match_namespaces_by_depth(table, names, also_on=["collection"])
    assert prefixes.PLACE in owned.columns
    counts = duplicates.uri_type_counts(owned, ["collection", "uri"])
    assert count(plan(counts), "Exchange hashpartitioning") == 2  # the rows and the namespaces
    plain = duplicates.uri_type_counts(owned.drop(prefixes.PLACE), ["collection", "uri"])
    assert counts.columns == plain.columns and rows(counts) == rows(plain)


@pytest.fixture
def large(monkeypatch):
    """Small tables take the ways of large ones."""
    monkeypatch.setattr(prefixes, "BROADCAST_ROWS", 30)
    monkeypatch.setattr(skew, "STAGED_BYTES", 0)
    monkeypatch.setattr(skew, "PROBE_BYTES", 0)


@pytest.mark.parametrize("name", ["duplicate_summary", "duplicate_summary_by_hash", "audit_summary"])
def test_large_tables_have_the_same_summary(spark, request, name):
    small = "/root/testdata/sf0.001"
    expected = rows(registry.QUERIES[name](spark, small))
    request.getfixturevalue("large")
    assert rows(registry.QUERIES[name](spark, small)) == expected


def _archive(spark, folder):
    made = {
        "observation": spark.range(40).selectExpr("id AS obs_id", "IF(id % 2 = 0, 'A', 'B') AS collection"),
        "plane": spark.range(200).selectExpr("id AS plane_id", "id % 50 AS obs_id"),
        "artifact": spark.range(900).selectExpr("id % 230 AS plane_id", "concat('n', id % 9, '/', id % 60, '/', id % 300) AS uri", "IF(id % 4 = 0, 'science', 'preview') AS product_type"),
        "mappings": spark.range(600).selectExpr("IF(id % 3 = 0, 'A', 'B') AS collection", "concat('n', id % 9, IF(id < 9, '', concat('/', id % 60))) AS si_namespace"),
    }
    for name, df in made.items():
        df.write.parquet(f"{folder}/{name}")
    return [spark.read.parquet(f"{folder}/{name}") for name in made]


def test_no_sketch_of_keys_runs_the_joins_before_it(spark, tmp_path, large, monkeypatch, no_broadcast):  # noqa: F811
    probed, real = [], skew.heavy_keys
    monkeypatch.setattr(skew, "heavy_keys", lambda r, on, parts, **k: probed.append((on, plan(r.select(*on)))) or real(r, on, parts))
    tables = _archive(spark, str(tmp_path))
    owned = duplicates.archive_artifacts_of_collections(*tables)
    assert [on for on, _ in probed] == [["obs_id"], ["plane_id"], ["collection", prefixes.PLACE]]
    assert all("Join" not in text for _, text in probed)
    monkeypatch.undo()
    expected = duplicates.archive_artifacts_of_collections(*tables)
    columns = ["collection", "namespace", "uri", "product_type"]
    assert expected.count() and rows(owned, *columns) == rows(expected, *columns)


def test_rows_counted_by_hash_are_made_once(spark, tmp_path, large):
    owned = duplicates.archive_artifacts_of_collections(*_archive(spark, str(tmp_path)))
    found = duplicates.duplicate_summary_of(owned, ["collection", "uri"], ["collection"], broadcast_rows=0)
    text = plan(found)
    assert "stocktake-owned" in text and "LeftAnti" not in text
    assert count(text, "SortMergeJoin") == 1 and "Inner" not in text
    assert rows(found) == rows(duplicates.duplicate_summary(duplicates.uri_type_counts(owned, ["collection", "uri"]), ["collection"]))


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.length()) if files.apply(k).getName().startswith("shuffle")}


def _left(spark, before):
    for _ in range(40):
        if not _shuffle_files(spark) - before:
            return set()
        time.sleep(0.25)
    return _shuffle_files(spark) - before


def test_shuffle_files_of_a_staged_table_and_of_a_sketch_go(spark):
    before = _shuffle_files(spark)
    table = spark.range(5000).selectExpr("id % 900 AS k", "id").groupBy("k").count()
    staged, path = stages.stage(table, "test")
    skew.heavy_keys(table.select("k"), ["k"], 64)
    assert skew.measured(table)[0] == 900
    assert _left(spark, before) == set()
    assert spark.conf.get(SHUFFLE_CLEANUP, "false") == "false"
    assert staged.count() == 900
    stages.drop(spark, path)


def test_stage_tables_of_a_settled_frame_go(spark):
    made = []

    def make():
        table, path = stages.stage(spark.range(20).selectExpr("id % 3 AS k"), "inner")
        made.append(Path(path.removeprefix("file://")))
        assert made[0].exists()
        return table.groupBy("k").count()

    found = stages.settled(spark, make, "test")
    assert not made[0].exists() and rows(found) == [(0, 7), (1, 7), (2, 6)]
    with stages.passing(spark):
        _, path = stages.stage(spark.range(3).toDF("k"), "other")
    assert not Path(path.removeprefix("file://")).exists()
    assert rows(found) == [(0, 7), (1, 7), (2, 6)]


def test_audits_leave_one_small_table_each(spark, large, monkeypatch):
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = {p.name for p in folder.iterdir()} if folder.exists() else set()
    text = plan(registry.QUERIES["audit_summary"](spark, "/root/testdata/sf0.001"))
    new = sorted(p.name.rsplit("-", 1)[0] for p in folder.iterdir() if p.name not in before)
    assert new == [f"stocktake-summary-{a}" for a in sorted(registry.SUMMARIES)]
    assert "Join" not in text
