"""Joins on keys that hold a large share of all rows, judged by Spark's event log."""

import json
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import rows
from stocktake.functions import skew
from stocktake.functions.prefixes import match_namespaces_indexed
from stocktake.operators import duplicates
from test_plans import count, no_broadcast, plan  # noqa: F401
from test_queries import SMALL, _normal
from workload import registry
from workload.views import TABLES, view

ROOT = Path(__file__).resolve().parents[1]

JOB = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
from stocktake.functions import skew
from stocktake.operators import profiles, reconcile

spark = (
    SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "32")
    .config("spark.sql.autoBroadcastJoinThreshold", "-1").config("spark.sql.adaptive.coalescePartitions.enabled", "false")
    .config("spark.eventLog.enabled", "true").config("spark.eventLog.compress", "false").config("spark.eventLog.dir", {log!r}).config("spark.driver.memory", "2g").getOrCreate()
)
skew.PROBE_BYTES = {probe}
n = 120_000
observation = spark.range(5000).selectExpr(
    "id AS obs_id", "concat('o', id) AS observation_id", "'C' AS collection", "'i' AS instrument_name", "'science' AS intent"
)
# A third of all planes in one observation, a third of all artifacts in one plane.
plane = spark.range(n).selectExpr(
    "id AS plane_id", "IF(id % 3 = 0, 77, id % 5000) AS obs_id", "'image' AS data_product_type", "'junk' AS quality_flag", "'t' AS max_last_modified"
)
artifact = spark.range(n).selectExpr(
    "IF(id % 3 = 0, 11, id) AS plane_id", "concat('ns/', id) AS uri", "'c' AS content_checksum", "id AS content_length",
    "'t' AS content_type", "'m' AS last_modified"
)
made = {{
    "planes": profiles.junk_planes(observation, plane),
    "artifacts": reconcile.described_artifacts(observation, plane, artifact),
}}
for name, df in made.items():
    spark.sparkContext.setJobGroup(name, name)
    print(name, df.agg(F.count("*"), F.sum(F.crc32(F.to_json(F.struct(*sorted(df.columns)))))).first()[:])
spark.stop()
"""


def _largest_share(log: Path) -> dict[str, float]:
    """Of every job group, the largest share of a stage's shuffled rows that one task read, in stages of many rows."""
    groups, read = {}, {}
    for line in next(p for p in log.rglob("*") if p.is_file() and "appstatus" not in p.name).read_text().splitlines():
        event = json.loads(line)
        if event["Event"] == "SparkListenerJobStart":
            for stage in event["Stage IDs"]:
                groups[stage] = (event.get("Properties") or {}).get("spark.jobGroup.id")
        if event["Event"] == "SparkListenerTaskEnd":
            metrics = event["Task Metrics"]["Shuffle Read Metrics"]
            read.setdefault(event["Stage ID"], []).append(metrics["Total Records Read"])
    shares = {}
    for stage, found in read.items():
        if sum(found) > 50_000:
            group = groups[stage]
            shares[group] = max(shares.get(group, 0), max(found) / sum(found))
    return shares


def _run(tmp_path, probe):
    log = tmp_path / f"log-{probe}"
    log.mkdir()
    out = subprocess.run(
        [sys.executable, "-c", JOB.format(root=str(ROOT), log=f"file://{log}", probe=probe)],
        capture_output=True, text=True, timeout=300, check=True,
    ).stdout
    return sorted(x for x in out.splitlines() if x.startswith(("planes", "artifacts"))), _largest_share(log)


def test_no_task_reads_a_hot_owner_whole(tmp_path):
    salted, shares = _run(tmp_path, 0)
    assert set(shares) == {"planes", "artifacts"} and max(shares.values()) < 1 / 8
    plain, hot = _run(tmp_path, 1 << 50)
    assert salted == plain
    assert min(hot.values()) > 1 / 4  # without the sketch one task gets the hot key


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("parts", [2, 64])
def test_same_rows_as_a_plain_join(spark, how, parts):
    many = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 5 WHEN id % 7 = 0 THEN NULL ELSE id % 900 END AS k", "id % 2 AS j", "id % 11 AS v")
    owners = spark.range(700).selectExpr("id AS k", "id % 2 AS j", "id * 2 AS w").union(spark.sql("SELECT 5L, 0L, -1L"))
    for on in (["k"], ["k", "j"]):
        right = owners if "j" in on else owners.drop("j")
        found = skew.owner_join(many, right, on, how, probe_bytes=0, parts=parts)
        assert rows(found) == rows(many.join(right, on, how)) and found.columns == many.join(right, on, how).columns


def test_heavy_keys(spark):
    keys = spark.range(10_000).selectExpr("IF(id % 4 = 0, 1, IF(id % 10 = 1, NULL, id)) AS k")
    one = keys.select(F.xxhash64(F.lit(1).cast("long"))).first()[0]
    assert skew.heavy_keys(keys, ["k"], 64) == [one]
    assert skew.heavy_keys(keys, ["k"], 2) == []
    assert skew.heavy_keys(keys.where("k < 0"), ["k"], 64) == []


def test_only_large_sources_are_probed(spark, monkeypatch):
    many, owners = spark.range(10).toDF("k"), spark.range(3).toDF("k")
    monkeypatch.setattr(skew, "heavy_keys", lambda *_: pytest.fail("probed"))
    assert skew.owner_join(many, owners, ["k"]).count() == 3


@pytest.mark.parametrize("name", [
    "catalog_listing", "duplicate_summary", "junk_planes", "plane_type_flags", "plane_preview_flags", "archive_reconcile_summary",
])
def test_queries_with_every_join_probed(spark, monkeypatch, no_broadcast, name):  # noqa: F811
    probed, real = [], skew.heavy_keys
    monkeypatch.setattr(skew, "PROBE_BYTES", 0)
    # Everything above a sixteenth of its table's fair share counts as heavy, so that salted keys occur.
    monkeypatch.setattr(skew, "heavy_keys", lambda r, on, parts, **k: probed.append(on) or real(r, on, parts * 16))
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    df = registry.QUERIES[name](spark, SMALL)
    result = db.execute(registry.ORACLE[name])
    columns = [c[0] for c in result.description]
    assert _normal(df.collect(), df.columns) == _normal(result.fetchall(), columns)
    assert probed


def test_a_large_lookup_is_neither_copied_nor_broadcast(spark, tmp_path):
    spark.range(3000).selectExpr("id % 700 AS k", "id AS v").write.parquet(str(tmp_path / "many"))
    spark.range(600).selectExpr("id AS k", "-id AS w").write.parquet(str(tmp_path / "table"))
    many, table = (spark.read.parquet(str(tmp_path / n)) for n in ("many", "table"))
    for how in ("inner", "left", "left_semi"):
        found = skew.lookup_join(many, table, ["k"], how, broadcast_rows=1)
        text = plan(found)
        assert "Broadcast" not in text and "Generate" not in text and "SortMergeJoin" in text
        assert rows(found) == rows(many.join(table, "k", how))


def test_a_large_lookup_spreads_heavy_keys_only(spark, monkeypatch):
    monkeypatch.setattr(skew, "PROBE_BYTES", 0)
    many = spark.range(3000).selectExpr("IF(id % 3 = 0, 5, id % 700) AS k", "id AS v")
    table = spark.range(600).selectExpr("id AS k", "-id AS w")
    found = skew.lookup_join(many, table, ["k"], broadcast_rows=1, spread_by=["v"])
    assert "Broadcast" not in plan(found) and rows(found) == rows(many.join(table, "k"))


def test_repeated_hashes_beyond_the_limit_are_not_broadcast(spark, tmp_path):
    spark.range(2000).selectExpr("concat('u', id % 900) AS uri", "'science' AS product_type").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    repeated, single = duplicates.by_repetition(table, broadcast_rows=10)
    assert all("Broadcast" not in plan(side) for side in (repeated, single))
    assert (repeated.count(), single.count()) == (2000, 0)


@pytest.mark.parametrize("name", ["artifact", "observation"])
def test_tables_of_a_view_meet_by_a_shuffle(spark, monkeypatch, name):
    assert "Broadcast" in plan(view(spark, SMALL, name))  # small ones are broadcast
    monkeypatch.setattr(skew, "ESTIMATED_BYTES", 0)
    assert "Broadcast" not in plan(view(spark, SMALL, name))


def test_an_index_beyond_the_limit_is_not_broadcast(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(skew, "ESTIMATED_BYTES", 0)
    spark.range(50).selectExpr("concat('n', id % 9, IF(id % 2 = 0, concat('/', id), '')) AS namespace").write.parquet(str(tmp_path / "n"))
    spark.range(300).selectExpr("concat('n', id % 12, '/', id % 40, '/f') AS uri").write.parquet(str(tmp_path / "u"))
    names, uris = (spark.read.parquet(str(tmp_path / n)) for n in "nu")
    found = match_namespaces_indexed(uris, names, broadcast_rows=-1)
    assert "Broadcast" not in plan(found)
    assert rows(found) == rows(names.join(uris, F.expr("startswith(uri, concat(namespace, '/'))")), *found.columns)
