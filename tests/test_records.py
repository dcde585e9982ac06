"""Duplicates, type profiles and previews."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from stocktake.model import PREVIEW_CATEGORIES, PRODUCT_TYPES, flag_name
from stocktake.operators import duplicates, previews, profiles

OBS = ("obs_id int, collection string, observation_id string, instrument_name string, intent string,"
       " max_last_modified string")
PLANE = "plane_id int, obs_id int, data_product_type string, quality_flag string, max_last_modified string"
ART = "plane_id int, uri string, product_type string"


def test_unknown_types_count_for_nothing(frame):
    art = frame(
        [(1, "unknown", "sketch"), (1, "unknown", None), (1, "one", "this"), (1, "two", "preview-image"),
         (2, "two", "preview-image"), (1, "two", "odd")] + [(1, "all", t) for t in PRODUCT_TYPES], ART)
    counts = duplicates.uri_type_counts(art)
    assert rows(counts, "uri", "n_known", "n_rows", "preview_image", "this") == [
        ("all", 17, 17, 1, 1), ("one", 1, 1, 0, 1), ("two", 2, 3, 2, 0), ("unknown", 0, 2, 0, 0),
    ]
    assert rows(duplicates.duplicate_uris(counts), "uri") == [("all",), ("two",)]
    assert tuple(duplicates.duplicate_summary(counts).first()) == (20, 1, 2, 19)
    empty = duplicates.duplicate_summary(counts.where("false")).first()
    assert tuple(empty) == (0, 0, 0, 0)
    flags = duplicates.product_type_flags(art.where("uri = 'two'"))
    assert rows(flags, "uri", "preview_image", "this") == [
        ("two", None, None), ("two", 1, None), ("two", 1, None)]


def test_instances_in_two_namespaces_count_twice(frame):
    described = frame([("a", "n/x/1", "this"), ("b", "n/x/1", "this")],
                      "collection string, uri string, product_type string")
    mappings = frame([("a", "n"), ("a", "n/x"), ("b", "m")], "collection string, si_namespace string")
    owned = duplicates.artifacts_of_collections(described, mappings)
    counts = duplicates.uri_type_counts(owned, ["collection", "uri"])
    assert rows(counts, "collection", "n_known") == [("a", 2)]


@pytest.fixture
def archive(frame):
    obs = frame([
        (1, "A", "o1", "cam", "science", "m"), (2, "A", "o2", None, None, "m"),
        (3, "A", "o3", "cam", "science", "m"), (4, "B", "o4", "cam", "science", "m"),
    ], OBS)
    plane = frame([
        (10, 1, "image", None, "m"), (11, 1, "image", "junk", "m"), (12, 1, "image", "ok", "m"),
        (20, 2, None, None, "m"), (30, 3, "image", "ok", "m"),
    ], PLANE)
    art = frame([
        (10, "u1", "science"), (10, "u2", "preview"), (10, "u3", "preview"), (11, "u4", "science"),
        (20, "u5", "odd"), (30, "u6", "science"), (99, "u7", "science"),
    ], ART)
    return obs, plane, art


def test_orphans_and_junk(archive):
    obs, plane, art = archive
    assert rows(profiles.no_planes(obs, plane), "category", "observation_id") == [("NO_PLANES", "o4")]
    assert rows(profiles.no_artifacts(*archive), "category", "plane_id") == [("NO_ARTIFACTS", 12)]
    assert rows(profiles.junk_planes(obs, plane), "category", "plane_id") == [("JUNK_PLANE", 11)]


def test_profile_and_summary(archive):
    planes = profiles.plane_type_flags(*archive)
    assert rows(planes, "plane_id", "science", "preview") == [(10, 1, 1), (20, None, None), (30, 1, None)]
    profile = profiles.type_profile(planes)
    assert sum(r.num_planes for r in profile.collect()) == planes.count()
    assert rows(profile, "instrument_name", "science", "preview", "num_planes") == [
        (None, None, None, 1), ("cam", 1, None, 1), ("cam", 1, 1, 1)]
    summary = profiles.profile_summary(*archive)
    columns = ("collection", "num_no_planes", "num_no_artifacts", "num_junk_planes", "num_planes",
               "num_artifacts", "num_combinations")
    assert rows(summary, *columns) == [("A", 0, 1, 1, 3, 5, 3), ("B", 1, 0, 0, 0, 0, 0)]


def test_profile_order_puts_nulls_first_both_ways(frame):
    df = frame([("c", "i", "a"), ("c", "i", None), ("c", "i", "b"), ("c", None, "a")],
               "collection string, instrument_name string, intent string")
    df = df.withColumns({"category": F.lit("TYPE"), "data_product_type": F.lit("x"),
                         **{flag_name(t): F.lit(None).cast("int") for t in PRODUCT_TYPES}})
    got = [(r.instrument_name, r.intent) for r in df.orderBy(*profiles.profile_order()).collect()]
    assert got == [(None, "a"), ("i", None), ("i", "b"), ("i", "a")]


def _planes(frame, data):
    columns = ("collection string, observation_id string, instrument_name string, intent string, plane_id int,"
               " data_product_type string, max_last_modified string, preview int, thumbnail int, this int,"
               " science int, calibration int")
    return frame(data, columns)


def _waterfall(planes):
    """The rounds as described, on plain rows."""
    key = lambda p: (p[0], p[2], p[3], p[5], *p[9:12])
    verdicts, left = {}, list(planes)
    for name, good in [
        ("BOTH", lambda p: p[7] == 1 and p[8] == 1), ("PREVIEW_ONLY", lambda p: p[7] == 1),
        ("THUMBNAIL_ONLY", lambda p: p[8] == 1),
    ]:
        combos = {key(p) for p in left if good(p)}
        for p in [p for p in left if key(p) in combos]:
            verdicts[p[4]] = ("CONSISTENT_FOR_" if good(p) else "INCONSISTENT_FOR_") + name
        left = [p for p in left if key(p) not in combos]
    verdicts.update({p[4]: "NEVER_HAD_PREVIEW" for p in left})
    return verdicts


@pytest.mark.parametrize("largest", [1, 1000])
def test_classes_equal_the_waterfall(frame, monkeypatch, largest):
    rng = random.Random(11)
    pick = lambda *v: rng.choice(v)
    data = [
        (pick("A", "B"), f"o{i}", pick("cam", "None", None), pick("science", None), i, pick("image", None), "m",
         int(rng.random() < .15), int(rng.random() < .15), pick(0, 1), pick(0, 1), 0)
        for i in range(300)
    ]
    planes = _planes(frame, data)
    expected = _waterfall(data)
    attach = previews.attach_group_values
    monkeypatch.setattr(previews, "attach_group_values", lambda *a: attach(*a, largest=largest))
    classified = previews.classify_planes(planes)
    assert {r.plane_id: r.category for r in classified.collect()} == expected
    counts = previews.category_counts(planes)
    summed = {r.category: r.n for r in counts.groupBy("category").agg(F.sum("num_planes").alias("n")).collect()}
    assert summed == {c: list(expected.values()).count(c) for c in set(expected.values())}
    assert set(summed) <= set(PREVIEW_CATEGORIES)
    summary = previews.preview_summary(counts).collect()
    assert sum(r.num_planes for r in summary) == len(data)
    for r in summary:
        assert r.num_planes == sum(r[f"num_{c.lower()}"] for c in PREVIEW_CATEGORIES)
    lacking = previews.inconsistent_planes(classified)
    assert lacking.count() == sum(v.startswith("INCONSISTENT") for v in expected.values())


def test_preview_flags_and_none_text(archive):
    planes = previews.plane_preview_flags(*archive)
    assert rows(planes, "plane_id", "preview", "science", "instrument_name") == [
        (10, 1, 1, "cam"), (20, 0, 0, None), (30, 0, 1, "cam")]
    text = previews.with_none_text(planes)
    assert rows(text.where("plane_id = 20"), "instrument_name", "intent", "data_product_type") == [("None",) * 3]
    combos = previews.combinations(planes)
    assert rows(combos, "category", "instrument_name", "science", "num_planes") == [
        ("PROFILE", None, 0, 1), ("PROFILE", "cam", 1, 2)]


@pytest.mark.parametrize("most", [0, 1000])
@pytest.mark.parametrize("seed", range(3))
def test_duplicates_by_hash_equal_the_wide_aggregate(frame, seed, most):
    rng = random.Random(seed)
    types = ["science", "preview", "unheard of", None]
    data = [(rng.choice(["A", "B", None]), rng.choice([f"u{rng.randint(0, 90)}", None]), rng.choice(types)) for _ in range(120)]
    table = frame(data, "collection string, uri string, product_type string")
    for keys, by in ((["uri"], []), (["collection", "uri"], ["collection"]), (["collection", "uri"], [])):
        counts = duplicates.uri_type_counts(table, keys)
        found = duplicates.duplicate_uris_of(table, keys, broadcast_rows=most)
        assert found.columns == counts.columns and rows(found) == rows(duplicates.duplicate_uris(counts))
        assert rows(duplicates.duplicate_summary_of(table, keys, by, broadcast_rows=most)) == rows(duplicates.duplicate_summary(counts, by))
    empty = table.where("false")
    assert rows(duplicates.duplicate_summary_of(empty, ["uri"])) == rows(duplicates.duplicate_summary(duplicates.uri_type_counts(empty)))


def test_only_repeated_rows_reach_the_wide_aggregate(spark):
    table = spark.range(5000).selectExpr("concat('u', IF(id < 20, id % 5, id)) AS uri", "'science' AS product_type")
    repeated, single = duplicates.by_repetition(table)
    assert (repeated.count(), single.count()) == (20, 4980)
    text = duplicates.duplicate_uris_of(table)._jdf.queryExecution().executedPlan().toString()
    # The rows meet the few hashes before the only shuffle of rows.
    assert text.index("Exchange hashpartitioning(uri") < text.index("BroadcastHashJoin") and "LeftSemi" in text
