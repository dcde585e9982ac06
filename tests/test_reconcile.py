import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from stocktake import model as m
from stocktake.operators import groups, reconcile

SIDE = "uri string, content_checksum string, content_length long, content_type string, last_modified string"


def test_each_category_and_nulls(frame):
    catalog = frame([
        ("same", "c", 1, "t", "m"), ("sum", "c", 1, "t", "m"), ("len", "c", 1, "t", "m"),
        ("type", "c", 1, "t", "m"), ("nosum", None, 1, "t", "m"), ("nolen", "c", None, "t", "m"),
        ("sumfirst", "c", None, None, "m"), ("onlycat", "c", 1, "t", "m"), ("notype", "c", 1, None, "m"),
    ], SIDE)
    inventory = frame([
        ("same", "c", 1, "t", "n"), ("sum", "d", 2, "u", "n"), ("len", "c", 2, "u", "n"),
        ("type", "c", 1, "u", "n"), ("nosum", "c", 2, "t", "n"), ("nolen", "c", 1, "u", "n"),
        ("sumfirst", "d", 1, "t", "n"), ("onlyinv", "c", 1, "t", "n"), ("notype", "c", 1, "t", "n"),
    ], SIDE)
    found = {r.uri: r.category for r in reconcile.reconcile(catalog, inventory).collect()}
    assert found == {
        "same": "CONSISTENT", "sum": "DIFF_CHECKSUMS", "len": "DIFF_LENGTHS", "type": "DIFF_TYPES",
        "nosum": "UNDETERMINED", "nolen": "UNDETERMINED", "notype": "UNDETERMINED",
        "sumfirst": "DIFF_CHECKSUMS", "onlycat": "MISSING_IN_INVENTORY",
        "onlyinv": "MISSING_IN_CATALOG",
    }


def _random_side(rng, n):
    pick = lambda *values: rng.choice(values)
    return [
        (f"u{rng.randint(0, n)}", pick("a", "b", None), pick(1, 2, None), pick("t", "u", None), "m")
        for _ in range(n)
    ]


def _expected(catalog, inventory):
    """The description in plain Python: six separate joins of lists."""
    pairs = [(c, i) for c in catalog for i in inventory if c[0] == i[0]]
    eq = lambda a, b: a is not None and b is not None and a == b
    ne = lambda a, b: a is not None and b is not None and a != b
    in_cat, in_inv = {c[0] for c in catalog}, {i[0] for i in inventory}
    return {
        "CONSISTENT": sum(eq(c[1], i[1]) and eq(c[2], i[2]) and eq(c[3], i[3]) for c, i in pairs),
        "DIFF_CHECKSUMS": sum(ne(c[1], i[1]) for c, i in pairs),
        "DIFF_LENGTHS": sum(eq(c[1], i[1]) and ne(c[2], i[2]) for c, i in pairs),
        "DIFF_TYPES": sum(eq(c[1], i[1]) and eq(c[2], i[2]) and ne(c[3], i[3]) for c, i in pairs),
        "MISSING_IN_INVENTORY": sum(c[0] not in in_inv for c in catalog),
        "MISSING_IN_CATALOG": sum(i[0] not in in_cat for i in inventory),
    }, len(pairs)


@pytest.mark.parametrize("seed", [1, 2])
def test_one_join_equals_the_separate_joins(frame, seed):
    rng = random.Random(seed)
    left, right = _random_side(rng, 120), _random_side(rng, 120)
    catalog, inventory = frame(left, SIDE), frame(right, SIDE)
    expected, pairs = _expected(left, right)
    result = reconcile.reconcile(catalog, inventory).cache()
    counts = {r.category: r["count"] for r in result.groupBy("category").count().collect()}
    undetermined = counts.pop("UNDETERMINED")
    assert counts == {k: v for k, v in expected.items() if v}
    matched = sum(v for k, v in expected.items() if not k.startswith("MISSING"))
    assert matched + undetermined == pairs
    for category, op in [
        ("CONSISTENT", reconcile.consistent), ("DIFF_CHECKSUMS", reconcile.diff_checksums),
        ("DIFF_LENGTHS", reconcile.diff_lengths), ("DIFF_TYPES", reconcile.diff_types),
        ("MISSING_IN_INVENTORY", reconcile.missing_in_inventory),
        ("MISSING_IN_CATALOG", reconcile.missing_in_catalog),
    ]:
        one = op(catalog, inventory)
        same = result.where(F.col("category") == category)
        assert rows(one, "uri") == rows(same, "uri")
    summary = reconcile.reconcile_summary(catalog, inventory).first()
    assert (summary.num_catalog, summary.num_inventory) == (120, 120)
    assert summary.catalog_bytes == sum(r[2] or 0 for r in left)
    for category in m.RECONCILE_CATEGORIES:
        value = undetermined if category == "UNDETERMINED" else expected[category]
        assert summary[f"num_{category.lower()}"] == value


def test_summary_keeps_a_group_only_one_side_has(frame):
    side = "collection string, " + SIDE
    catalog = frame([("a", "u", "c", 1, "t", "m")], side)
    inventory = frame([("b", "u", "c", 1, "t", "m")], side)
    got = reconcile.reconcile_summary(catalog, inventory, ["collection", "uri"], ["collection"])
    assert rows(got, "collection", "num_catalog", "num_inventory", "num_missing_in_inventory",
                "num_missing_in_catalog", "num_consistent") == [("a", 1, 0, 1, 0, 0), ("b", 0, 1, 0, 1, 0)]


def test_copies_are_dropped_per_collection_and_namespace_only(frame):
    described = frame([
        ("c1", "n/1", "x", 1, "t", "2024-01-01"), ("c1", "n/1", "y", 1, "t", "2024-01-02"),
        ("c2", "n/1", "x", 1, "t", "2024-01-01"), ("c2", "n/deep/2", "x", 1, "t", "2024-01-01"),
        ("c3", "n/3", "x", 1, "t", "2024-01-01"), ("c1", "other/1", "x", 1, "t", "2024-01-01"),
    ], "collection string, " + SIDE)
    mappings = frame([("c1", "n"), ("c2", "n"), ("c2", "n/deep"), ("c3", "elsewhere")],
                     "collection string, si_namespace string")
    members = groups.audit_groups(mappings)
    listing = reconcile.catalog_listing_for_groups(described, members)
    assert rows(listing, "group_id", "collection", "namespace", "uri", "content_checksum") == [
        ("c1", "c1", "n", "n/1", "y"), ("c1", "c2", "n", "n/1", "x"), ("c1", "c2", "n", "n/deep/2", "x"),
        ("c1", "c2", "n/deep", "n/deep/2", "x"),
    ]
    inventory = described.drop("collection")
    held = reconcile.inventory_listing_for_groups(inventory, members)
    assert rows(held, "group_id", "namespace", "uri") == [
        ("c1", "n", "n/1"), ("c1", "n", "n/3"), ("c1", "n", "n/deep/2"), ("c1", "n/deep", "n/deep/2"),
    ]
    # One catalog row per namespace meets one inventory row per namespace.
    summary = reconcile.reconcile_summary(listing, held, ["group_id", "uri"], ["group_id"]).first()
    assert (summary.num_catalog, summary.num_inventory) == (4, 4)
    assert summary.num_consistent + summary.num_diff_checksums == 2 + 4


def test_single_listings(frame):
    obs = frame([(1, "A"), (2, "B")], "obs_id int, collection string")
    plane = frame([(10, 1), (20, 2), (30, 9)], "plane_id int, obs_id int")
    art = frame([
        (10, "n/1", "x", 1, "t", "2024-01-01"), (10, "n/1", "y", 1, "t", "2024-01-02"),
        (20, "n/2", "x", 1, "t", "m"), (30, "n/3", "x", 1, "t", "m"), (10, "nn/1", "x", 1, "t", "m"),
    ], "plane_id int, " + SIDE)
    got = reconcile.catalog_listing(obs, plane, art, "A", "n")
    assert rows(got, "collection", "uri", "content_checksum") == [("A", "n/1", "y")]
    held = reconcile.inventory_listing(art.drop("plane_id"), "n")
    assert rows(held, "uri") == [("n/1",), ("n/2",), ("n/3",)]
