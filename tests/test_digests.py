"""Listings that mostly agree: digests of ranges, results taken over, stored listings."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from stocktake.functions.dedupe import dedupe_first, newest_first
from stocktake.operators import digests, reconcile
from stocktake.sources import layout
from test_plans import count, no_broadcast, plan  # noqa: F401

SIDE = "uri string, content_checksum string, content_length long, content_type string, last_modified string"


def _listing(rng, n):
    return {f"u{k}": (f"c{rng.randint(0, 9)}", k, "t", f"m{k % 5}") for k in range(n)}


def _changed(rng, files, changes):
    """The same files with some changed, removed, added and nulled, and all their times new."""
    other = {u: (*v[:3], v[3] + "'") for u, v in files.items()}
    for k, u in enumerate(rng.sample(sorted(other), changes)):
        c, length, t, m = other[u]
        kinds = ("d", length, t, m), (c, length + 1, t, m), (c, length, "u", m), (None, length, t, m), None
        other[u] = kinds[k % 5]
        if other[u] is None:
            del other[u]
            other[u + "-new"] = (c, length, t, m)
    return other


def _frame(frame, files):
    return frame([(u, *v) for u, v in files.items()], SIDE)


def _not_consistent(left, right):
    return reconcile.reconcile(left, right).where("category <> 'CONSISTENT'")


@pytest.mark.parametrize("changes", [0, 1, 40, 400])
def test_same_rows_as_reconcile(frame, changes):
    rng = random.Random(changes)
    files = _listing(rng, 400)
    left, right = _frame(frame, files), _frame(frame, _changed(rng, files, changes))
    want = rows(_not_consistent(left, right))
    assert rows(digests.reconcile_changes(left, right)) == want
    # Every level, and ranges of a level that are too many for all tasks.
    for options in ({"few_rows": 0}, {"few_rows": 0, "most_ranges": 3}, {"levels": (2,)}, {"levels": (1, 3, 40), "few_rows": 5}):
        assert rows(digests.reconcile_changes(left, right, **options)) == want
    assert rows(digests.reconcile_changes_summary(left, right)) == rows(reconcile.reconcile_summary(left, right))


def test_nulls_in_key_and_content_are_never_equal(frame):
    left = frame([(None, "c", 1, "t", "m"), ("a", None, 1, "t", "m"), ("b", "c", None, None, "m"), ("x", "c", 1, "t", "m")], SIDE)
    assert rows(digests.reconcile_changes(left, left)) == rows(_not_consistent(left, left))
    assert digests.reconcile_changes(left, left).count() == 4
    swapped = frame([("k", None, 1, "c", "m")], SIDE), frame([("k", "c", 1, None, "m")], SIDE)
    assert rows(digests.reconcile_changes(*swapped)) == rows(_not_consistent(*swapped))


def test_sides_of_other_types(frame):
    left = frame([("a", "c", 1, "t", "m"), ("b", "c", 2, "t", "m")], SIDE)
    right = frame([("a", "c", 1, "t", "m"), ("b", "c", 3, "t", "m")], SIDE.replace("content_length long", "content_length int"))
    found = digests.differences(left, right, few_rows=0)
    assert found.steps[0][1:] == (1, 2)
    assert rows(digests.reconcile_changes(left, right), "category", "uri") == [("DIFF_LENGTHS", "b")]


def test_rows_that_are_joined_grow_with_the_changes(spark):
    n = 200_000
    left = spark.range(n).select(
        F.concat(F.lit("u"), "id").alias("uri"), F.md5(F.col("id").cast("string")).alias("content_checksum"),
        F.col("id").alias("content_length"), F.lit("t").alias("content_type"), F.lit("m").alias("last_modified"),
    )
    joined = []
    for changes in (0, 2, 20, 200):
        right = left.withColumn("content_length", F.expr(f"IF(content_length % {n} < {changes}, -1, content_length)"))
        found = digests.differences(left, right, few_rows=0)
        joined.append(found.steps[-1][2])
        assert found.catalog.count() + found.inventory.count() == joined[-1]
        assert digests.reconcile_changes(left, right, few_rows=0).count() == changes
        # The first level already leaves what shares one of 2^14 ranges with a change.
        assert found.steps[0][2] <= 2 * changes * (n / 2**14 + 40)
    assert joined[0] == 0 and all(2 * c <= j <= 10 * c for c, j in zip((2, 20, 200), joined[1:]))


def test_only_rows_of_open_ranges_are_shuffled(spark, tmp_path, no_broadcast):  # noqa: F811
    for name in "ab":
        spark.range(1000).selectExpr(
            "concat('u', id) AS uri", f"IF(id < 3, '{name}', 'c') AS content_checksum", "id AS content_length",
            "'t' AS content_type", "'m' AS last_modified",
        ).write.parquet(f"{tmp_path}/{name}")
    sides = [spark.read.parquet(f"{tmp_path}/{n}") for n in "ab"]
    for bits, df in zip((14, 14), sides):
        text = plan(digests.digests(df, ["uri"], bits, "x"))
        assert text.index("HashAggregate") < text.index("Exchange") < text.rindex("HashAggregate")
        assert count(text, "Exchange") == 1
    text = plan(digests.reconcile_changes(*sides))
    # Each side meets its ranges before the shuffle to the join.
    for side in text.split("SortMergeJoin")[1:]:
        assert side.index("Exchange hashpartitioning(uri") < side.index("BroadcastHashJoin") and "LeftSemi" in side


@pytest.mark.parametrize("most", [0, 10_000])
def test_results_are_taken_over(spark, frame, tmp_path, most):
    rng = random.Random(7)
    files = _listing(rng, 300)
    days = [(files, _changed(rng, files, 60))]
    for changes in (0, 5, 25):
        left, right = days[-1]
        days.append((_changed(rng, left, changes), _changed(rng, right, changes) if changes else right))
    previous = None
    for k, (left, right) in enumerate(days):
        left, right = _frame(frame, left), _frame(frame, right)
        state = f"{tmp_path}/{k}"
        found = digests.reconcile_again(left, right, state, previous, bits=6, most_ranges=most)
        assert rows(found) == rows(_not_consistent(left, right))
        previous = state


def test_taking_over_reads_changed_ranges_only(spark, frame, tmp_path, monkeypatch):
    rng = random.Random(8)
    files = _listing(rng, 500)
    right = _frame(frame, _changed(rng, files, 100))
    digests.reconcile_again(_frame(frame, files), right, f"{tmp_path}/0")
    sizes, real = [], digests.differences
    monkeypatch.setattr(digests, "differences", lambda c, i, *a, **k: sizes.append((c.count(), i.count())) or real(c, i, *a, **k))
    files["u7"] = ("other", *files["u7"][1:])
    digests.reconcile_again(_frame(frame, files), right, f"{tmp_path}/1", f"{tmp_path}/0")
    assert sizes == [(1, 1)]


# --- stored listings ---------------------------------------------------------------------------


def _stored(spark, df, path, keys=("uri",), **options):
    layout.write_listing(df, path, keys, buckets=4, **options)
    return layout.read_listing(spark, path)


def test_stored_listings_meet_without_a_shuffle(spark, frame, tmp_path, no_broadcast):  # noqa: F811
    rng = random.Random(1)
    files = _listing(rng, 200)
    sides = []
    for name, content in (("a", files), ("b", _changed(rng, files, 30))):
        copies = _frame(frame, content).unionAll(_frame(frame, {u: (*v[:3], "") for u, v in content.items()}))
        sides.append((copies, _stored(spark, copies, f"{tmp_path}/{name}")))
    text = plan(reconcile.reconcile(*[s for _, s in sides]))
    assert count(text, "Exchange") == 0 and count(text, "SortMergeJoin") == 1 and "SelectedBucketsCount: 4 out of 4" in text
    assert count(plan(dedupe_first(sides[0][1], ["uri"], newest_first())), "Exchange") == 0
    raw = [dedupe_first(c, ["uri"], newest_first()) for c, _ in sides]
    assert rows(reconcile.reconcile(*[s for _, s in sides])) == rows(reconcile.reconcile(*raw))
    # One file for each bucket.
    assert len(list((tmp_path / "a" / "data").glob("*.parquet"))) == 4


def test_keys_of_two_columns(spark, frame, tmp_path, no_broadcast):  # noqa: F811
    df = frame([("c", "u", 1), ("c", "v", 2), ("d", "u", 3)], "collection string, uri string, content_length long")
    keys = ["collection", "uri"]
    sides = [_stored(spark, df, f"{tmp_path}/{n}", keys, unique=True) for n in "ab"]
    joined = sides[0].join(sides[1], keys, "full_outer")
    assert count(plan(joined), "Exchange") == 0 and joined.count() == 3


def test_writing_drops_copies_before_its_only_shuffle(spark, frame, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    stored = _stored(spark, frame([("u", "c", 1, "t", "a"), ("u", "d", 1, "t", "b")], SIDE), f"{tmp_path}/a")
    assert rows(stored) == [("u", "d", 1, "t", "b")]
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    with pytest.raises(Exception, match="non-empty directory"):
        layout.write_listing(stored, f"{tmp_path}/a", ["uri"], buckets=4)


def test_changes_are_merged_by_shuffling_the_changes(spark, frame, tmp_path, no_broadcast):  # noqa: F811
    rng = random.Random(3)
    stored_rows = [(f"u{k}", "c", k, "t", f"m{k % 3}") for k in range(60)]
    stored = _stored(spark, frame(stored_rows, SIDE), f"{tmp_path}/a")
    changes = [(f"u{rng.randint(0, 90)}", rng.choice("cd"), k, "t", f"m{rng.randint(0, 4)}", rng.choice([True, False, None])) for k in range(50)]
    merged = layout.with_changes(stored, frame(changes, SIDE + ", gone boolean"), ["uri"], deleted="gone")
    best = {}
    for row in [(*r, False) for r in stored_rows] + changes:
        # The newest, then the least content.
        rank = ([-ord(x) for x in row[4]], row[1:4])
        if row[0] not in best or rank < best[row[0]][0]:
            best[row[0]] = (rank, row)
    assert rows(merged) == rows(frame([r[:5] for _, r in best.values() if not r[5]], SIDE))
    text = plan(merged)
    # Stored rows without a change reach the result through joins with the shuffled keys alone.
    assert "LeftAnti" in text and count(text, "SelectedBucketsCount") == 2
    anti = text[text.index("LeftAnti"):]
    assert "Exchange" not in anti[: anti.index("FileScan")]
