"""Look-ups of the longest beginning."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from stocktake.functions import longest, prefixes, skew
from stocktake.operators import manifests
from test_plans import count, no_broadcast, plan  # noqa: F401


@pytest.mark.parametrize("size", range(1, 20))
def test_way_to_every_place(size):
    for index in range(size):
        way = longest.way_to(index, size)
        assert way == sorted(way) and all(k < index for k in way) and len(way) < size.bit_length()


def _paths(rng, n, deep=6, names="ab"):
    return ["/".join(rng.choice(names) for _ in range(rng.randint(1, deep))) for _ in range(n)]


@pytest.mark.parametrize("large", [False, True])
@pytest.mark.parametrize("seed", range(3))
def test_longest_beginning_against_all(spark, frame, monkeypatch, seed, large):
    monkeypatch.setattr(skew, "PROBE_BYTES", 0 if large else 1 << 40)
    rng = random.Random(seed)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(25)]
    lines = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 12))) for _ in range(300)] + [None]
    index = longest.prefix_index(
        frame([(t,) for t in texts] + [(None,)], "t string"), "t", longest.first_characters, F.length,
        broadcast_rows=-1 if large else 1000,
    )
    assert index.small is not large and index.levels == sorted({len(t) for t in texts})
    found = index.longest(frame([(k, x) for k, x in enumerate(lines)], "k int, line string"), "line").collect()
    assert len(found) == len(lines)
    for r in found:
        assert r["longest"] == max((t for t in texts if r["line"] is not None and r["line"].startswith(t)), key=len, default=None)
    chain = {}
    for r in index.chain.collect():
        chain.setdefault(r["longest"], set()).add(r["text"])
    assert chain == {t: {x for x in texts if t.startswith(x)} for t in texts}


@pytest.mark.parametrize("large", [False, True])
def test_namespaces_by_index(spark, frame, monkeypatch, large):
    rng = random.Random(4)
    names = [(p, rng.choice("xy"), k) for k, p in enumerate(_paths(rng, 60))] + [("", "x", 98), ("a/", "y", 99), (None, "x", 97)]
    uris = [(u, rng.choice("xy")) for u in _paths(rng, 300, 9)] + [("/a", "x"), ("a//b", "y"), (None, "x"), ("", "x")]
    right = frame(names, "namespace string, g string, n int")
    left = frame(uris, "uri string, g string")
    for also_on in ([], ["g"]):
        part = right if also_on else right.drop("g")
        side = left if also_on else left.withColumnRenamed("g", "h")
        options = {"broadcast_rows": -1} if large else {}
        found = prefixes.match_namespaces_indexed(side, part, "uri", "namespace", also_on, **options)
        want = [
            (ns, *([g] if also_on else []), u, *([] if also_on else [g]), n)
            for u, g in uris for ns, g2, n in names
            if u is not None and ns is not None and u.startswith(ns + "/") and (not also_on or g == g2)
        ]
        columns = "namespace string, " + ("g string, uri string, n int" if also_on else "uri string, h string, n int")
        assert found.columns == [c.split()[0] for c in columns.split(", ")]
        assert rows(found) == rows(frame(want, columns))
        # The same as by forming all prefixes.
        assert rows(found) == rows(prefixes.match_namespaces(side, part, also_on=also_on).select(*found.columns))


def test_many_depths_are_looked_up_not_formed(spark, frame, monkeypatch):
    deep = frame([("/".join("a" * k),) for k in range(1, 30)], "namespace string")
    uris = frame([("/".join("a" * k),) for k in range(1, 40)], "uri string")
    found = prefixes.match_namespaces(uris, deep)
    assert found.count() == sum(min(k - 1, 29) for k in range(1, 40))
    # The URI side meets the index first; only the index itself forms all beginnings of its keys.
    assert count(plan(found).split("BroadcastExchange")[0], "Generate") == 0


def test_rows_stay_one_until_they_match(spark, frame):
    index = longest.prefix_index(
        frame([("a/" * k + "b",) for k in range(12)], "p string"), "p", longest.first_elements,
        lambda p: F.length(p) - F.length(F.translate(p, "/", "")) + 1,
    )
    uris = spark.range(1000).selectExpr("concat(repeat('a/', cast(id % 15 as int)), 'b/', id) AS uri")
    found = index.longest(uris, "uri")
    text = plan(found)
    # Twelve depths, four look-ups, no row made twice.
    assert count(text, "BroadcastHashJoin") >= 4 and found.count() == 1000
    assert "Generate" not in text.split("BroadcastExchange")[0]


def test_names_in_lines_whatever_their_lengths(frame):
    rng = random.Random(6)
    names = sorted({"".join(rng.choice("BCab") for _ in range(rng.randint(1, 7))) for _ in range(120)})
    lines = ["".join(rng.choice("BCab .") for _ in range(rng.randint(0, 14))) for _ in range(25)] + [None]
    found = manifests.not_listed(frame([(n,) for n in names], "name string"), frame([(x,) for x in lines], "line string"), "BC")
    assert rows(found) == sorted((n,) for n in names if n[0] in "BC" and not any(n in x for x in lines if x is not None))
    none = manifests.not_listed(frame([("Ab",)], "name string"), frame([("Ab",)], "line string"), "BC")
    assert rows(none) == []
