import hashlib
from collections import Counter, defaultdict

import pytest

from stocktake.llm import sharding
from llm_fixtures import documents  # noqa: F401


def key(doc_id, text):
    return f"{int(hashlib.md5(f'{'' if doc_id is None else doc_id}:{text or ''}'.encode()).hexdigest()[:15], 16):060b}"


def brute(rows, limit):
    """Split whatever is too large on one more bit."""
    out, todo = {}, [("", [(key(*r), len((r[1] or "").encode())) for r in rows])]
    while todo:
        prefix, own = todo.pop()
        if sum(b for _, b in own) <= limit or len(own) == 1 or len(prefix) == 60:
            for k, b in own:
                out[k] = (prefix, sum(b for _, b in own))
            continue
        for bit in "01":
            if some := [x for x in own if x[0][len(prefix)] == bit]:
                todo.append((prefix + bit, some))
    return out


ROWS = [(k, "é" * (k % 50)) for k in range(3000)] + [(None, None), (None, "x"), (7, ""), (9999, "z" * 700)]


@pytest.mark.parametrize("limit", [500, 3000, 10**9])
def test_against_splitting(documents, limit):
    found = sharding.shards(documents(ROWS), limit).collect()
    assert len(found) == len(ROWS)
    want = brute(ROWS, limit)
    shard_of = Counter((r["shard"], r["shard_bytes"]) for r in found if r["shard_bytes"] <= limit)
    assert shard_of == Counter(v for v in want.values() if v[1] <= limit)
    size = defaultdict(int)
    for r in found:
        size[r["shard"], r["part"]] += r["n_bytes"]
    for r in found:
        assert size[r["shard"], r["part"]] == r["shard_bytes"]
        assert r["oversized"] == (r["shard_bytes"] > limit) and (not r["oversized"] or r["n_bytes"] > limit)
        assert len(r["shard"]) == r["depth"]


def test_repeated_rows_overflow(documents):
    rows = [(1, "a" * 10)] * 1000 + [(2, "b")]
    found = sharding.shards(documents(rows), 95).collect()
    assert len(found) == 1001
    parts = Counter(r["part"] for r in found if r["doc_id"] == 1)
    assert sorted(parts.values()) == [1] + [9] * 111
    assert all(r["shard_bytes"] <= 95 for r in found)


def test_empty(documents):
    assert sharding.shards(documents([])).count() == 0
    assert [r["n_bytes"] for r in sharding.shards(documents([(1, None)])).collect()] == [0]


@pytest.mark.parametrize("broadcast_rows", [0, 10**6])
@pytest.mark.parametrize("limit", [500, 10**9])
def test_written_shards(spark, documents, tmp_path, limit, broadcast_rows):
    rows = [*ROWS, *[(1, "a" * 100, f"source {k % 3}") for k in range(40)], (5, "z" * 2000)]
    docs = documents(rows)
    folder = f"file://{tmp_path}/shards"
    sharding.write_shards(docs, folder, limit, broadcast_rows)
    stored = sharding.read_shards(spark, folder, docs.schema).collect()
    assert sorted(map(str, (tuple(r["row"]) for r in stored))) == sorted(map(str, map(tuple, docs.collect())))  # texts and all columns
    held = defaultdict(list)
    for r in stored:
        assert key(r["row"]["doc_id"], r["row"]["text"]).startswith(r["shard"])
        held[r["shard"], r["part"]].append(len((r["row"]["text"] or "").encode()))
    assert all(sum(sizes) <= limit or len(sizes) == 1 for sizes in held.values())
    folders = {(p.parent.name, p.name) for p in (tmp_path / "shards").glob("shard=*/part=*")}
    assert folders == {(f"shard=b{s}", f"part={n}") for s, n in held}
    assert all(len(list((tmp_path / "shards" / s / p).glob("*.parquet"))) == 1 for s, p in folders)
    told = Counter((r["doc_id"], r["shard"], r["part"], r["shard_bytes"]) for r in sharding.shards(docs, limit, broadcast_rows).collect())
    assert told == Counter((r["row"]["doc_id"], r["shard"], r["part"], sum(held[r["shard"], r["part"]])) for r in stored)
