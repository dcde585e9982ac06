import numpy as np
import pytest

from stocktake.llm import decontaminate
from llm_fixtures import documents  # noqa: F401


def distance(a, b):
    row = list(range(len(b) + 1))
    for x in a:
        new = [row[0] + 1]
        for k, y in enumerate(b):
            new.append(min(row[k] + (x != y), row[k + 1] + 1, new[k] + 1))
        row = new
    return row[-1]


def test_best_stretch():
    rng = np.random.default_rng(3)
    for _ in range(60):
        item, text = rng.integers(4, size=rng.integers(1, 7)).astype(np.uint64), rng.integers(4, size=rng.integers(0, 12)).astype(np.uint64)
        edits, begin, end = decontaminate.best_stretch(item, text)
        every = [distance(item.tolist(), text[a:b].tolist()) for a in range(len(text) + 1) for b in range(a, len(text) + 1)]
        assert edits == min(every) == distance(item.tolist(), text[begin:end].tolist())


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at, kind = int(rng.integers(len(words))), int(rng.integers(3))
        if kind == 0:
            words[at] = f"new{rng.integers(10**6)}"
        elif kind == 1 and len(words) > 1:
            del words[at]
        else:
            words.insert(at, f"new{rng.integers(10**6)}")
    return words


def corpus(seed):
    rng = np.random.default_rng(seed)
    common = [f"c{k}" for k in range(30)]

    def prose(n):
        return [common[int(rng.integers(30))] if rng.random() < 0.5 else f"w{rng.integers(3000)}" for _ in range(n)]

    items = [(k, prose(int(rng.integers(16, 60)))) for k in range(40)] + [(100 + k, prose(k + 1)) for k in range(5, 15)]
    docs = []
    for k in range(300):
        words = prose(int(rng.integers(0, 300)))
        if k % 2:
            _, own = items[int(rng.integers(len(items)))]
            at = int(rng.integers(len(words) + 1))
            words[at:at] = edited(rng, own, int(rng.integers(len(own) * 20 // 100 + 2)))
        docs.append((k, " ".join(words).title() if k % 3 else " ".join(words)))
    return docs, items


def brute(docs, items):
    found = {}
    for doc_id, text in docs:
        words = (text or "").lower().split()
        for item_id, own in items:
            row = [0] * (len(words) + 1)
            for k, x in enumerate(own):
                new = [k + 1]
                for j, y in enumerate(words):
                    new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
                row = new
            if own and min(row) <= len(own) * 20 // 100:
                found[doc_id, item_id] = min(row)
    return found


def test_recall_against_brute_force(spark, documents):
    docs, items = corpus(1)
    benchmark = spark.createDataFrame([(k, " ".join(w), 0.1) for k, w in items], "item_id long, text string, doc_id double")
    found = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(documents(docs), benchmark).collect()}
    want = brute(docs, items)
    assert set(found) <= set(want)  # verified exactly: nothing else
    assert len(found) >= 0.95 * len(want) > 50
    exact = {k for k, edits in want.items() if edits == 0}
    assert exact <= set(found)
    for k, r in found.items():
        assert r["edits"] >= want[k]
    clean = {r["doc_id"] for r in decontaminate.without_items(documents(docs), benchmark).collect()}
    assert clean == {k for k, _ in docs} - {k for k, _ in found}


def test_edges(spark, documents):
    item = " ".join(f"a{k}" for k in range(20))
    benchmark = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (None, item), (4, "solo")], "item_id long, text string")
    rows = [(1, None), (2, ""), (3, item.upper()), (3, item.upper()), (None, "x " * 20_000 + item), (5, item + " y " + item), (6, "the solo end"), (7, "é" * 9)]
    docs = documents(rows)
    found = sorted(map(tuple, decontaminate.contaminated(docs, benchmark).collect()), key=str)
    of_item = [(d, i) for d in (3, 3, None, 5) for i in (1, 1, None)]
    assert sorted([f[:2] for f in found], key=str) == sorted([*of_item, (6, 4)], key=str)
    assert {f[3] for f in found if f[0] == 5} == {0} and {f[3] for f in found if f[0] is None} == {20_000}
    out = decontaminate.without_items(docs, benchmark)
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 2, 7]
    assert decontaminate.contaminated(documents([]), benchmark).count() == 0
    assert decontaminate.contaminated(docs, benchmark.limit(0)).count() == 0
    assert decontaminate.without_items(docs, benchmark.limit(0)).count() == len(rows)


@pytest.mark.parametrize("block", [1, 7])
def test_blocks_of_items(spark, documents, block):
    docs, items = corpus(2)
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in items[:12]], "item_id long, text string")
    index = list(decontaminate.indexes(benchmark, block=block))
    assert sum(len(i.ids) for i in index) == 12 and len(index) == -(-12 // block)


LENGTHS = [5, 6, 8, 9, 12, 15, 16, 19, 20, 24, 32, 47, 63, 64, 100, 128]


def planted(rng, n, pattern, count):
    """Items of n words and texts that hold them with all the edits allowed, between other words."""
    items = [rng.integers(1, 1 << 63, n, dtype=np.uint64) for _ in range(count)]
    texts = []
    for item in items:
        own = decontaminate._edited(rng, item, n * 20 // 100, pattern)
        texts.append(np.concatenate([rng.integers(1, 1 << 63, int(rng.integers(0, 60)), dtype=np.uint64), own, rng.integers(1, 1 << 63, int(rng.integers(0, 60)), dtype=np.uint64)]))
    return items, texts


@pytest.mark.parametrize("pattern", decontaminate.PATTERNS)
def test_recall_of_every_length_with_all_edits_allowed(pattern):
    rng = np.random.default_rng(17)
    for n in LENGTHS:
        found = tried = 0
        for _ in range(2):
            items, texts = planted(rng, n, pattern, 50)
            index = decontaminate.Index(list(range(len(items))), items)
            rows = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            words = np.concatenate(texts)
            worth = set(decontaminate.worth_walking(words, rows, index).tolist())
            assert worth == set(range(len(texts)))  # the first look passes over none of them
            hits = {(row, item) for row, item, *_ in decontaminate._of_rows(words, rows, index)}
            found += sum((k, k) in hits for k in range(len(items)))
            tried += len(items)
        assert found >= 0.95 * tried, (n, found / tried)


def test_walks_derive_from_the_recall():
    for size in (5, 16, 40):
        assert decontaminate.WALKS[size] == decontaminate.walks_needed(size, trials=96, tried=64)
    assert decontaminate.walks_needed(16, recall=0.5) < decontaminate.walks_needed(16, recall=0.99)
    assert decontaminate.walks_needed(16, edits=0) == 1
    sizes = decontaminate.sizes_up_to(1000)
    assert sizes == sorted(set(sizes)) and {16, 32, 64, 128} <= set(sizes) and all(decontaminate._largest(a) == b - 1 for a, b in zip(sizes, sizes[1:]))


def test_many_items_take_longer_keys(monkeypatch):
    rng = np.random.default_rng(5)
    items, texts = planted(rng, 20, "changed any", 60)
    monkeypatch.setattr(decontaminate, "ITEMS", 10)
    index = decontaminate.Index(list(range(60)), items)
    assert {len(steps) for of in index.classes for (_, steps), *_ in of.walks} == {decontaminate.SAMPLED + 1}
    rows = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    assert len({r for r, *_ in decontaminate._of_rows(np.concatenate(texts), rows, index)}) >= 57


def test_rows_walked_together_change_nothing(monkeypatch):
    docs, items = corpus(6)
    import pyarrow as pa

    index = decontaminate._index([i for i, _ in items], [" ".join(w) for _, w in items], 20)
    texts = pa.array([t for _, t in docs])
    want = list(decontaminate.matches(texts, index))
    monkeypatch.setattr(decontaminate, "TOGETHER", 100)
    assert list(decontaminate.matches(texts, index)) == want and len(want) > 50
