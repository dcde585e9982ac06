import re

import numpy as np
import pytest

from stocktake.llm import filters, jaccard
from stocktake.llm.components import components
from llm_fixtures import documents  # noqa: F401

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        r = find(k)
        least[r] = min(least.get(r, doc_id), doc_id)
    return sorted((doc_id, len(sets[k]), least[find(k)]) for k, (doc_id, _) in enumerate(rows))


def made(seed, vocabulary):
    """Texts of all sizes, some edited a little, some much, in groups."""
    rng = np.random.default_rng(seed)
    rows = [(9000, None), (9001, ""), (9002, " \n"), (9003, "One two"), (9004, "one\ttwo"), (9005, "two one"), (9006, "a b c d e"), (9006, "A b c d e")]
    k = 0
    for size in (5, 7, 8, 9, 12, 14, 20, 40, 90, 250):
        for _ in range(4):
            base = [str(x) for x in rng.integers(vocabulary, size=size)]
            for edits in (0, 0, 1, 1, 1, 2, 2, 3, 5, 8):
                w = list(base)
                for _ in range(min(edits, size // 6 + 1)):
                    w[int(rng.integers(len(w)))] = "E" + str(rng.integers(50))
                rows.append((int(k * 7919 % 100003), " ".join(w[: len(w) - int(rng.integers(2))])))
                k += 1
    return rows


@pytest.mark.parametrize("seed, vocabulary, ordered", [(1, 10**6, 1 << 20), (2, 6, 1 << 20), (3, 40, 0)])
def test_against_all_pairs(documents, monkeypatch, seed, vocabulary, ordered):
    monkeypatch.setattr(jaccard, "ORDERED", ordered)
    rows = made(seed, vocabulary)
    assert sorted(map(tuple, jaccard.similar(documents(rows).repartition(3)).collect())) == brute(rows)


def test_hot_lists_and_full_filters(documents, monkeypatch):
    """The way for hot shingles and a bit map that lets nearly all through give the same."""
    monkeypatch.setattr(jaccard, "HOT", 3)
    monkeypatch.setattr(filters, "BITS", (6, 6))
    monkeypatch.setattr(jaccard, "CROWD", 2)
    rows = made(4, 40)
    assert sorted(map(tuple, jaccard.similar(documents(rows)).collect())) == brute(rows)


@pytest.mark.parametrize("light", [0, 10, 1000])
def test_any_boundary(documents, monkeypatch, light):
    monkeypatch.setattr(jaccard, "boundary", lambda *_: light)
    rows = made(5, 30)
    assert sorted(map(tuple, jaccard.similar(documents(rows)).collect())) == brute(rows)


def test_null_ids_and_empty(documents):
    rows = [(None, "a b c d e f g h"), (5, "a b c d e f g h"), (None, None), (None, "z z z y y")]
    found = sorted(((r[0], r[2]) for r in jaccard.similar(documents(rows)).collect()), key=str)
    assert found == sorted([(None, 5), (5, 5), (None, None), (None, None)], key=str)
    assert jaccard.similar(documents([])).count() == 0


def test_one_of_each(documents):
    text = " ".join(str(k) for k in range(60))
    rows = [(4, text), (2, text), (2, text), (3, text + " more"), (7, "other words here in this one"), (8, None), (8, None), (None, text), (9, "")]
    docs = documents(rows)
    out = jaccard.one_of_each(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [2, 7, 8, 8, 9]
    assert jaccard.one_of_each(documents([])).count() == 0


def test_components(spark):
    chain = [(k, k + 1) for k in range(300)] + [(1000 + k, 1000) for k in range(1, 200)] + [(2001, 2000), (2000, 2001)]
    found = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert found == {k: 0 for k in range(1, 301)} | {1000 + k: 1000 for k in range(1, 200)} | {2001: 2000}
