import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stocktake.llm import suffixes
from llm_fixtures import documents  # noqa: F401


def brute(texts, length=200):
    """(bytes, removed, runs, rest's digest) of each text."""
    texts = [(t or "").encode() for t in texts]
    count = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - length + 1):
            if count[t[k : k + length]] > 1:
                gone[k : k + length] = True
        left = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if t else 0, hashlib.sha256(left).hexdigest()))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([97, 98, 99, 255]), min_size=1, max_size=60))
def test_suffix_order(values):
    text = np.array(values, np.uint8)
    raw = text.tobytes()
    assert suffixes.suffix_order(text).tolist() == sorted(range(len(raw)), key=lambda k: raw[k:])


def rows_of(seed):
    rng = np.random.default_rng(seed)

    def words(n):
        return "".join(rng.choice(list("abcdeé \n"), n))

    shared, other = words(700), words(260)
    texts = [None, "", "short", words(199), words(5000), shared, "x" + shared, shared[:350] + words(30) + shared[351:], words(50) + other + words(80) + other,
             other[:199] + "!", other[:200] + "?", "a" * 450, "ab" * 120, "ab" * 99, words(120) + shared[100:420] + words(90)]
    return [(k, t) for k, t in enumerate(texts)] + [(4, texts[4]), (None, "n" * 10)]


@pytest.mark.parametrize("hot, piece", [(suffixes.HOT, suffixes.PIECE), (1, 300), (suffixes.HOT, 150)])
def test_against_counting(documents, monkeypatch, hot, piece):
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "PIECE", piece)

    for seed in (1, 2):
        rows = rows_of(seed)
        want = Counter(zip([r[0] for r in rows], brute([r[1] for r in rows])))
        found = suffixes.without_repeats(documents(rows)).collect()
        assert Counter((r["doc_id"], (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])) for r in found) == want


def test_many_batches(documents, monkeypatch):
    monkeypatch.setattr(suffixes, "BATCH", 2000)
    rng = np.random.default_rng(5)
    base = ["".join(rng.choice(list("abcdefgh "), 900)) for _ in range(6)]
    rows = [(k, base[k % 6][: 500 + 7 * k] + str(k) * 40 + base[(k + 1) % 6][k:]) for k in range(40)]
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffixes.without_repeats(documents(rows).repartition(3)).collect()}
    assert [found[k] for k, _ in rows] == brute([t for _, t in rows])


def test_empty(documents):
    assert suffixes.without_repeats(documents([])).count() == 0
