import numpy as np
import pyarrow as pa

from stocktake.llm import suffixes, tokens


def test_long_texts_in_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    text = " ".join("x" * int(rng.integers(1, 40)) + str(k) for k in range(3000)) + " " + "y" * 5000 + " end\té\n"
    data, offsets = tokens.text_bytes(pa.array([None, text, ""]))
    whole = tokens.hashed_words(data, offsets, 1, 2), tokens.hashed_grams(data, offsets, 1, 2, 5)
    monkeypatch.setattr(tokens, "LONG", 1000)
    parts = tokens.hashed_words(data, offsets, 1, 2), tokens.hashed_grams(data, offsets, 1, 2, 5)
    for (a, b), (c, d) in zip(whole, parts):
        assert np.array_equal(a, c) and np.array_equal(b, d)
    assert len(whole[0][0]) == len(text.split())


def test_rows_do_not_run_into_each_other():
    data, offsets = tokens.text_bytes(pa.array(["ab", "cd", "", None, "abcd", "AB cd"]))
    hashes, rows = tokens.hashed_words(data, offsets, 0, 6)
    assert rows.tolist() == [0, 1, 2, 2, 2, 3, 5]
    assert hashes[0] == hashes[3] and hashes[1] == hashes[4] and len(set(hashes.tolist())) == 3
    grams, places = tokens.hashed_grams(data, offsets, 0, 6, 3)
    assert places.tolist() == [0, 1, 2, 2, 2, 5, 7]  # ^ab; ^cd; ^ab abc bcd; ^ab ^cd
    assert list(tokens.chunks(offsets, 2)) == [(0, 1), (1, 4), (4, 5), (5, 6)]


def test_sliced_columns():
    column = pa.array(["skip", "one two", None, "three"]).slice(1)
    data, offsets = tokens.text_bytes(column)
    assert tokens.hashed_words(data, offsets, 0, 3)[1].tolist() == [0, 2, 2, 3]


def test_segments_of_a_long_text(monkeypatch):
    rng = np.random.default_rng(2)
    text = "".join(rng.choice(list("abcdefg"), 5000))
    batch = pa.RecordBatch.from_arrays([pa.array([text]), pa.array([7], pa.int64())], ["text", "key"])
    monkeypatch.setattr(suffixes, "PIECE", 700)
    found = np.concatenate([r[0] for r in suffixes.records(batch)])
    covered = np.concatenate([np.arange(r["at"], r["at"] + r["n"]) for r in found])
    assert sorted(covered.tolist()) == list(range(5000 - suffixes.LENGTH + 1))
