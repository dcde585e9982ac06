import io
import random
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stocktake.llm import token_files
from llm_fixtures import documents  # noqa: F401

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("width", range(1, 33))
def test_packing(width):
    rng = np.random.default_rng(width)
    numbers = rng.integers(0, 1 << width, (3, 128), dtype=np.uint64).astype(np.uint32)
    words = token_files.packed(numbers, width)
    assert words.shape == (3, 2 * width)
    assert (token_files.unpacked(words, width) == numbers).all()
    # The lowest bits of the first word are the first number.
    assert int(words[0, 0]) & ((1 << width) - 1) == int(numbers[0, 0])


def file_of(docs, **options):
    buffer = io.BytesIO()
    buffer.close, real = (lambda: None), buffer.close
    writer = token_files.Writer(buffer, **options)
    for i, ids in docs:
        writer.add(i, np.array(ids, np.uint32))
    size = writer.close()
    data = buffer.getvalue()
    real()
    assert size == len(data)
    return data


def reader_of(data):
    return token_files.Reader(pa.PythonFile(io.BytesIO(data), "r"))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.none() | st.integers(-(2**63), 2**63 - 1), st.lists(st.sampled_from([0, 1, 2, 7, 300, 50_256, 2**32 - 1]) | st.integers(0, 900), max_size=2500)), max_size=5), st.sampled_from([0.0, 0.5, 0.9, 1.0]))
def test_file_round_trip(docs, width_at):
    data = file_of(docs, width_at=width_at)
    reader = reader_of(data)
    got = [(i, at, [int(x) for p in pieces for x in p]) for i, at, pieces in reader.documents()]
    at = 0
    for (i, ids), found in zip(docs, got, strict=True):
        assert found == (i, at, ids)
        at += len(ids)


def test_many_groups_and_any_range(monkeypatch):
    monkeypatch.setattr(token_files, "GROUP", 2)
    rng = np.random.default_rng(1)
    docs = [(k, rng.integers(0, 50_257, n)) for k, n in enumerate((0, 1, 1023, 1025, 9000, 5))]
    data = file_of(docs)
    every, reader = np.concatenate([d for _, d in docs]), reader_of(data)
    for first, last in [(0, 0), (0, 1), (1023, 1025), (5000, 11_054), (0, 11_054), (2048, 3072)]:
        assert (reader.ids(first, last) == every[first:last]).all()
    assert [np.concatenate([*p, []]).tolist() for _, _, p in reader.documents()] == [d.tolist() for _, d in docs]


def test_outliers_are_exceptions():
    ids = np.full(1024, 100, np.uint32)
    ids[[3, 900]] = 50_256, 40_000
    ids[5] = 103
    block = token_files.encoded_blocks(ids)
    least, n, width, exceptions = struct.unpack_from(token_files.HEAD, block[0])
    assert (least, n, width, exceptions) == (100, 1024, 0, 3)
    assert (token_files.decoded_blocks(block[0], [0]) == ids).all()
    assert len(block[0]) == token_files.HEAD_SIZE + 3 * 6


@pytest.mark.parametrize("damage", [lambda d: d[:-1], lambda d: b"XXXX" + d[4:], lambda d: b"", lambda d: d[:60] + d[61:]])
def test_damage_is_an_error(damage):
    with pytest.raises(ValueError):
        reader_of(damage(file_of([(1, range(3000))])))


PIECES = ["word", ",", ".\n", "\n\n", " Ä", "ÿ", "!?", " .", "7", "ª", "×", "ǈ", "\u0301", "\xa0", "\u3000", "word", " the", "  ", "\n", "\t\n ", "é", "漢字", "🙂", "'s", "' s", "...", "12", "_", "<|endoftext|>", " ", " x", "\x1c", "\x85", "ſ", "á", "don't", " I'LL"]


def test_words_give_the_ids_of_whole_texts(library):
    rng = random.Random(4)
    encoder = token_files.Encoder(TOKENIZER)
    texts = ["", " ", "\n\n a", "a \n", "x" * 5000] + ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    for k in range(0, len(texts), 100):
        part = texts[k : k + 100]
        assert [ids.tolist() for ids in encoder(part)] == [library(t) for t in part]


def test_words_of_given_documents(spark, library):
    texts = [r[0] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    assert [ids.tolist() for ids in token_files.Encoder(TOKENIZER)(texts)] == [library(t) for t in texts]
    assert [ids.tolist() for ids in token_files.Encoder(TOKENIZER, whole=True)(texts[:20])] == [library(t) for t in texts[:20]]


def test_bounded_table_of_words(monkeypatch, library):
    monkeypatch.setattr(token_files, "KEPT_WORDS", 3)
    encoder = token_files.Encoder(TOKENIZER)
    for t in ["one two three four five", "six " + "y" * 100, "one two", "y" * 100]:
        assert encoder([t])[0].tolist() == library(t)
    assert "y" * 100 not in encoder.known and len(encoder.known) <= 3 and len(encoder.known.older) <= 3


def expected(rows, library):
    out, start = [], 0
    for i, text in rows:
        ids = library(text or "") + [0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


ROWS = [(5, "five ! !"), (None, "none"), (-7, None), (3, ""), (2, "two " * 3000), (1, "<|endoftext|> is text"), (40, "é" * 700), (41, "\n")]


@pytest.mark.parametrize("file_ids", [1, 50, token_files.FILE_IDS])
def test_query_rows(spark, documents, tmp_path, library, file_ids):  # noqa: F811
    folder = f"file://{tmp_path}/tokens"
    docs = documents(ROWS).repartition(3)
    token_files.write_tokens(docs, folder, TOKENIZER, file_ids=file_ids)
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    want = expected(order, library)
    found = token_files.read_index(spark, folder).collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == want
    ids = {r["doc_id"]: (r["start"], r["ids"]) for r in token_files.read_tokens(spark, folder).collect()}
    assert ids == {i: (w[1], library(t or "") + [0]) for (i, t), w in zip(order, want)}
    assert len(list((tmp_path / "tokens").glob("*.tkf"))) == spark.read.parquet(f"{folder}/files").count()


def test_repeated_rows_and_ids(spark, documents, tmp_path, library):  # noqa: F811
    rows = [(1, "same"), (1, "same"), (1, "other"), (None, "same"), (0, "x")]
    token_files.write_tokens(documents(rows), f"{tmp_path}/t", TOKENIZER)
    found = sorted((tuple(r) for r in token_files.read_index(spark, f"{tmp_path}/t").collect()), key=lambda r: r[1])
    assert [r[0] for r in found] == [None, 0, 1, 1, 1]
    assert [r[1] for r in found] == [0, *np.cumsum([r[2] for r in found])[:-1].tolist()]
    assert sorted(r[3] for r in found if r[0] == 1) == sorted(w[3] for w in expected([(1, "same"), (1, "same"), (1, "other")], library))


def test_files_that_are_not_in_the_table_do_not_count(spark, documents, tmp_path):  # noqa: F811
    token_files.write_tokens(documents([(1, "a"), (2, "b")]), f"{tmp_path}/t", TOKENIZER)
    (tmp_path / "t" / "00000000-000000-left-by-a-lost-task.tkf").write_bytes(b"rest")
    assert token_files.read_index(spark, f"{tmp_path}/t").count() == 2


def test_empty(spark, documents, tmp_path):  # noqa: F811
    token_files.write_tokens(documents([]), f"{tmp_path}/t", TOKENIZER)
    assert token_files.read_index(spark, f"{tmp_path}/t").collect() == []


def test_query_on_given_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    found = sorted((tuple(r) for r in token_files.op12_tokens(spark, "/root/testdata/sf0.001").collect()), key=lambda r: r[1])
    assert found == expected(docs, library)


def test_units_are_the_text():
    for text in (" a b,\n c  ", "It's 12.5 e.g. this...\n\nNew\tline!? _x_ é漢 .", "a.b a. b ..c"):
        assert "".join(re.findall(token_files._UNITS, text)) == text
    assert re.findall(token_files._UNITS, "Of cats, dogs.\nAnd 'mice' ") == ["Of", " cats", ",", " dogs", ".", "\n", "And", " 'mice'", " "]


def test_words_before_any_ascii_mark_are_units(library):
    assert re.findall(token_files._UNITS, "cats%%% dogs### (x) a_b don't it's.") == ["cats", "%%%", " dogs", "###", " (x)", " a", "_b", " don't", " it's."]
    rng = random.Random(7)
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    texts = ["".join(rng.choice(["ab", " the", "é", "s", "ll", "7", " ", "\n", *rng.choices(marks, k=6)]) for _ in range(30)) for _ in range(2000)]
    assert [ids.tolist() for ids in token_files.Encoder(TOKENIZER)(texts)] == [library(t) for t in texts]
