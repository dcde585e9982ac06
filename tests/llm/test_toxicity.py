import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from stocktake.llm import toxicity
from llm_fixtures import documents  # noqa: F401

NICE, BAD = "river stone market letter window garden bread music".split(), "idiot scum worthless moron".split()


def labelled(n, seed, biased=True):
    """Texts with labels; toxic ones mention a group more often, so that an unregularised model blames the group."""
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for k in range(n):
        toxic = int(rng.random() < 0.3)
        words = [NICE[int(rng.integers(8))] for _ in range(30)]
        if toxic and rng.random() < 0.9:
            words[3] = BAD[int(rng.integers(4))]
        if rng.random() < (0.8 if toxic and biased else 0.1):
            words[7] = "muslims"
        rows.append((k, " ".join(words).capitalize() + "."))
        labels.append((k, 1, toxic, "x"))
    return rows, labels


@pytest.fixture(scope="module")
def texts():
    rows, labels = labelled(1500, 1)
    ids = []
    for (_, text), (_, _, toxic, _) in zip(rows, labels):
        from stocktake.llm.tokens import text_bytes

        (_, ((words, _), (parts, _))), = toxicity.feature_ids(*text_bytes(pa.array([text])))
        ids.append((toxic, np.unique(np.concatenate([words, parts]))))
    return ids


def score(model, text):
    weights, bias = model
    chosen = np.flatnonzero(weights)
    return float(toxicity.scores(pa.array([text]), chosen, weights[chosen], bias)[0])


def test_mentions_of_groups_are_not_blamed(texts):
    plain, fair = toxicity.fit(texts, fair=0.0), toxicity.fit(texts)
    mention, neutral = "The river and the muslims of the market.", "The river and the people of the market."
    assert score(plain, mention) - score(plain, neutral) > 0.2
    assert abs(score(fair, mention) - score(fair, neutral)) < 0.05
    assert score(fair, mention) < 0.5 and score(fair, "The river and the idiot of the market.") > 0.5


def test_held_out(spark, documents):
    rows, labels = labelled(1500, 2)
    docs, known = documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")
    fitted = toxicity.model(docs, known)
    found = {r["doc_id"]: r["score"] for r in toxicity.classify(docs, fitted).collect()}
    truth = {k: t for k, _, t, _ in labels}
    held = [k for k in truth if zlib.crc32(str(k).encode()) % 5 == 0]
    assert np.mean([(found[k] >= 0.5) == truth[k] for k in held]) > 0.93
    kept = toxicity.without_toxic(docs, known)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k, s in found.items() if s < 0.5}
    again = toxicity.model(docs.repartition(7), known.repartition(3))
    assert all(np.array_equal(a, b) for a, b in zip(fitted, again))


def test_only_training_rows_teach(spark, documents):
    rows, labels = labelled(600, 3)
    held = [k for k, *_ in labels if zlib.crc32(str(k).encode()) % 5 == 0]
    other = [(k, q, 1 - t if k in held else t, x) for k, q, t, x in labels]
    schema = "doc_id long, quality int, toxic int, text string"
    one = toxicity.model(documents(rows), spark.createDataFrame(labels, schema))
    two = toxicity.model(documents(rows), spark.createDataFrame(other, schema))
    assert all(np.array_equal(a, b) for a, b in zip(one, two))


def test_swapped_copies_of_each_text(spark, documents):
    identity = ["muslims", "jews", "women", "men"]
    texts = ["Jews and MUSLIMS met.", "the women, the womenfolk", "no group: womenfolk", "men; men and muslims", "épée jews", "jewsé"]
    ids = [k for k in range(1, 40) if zlib.crc32(str(k).encode()) % 5][: len(texts)]
    docs = documents(list(zip(ids, texts)))
    known = spark.createDataFrame([(k, 1, 0, "x") for k in ids], "doc_id long, quality int, toxic int, text string")
    found = toxicity.sample(docs, known, identity=identity)
    want = {}
    for text in texts:
        low = toxicity.features(text.encode())
        words = re.findall(r"[^\x00-\x60\x7b-\x7f]+", text.lower())
        present = [a for a in identity if a in words]
        for a in present:
            for b in [*(w for w in identity if w != a), ""]:
                copy = toxicity.features(" ".join(b if w == a else w for w in words).encode())
                change = tuple(sorted([(i, 1) for i in set(copy.tolist()) - set(low.tolist())] + [(i, -1) for i in set(low.tolist()) - set(copy.tolist())]))
                if change:
                    want[change] = want.get(change, 0) + 1 / 4
    got = {tuple(sorted(change.items())): n for change, n in toxicity.swaps_of(identity, found)}
    assert got == pytest.approx(want)


def test_one_row_for_each_sampled_id(spark, documents):
    rows, labels = labelled(300, 4)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")
    docs = documents(rows + [(k, f"{t} again {j}") for k, t in rows[:20] for j in range(30)])
    assert len(toxicity.sample(docs, known)) == sum(zlib.crc32(str(k).encode()) % 5 != 0 for k, _ in rows)
    assert len(toxicity.sample(docs, known, limit=50)) == 50


def test_edges(spark, documents):
    schema = "doc_id long, quality int, toxic int"
    docs = documents([(1, None), (2, ""), (2, ""), (None, "scum"), (3, "x " * 60_000)])
    for labels in ([], [(1, 1, None), (None, 1, 1)], [(1, 1, 1), (1, 0, 0), (3, 1, 0)], [(3, 1, 0)]):
        known = spark.createDataFrame(labels, schema)
        found = [tuple(r) for r in toxicity.classify(docs, toxicity.model(docs, known)).collect()]
        assert len(found) == 5 and all(0 <= s <= 1 for _, s in found)
        assert len({s for k, s in found if k in (1, 2)}) == 1
    assert toxicity.classify(documents([]), toxicity.model(documents([]), spark.createDataFrame([], schema))).count() == 0


def test_terms_of_slots_give_swaps_on_given_tables(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    terms = toxicity.terms_of_slots(docs, labels)
    assert 0 < len(terms) <= toxicity.TERMS and terms == toxicity.terms_of_slots(docs.repartition(5), labels)
    identity = [*toxicity.IDENTITY, *terms]
    texts = toxicity.sample(docs, labels, identity=identity)
    swaps = toxicity.swaps_of(identity, texts)
    assert len(swaps) > 0

    def gap(fair):
        weights, _ = toxicity.fit(texts, identity, fair=fair)
        return sum(n * abs(sum(x * weights[i] for i, x in change.items())) for change, n in swaps) / sum(n for _, n in swaps)

    assert gap(toxicity.FAIR) < 0.1 * gap(0.0)


def test_terms_stand_in_slots_of_either_label(spark, documents):
    filler = ["alpha", "beta", "gamma", "delta"]
    rows, labels = [], []
    for k in range(200):
        group, toxic = ["zorps", "blims", "quents"][k % 3] if k % 4 == 0 else "nothing", k % 2
        rows.append((k, f"the {group} are here {filler[k % 4]} {'vile' if toxic else 'kind'} {'x' * (k % 7 + 1)}{k}"))
        labels.append((k, int(k % 8 < 4)))
    found = toxicity.terms_of_slots(documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {"zorps", "blims", "quents"} <= set(found) and not {"vile", "kind", "the"} & set(found)
    assert toxicity.terms_of_slots(documents([]), spark.createDataFrame([], "doc_id long, toxic int")) == []


def test_null_ids_are_held_out(spark, documents, tmp_path):
    documents([(None, "a"), (None, None), (1, "b")]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1), (None, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = toxicity.op9_toxicity(spark, str(tmp_path)).collect()
    assert [r["held_out"] for r in found if r["doc_id"] is None] == [True, True] and all(r["score"] is not None for r in found)
