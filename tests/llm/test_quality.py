import re

import pytest

from stocktake.llm import quality
from llm_fixtures import documents  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    places = {}
    for k in range(len(words) - 7):
        places.setdefault(tuple(words[k : k + 8]), []).append(k)
    covered = {x for v in places.values() if len(v) > 1 for k in v for x in range(k, k + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


TEXTS = [
    None, "", " \n\t ", "one", "a b c d e f g h", "a b c d e f g h " * 2, "x " * 40, "x\ny\nx\n\n \nx \n", "é\x0bü\x0cñ\x85z w", "# $ %& <a> | *",
    "p q r s t u v w x a b c d e f g h i p q r s t u v w x", " lead and trail ", "w" * 100_000, "a b c d e f g h i " * 3000,
]


def test_counts(documents):
    rows = list(enumerate(TEXTS))
    for r in quality.judge(documents(rows + rows[:2])).collect():
        want = brute(TEXTS[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_faults_of_each_kind_are_found(documents):
    good = [(k, "\n".join(" ".join(f"w{k}x{j}y{i}" for i in range(25)) + "." for j in range(3))) for k in range(300)]
    shout = [(1000 + k, " ".join(f"BUY{k}{j}!!" for j in range(40))) for k in range(12)]
    signs = [(2000 + k, " ".join(f"word{k}{j}###" for j in range(40))) for k in range(12)]
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(documents(good + shout + signs)).collect()}
    assert all(kept[k] for k, _ in good)
    assert not any(kept[k] for k, _ in shout + signs)


def test_fit_weighs_rules():
    names = ["precise", "noisy", "praise"]
    patterns = [((0, 0, 1), 800), ((-1, 0, 0), 100), ((0, -1, 1), 40), ((-1, -1, 0), 20), ((0, 0, 0), 40)]
    prior, chances = quality.fit(patterns, names)
    assert sum(prior) == pytest.approx(1) and prior[0] > 0.7
    assert chances[0]["precise"][quality.BAD] < 0.05 < chances[1]["precise"][quality.BAD]
    assert quality.fit([], names)[0] == [1.0]


def test_a_noisy_rule_is_overruled():
    # "noisy" votes on a tenth of everything, whatever the others say.
    names = ["precise", "second", "noisy", "praise"]
    clean, foul = (0, 0, 0, 1), (-1, -1, 0, 0)
    patterns = [(clean, 7200), ((0, 0, -1, 1), 800), (foul, 700), ((-1, -1, -1, 0), 80), ((-1, 0, 0, 0), 100), ((0, -1, -1, 0), 20)]
    prior, chances = quality.fit(patterns, names)
    good = {votes: belief(votes, names, prior, chances) for votes, _ in patterns}
    assert good[0, 0, -1, 1] > 0.9 and good[foul] < 0.1 and good[0, -1, -1, 0] < 0.5
    assert abs(weight(chances, "noisy")) < 0.3 < 1 < weight(chances, "precise")


def test_weak_votes_drop_a_document_together():
    names = ["gross", "weak one", "weak two", "weak three", "praise"]
    patterns = [((0, 0, 0, 0, 1), 8000)]
    # Each weak fault alone is common among good documents, all of them together among those with a gross fault.
    patterns += [((0, *[-1 if k == j else 0 for k in range(3)], 1), 300) for j in range(3)]
    patterns += [((-1, -1, -1, -1, 0), 300), ((-1, -1, -1, 0, 0), 100), ((0, -1, -1, -1, 0), 60), ((0, -1, -1, -1, 1), 5)]
    prior, chances = quality.fit(patterns, names, {"gross": quality.PRECISE})
    good = {votes: belief(votes, names, prior, chances) for votes, _ in patterns}
    assert all(good[0, *[-1 if k == j else 0 for k in range(3)], 1] > 0.5 for j in range(3))
    assert good[0, -1, -1, -1, 0] < 0.1 < good[0, -1, -1, -1, 1]  # praise speaks for the others


def belief(votes, names, prior, chances):
    odds = prior[1] / prior[0]
    for x, v in zip(names, votes):
        odds *= chances[1][x][v] / chances[0][x][v]
    return 1 / (1 + odds)


def weight(chances, rule):
    """How much a bad vote of the rule speaks for the bad class."""
    import math

    return math.log(chances[1][rule][quality.BAD] / chances[0][rule][quality.BAD])


def plain_em(rows, names):
    """Expectation-maximisation document by document, without counted patterns; rows of votes. The probability of each to be good."""
    import math

    start = [math.log(a / (1 - a)) for a in (quality.PRECISE if x in quality.GROSS else quality.WEAK for x in names)]
    p = [1 / (1 + math.exp(-sum(w * v for w, v in zip(start, r)))) for r in rows]
    for _ in range(quality.ROUNDS):
        share = [(sum(p) + 1) / (len(rows) + 2), (len(rows) - sum(p) + 1) / (len(rows) + 2)]
        chance = [[{v: (sum(q for q, r in zip(side, rows) if r[k] == v) + 0.1) / (sum(side) + 0.3) for v in (-1, 0, 1)} for k in range(len(names))]
                  for side in (p, [1 - q for q in p])]
        new = []
        for r in rows:
            odds = share[1] / share[0]
            for k, v in enumerate(r):
                odds *= chance[1][k][v] / chance[0][k][v]
            new.append(1 / (1 + odds))
        done = max(abs(a - b) for a, b in zip(new, p)) < quality.SETTLED
        p = new
        if done:
            break
    return p


def test_kept_against_plain_expectation_maximisation(documents):
    import random

    rng = random.Random(4)
    rows = []
    for k in range(400):
        words = [f"w{rng.randint(0, 900)}" * rng.choice([1, 1, 1, 2]) for _ in range(rng.choice([10, 30, 80, 120]))]
        if rng.random() < 0.2:
            words = [w + rng.choice(["#", "##", "", "!"]) for w in words]
        if rng.random() < 0.1:
            words = [w.upper() for w in words]
        size = rng.choice([5, 20, 60])
        lines = [" ".join(words[i : i + size]) + rng.choice([".", ".", ""]) for i in range(0, len(words), size)]
        rows.append((k, "\n".join(lines + lines[: rng.choice([0, 0, 0, 2])])))
    found = quality.judge(documents(rows)).collect()
    names = list(quality.rules())
    want = plain_em([[r[x] for x in names] for r in found], names)
    for r, p in zip(found, want):
        assert r["quality"] == pytest.approx(p, abs=1e-6)
        assert r["kept"] == (not r["base_failed"] and p >= 0.5)
    assert 20 < sum(r["kept"] for r in found) < 380


def test_verdicts_on_given_documents(spark):
    """The verdict is not that all rules must pass, and it agrees with the labels it never sees."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    names = list(quality.rules())
    found = quality.judge(docs).join(labels.where("quality IS NOT NULL").selectExpr("doc_id", "quality AS label"), "doc_id", "left").collect()
    strict = [not r["base_failed"] and all(r[x] != quality.BAD for x in names) for r in found]
    assert sum(r["kept"] != s for r, s in zip(found, strict)) > 0.02 * len(found)
    passed = [r for r in found if r["label"] is not None and not r["base_failed"]]
    assert sum(r["kept"] == (r["label"] == 1) for r in passed) > 0.99 * len(passed)


def test_empty(documents):
    assert quality.judge(documents([])).count() == 0
