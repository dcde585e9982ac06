from collections import defaultdict

import pytest

from stocktake.llm import mixing
from llm_fixtures import documents  # noqa: F401


def fill(sizes, share=1.5, most=2.0):
    """Targets by taking excess away again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(names)}
    total, out, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        level = (total - sum(out.values())) / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] >= most * sizes[s]]
        if not over:
            return out | {s: level * weight[s] for s in open_}
        out |= {s: most * sizes[s] for s in over}
        open_ -= set(over)
    return out


ROWS = [(k, "w " * (k % 37), "abcd"[k % 4]) for k in range(200)] + [(500 + k, "x", "hot") for k in range(300)] + [
    (900, None, "a"), (901, "", None), (902, "one two\tthree four", None), (902, "one two\tthree four", None), (903, "w " * 5000, "c"), (None, "n n", "b"),
]


@pytest.fixture
def mixed(documents):
    return mixing.mix(documents(ROWS)).collect()


def test_targets_and_takes(mixed):
    assert len(mixed) == len(ROWS)
    source_of = {r[0]: r[2] for r in ROWS}
    sizes, taken, targets = defaultdict(int), defaultdict(int), {}
    for r in mixed:
        s = source_of[r["doc_id"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        targets[s] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert (r["position"] is None) == (r["taken"] == 0)
    want = fill(sizes)
    for s in sizes:
        assert targets[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= 1
    assert next(r["size"] for r in mixed if r["doc_id"] == 902) == 3


def test_words_follow_the_schedules(documents):
    rows = [(k, "w " * (5 + k % 20), "abcde"[k % 5]) for k in range(2000)] + [(5000 + k, "w " * 9, "a") for k in range(600)]
    found = mixing.mix(documents(rows)).collect()
    source_of, names = {r[0]: r[2] for r in rows}, "abcde"
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(names)}
    target = {source_of[r["doc_id"]]: r["target"] for r in found}
    assert any(r["taken"] > r["size"] for r in found)
    for tenth in range(1, 11):
        words = defaultdict(int)
        for r in found:
            takes = r["positions"]
            assert len(takes) == -(-r["taken"] // r["size"]) and takes == sorted(takes)
            assert (r["position"], r["last_position"]) == ((takes[0], takes[-1]) if takes else (None, None))
            for k, at in enumerate(takes):
                if at < tenth / 10:
                    words[source_of[r["doc_id"]]] += min(r["size"], r["taken"] - k * r["size"])
        for s in names:
            (t0, w0), (t1, w1) = mixing.SCHEDULES[weight[s]]
            t = tenth / 10
            demand = target[s] * (w0 * t + (w1 - w0) * t * t / 2) / ((w0 + w1) / 2)
            assert abs(words[s] - demand) <= 30, (s, tenth)  # one document more or less


def test_documents_come_in_the_order_of_their_takes(documents):
    rows = [(k, "w " * 10, "ab"[k % 2]) for k in range(400)]
    at = {r["doc_id"]: r["positions"] for r in mixing.mix(documents(rows)).collect()}
    seen, times = defaultdict(int), []
    for r in mixing.mixed_documents(documents(rows)).collect():
        times.append(at[r["doc_id"]][seen[r["doc_id"]]])
        seen[r["doc_id"]] += 1
    assert times == sorted(times) and max(seen.values()) == 2
    # The second passes of the heavy source do not wait for the end of the light one.
    assert sum(t < 0.9 for t in times) > 0.8 * len(times)


def test_order_and_reruns(mixed, documents):
    at = [r["position"] for r in mixed if r["position"] is not None]
    assert at == sorted(at) and all(0 <= p <= 1 for p in at)
    again = mixing.mix(documents(ROWS[::-1]).repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, mixed))


def test_due_time(spark):
    from pyspark.sql import functions as F

    knots = mixing.schedule_of(F.lit(9), {9: ((0.0, 0.0), (0.25, 2.0), (0.5, 0.0), (1.0, 1.0))})
    for done, want in ((0.0, 0.0), (0.25 / 0.75, 0.25), (0.5 / 0.75, 0.5), (1.0, 1.0), (0.0625 / 0.75, 0.125)):
        assert spark.range(1).select(mixing.due_time(F.lit(done), knots).alias("t")).first()["t"] == pytest.approx(want)


def test_documents(documents):
    docs = documents(ROWS)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    times = defaultdict(int)
    for r in out.collect():
        times[r["doc_id"]] += 1
    for r in mixing.mix(docs).collect():
        if r["size"] and r["doc_id"] != 902:
            assert times[r["doc_id"]] == int(r["taken"] / r["size"] + 0.5), r


def test_empty(documents):
    assert mixing.mix(documents([])).count() == 0
    assert mixing.mix(documents([(1, None), (2, "")])).where("taken = 0").count() == 2
