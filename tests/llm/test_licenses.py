import math
import re
import textwrap

import numpy as np
import pytest

from stocktake.llm import licenses
from llm_fixtures import documents  # noqa: F401

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, notices, threshold):
    own, starts, base = words(text), [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for k in range(len(own) - len(p) + 1):
            if own[k : k + len(p)] == p:
                starts.append(k)
                base.add(label)
    held = {}
    for line in (text or "").split("\n"):
        block = set(words(line))
        found = []
        for label, texts in notices.items():
            for t in texts:
                notice = set(words(t))
                if len(block & notice) >= math.ceil(round(threshold * len(notice), 9)):
                    found.append((label, len(block & notice) / len(notice), block & notice))
        for label, share, shared in found:
            if not any(s > share and shared <= o for _, s, o in found):
                held[label] = max(held.get(label, 0), share)
    score = 1.0 if starts else max(held.values(), default=0.0)
    return (len(own), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | set(held))), score)


def texts(seed):
    rng = np.random.default_rng(seed)
    out = [None, "", "MIT License", "mit\nlicense mit-license", "GNU General Public License, the general public license!", "Apache  LICENSE mit license", "é mit licenses ümit license",
           "word " * 60_000 + "mit license", "license", "permitted under the terms"]
    every = [t for ts in licenses.NOTICES.values() for t in ts]
    for t in every:
        out.append(t.upper())
        out.append("first line\n" + t + " and more of it\nlast line")
        for drop in (0.1, 0.2, 0.25, 0.5):
            w = t.split()
            gone = set(rng.choice(len(w), int(len(w) * drop), replace=False).tolist())
            out.append("x y " + " ".join(x for k, x in enumerate(w) if k not in gone) + " z")
        out.append(t.replace(" ", "\n"))
    return out


@pytest.mark.parametrize("threshold", [0.8, 0.5, 1.0])
def test_against_counting(documents, threshold):
    rows = list(enumerate(texts(1))) + [(2, "MIT License"), (None, "mit license")]
    found = licenses.scan(documents(rows), threshold=threshold).collect()
    want = sorted([(k, *brute(t, licenses.NOTICES, threshold)) for k, t in rows], key=str)
    assert sorted([tuple(r) for r in found], key=str) == want


def test_empty_and_other_notices(documents):
    assert licenses.scan(documents([])).count() == 0
    found = licenses.scan(documents([(1, "all rights reserved by ACME corp")]), {"acme": ["All rights reserved by Acme"]}).first()
    assert found["labels"] == "acme" and found["score"] == 1.0 and found["base_labels"] == ""


def brute_windows(text, notices, threshold):
    own, held, found = words(text), {}, []
    for label, texts in notices.items():
        for t in texts:
            notice, length = set(words(t)), math.ceil(round(len(words(t)) / threshold, 9))
            for k in range(len(own)):
                if own[k] in notice:
                    hits = [(i, w) for i, w in enumerate(own[k : k + length], k) if w in notice]
                    shared = {w for _, w in hits}
                    if len(shared) >= math.ceil(round(threshold * len(notice), 9)):
                        found.append((label, len(shared) / len(notice), shared, k, hits[-1][0]))
    for label, share, shared, first, last in found:
        if not any(s > share and b <= last and e >= first and shared <= o for _, s, o, b, e in found):
            held[label] = max(held.get(label, 0), share)
    base = brute(text, {}, threshold)
    return (*base[:5], ",".join(sorted(set(filter(None, base[4].split(","))) | set(held))), base[6] or max(held.values(), default=0.0))


def wrapped(seed):
    rng = np.random.default_rng(seed)
    out = [t for t in texts(seed) if len(t or "") < 10_000]
    every = [t for ts in licenses.NOTICES.values() for t in ts]
    known = sorted({w for t in every for w in words(t)})
    for k, t in enumerate(every):
        comment = "\n".join(" * " + line for line in textwrap.wrap(t, 40))
        edited = words(t)
        edited.insert(len(edited) // 2, "really")
        out += [comment, "x " * (37 * k) + comment + "\n" + every[k - 1], "the of\n" * k + textwrap.fill(" ".join(edited), 30) + " the license" * k]
        out.append(" filler words in between ".join(t.split()))  # all words, but scattered
    for n in (50, 300, 1500):
        out.append(" ".join(rng.choice(known, n)))
        out.append("\n".join(rng.choice([*every, "some other line", "the license of the software"], n // 10)))
    return out


@pytest.mark.parametrize("threshold", [0.8, 0.5, 1.0])
def test_windows_against_counting(documents, threshold):
    rows = list(enumerate(wrapped(2))) + [(2, "MIT License"), (None, "mit license")]
    found = licenses.scan(documents(rows), threshold=threshold, across_lines=True).collect()
    want = sorted([(k, *brute_windows(t, licenses.NOTICES, threshold)) for k, t in rows], key=str)
    assert sorted([tuple(r) for r in found], key=str) == want


def test_query_finds_wrapped_notices(spark, tmp_path):
    notices = [(label, t) for label, ts in licenses.NOTICES.items() for t in ts]
    rows = [(k, textwrap.fill(t, 40)) for k, (_, t) in enumerate(notices)] + [(99, " filler words in between ".join(notices[3][1].split()))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r["labels"] for r in licenses.op10_licenses(spark, str(tmp_path)).collect()}
    assert found == {k: label for k, (label, _) in enumerate(notices)} | {99: ""}
