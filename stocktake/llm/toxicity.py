"""Toxicity by a counterfactually regularised classifier.

A logistic model on hashed words and word parts is fitted on a bounded sample of labelled texts. For every sampled text that mentions
an identity group, the features of copies with the group's word swapped for other sampled groups' and for a neutral word are made, and the
squared differences of their scores, as log odds, are added to the loss: a mere mention of a group must not move the score. Copies that differ
from their texts by the same features are added once, with their number. Group words come from a lexicon by language and from the sample itself: rare
words that stand in the same slots, between the same neighbours, as others do, about as often in texts of either label, are swapped like names of groups.

Defined results: a null id counts as the empty text, is held out and is never learned from; of rows with one id the sample takes one; null and empty texts get the score of the bias alone; rows are scored one by one; without any usable label
the score is 0, with labels of one class only it is that class's smoothed share; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktake.llm.common import ascii_lower, bounded_batches, table
from stocktake.llm.tokens import LETTERS, LOWER, chunks, hashed_grams, hashed_words, text_bytes

#: Labelled texts that the model is fitted on, at most: those with the smallest hashes of their ids.
SAMPLE = 6000
BITS = 20
#: Bytes of a word part; compounds share parts, not whole words.
PART = 5
FOLDS = 5
#: A word enters the model if its count among toxic texts is this many standard deviations from what its count among all would give.
NOTABLE, LEAST_TEXTS = 4.0, 4
RIDGE, FAIR, STEPS, RATE = 0.1, 20.0, 400, 0.1
#: Names of groups by language; a score never asks for a text's language, all are looked for in every text.
LEXICON = {
    "en": (
        "women men woman man girls boys muslims muslim christians christian jews jewish hindus hindu buddhists atheists black white asian asians "
        "african africans latino latinos arab arabs immigrants immigrant refugees foreigners gay gays lesbian lesbians straight bisexual transgender "
        "disabled blind deaf old young americans chinese mexicans indians germans french europeans"
    ).split(),
    "fr": "femmes femme hommes homme musulmans musulman chrétiens juifs noirs blancs arabes africains asiatiques immigrés réfugiés étrangers homosexuels handicapés".split(),
    "de": "frauen frau männer muslime muslim christen juden schwarze weiße araber afrikaner asiaten einwanderer flüchtlinge ausländer schwule lesben behinderte".split(),
    "es": "mujeres mujer hombres musulmanes cristianos judíos negros blancos árabes africanos asiáticos inmigrantes refugiados extranjeros gays lesbianas discapacitados".split(),
}
IDENTITY = list(dict.fromkeys(w for words in LEXICON.values() for w in words))
#: Group-like words taken from the sample, the share of its texts that may hold one (of small samples the number), and the texts of each label that must.
TERMS, RARE, RARE_TEXTS, LEAST_OF_EACH = 8, 0.02, 30, 2
#: Standard deviations by which a group-like word may be commoner or rarer among toxic texts: what marks toxic texts is no mere mention.
NEUTRAL_WITHIN = 1.5
NEUTRAL = "people"


def feature_ids(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, list[tuple[np.ndarray, np.ndarray]]]]:
    """(first row, [(ids, places of the rows)] of words and of word parts) for each chunk."""
    for first, last in chunks(offsets):
        found = [hashed_words(data, offsets, first, last, LETTERS), hashed_grams(data, offsets, first, last, PART)]
        yield first, [((hashes >> np.uint64(64 - BITS)).astype(np.int32), rows) for hashes, rows in found]


def ids_of(word: str) -> np.ndarray:
    """All ids of a word, its own first, then those of its parts."""
    _, ((words, _), (parts, _)) = next(feature_ids(*text_bytes(pa.array([word]))))
    return np.concatenate([words, np.unique(parts)])


def train_fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS != 0


def features(text: bytes) -> np.ndarray:
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    found = [ids for _, pairs in feature_ids(data, offsets) for ids, _ in pairs]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int32)


def mentions(text: bytes, ids: np.ndarray, pattern: re.Pattern) -> dict[str, np.ndarray]:
    """For each identity word of the text the ids that go with it: other words may share its parts."""
    text = text.translate(LOWER.tobytes())
    found = {}
    for word in sorted(set(pattern.findall(text))):
        rest = pattern.sub(lambda m: b" " if m[0] == word else m[0], text)
        found[word.decode()] = np.setdiff1d(ids, features(rest))
    return found


def pattern_of(identity: list[str]) -> re.Pattern:
    """Whole words, where letters are those of LETTERS in small letters."""
    words = b"|".join(sorted((re.escape(w.encode()) for w in identity), key=len, reverse=True))
    return re.compile(rb"(?<![a-z\x80-\xff])(?:" + words + rb")(?![a-z\x80-\xff])" if identity else rb"(?!)")


def _chosen(labels: DataFrame, limit: int) -> DataFrame:
    """Ids of the sample with their labels; conflicting labels count as toxic."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & train_fold(F.col("doc_id")))
    return known.groupBy("doc_id").agg(F.max("toxic").alias("_toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def terms_of_slots(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE, most: int = TERMS) -> list[str]:
    """Rare words of the sample that meet most other such words in a slot, a pair of neighbouring words, and are no sign of either label.

    All of it is counted where the texts are; at most `most` words come back.
    """
    chosen = _chosen(labels, limit)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("_toxic").alias("_toxic"))
    words = F.regexp_extract_all(ascii_lower(F.coalesce(F.col("text"), F.lit(""))), F.lit(r"([a-z\x{80}-\x{10FFFF}]+)"), F.lit(1))
    triples = F.when(F.size("words") > 2, F.transform(
        F.sequence(F.lit(1), F.size("words") - 2), lambda i: F.struct(F.get("words", i - 1).alias("left"), F.get("words", i).alias("word"), F.get("words", i + 1).alias("right"))
    ))
    slots = texts.select("doc_id", "_toxic", words.alias("words")).select("doc_id", "_toxic", F.explode(F.array_distinct(triples)).alias("s")).select("doc_id", "_toxic", "s.*")
    size = texts.agg(F.count("*").alias("all"), F.count_if(F.col("_toxic") > 0).alias("toxic")).first()
    share, n = size["toxic"] / max(1, size["all"]), F.col("toxic") + F.col("clean")
    if not 0 < share < 1:
        return []
    surprise = F.abs(F.col("toxic") - n * share) / F.sqrt(n * share * (1 - share))
    held = slots.select("doc_id", "_toxic", "word").distinct().groupBy("word").agg(
        F.count_if(F.col("_toxic") > 0).alias("toxic"), F.count_if(F.col("_toxic") <= 0).alias("clean")
    ).where(
        (F.col("toxic") >= LEAST_OF_EACH) & (F.col("clean") >= LEAST_OF_EACH) & (n <= max(RARE * size["all"], RARE_TEXTS)) & (surprise <= NEUTRAL_WITHIN)
    )
    met = slots.select("left", "right", "word").distinct().join(held.select("word"), "word")
    shared = met.groupBy("left", "right").agg(F.count("*").alias("words")).where("words > 1").select("left", "right")
    ranked = met.join(shared, ["left", "right"]).groupBy("word").agg(F.count("*").alias("slots")).orderBy(F.desc("slots"), "word").limit(most)
    return [r["word"] for r in ranked.collect()]


def sample(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE, identity: list[str] = IDENTITY) -> list[tuple[int, np.ndarray, dict[str, np.ndarray]]]:
    """(label, word ids, ids that go with each identity word) of the sampled training texts, featurised where the texts are; one for each id.
    Conflicting labels count as toxic."""
    chosen, pattern = _chosen(labels, limit), pattern_of(identity)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            out, gone = [], []
            for first, ((words, at), (parts, of)) in feature_ids(data, offsets):
                for k in range(len(at) - 1):
                    ids = np.unique(np.concatenate([words[at[k] : at[k + 1]], parts[of[k] : of[k + 1]]]))
                    found = mentions(data[offsets[first + k] : offsets[first + k + 1]].tobytes(), ids, pattern)
                    out.append(ids.tobytes())
                    gone.append([{"word": w, "ids": i.tobytes()} for w, i in found.items()])
            kind = pa.list_(pa.struct([("word", pa.string()), ("ids", pa.binary())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_toxic"), pa.array(out, pa.binary()), pa.array(gone, kind)], ["doc_id", "toxic", "ids", "gone"])

    # The sample has a documented bound, so it is broadcast and the texts stay where they are.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = texts.mapInArrow(featurise, "doc_id long, toxic int, ids binary, gone array<struct<word:string,ids:binary>>")
    rows = found.groupBy("doc_id").agg(F.min(F.struct("ids", "gone", "toxic")).alias("x")).select("doc_id", "x.*").collect()
    rows.sort(key=lambda r: r["doc_id"])
    return [(int(r["toxic"] > 0), np.frombuffer(r["ids"], np.int32), {g["word"]: np.frombuffer(g["ids"], np.int32) for g in r["gone"]}) for r in rows]


def swaps_of(identity: list[str], texts: list[tuple]) -> list[tuple[dict[int, int], float]]:
    """Swaps of the groups that texts mention, each for all others mentioned anywhere and for the neutral word (which no weight knows): the ids
    that come (1) into a copy and go (-1), and how many texts the swap stands for. For texts without the ids that go with a
    word, none of its parts counts as shared."""
    ids = {w: ids_of(w) for w in dict.fromkeys(identity)}
    every = np.unique(np.concatenate([*ids.values(), np.zeros(0, np.int32)]))
    copies: Counter = Counter()
    for _, own, *gone in texts:
        mentioned = {w: g for w, g in gone[0].items() if w in ids} if gone else {w: np.intersect1d(i, own) for w, i in ids.items() if i[0] in own}
        if mentioned:
            held = every[np.isin(every, own)].tobytes()
            copies.update((w, g.tobytes(), held) for w, g in mentioned.items())
    present = [w for w in ids if w in {w for w, _, _ in copies}]
    out: Counter = Counter()
    for (a, gone, held), n in copies.items():
        goes, has = np.frombuffer(gone, np.int32).tolist(), set(np.frombuffer(held, np.int32).tolist())
        for b in [*(w for w in present if w != a), None]:
            new = set(ids[b].tolist()) if b else set()
            change = dict.fromkeys(sorted(new - has), 1) | {i: -1 for i in goes if i not in new}
            out[tuple(change.items())] += n / len(present)
    return [(dict(change), n) for change, n in out.items() if change]


def fit(texts: list[tuple], identity: list[str] = IDENTITY, fair: float = FAIR) -> tuple[np.ndarray, float]:
    """Weights of all word ids, and the bias, of texts as sample() returns them, or (label, word ids) only."""
    weights, y = np.zeros(1 << BITS), np.array([t[0] for t in texts], dtype=float)
    if not len(y):
        return weights, -50.0
    if y.min() == y.max():
        return weights, float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    texts_with, toxic_with = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for toxic, ids, *_ in texts:
        texts_with[ids] += 1
        toxic_with[ids] += toxic
    share = y.mean()
    surprise = (toxic_with - texts_with * share) / np.sqrt(np.maximum(texts_with, 1) * share * (1 - share))
    swaps = swaps_of(list(identity), texts)
    used = (texts_with >= LEAST_TEXTS) & (np.abs(surprise) >= NOTABLE)
    for change, _ in swaps:
        used[list(change)] = True
    kept = np.flatnonzero(used)
    column = np.full(1 << BITS, -1)
    column[kept] = np.arange(len(kept))
    texts_used = [ids[used[ids]] for _, ids, *_ in texts]
    rows, cols = np.repeat(np.arange(len(texts)), [len(ids) for ids in texts_used]), column[np.concatenate(texts_used)]
    swap = np.repeat(np.arange(len(swaps)), [len(c) for c, _ in swaps])
    swap_col = column[[i for c, _ in swaps for i in c]] if swaps else np.zeros(0, int)
    sign = np.array([x for c, _ in swaps for x in c.values()], dtype=float)
    pull = fair * np.array([n for _, n in swaps]) / len(y)
    w, bias = np.zeros(len(kept)), float(np.log(share / (1 - share)))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, STEPS + 1):
        score = 1 / (1 + np.exp(-(bias + np.bincount(rows, weights=w[cols], minlength=len(y)))))
        grad = np.bincount(cols, weights=(score - y)[rows], minlength=len(w)) / len(y) + RIDGE * w / len(y)
        if swaps:
            moved = pull * np.bincount(swap, weights=sign * w[swap_col], minlength=len(swaps))
            grad += np.bincount(swap_col, weights=sign * moved[swap], minlength=len(w))
        grad_b = float((score - y).mean())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        mb, vb = 0.9 * mb + 0.1 * grad_b, 0.999 * vb + 0.001 * grad_b**2
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        bias -= RATE * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.999**step)) + 1e-8)
    weights[kept] = w
    return weights, bias


def scores(texts: pa.Array, chosen: np.ndarray, values: np.ndarray, bias: float) -> np.ndarray:
    """Score of each text: every word of the model counts once."""
    data, offsets = text_bytes(texts)
    weights = np.zeros(1 << BITS)
    weights[chosen] = values
    known = weights != 0
    out = np.full(len(offsets) - 1, bias)
    for first, found in feature_ids(data, offsets):
        pairs = []
        for ids, rows in found:
            at = np.flatnonzero(known[ids])
            row = np.searchsorted(rows, at, side="right") - 1
            pairs.append((row.astype(np.int64) << BITS) | ids[at])
        once = np.unique(np.concatenate(pairs))
        np.add.at(out, first + (once >> BITS), weights[once & ((1 << BITS) - 1)])
    return 1 / (1 + np.exp(-out))


def model(docs: DataFrame, labels: DataFrame, identity: list[str] = IDENTITY, **options) -> tuple[np.ndarray, np.ndarray, float]:
    """Ids with a weight, their weights, the bias. To the identity words come those of the sample's own slots."""
    identity = list(dict.fromkeys([*identity, *terms_of_slots(docs, labels)]))
    weights, bias = fit(sample(docs, labels, identity=identity), identity, **options)
    chosen = np.flatnonzero(weights)
    return chosen, weights[chosen], bias


def classify(docs: DataFrame, fitted: tuple[np.ndarray, np.ndarray, float]) -> DataFrame:
    """doc_id and score of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores(batch.column("text"), *fitted))], ["doc_id", "score"])

    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that score below the threshold, with the columns they came with."""
    fitted = model(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(scores(batch.column("text"), *fitted) < threshold))

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score all documents by the model fitted on the training folds."""
    docs = table(spark, sf_dir, "documents")
    scored = classify(docs, model(docs, table(spark, sf_dir, "labels")))
    # A null id counts as the empty text, whose remainder is 0.
    return scored.select("doc_id", F.coalesce(~train_fold(F.col("doc_id")), F.lit(True)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
