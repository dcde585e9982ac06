"""Benchmark decontamination: documents that hold a benchmark item within a share of word edits.

Lower-cased words are symbols. The CGK embedding walks over a text: at step j it emits the word under its pointer and moves on if a random
function of (j, word) says so; two texts of small edit distance fall into step again after each edit, so edit distance becomes
Hamming distance of the emitted words. Bit sampling takes the words emitted at a few steps as a key. Walks begin at every word of
every item and at every word of a text around which a window of an item's size may hold the item. A walk spans its window: it has two steps for
each word, and the sampled steps are any of them. Items belong to classes of size; a class has as many walks as the
recall target asks for. How many that are comes from embedding random items and their edited copies (`walks_needed`). Equal keys propose
(item, place); proposals are verified exactly by the edit distance of the whole item to the best stretch of the text there.

Places are passed over before walking if the window there cannot hold an item of the class: all its words but the allowed edits belong to the items'
vocabulary, and what its words weigh, by the number of items that hold them, is what an item weighs less its edits. That loss is taken at three standard
deviations of edits at random places (at most the heaviest words), the only part besides the walks that may miss an item. Items are a stated query set; they go to
the tasks in blocks of known size.

Defined results: null and empty texts or items match nothing; repeated documents are reported each; of several places of an item in a
text the one with fewest edits counts, ties go to the first; repeated item rows are reported under each id; empty tables
give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from stocktake.llm.common import bounded_batches, table
from stocktake.llm.tokens import chunks, hashed_words, mixed, text_bytes

#: Edits allowed, as a percentage of the item's words, and the share of items with that many edits that must be proposed.
EDITS, RECALL = 20, 0.99
#: Words sampled from a walk; one more for each 16 times as many items in a block.
SAMPLED, ITEMS = 2, 500
#: Walks of each size up to 128 that reach RECALL with EDITS and SAMPLED, as `walks_needed` finds them with 96 trials and 64 tried walks.
WALKS = {
    1: 1, 2: 1, 3: 1, 4: 1, 5: 9, 6: 11, 7: 9, 8: 8, 10: 12, 12: 9, 14: 11, 16: 12, 20: 13, 24: 9, 28: 15, 32: 15, 40: 15, 48: 21, 56: 25,
    64: 34, 80: 34, 96: 36, 112: 23, 128: 25,
}
#: What a word that only one item holds may weigh.
HEAVIEST = 200
#: Words of texts with places to walk from that are walked together.
TOGETHER = 1 << 20
SLACK = 8
#: Items in a block: one pass over the texts for each block.
BLOCK = 20_000


def sizes_up_to(longest: int) -> list[int]:
    """Sizes of classes: every number up to 8, then four for each doubling."""
    sizes = list(range(1, min(longest, 8) + 1))
    step = 2
    while sizes and sizes[-1] + step <= longest:
        for _ in range(4):
            if sizes[-1] + step <= longest:
                sizes.append(sizes[-1] + step)
        step *= 2
    return sizes


def _largest(size: int) -> int:
    """Words of the largest item in the class of this size."""
    following = sizes_up_to(4 * size + 8)
    return following[following.index(size) + 1] - 1


def beginnings(size: int, limit: int) -> int:
    """Of the words of a text where an item may lie, how many walks begin at: a quarter of a window and the words that edits may add."""
    return -(-size // 4) + limit


def _walk(rng: np.random.Generator, size: int, sampled: int) -> tuple[int, tuple[int, ...]]:
    """A random number for the walk's moves, and the steps at which its words are taken."""
    horizon = 2 * size
    return int(rng.integers(64)), tuple(sorted(rng.choice(horizon, min(sampled, horizon), replace=False).tolist()))


def _edited(rng: np.random.Generator, item: np.ndarray, edits: int, pattern: str) -> np.ndarray:
    """The item with edits at even distances or anywhere."""
    words, n = item.tolist(), len(item)
    even, new = [(k + 1) * n // (edits + 1) for k in range(edits)], rng.integers(1, 1 << 63, edits, dtype=np.uint64)
    places = even if "even" in pattern else sorted(rng.choice(n, edits, replace=False).tolist())
    for k in reversed(range(edits)):
        kind = pattern.split(" ")[0] if "mixed" not in pattern else ("changed", "left out", "added")[int(rng.integers(3))].split(" ")[0]
        if kind == "changed":
            words[places[k]] = int(new[k])
        elif kind == "left":
            del words[places[k]]
        else:
            words.insert(places[k], int(new[k]))
    return np.array(words, np.uint64)


PATTERNS = ("changed even", "left even", "added even", "changed any", "left any", "added any", "mixed any")


@lru_cache(None)
def walks_needed(size: int, edits: int = EDITS, sampled: int = SAMPLED, recall: float = RECALL, trials: int = 24, tried: int = 48) -> int:
    """Walks by which edited copies of items of this class are proposed with the recall, whatever the pattern of their edits.

    Of each pattern, and of the smallest and the largest items of the class, `trials` random items are embedded by `tried` walks. An item that a share p of them
    proposes is proposed by one of L walks with probability 1 - (1 - p)^L.
    """
    rng = np.random.default_rng(size)
    walks = [_walk(rng, size, sampled) for _ in range(tried)]
    most = 1
    for n in sorted({size, _largest(size)}):
        limit = n * edits // 100
        if not limit:
            continue
        for pattern in PATTERNS:
            items = [rng.integers(1, 1 << 63, n, dtype=np.uint64) for _ in range(trials)]
            texts = [_edited(rng, x, limit, pattern) for x in items]
            sides = []
            for side, last in ((items, n), (texts, beginnings(size, limit))):
                rows = np.concatenate([[0], np.cumsum([len(x) for x in side])])
                walker = Walker(np.concatenate(side), rows)
                places = np.arange(rows[-1])
                sides.append((walker, places[places - rows[walker.row_of] < last]))
            hits = np.zeros(trials)
            for walk in walks:
                pairs = []
                for walker, starts in sides:
                    key, over = walker.keys(starts, walk)
                    owner = walker.row_of[starts[~over]]
                    pairs.append(mixed(key[~over] + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
                hits[np.unique(owner[np.isin(pairs[1], pairs[0])])] += 1
            # Half a walk stands for an item that none of those tried proposes.
            missed = 1 - np.maximum(hits, 0.5) / tried
            walks_for = 1
            while 1 - np.mean(missed**walks_for) < recall:
                walks_for += 1
            most = max(most, walks_for)
    return most


class _Class(NamedTuple):
    """Items of one size: the most edits and words, the least weight with all edits, and of each walk its keys with their items and places."""

    size: int
    limit: int
    longest: int
    need: int
    walks: list


class Index:
    """Keys of all windows of a block of items."""

    def __init__(self, ids: list[int], items: list[np.ndarray], edits: int = EDITS):
        self.ids, self.items, self.different = ids, items, [set(x.tolist()) for x in items]
        self.length = np.array([len(x) for x in items], np.int64)
        self.limit = self.length * edits // 100
        # A bit map of the items' words, 16 bits for each and more.
        self.shift = np.uint64(64 - min(27, max(20, int(16 * self.length.sum()).bit_length())))
        self.weights = np.zeros(1 << (64 - int(self.shift)), np.uint8)
        self.needs = self._weigh()
        sampled = SAMPLED + max(0, int(np.ceil(np.log(max(1, len(items)) / ITEMS) / np.log(16))))
        sizes = sizes_up_to(int(self.length.max(initial=0)))
        class_of = np.searchsorted(sizes, self.length, side="right") - 1
        rng = np.random.default_rng(8)
        self.classes = []
        for number, size in enumerate(sizes):
            members = np.flatnonzero(class_of == number)
            if not len(members):
                continue
            known = (edits, sampled) == (EDITS, SAMPLED)
            many = WALKS[size] if known and size in WALKS else walks_needed(size, edits, sampled)
            own = members.tolist()
            words, length = np.concatenate([items[k] for k in own]), self.length[members]
            starts = np.arange(len(words))
            walker = Walker(words, np.concatenate([[0], np.cumsum(length)]))
            item = np.repeat(members.astype(np.int32), length)
            offset = (starts - np.repeat(np.cumsum(length) - length, length)).astype(np.int32)
            walks = []
            for _ in range(many):
                walk = _walk(rng, size, sampled)
                key, over = walker.keys(starts, walk)
                key, of, at = key[~over], item[~over], offset[~over]
                order = np.argsort(key, kind="stable")
                walks.append((walk, key[order], of[order], at[order]))
            self.classes.append(_Class(size, int(self.limit[members].max()), int(length.max()), int(self.needs[members].min()), walks))

    def _weigh(self) -> np.ndarray:
        """Fill the table of weights; what each item still weighs with all its edits."""
        held = [np.unique(x) for x in self.items]
        words, holders = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
        # Words of many items weigh little, but at least 1: a known word.
        scale = HEAVIEST / np.log(2 + len(self.items))
        weight = np.maximum(1, np.round(scale * np.log((1 + len(self.items)) / holders))).astype(np.uint8)
        np.maximum.at(self.weights, words >> self.shift, weight)
        needs = np.zeros(len(self.items), np.int64)
        for k, item in enumerate(self.items):
            own, edits, n = np.sort(self.weights[item >> self.shift].astype(np.int64)), int(self.limit[k]), len(item)
            lost = 0.0
            if edits:
                spread = 3 * own.std() * np.sqrt(edits * (n - edits) / max(1, n - 1))
                lost = min(float(own[n - edits :].sum()), edits * own.mean() + spread)
            needs[k] = int(own.sum() - lost)
        return needs


class Walker:
    """Walks over some texts, of which each is followed by a mark that no walk goes beyond."""

    def __init__(self, words: np.ndarray, rows: np.ndarray):
        self.row_of = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
        self.words = np.zeros(len(words) + len(rows), np.uint64)
        self.words[np.arange(len(words)) + self.row_of] = words
        self.moves: dict[int, np.ndarray] = {}

    def _moves(self, bit: int) -> np.ndarray:
        """Whether a walk moves on from each word at a step that asks for this bit."""
        if bit not in self.moves:
            self.moves[bit] = ((self.words >> np.uint64(bit)) & np.uint64(1)).astype(np.int8)
        return self.moves[bit]

    def keys(self, starts: np.ndarray, walk: tuple[int, tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the walks that begin at these words; and which had run past their text's end when a word was taken."""
        bit, steps = walk
        at = (starts + self.row_of[starts]).astype(np.intp)
        key, over, moved = np.zeros(len(at), np.uint64), np.zeros(len(at), bool), np.zeros(len(at), np.int8)
        for step in range(steps[-1] + 1):
            if step in steps:
                word = self.words[at]
                over |= word == 0
                key = mixed(key * np.uint64(31) + word)
            np.take(self._moves((bit + step * 7) % 64), at, out=moved, mode="clip")
            at += moved
        return key, over


def _row(previous: np.ndarray, differs: np.ndarray, first: int) -> np.ndarray:
    """The next row of an edit-distance table; gaps along the row are a running minimum."""
    row = np.empty_like(previous)
    row[0] = first
    row[1:] = np.minimum(previous[:-1] + differs, previous[1:] + 1)
    steps = np.arange(len(row))
    return np.minimum.accumulate(row - steps) + steps


def best_stretch(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, begin, end) of the stretch of text nearest to the item; ties go to the first end, then the shortest stretch."""
    row = np.zeros(len(text) + 1, np.int64)
    for k, word in enumerate(item):
        row = _row(row, (text != word).astype(np.int64), k + 1)
    end = int(np.argmin(row))
    edits, back = int(row[end]), text[:end][::-1]
    row = np.arange(end + 1)
    for k, word in enumerate(item[::-1]):
        row = _row(row, (back != word).astype(np.int64), k + 1)
    return edits, end - int(np.flatnonzero(row == edits)[0]), end


class _Sums:
    """Known words and weights up to every place of texts."""

    def __init__(self, words: np.ndarray, rows: np.ndarray, index: Index):
        weight = index.weights[words >> index.shift]
        self.known = np.concatenate([[0], np.cumsum(weight > 0)])
        self.weight = np.concatenate([[0], np.cumsum(weight, dtype=np.int64)])
        self.end_of = np.repeat(rows[1:], np.diff(rows))
        self.places = np.arange(len(words))

    def able(self, of: _Class) -> np.ndarray:
        """Places whose window has words enough, and weight enough as far as an item may reach from there."""
        count = self.known[np.minimum(self.places + of.size, self.end_of)] - self.known[:-1]
        able = np.flatnonzero(count >= of.size - of.limit)
        weight = self.weight[np.minimum(able + of.longest + of.limit, self.end_of[able])] - self.weight[able]
        return able[weight >= of.need]


def proposals(words: np.ndarray, rows: np.ndarray, index: Index) -> np.ndarray:
    """Distinct (row, item, estimated begin of the item) of some texts."""
    if not len(words):
        return np.zeros((0, 3), np.int64)
    sums = _Sums(words, rows, index)
    known, end_of = sums.known, sums.end_of
    walker = Walker(words, rows)
    row_of = walker.row_of
    found = []
    for of in index.classes:
        able = sums.able(of)
        if not len(able):
            continue
        # An item may begin at an able place; its walks begin there and behind.
        change = np.zeros(len(words) + 1, np.int32)
        np.add.at(change, able, 1)
        np.add.at(change, np.minimum(able + beginnings(of.size, of.limit), end_of[able]), -1)
        starts = np.flatnonzero(np.cumsum(change[:-1]) > 0)
        for walk, keys, item, offset in of.walks:
            key, over = walker.keys(starts, walk)
            low = np.searchsorted(keys, key, "left")
            hit = np.flatnonzero((keys[np.minimum(low, len(keys) - 1)] == key) & ~over) if len(keys) else low[:0]
            low = low[hit]
            many = np.searchsorted(keys, key[hit], "right") - low
            which = np.repeat(low, many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            begin = np.repeat(starts[hit], many)
            found.append(np.stack([row_of[begin], item[which], begin - offset[which]], axis=1))
    if not found:
        return np.zeros((0, 3), np.int64)
    every = np.concatenate(found)
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    # Proposals of one item within SLACK words are the same place.
    same = (every[1:, :2] == every[:-1, :2]).all(axis=1) & (every[1:, 2] // SLACK == every[:-1, 2] // SLACK)
    every = every[np.concatenate([[True], ~same])] if len(every) else every
    # The item needs all its words but the edits there, and their weight.
    low, high = reach(every[:, 0], every[:, 1], every[:, 2], rows, index)
    enough = known[high] - known[low] >= (index.length - index.limit)[every[:, 1]]
    return every[enough & (sums.weight[high] - sums.weight[low] >= index.needs[every[:, 1]])]


def reach(row: np.ndarray, item: np.ndarray, begin: np.ndarray, rows: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Words of the text in which an item that seems to begin there has to lie."""
    wide = index.limit[item] + SLACK
    low = np.maximum(rows[row], begin - wide)
    return low, np.maximum(low, np.minimum(rows[row + 1], begin + index.length[item] + wide))


def worth_walking(words: np.ndarray, rows: np.ndarray, index: Index) -> np.ndarray:
    """Rows with a place to walk from."""
    if not len(words):
        return np.zeros(0, np.int64)
    sums, able = _Sums(words, rows, index), np.zeros(len(words), bool)
    for of in index.classes:
        able[sums.able(of)] = True
    return np.unique(np.searchsorted(rows, np.flatnonzero(able), side="right") - 1)


def _of_rows(words: np.ndarray, rows: np.ndarray, index: Index) -> Iterator[tuple[int, int, int, int, int]]:
    """matches of texts whose words these are."""
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    proposed, listed = proposals(words, rows, index), words.tolist()
    lows, highs = reach(proposed[:, 0], proposed[:, 1], proposed[:, 2], rows, index)
    for (row, item, _), low, high in zip(proposed.tolist(), lows.tolist(), highs.tolist(), strict=True):
        own, limit = index.items[item], int(index.limit[item])
        if len(index.different[item].intersection(listed[low:high])) < len(index.different[item]) - limit:
            continue  # an edit takes away one word at most
        edits, start, end = best_stretch(own, words[low:high])
        if edits <= limit:
            found = (edits, low + start - int(rows[row]), end - start)
            best[row, item] = min(best.get((row, item), found), found)
    for (row, item), (edits, start, length) in sorted(best.items()):
        yield row, item, edits, start, length


def matches(texts: pa.Array, index: Index) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item number, edits, first word, words) of the best place of each item in each text, in any case of letters."""
    data, offsets = text_bytes(pc.utf8_lower(texts))
    held: list[np.ndarray] = []
    numbers: list[int] = []

    def walked() -> Iterator[tuple[int, int, int, int, int]]:
        rows = np.concatenate([[0], np.cumsum([len(w) for w in held])]).astype(np.int64)
        for row, *rest in _of_rows(np.concatenate(held), rows, index):
            yield numbers[row], *rest
        held.clear()
        numbers.clear()

    for first, last in chunks(offsets):
        words, rows = hashed_words(data, offsets, first, last)
        for row in worth_walking(words, rows, index).tolist():
            held.append(words[rows[row] : rows[row + 1]])
            numbers.append(first + row)
        if sum(map(len, held)) > TOGETHER:
            yield from walked()
    if held:
        yield from walked()


def indexes(benchmark: DataFrame, edits: int = EDITS, block: int = BLOCK) -> Iterator[Index]:
    """Indexes of all items, a block at a time."""
    bounded_batches(benchmark.sparkSession)
    rows = benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator()
    ids, texts = [], []
    for r in rows:
        ids.append(r["item_id"])
        texts.append(r["text"])
        if len(ids) == block:
            yield _index(ids, texts, edits)
            ids, texts = [], []
    if ids:
        yield _index(ids, texts, edits)


def _index(ids: list, texts: list, edits: int) -> Index:
    data, offsets = text_bytes(pc.utf8_lower(pa.array(texts, pa.string())))
    words, rows = hashed_words(data, offsets, 0, len(ids))
    return Index(ids, [words[rows[k] : rows[k + 1]] for k in range(len(ids))], edits)


def contaminated(docs: DataFrame, benchmark: DataFrame, edits: int = EDITS) -> DataFrame:
    """(doc_id, item_id, edits, first_word, n_words), one row for each document and item that it holds."""
    names = ["doc_id", "item_id", "edits", "first_word", "n_words"]
    schema = "doc_id long, item_id long, edits int, first_word int, n_words int"

    def search(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = list(matches(batch.column("text"), index))
                at = pa.array([f[0] for f in found], pa.int64())
                rest = [pa.array([f[k] for f in found], pa.int32()) for k in (2, 3, 4)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").cast(pa.int64()).take(at), pa.array([index.ids[f[1]] for f in found], pa.int64()), *rest], names
                )

        return run

    out = docs.sparkSession.createDataFrame([], schema)
    for index in indexes(benchmark, edits):
        out = out.unionAll(docs.select("doc_id", "text").mapInArrow(search(index), schema))
    return out


def without_items(docs: DataFrame, benchmark: DataFrame, edits: int = EDITS) -> DataFrame:
    """The documents that hold no item, with the columns they came with."""
    at = docs.columns.index("text")

    def search(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[f[0] for f in matches(batch.column(at), index)]] = False
                yield batch.filter(pa.array(clean))

        return run

    for index in indexes(benchmark, edits):
        docs = docs.mapInArrow(search(index), docs.schema)
    return docs


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that hold items of the benchmark."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
