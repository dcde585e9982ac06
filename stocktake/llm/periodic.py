"""Periodic runs of words in each text, by common extensions from suffixes sorted at a difference cover only.

The words of many documents stand in one array of numbers, each document between separators of its own. Of its suffixes only those
are sorted whose place modulo COVER lies in the cover: any two places reach two such suffixes after the same few words, so the longest
common extension of two places is those few words, compared one by one, and then a range minimum over the common prefixes of
neighbours in the sorted sample, from a sparse table. A second such index over the reversed array extends to the left.

A run of period q and length 4q or more holds 3q places in a row that equal the place q further on, so it is met at a place of the grid
0, 3q, 6q, ... of its document. The places of all grids are harmonically many: n/3 + n/6 + n/9 + ... for n words. Where a grid place
equals the place q further on, both are extended to both sides, and what is long enough is a run. The same stretch found under a multiple
of its period is dropped.

Defined results: a null text has no words, a text without a run has no runs and keeps all words; a null id counts as the empty text in
its checksum; repeated rows are judged each by itself; an empty table gives an empty table. Texts of any length are taken whole: the
arrays of one batch grow with its longest document, grids are gone through GRID places at a time.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktake.llm.common import WORD, bounded_batches, table

#: A perfect difference set: every difference modulo COVER is that of two of its members.
COVER, MEMBERS = 13, (0, 1, 3, 9)
#: SHIFT[i, j] words on, two places that are i and j modulo COVER are both in the cover.
SHIFT = np.array([[next(d for d in range(COVER) if {(i + d) % COVER, (j + d) % COVER} <= set(MEMBERS)) for j in range(COVER)] for i in range(COVER)])
#: A run repeats its period at least TIMES times and has at least LEAST words.
TIMES, LEAST = 4, 6
#: Words that are indexed together, unless one document has more, and grid places that are looked at together.
BATCH_WORDS, GRID = 1 << 17, 1 << 20
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_WORDS = re.compile(WORD)


class Extensions:
    """Longest common extensions to the right between places of an array of numbers.

    The array must end with a number that occurs once, and any two equal stretches that are asked about must be followed by different
    numbers before its end.
    """

    def __init__(self, values: np.ndarray) -> None:
        self.values = values
        n, k = len(values), len(MEMBERS)
        places = np.arange(n)
        member = np.full(COVER, -1)
        member[list(MEMBERS)] = np.arange(k)
        # Sample s stands for place self.at[s]; samples of a member follow each other, COVER places apart.
        rows = -(-n // COVER)
        self.sample = member[places % COVER] * rows + places // COVER
        at = (np.array(MEMBERS)[:, None] + COVER * np.arange(rows)[None, :]).ravel()
        self.real = at < n
        self.at = np.where(self.real, at, n - 1)
        self._sort()
        self._common()
        self._table()

    def _sort(self) -> None:
        """Order the samples; ranks by ever longer beginnings are kept, with the places a beginning is sure to cover."""
        n, at = len(self.values), self.at
        padded = np.concatenate([self.values, np.full(COVER + 1, -1, self.values.dtype)]).astype(np.int64)
        tied, known = np.flatnonzero(self.real), 0
        order, rank = tied.copy(), np.where(self.real, 0, len(tied)).astype(np.int32)
        self.levels = []
        while len(tied):
            if known < COVER:  # two more words
                here = at[tied] + known
                key = (padded[here] + 1 << 32) + padded[here + 1] + 1
                known += 2
            else:  # what is already sorted, a multiple of COVER places on
                step = known // COVER
                key = rank[tied + step]
                known += step * COVER
            by = np.lexsort((key, rank[tied]))
            tied, key, old = tied[by], key[by], rank[tied[by]]
            new = np.ones(len(tied), bool)
            new[1:] = (old[1:] != old[:-1]) | (key[1:] != key[:-1])
            first = np.ones(len(tied), bool)
            first[1:] = old[1:] != old[:-1]
            here = np.arange(len(tied))
            slot = old + here - np.maximum.accumulate(np.where(first, here, 0))
            order[slot] = tied
            rank = rank.copy()
            # A group's rank is the place in the order where it begins.
            rank[tied] = slot[np.maximum.accumulate(np.where(new, here, 0))]
            if known >= COVER:
                self.levels.append((known // COVER, rank))
            alone = new & np.append(new[1:], True)
            tied = tied[~alone]
        self.order, self.rank = order, rank

    def _common(self) -> None:
        """Common prefixes of neighbours in the order, by the kept ranks from the longest beginnings down, then word by word."""
        a, b = self.order[:-1].copy(), self.order[1:].copy()
        common = np.zeros(len(a), np.int32)
        for step, rank in reversed(self.levels):
            moved = np.where(rank[a] == rank[b], step, 0)
            a, b, common = a + moved, b + moved, common + (moved * COVER).astype(np.int32)
        a, b, live = self.at[a], self.at[b], np.arange(len(a))
        while len(live):
            live = live[self.values[a[live]] == self.values[b[live]]]
            common[live] += 1
            a[live] += 1
            b[live] += 1
        self.common = common

    def _table(self) -> None:
        """Minima of all stretches of 1, 2, 4, ... neighbours."""
        self.minima = [self.common]
        width = 1
        while 2 * width <= len(self.common):
            low = self.minima[-1]
            self.minima.append(np.minimum(low[:-width], low[width:]))
            width *= 2

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many numbers from places i and from places j on (i != j) are alike."""
        shift = SHIFT[i % COVER, j % COVER]
        found, live = shift.copy(), np.arange(len(i))
        for d in range(COVER - 1):
            live = live[shift[live] > d]
            unlike = self.values[i[live] + d] != self.values[j[live] + d]
            found[live[unlike]] = d
            live = live[~unlike]
        reached = np.flatnonzero(found == shift)
        if len(reached):
            a = self.rank[self.sample[i[reached] + shift[reached]]]
            b = self.rank[self.sample[j[reached] + shift[reached]]]
            low, width = np.minimum(a, b), np.abs(a - b)
            level = np.frexp(width)[1] - 1
            least = np.empty(len(reached), np.int64)
            for k in np.unique(level):
                at = np.flatnonzero(level == k)
                minima = self.minima[k]
                least[at] = np.minimum(minima[low[at]], minima[low[at] + width[at] - (1 << int(k))])
            found[reached] += least
        return found


def _grids(begin: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All (document, place, period) of the grids of documents with n words from `begin` on, about GRID at a time."""
    periods = n // TIMES
    doc = np.repeat(np.arange(len(n)), periods)
    period = np.arange(len(doc)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    apart = (TIMES - 1) * period
    places = -(-(n[doc] - period) // apart)
    until = np.cumsum(places)
    at = 0
    while at < len(doc):
        end = max(at + 1, int(np.searchsorted(until, (until[at - 1] if at else 0) + GRID, side="right")))
        many = places[at:end]
        which = np.repeat(np.arange(at, end), many)
        step = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        yield doc[which], begin[doc[which]] + step * apart[which], period[which]
        at = end


def runs_of(texts: Sequence[np.ndarray]) -> list[np.ndarray]:
    """For each array of word numbers its runs (start, length, period), by start, then period."""
    n = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(n + 1) - n
    values = np.empty(int((n + 1).sum()) + 1, np.int64)
    top = max((int(t.max()) for t in texts if len(t)), default=0) + 1
    values[0] = top
    for k, t in enumerate(texts):
        values[begin[k] : begin[k] + n[k]] = t
        values[begin[k] + n[k]] = top + 1 + k
    length = len(values)
    right = left = None
    found = []
    for doc, i, q in _grids(begin, n):
        alike = values[i] == values[i + q]
        if not alike.any():
            continue
        if right is None:
            right, left = Extensions(values), Extensions(values[::-1].copy())
        doc, i, q = doc[alike], i[alike], q[alike]
        after = right(i, i + q)
        before = left(length - i, length - i - q)
        size = before + after + q
        long = size >= np.maximum(LEAST, TIMES * q)
        found.append(np.stack([doc[long], (i - before)[long] - begin[doc[long]], size[long], q[long]]))
    if not found:
        return [np.zeros((0, 3), np.int64)] * len(texts)
    every = np.concatenate(found, axis=1).T
    # A stretch has one run: that of its smallest period.
    every = every[np.lexsort((every[:, 3], every[:, 2], every[:, 1], every[:, 0]))]
    keep = np.ones(len(every), bool)
    keep[1:] = (every[1:, :3] != every[:-1, :3]).any(axis=1)
    every = every[keep]
    every = every[np.lexsort((every[:, 3], every[:, 1], every[:, 0]))]
    return np.split(every[:, 1:], np.searchsorted(every[:, 0], np.arange(1, len(texts))))


def collapsed(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay when each run is cut to its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change)[:n] == 0


def numbered(words: Sequence[str]) -> np.ndarray:
    """Equal words get equal numbers."""
    return pa.array(words, pa.string()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) if words else np.zeros(0, np.int64)


def _blocks(documents: Iterator[list[str]]) -> Iterator[list[list[str]]]:
    """Documents in blocks of about BATCH_WORDS words."""
    block, size = [], 0
    for words in documents:
        if block and size + len(words) > BATCH_WORDS:
            yield block
            block, size = [], 0
        block.append(words)
        size += len(words)
    if block:
        yield block


def _runs_of_words(documents: Iterator[list[str]]) -> Iterator[tuple[list[str], np.ndarray]]:
    for block in _blocks(documents):
        numbers = numbered([w for words in block for w in words])
        yield from zip(block, runs_of(np.split(numbers, np.cumsum([len(words) for words in block])[:-1])))


def with_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows, with `runs` (start, length, period, in words) of the text and `collapsed_text`, its words joined by one space with
    every run cut to its first period. Columns of these names are replaced."""
    bounded_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() not in ("runs", "collapsed_text")]
    rows = docs.select(F.col(f"`{text}`").cast("string").alias("_words_of"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            runs, short = [], []
            for words, found in _runs_of_words(_WORDS.findall(t or "") for t in texts):
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in found.tolist()])
                short.append(" ".join(w for w, stays in zip(words, collapsed(len(words), found)) if stays))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(runs, pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))), pa.array(short, pa.string())],
                names=["row", "runs", "collapsed_text"],
            )

    out = rows.mapInArrow(find, f"row {rows.schema['row'].dataType.simpleString()}, runs {RUNS}, collapsed_text string")
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], "runs", "collapsed_text")


def planted(words: list[str], checksum: int) -> list[str]:
    """The words with the periodic tail that the query's contract gives to every tenth document."""
    n, g = len(words), checksum // 10
    if checksum % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def summary(words: list[str], runs: np.ndarray) -> tuple:
    """(n_runs, start, length, period and exponent_milli of the best run, digest of the runs, digest of the collapsed text)."""
    listing = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist()).encode()).hexdigest()
    if not len(runs):
        return 0, None, None, None, None, listing, hashlib.sha256(" ".join(words).encode()).hexdigest()
    best = None
    for s, n, q in runs.tolist():  # by start, then period: of equal ratios the first stays
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    kept = " ".join(w for w, stays in zip(words, collapsed(len(words), runs)) if stays)
    return len(runs), *best, 1000 * best[1] // best[2], listing, hashlib.sha256(kept.encode()).hexdigest()


_NUMBERS = ("n_runs", "start", "length", "period", "exponent_milli")
OP11_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in _NUMBERS) + ", runs_sha256 string, collapsed_sha256 string"


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document after its planted tail: their number, the best one, and digests of all and of the collapsed text."""
    bounded_batches(spark)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = (
                planted(_WORDS.findall(t or ""), zlib.crc32((d or "").encode()))
                for d, t in zip(batch["id"], batch["text"])
            )
            found = [summary(w, r) for w, r in _runs_of_words(words)]
            out = pd.DataFrame(found, columns=[*_NUMBERS, "runs_sha256", "collapsed_sha256"])
            for c in _NUMBERS:
                out[c] = out[c].astype("Int64")
            out.insert(0, "doc_id", batch["id"].astype("Int64"))
            yield out

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    return docs.mapInPandas(rows, OP11_SCHEMA)


_HASH = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(coalesce(CAST(doc_id AS VARCHAR), '')) + 1),
    lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))), lambda c, x: {step})"""
_STEP = """list_reduce(list_prepend(xor(c, x), CAST(range(8) AS BIGINT[])), lambda s, k: xor(s >> 1, 3988292384 * (s & 1)))"""

OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    xor({_HASH.format(step=_STEP)}, 4294967295) AS h FROM documents),
p AS (SELECT *, len(ws) AS n, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM d),
w AS (SELECT id, doc_id, n, CASE WHEN a IS NULL THEN ws ELSE list_transform(range(n), lambda i:
    CASE WHEN i < a THEN ws[i + 1] ELSE ws[a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) + 1] END) END AS ws FROM p),
one AS (SELECT id, n, unnest(ws) AS word, unnest(range(n)) AS i FROM w),
same AS (SELECT x.id, y.i - x.i AS q, x.i FROM one x JOIN one y ON x.id = y.id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT id, q, i, i - row_number() OVER (PARTITION BY id, q ORDER BY i) AS island FROM same),
long AS (SELECT id, min(i) AS start, count(*) + q AS length, q FROM islands GROUP BY id, q, island HAVING count(*) >= 3 * q AND count(*) + q >= 6),
runs AS (SELECT id, start, length, min(q) AS q FROM long GROUP BY ALL),
gone AS (SELECT DISTINCT id, unnest(range(start + q, start + length)) AS i FROM runs),
r AS (SELECT id, count(*) AS n_runs, sha256(string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q)) AS runs_sha256,
    first({{'start': start, 'length': length, 'q': q}} ORDER BY length / CAST(q AS DOUBLE) DESC, start, q) AS best FROM runs GROUP BY id),
kept AS (SELECT one.id, sha256(string_agg(word, ' ' ORDER BY one.i)) AS collapsed_sha256 FROM one ANTI JOIN gone ON gone.id = one.id AND gone.i = one.i GROUP BY one.id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, CAST(best.length AS BIGINT) AS length, best.q AS period,
  CAST(1000 * best.length // best.q AS BIGINT) AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256,
  coalesce(collapsed_sha256, sha256('')) AS collapsed_sha256
FROM w LEFT JOIN r ON r.id = w.id LEFT JOIN kept ON kept.id = w.id
"""
