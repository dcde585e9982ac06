"""Removal of repeated byte strings by two-stage suffix sorting.

A byte goes if a string of LENGTH bytes that covers it starts anywhere else as well. Every such string holds the smallest (by
hash) of its GRAM-byte grams, its anchor; equal strings have equal anchors at equal places. Neighbouring strings of one anchor form a
segment, and strings of different anchors never equal each other, so:

1. Segments are grouped by anchor as packed digests. A segment that occurs twice is repeated as a whole. An anchor with one
   segment repeats nothing. Only anchors with different segments need a comparison, on one copy of each segment.
2. These copies are sorted by suffix, a batch of anchors at a time. Suffixes smaller than their successor are sorted
   directly; all others are induced by scanning the buckets of first bytes from small to large. Neighbours in suffix order
   with a common prefix of LENGTH bytes or more are repeated strings.
3. The repeated runs meet their documents again and are cut out.

An anchor with more than HOT different segments is not gathered: its strings are counted one by one by their digests.

Defined results: null and empty texts have no bytes and are kept as they are; texts shorter than LENGTH lose nothing; rows repeated in
full repeat each other and lose all that strings of LENGTH bytes cover; an empty table gives no rows. Matches never cross
documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktake.llm.common import buckets_for, staged, table
from stocktake.llm.filters import bit_filter, in_filter
from stocktake.llm.tokens import BYTE, chunks, mixed, text_bytes

LENGTH, GRAM = 200, 48
#: Different segments of one anchor that are sorted together, at most; beyond that strings are counted by digest.
HOT = 20_000
#: Bytes of a long text that are looked at together.
PIECE = 1 << 21
#: Bytes of segments that are sorted at once, unless one anchor has more.
BATCH = 1 << 18
SEPARATOR = 0xFF  # in no UTF-8 text
STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)
RECORD = np.dtype([("anchor", "<u8"), ("digest", "<u8"), ("key", "<i8"), ("at", "<i4"), ("n", "<i4")])


def window_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the strings of GRAM and of LENGTH bytes at every place, from strings of half their size."""
    by_size, n = {1: BYTE[raw]}, 1
    for step in STEP:
        by_size[2 * n] = by_size[n][:-n] * step + by_size[n][n:] if len(by_size[n]) > n else np.zeros(0, np.uint64)
        n *= 2

    def joined(size: int) -> np.ndarray:
        m = max(0, len(raw) - size + 1)
        total, at = np.zeros(m, np.uint64), 0
        for part in (128, 64, 32, 16, 8, 4, 2, 1):
            if size & part:
                total = total * STEP[0] + by_size[part][at : at + m]
                at += part
        return mixed(total)

    return joined(GRAM), joined(LENGTH)


def segments(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, first string, number of strings, anchor, digest) of every segment of the rows, and the hashes of all strings."""
    grams, strings = window_hashes(raw)
    counts = np.maximum(np.diff(bounds) - LENGTH + 1, 0)
    total = int(counts.sum())
    nothing = np.zeros(0, np.int64)
    if not total:
        return nothing, nothing, nothing, np.zeros(0, np.uint64), np.zeros(0, np.uint64), strings
    # The upper half orders grams by hash, the lower half is their place: the smallest tells where the anchor is.
    keys = (grams & ~np.uint64(0xFFFFFFFF)) | np.arange(len(grams), dtype=np.uint64)
    width, span = 1, LENGTH - GRAM + 1
    while width * 2 <= span:
        keys, width = np.minimum(keys[:-width], keys[width:]), width * 2
    if width < span:
        keys = np.minimum(keys[: len(keys) - (span - width)], keys[span - width :])
    row = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts) + bounds[:-1][row]
    anchor_at = (keys[place] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    begins = np.flatnonzero(np.concatenate([[True], (anchor_at[1:] != anchor_at[:-1]) | (row[1:] != row[:-1])]))
    n = np.diff(np.append(begins, total))
    first, where = place[begins], anchor_at[begins]
    # Two strings at the ends cover a segment, as it has fewer strings than LENGTH.
    digest = mixed(strings[first] * STEP[1] + strings[first + n - 1] * STEP[2] + (n.astype(np.uint64) << np.uint64(20)) + (where - first).astype(np.uint64))
    return row[begins], first, n, grams[where], digest, strings


def records(batch: pa.RecordBatch, single: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(records, their rows, first row) of each chunk. With `single`, only segments of these anchors, string by string."""
    data, offsets = text_bytes(batch.column("text"))
    keys = batch.column("key").to_numpy()
    for begin, end in chunks(offsets):
        whole = offsets[begin : end + 1] - offsets[begin]
        # A long text is taken in pieces that share LENGTH - 1 bytes: every string lies in one. A segment cut in two is two.
        step = PIECE if end == begin + 1 else max(1, int(whole[-1]))
        for low in range(0, max(1, int(whole[-1]) - LENGTH + 1 if end == begin + 1 else 1), step):
            raw, bounds = data[offsets[begin] : offsets[end]], whole
            if end == begin + 1:
                raw = raw[low : low + step + LENGTH - 1]
                bounds = np.array([0, len(raw)])
            row, first, n, anchor, digest, strings = segments(raw, bounds)
            if single is not None:
                hot = np.flatnonzero(_among(anchor, single))
                each = np.repeat(hot, n[hot])
                place = first[each] + np.arange(len(each)) - np.repeat(np.cumsum(n[hot]) - n[hot], n[hot])
                row, first, n, anchor, digest = row[each], place, np.ones(len(each), np.int64), strings[place], strings[place]
            out = np.empty(len(row), RECORD)
            out["anchor"], out["digest"], out["key"], out["at"], out["n"] = anchor, digest, keys[begin + row], low + first - bounds[row], n
            yield out, row, begin


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values if len(ordered) else np.zeros(len(values), bool)


def _spans(rec: np.ndarray) -> pa.RecordBatch:
    """Repeated bytes (kind 0) of whole segments; runs that touch in one document are joined."""
    rec = rec[np.lexsort((rec["at"], rec["key"]))]
    low, high = rec["at"].astype(np.int64), rec["at"].astype(np.int64) + rec["n"] + LENGTH - 1
    new = np.concatenate([[True], (rec["key"][1:] != rec["key"][:-1]) | (low[1:] > high[:-1])]) if len(rec) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return _rows(0, rec["key"][at], low[at], np.maximum.reduceat(high, at) if len(at) else high)


def _rows(kind: int, x: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(x), kind, np.int32)), pa.array(np.ascontiguousarray(x).view(np.int64)), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))],
        ["kind", "x", "low", "high"],
    )


def _name(rec: np.ndarray) -> np.ndarray:
    """A number for a segment's place in the corpus."""
    return mixed(np.ascontiguousarray(rec["key"]).view(np.uint64) * STEP[3] + rec["at"].astype(np.uint64))


def classify(keyed: DataFrame, buckets: int, single: np.ndarray | None = None) -> DataFrame:
    """(kind, x, low, high): kind 0 repeated bytes low..high of document x; kind 1 the copy x of a segment to be
    sorted; kind 2 a hot anchor x. Copies within a batch are settled there, so a common segment is sent once by each batch."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [r[0] for r in records(batch, single)]
            if not parts:
                continue
            rec = np.concatenate(parts)
            rec = rec[np.lexsort((rec["digest"], rec["anchor"]))]
            same = (rec["digest"][1:] == rec["digest"][:-1]) & (rec["anchor"][1:] == rec["anchor"][:-1])
            several = np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(rec) else np.zeros(0, bool)
            found = _spans(rec[several])
            one = np.concatenate([[True], ~same]) if len(rec) else np.zeros(0, bool)
            sent, settled = rec[one], several[one]
            bucket = (mixed(np.ascontiguousarray(sent["anchor"]) ^ STEP[4]) % np.uint64(buckets)).astype(np.int32)
            code = bucket.astype(np.int64) * 2 + settled
            order = np.argsort(code, kind="stable")
            sent, code = sent[order], code[order]
            begins = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
            blobs = [sent[a:b].tobytes() for a, b in zip(begins, np.append(begins[1:], len(sent)), strict=True)]
            k = len(begins)
            yield pa.RecordBatch.from_arrays(
                [pa.array((code[begins] // 2).astype(np.int32)), pa.array((code[begins] % 2).astype(bool)), pa.array(blobs, pa.binary()), *[pa.nulls(k, t) for t in (pa.int64(), pa.int32(), pa.int32())]], names)
            k = found.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(k, dtype=np.int32) % buckets), pa.nulls(k, pa.bool_()), pa.nulls(k, pa.binary()), found.column("x"), found.column("low"), found.column("high")], names)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = [], []
        for batch in batches:
            done = batch.column("blob").is_null()
            if done.true_count:
                some = batch.filter(done)
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(some.num_rows, np.int32)), some.column("x"), some.column("low"), some.column("high")], ["kind", "x", "low", "high"])
            for settled, blob in zip(batch.column("settled").to_pylist(), batch.column("blob"), strict=True):
                if blob.is_valid:
                    held.append(np.frombuffer(blob.as_buffer(), RECORD))
                    known.append(np.full(len(held[-1]), settled))
        if not held:
            return
        rec, settled = np.concatenate(held), np.concatenate(known)
        order = np.lexsort((rec["digest"], rec["anchor"]))
        rec, settled = rec[order], settled[order]
        new_anchor = np.concatenate([[True], rec["anchor"][1:] != rec["anchor"][:-1]])
        new = new_anchor | np.concatenate([[True], rec["digest"][1:] != rec["digest"][:-1]])
        group = np.cumsum(new) - 1
        repeated = np.bincount(group)[group] > 1
        yield _spans(rec[repeated & ~settled])
        firsts = np.flatnonzero(new)
        anchor_of = (np.cumsum(new_anchor) - 1)[firsts]
        different = np.bincount(anchor_of)[anchor_of]
        copies = rec[firsts[(different > 1) & (different <= HOT)]]
        yield _rows(1, _name(copies), np.zeros(len(copies)), np.zeros(len(copies)))
        hot = np.unique(rec["anchor"][firsts[different > HOT]])
        yield _rows(2, hot, np.zeros(len(hot)), np.zeros(len(hot)))

    names = ["bucket", "settled", "blob", "x", "low", "high"]
    sent = keyed.select("key", "text").mapInArrow(send, "bucket int, settled boolean, blob binary, x long, low int, high int")
    return sent.repartition(buckets, "bucket").mapInArrow(settle, "kind int, x long, low int, high int")


def types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; the empty suffix is smallest."""
    n = len(text)
    differs = np.concatenate([text[1:] != text[:-1], [True]])
    until = np.minimum.accumulate(np.where(differs, np.arange(n), n)[::-1])[::-1]
    after = np.append(text, 0)[until + 1]
    return np.where(until == n - 1, False, text < after)


def suffix_order(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Suffixes of text in order, by their first `depth` bytes at least.

    Two stages: suffixes smaller than their successor are sorted directly, five bytes at a time within ties; then buckets of first bytes
    are scanned from small to large, and every suffix found puts its predecessor, if that is larger than it, next in the
    front of the predecessor's bucket.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(depth + 8, np.uint8)])
    small = types(text)
    five = np.zeros(n + depth, np.uint64)
    for k in range(5):
        five = (five << np.uint64(8)) | padded[k : k + n + depth]
    order = np.flatnonzero(small)
    order = order[np.argsort(five[order])]
    key = five[order]
    tie = np.concatenate([[False], key[1:] == key[:-1]])
    for at in range(5, depth, 5):
        open_ = np.flatnonzero(tie | np.append(tie[1:], False))
        if not len(open_):
            break
        group = np.cumsum(~tie[open_]).astype(np.uint64)
        now = five[order[open_] + at]
        turn = np.argsort((group << np.uint64(40)) | now)
        order[open_] = order[open_[turn]]
        key = now[turn]
        tie[open_[1:]] &= key[1:] == key[:-1]
    first = text[order]
    sorted_small = np.split(order, np.searchsorted(first, np.arange(1, 256)))
    front: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n and not small[n - 1]:
        front[text[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        whole = front[c]
        # Suffixes of this bucket may bring predecessors of the same bucket: runs of one byte, a layer at a time.
        at = 0
        while at < len(whole):
            layer = whole[at]
            before = layer[layer > 0] - 1
            before = before[(text[before] == c) & ~small[before]]
            if len(before):
                whole.append(before)
            at += 1
        full = np.concatenate([*whole, sorted_small[c]])
        out.append(full)
        before = full[full > 0] - 1
        byte = text[before]
        before = before[byte > c]
        byte = byte[byte > c]
        turn = np.argsort(byte, kind="stable")
        before, byte = before[turn], byte[turn]
        cuts = np.flatnonzero(np.concatenate([[True], byte[1:] != byte[:-1]])) if len(byte) else []
        for a, b in zip(cuts, np.append(cuts[1:], len(byte)).astype(int) if len(byte) else [], strict=True):
            front[byte[a]].append(before[a:b])
    return np.concatenate(out)


def repeated_starts(pieces: list[bytes]) -> np.ndarray:
    """For the joined pieces (each followed by a separator): whether the LENGTH bytes at each place occur at another place."""
    text = np.frombuffer(b"".join(p + bytes([SEPARATOR]) for p in pieces), np.uint8)
    order = suffix_order(text)
    padded = np.concatenate([text, np.zeros(LENGTH + 8, np.uint8)])
    eight = np.zeros(len(text) + LENGTH, np.uint64)
    for k in range(8):
        eight = (eight << np.uint64(8)) | padded[k : k + len(eight)]
    ends = np.flatnonzero(text == SEPARATOR)
    whole = ends[np.searchsorted(ends, np.arange(len(text)))] - np.arange(len(text)) >= LENGTH
    # Common prefixes of neighbours, eight bytes at a time while they last.
    alike = np.flatnonzero(whole[order[:-1]] & whole[order[1:]])
    for at in range(0, LENGTH, 8):
        alike = alike[eight[order[alike] + at] == eight[order[alike + 1] + at]]
    found = np.zeros(len(text), bool)
    found[order[alike]] = True
    found[order[alike + 1]] = True
    return found


def sorted_spans(keyed: DataFrame, chosen: DataFrame, buckets: int) -> DataFrame:
    """(key, low, high): repeated bytes found by suffix sorting the chosen copies of segments."""
    words, bits = bit_filter(chosen, "x")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rec, row, begin in records(batch):
                if not len(rec):
                    continue
                use = np.flatnonzero(in_filter(_name(rec), words, bits))
                if not len(use):
                    continue
                data, offsets = text_bytes(batch.column("text"))
                low = offsets[begin + row[use]] + rec["at"][use]
                pieces = [data[a : a + m + LENGTH - 1].tobytes() for a, m in zip(low.tolist(), rec["n"][use].tolist(), strict=True)]
                anchor = np.ascontiguousarray(rec["anchor"][use])
                yield pa.RecordBatch.from_arrays(
                    [pa.array((mixed(anchor ^ STEP[4]) % np.uint64(buckets)).astype(np.int32)), pa.array(anchor.view(np.int64)),
                     pa.array(np.ascontiguousarray(rec["key"][use])), pa.array(np.ascontiguousarray(rec["at"][use])), pa.array(pieces, pa.binary())], names)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        every = pa.Table.from_batches(parts).sort_by([("anchor", "ascending")]).combine_chunks()
        anchor, key, at = (every.column(c).to_numpy() for c in ("anchor", "key", "at"))
        pieces = every.column("piece")
        size = np.cumsum([len(p.as_buffer()) for p in pieces])
        ends = np.append(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, len(anchor))
        begin = 0
        while begin < len(anchor):
            fits = ends[(ends > begin) & (size[ends - 1] - (size[begin - 1] if begin else 0) <= BATCH)]
            end = int(fits[-1]) if len(fits) else int(ends[ends > begin][0])
            if end - begin > 1:
                own = [p.as_py() for p in pieces[begin:end]]
                found = np.flatnonzero(repeated_starts(own))
                starts = np.cumsum([0] + [len(p) + 1 for p in own])
                piece = np.searchsorted(starts, found, side="right") - 1
                new = np.concatenate([[True], (found[1:] != found[:-1] + 1) | (piece[1:] != piece[:-1])]) if len(found) else np.zeros(0, bool)
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(found)) - 1 if len(found) else first
                low = at[begin + piece[first]] + found[first] - starts[piece[first]]
                high = low + (found[last] - found[first]) + LENGTH
                yield pa.RecordBatch.from_arrays([pa.array(key[begin + piece[first]]), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))], ["key", "low", "high"])
            begin = end

    names = ["bucket", "anchor", "key", "at", "piece"]
    sent = keyed.select("key", "text").mapInArrow(send, "bucket int, anchor long, key long, at int, piece binary")
    return sent.repartition(buckets, "bucket").mapInArrow(search, "key long, low int, high int")


def repeated_spans(keyed: DataFrame) -> DataFrame:
    """(key, low, high): all repeated bytes of all documents, overlapping."""
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A segment starts about every (LENGTH - GRAM) / 2 bytes.
    buckets = buckets_for(keyed.sparkSession, size * RECORD.itemsize / ((LENGTH - GRAM) / 2))
    told = staged(classify(keyed, buckets), "suffix-classes")
    spans = told.where("kind = 0").select(F.col("x").alias("key"), "low", "high")
    hot = np.sort(told.where("kind = 2").select("x").toPandas()["x"].to_numpy(np.int64).view(np.uint64))
    if len(hot):
        # At most one hot anchor for every HOT segments.
        by_string = classify(keyed, buckets, hot).where("kind = 0")
        spans = spans.unionAll(by_string.select(F.col("x").alias("key"), "low", "high"))
    return spans.unionAll(sorted_spans(keyed, told.where("kind = 1").select("x"), buckets))


def cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of the text, and the maximal runs that were removed."""
    runs: list[list[int]] = []
    for low, high in sorted(spans):
        if runs and low <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], high)
        else:
            runs.append([low, high])
    kept, at = [], 0
    for low, high in runs:
        kept.append(text[at:low])
        at = high
    return b"".join(kept) + text[at:], [(a, b) for a, b in runs]


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept), one row for each row of docs; kept is the remaining bytes
    if anything was removed, else null: the text is whole."""
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", text.alias("text"), F.xxhash64("doc_id", text).alias("key"))
    spans = staged(repeated_spans(keyed), "suffix-spans")
    by_doc = spans.groupBy("key").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    words, bits = bit_filter(spans.select("key").distinct(), "key")

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            asked = in_filter(np.ascontiguousarray(keys).view(np.uint64), words, bits)
            texts = batch.column("text")
            data, offsets = text_bytes(texts)
            sizes = np.diff(offsets)
            digest = [None if a else hashlib.sha256(data[low : low + n]).hexdigest() for a, low, n in zip(asked, offsets[:-1].tolist(), sizes.tolist(), strict=True)]
            held = pa.array([data[low : low + n].tobytes() if a else None for a, low, n in zip(asked, offsets[:-1].tolist(), sizes.tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(sizes.astype(np.int64)), pa.array(digest, pa.string()), held], ["doc_id", "key", "n_bytes", "digest", "held"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, runs, digests, kept = [], [], batch.column("digest").to_pylist(), []
            for k, (held, spans) in enumerate(zip(batch.column("held").to_pylist(), batch.column("spans").to_pylist(), strict=True)):
                left, gone = cut(held, [(s["low"], s["high"]) for s in spans or []]) if held is not None else (None, [])
                if held is not None:
                    digests[k] = hashlib.sha256(left).hexdigest()
                removed.append(len(held) - len(left) if gone else 0)
                runs.append(len(gone))
                kept.append(left if gone else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.binary())], names)

    kind = dict(docs.dtypes)["doc_id"]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    ready = keyed.mapInArrow(prepare, f"doc_id {kind}, key long, n_bytes long, digest string, held binary")
    return ready.join(by_doc, "key", "left").select("doc_id", "n_bytes", "digest", "held", "spans").mapInArrow(
        finish, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove repeated strings from all documents."""
    return without_repeats(table(spark, sf_dir, "documents")).drop("kept")
