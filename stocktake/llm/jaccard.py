"""Join of documents by the Jaccard similarity of their word shingles, size-aware and exact.

Documents with equal shingle sets are one class and meet by digest. Shingles have one global order, rare ones first. Two
sets of similarity t share, within their first |s| - ceil(t |s|) + c shingles, at least c of them (c = 1, 2). Small sets
enumerate all fixed-size subsets (pairs) of that prefix and meet at equal subsets: many short lists. For large sets that is too much; they
scan the inverted lists of single prefix shingles, among all sets that are large enough to be their partners. The boundary
is the size at which a set's subsets cost more than its lists. Lists hold (class, size, place): pairs whose sizes differ
too much or that cannot reach the overlap from the place of the shared shingle are dropped; the rest is counted exactly on whole sets.

Not all pairs of a list are formed: first every member meets only the list's best connected member, then only members that are
still in different components meet. A pair that is left out joins documents that are connected already.

Defined results: null, empty and blank texts have no shingles, link with nothing and are their own components; equal texts
link; rows with equal ids are copies or not by their texts, like any rows; a null id takes part and its class shows the smallest id that
is not null; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktake.llm.common import buckets_for, fresh, staged, table
from stocktake.llm.components import components
from stocktake.llm.filters import bit_filter, in_filter
from stocktake.llm.tokens import chunks, hashed_words, mixed, text_bytes

WORDS = 5
PERCENT = 80
#: Shingles whose frequency orders them, at most: the most frequent ones. Any order gives the same links; a better one shorter lists.
ORDERED = 1 << 20
#: Pairs of one class that meet its set in one task.
CROWD = 500
#: Shingles that a task looks through at once for recurring ones.
RECURRING = 3_000_000
SUBSET = 2
#: A list of a shingle that recurs at least so often is never gathered in one task.
HOT = 10_000


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, sorted distinct shingles of its chunk's rows, places of the rows) for each chunk.

    A text with fewer words than a shingle is one shingle of all its words.
    """
    for first, last in chunks(offsets):
        hashes, rows = hashed_words(data, offsets, first, last)
        counts = np.diff(rows)
        rolled = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
        for k in range(words):
            rolled += hashes[k : k + len(rolled)] * np.uint64(2 * k + 3) if len(rolled) else 0
            rolled = (rolled << np.uint64(13)) | (rolled >> np.uint64(51))
        rolled = mixed(rolled)
        sets = []
        for r, n in enumerate(counts):
            at = rows[r]
            if n >= words:
                own = np.sort(rolled[at : at + n - words + 1])
                sets.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
            elif n:
                whole = np.array([n], np.uint64)
                for k in range(at, at + n):
                    whole = mixed(whole * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + 1])
                sets.append(whole)
            else:
                sets.append(np.zeros(0, np.uint64))
        yield first, np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum([len(s) for s in sets])])


def _digests(shingles: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each row's set: sums of its mixed shingles. The first is the class; nothing compares the second yet."""
    parts = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(shingles ^ np.uint64(salt)), dtype=np.uint64)])
        parts.append(mixed((sums[rows[1:]] - sums[rows[:-1]]) + np.diff(rows).astype(np.uint64)))
    return parts[0], parts[1]


def needed(percent: int, a: int, b: int) -> int:
    """Shared shingles that sets of sizes a and b need: 100 * o >= percent * (a + b - o)."""
    return -(-percent * (a + b) // (100 + percent))


def _profile(docs: DataFrame, words: int) -> DataFrame:
    """One pass over the texts: (kind 0) id, digest and size of each document; (kind 1) shingles that recur among some
    RECURRING shingles of a task, counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every: list[np.ndarray] = []
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            first, second, size = [], [], []
            for _, shingles, rows in shingle_sets(data, offsets, words):
                a, b = _digests(shingles, rows)
                first.append(a), second.append(b), size.append(np.diff(rows)), every.append(shingles)
                if sum(map(len, every)) >= RECURRING:
                    yield recurring(every)
                    every = []
            n = batch.num_rows
            if not n:
                continue
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(n, np.int32)), batch.column("doc_id").cast(pa.int64()), pa.array(np.concatenate(first).view(np.int64)),
                 pa.array(np.concatenate(second).view(np.int64)), pa.array(np.concatenate(size).astype(np.int64))], names)
        if every:
            yield recurring(every)

    def recurring(every: list[np.ndarray]) -> pa.RecordBatch:
        ordered = np.concatenate(every)
        ordered.sort()
        begins = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, int)
        count = np.diff(np.append(begins, len(ordered)))
        found, count = ordered[begins][count > 1].view(np.int64), count[count > 1].astype(np.int64)
        nothing = pa.nulls(len(found), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(np.ones(len(found), np.int32)), nothing, pa.array(found), nothing, pa.array(count)], names)

    names = ["kind", "doc_id", "x", "y", "n"]
    return docs.select("doc_id", "text").mapInArrow(run, "kind int, doc_id long, x long, y long, n long")


def frequent_shingles(profile: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent recurring shingles, sorted, and their counts: a table of at most 16 * most bytes."""
    counted = profile.where("kind = 1").groupBy("x").agg(F.sum("n").alias("n")).where("n > 2").orderBy(F.desc("n"), "x").limit(most).toPandas()
    keys, counts = counted["x"].to_numpy(np.int64).view(np.uint64), counted["n"].to_numpy(np.int64)
    order = np.argsort(keys)
    return keys[order], counts[order]


def in_order(shingles: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of one set by frequency, then by number; and which of them are hot."""
    if not len(keys):
        return shingles, np.zeros(len(shingles), bool)
    at = np.minimum(np.searchsorted(keys, shingles), len(keys) - 1)
    common = keys[at] == shingles
    often = np.where(common, counts[at], 0)
    order = np.lexsort((shingles, often))
    return shingles[order], often[order] >= HOT


def boundary(sizes: list[tuple[int, int]], percent: int, mean_list: float) -> int:
    """The size from which lists are cheaper than subsets: enumerating a set's subsets costs one posting each, scanning its
    lists costs a posting and the list for each prefix shingle."""
    best = 0
    for size, _ in sorted(sizes):
        lists = size - needed_share(size, percent) + 1
        enumerated = math.comb(lists + SUBSET - 1, SUBSET)
        if enumerated > lists * (1 + mean_list):
            break
        best = size
    return best


def needed_share(size: int, percent: int) -> int:
    """Shingles of a set of this size that any partner must share."""
    return -(-percent * size // 100)


def _postings(docs: DataFrame, keys: np.ndarray, counts: np.ndarray, light: int, words: int, percent: int, buckets: int) -> DataFrame:
    """Live postings (sig, class, size, place): signatures that at least two classes have.

    Postings travel as packed arrays, a bucket of signatures to a task, which keeps those that may have a partner in their list. Signatures
    of hot shingles are not gathered but go through wherever they are.
    """
    packed = np.dtype([("sig", "<u8"), ("cls", "<u8"), ("size", "<i4"), ("place", "<i4")])

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            out, known = [], []
            for _, shingles, rows in shingle_sets(data, offsets, words):
                cls, _ = _digests(shingles, rows)
                for r in range(len(rows) - 1):
                    n = int(rows[r + 1] - rows[r])
                    # Sets as small as this only link with equal ones, which are their own class.
                    if not n or n * 100 // percent == n and needed(percent, n, n) == n:
                        continue
                    ordered, common = in_order(shingles[rows[r] : rows[r + 1]], keys, counts)
                    single = n - needed_share(n, percent) + 1
                    sigs, place, frequent = [], [], []
                    if n <= light:
                        head = ordered[: single + SUBSET - 1]
                        a, b = np.triu_indices(len(head), 1)
                        sigs.append(mixed(mixed(head[a]) + head[b] * np.uint64(5)))
                        place.append(a)
                        frequent.append(common[a] & common[b])
                    if 100 * n >= percent * light:  # large, or a partner of large ones
                        sigs.append(ordered[:single])
                        place.append(np.arange(single))
                        frequent.append(common[:single])
                    sig = np.concatenate(sigs)
                    rec = np.empty(len(sig), packed)
                    rec["sig"], rec["cls"], rec["size"], rec["place"] = sig, cls[r], n, np.concatenate(place)
                    out.append(rec)
                    known.append(np.concatenate(frequent))
            if not out:
                continue
            every, frequent = np.concatenate(out), np.concatenate(known)
            bucket = ((every["sig"] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
            bucket[frequent] = (np.arange(int(frequent.sum())) // 4096 + int(every["cls"][0] % 997)) % buckets
            code = bucket * 2 + frequent
            order = np.argsort(code, kind="stable")
            every, code = every[order], code[order]
            begins = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            blobs = [every[a:b].tobytes() for a, b in zip(begins, np.append(begins[1:], len(every)), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array((code[begins] // 2).astype(np.int32)), pa.array((code[begins] % 2).astype(bool)), pa.array(blobs, pa.binary())], ["bucket", "frequent", "postings"]
            )

    def table_of(rec: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(rec["sig"]).view(np.int64)), pa.array(np.ascontiguousarray(rec["cls"]).view(np.int64)), pa.array(np.ascontiguousarray(rec["size"])), pa.array(np.ascontiguousarray(rec["place"]))],
            ["sig", "cls", "size", "place"],
        )

    def recurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for frequent, blob in zip(batch.column("frequent").to_pylist(), batch.column("postings"), strict=True):
                rec = np.frombuffer(blob.as_buffer(), packed)
                if frequent:
                    yield table_of(rec)
                else:
                    held.append(rec.copy())
        if held:
            rec = np.concatenate(held)
            rec = rec[np.lexsort((rec["cls"], rec["sig"]))]
            sig, cls = np.ascontiguousarray(rec["sig"]), np.ascontiguousarray(rec["cls"])
            new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (cls[1:] != cls[:-1])])
            yield table_of(hopeful(rec[new], percent))  # copies of a class say the same

    sent = docs.select("text").mapInArrow(post, "bucket int, frequent boolean, postings binary")
    return sent.repartition(buckets, "bucket").mapInArrow(recurring, "sig long, cls long, size int, place int")


def hopeful(rec: np.ndarray, percent: int) -> np.ndarray:
    """The postings that can reach the overlap with some partner of their list: the smallest one that is large enough asks least."""
    while len(rec):
        rec = rec[np.lexsort((rec["size"], rec["sig"]))]
        sig, size = np.ascontiguousarray(rec["sig"]), rec["size"].astype(np.int64)
        group = np.cumsum(np.concatenate([[0], sig[1:] != sig[:-1]]))
        wide = int(size.max()) + 1
        at = np.searchsorted(group * wide + size, group * wide + -(-percent * size // 100))
        at += at == np.arange(len(rec))
        partner = np.minimum(at, len(rec) - 1)
        need = -(-percent * (size + size[partner]) // (100 + percent))
        able = (at < len(rec)) & (group[partner] == group) & (size[partner] * percent <= size * 100) & (size - rec["place"] >= need)
        if able.all():
            break
        rec = rec[able]
    return rec


def _able(percent: int) -> Column:
    """Whether sizes and places of a shared signature allow the overlap; a and b are postings of two classes."""
    need = F.ceil((F.lit(percent) * (F.col("a_size") + F.col("b_size"))) / F.lit(100 + percent))
    rest = F.least(F.col("a_size") - F.col("a_place"), F.col("b_size") - F.col("b_place"))
    return (F.least("a_size", "b_size") * 100 >= F.greatest("a_size", "b_size") * percent) & (rest >= need)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that link, by counting on whole sets.

    A class b with more than CROWD pairs has its set dealt to as many parts as its pairs need.
    """
    crowds = pairs.groupBy("b").agg(F.count("*").alias("n")).where(F.col("n") > CROWD)
    crowds = staged(crowds.select("b", F.ceil(F.col("n") / CROWD).cast("int").alias("parts")), "jaccard-crowds")
    left, right = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("a_set")), sets.select(F.col("cls").alias("b"), F.col("shingles").alias("b_set"))
    both = pairs.join(left, "a").join(right, "b")
    if not crowds.isEmpty():
        both = pairs.join(crowds, "b", "left_anti").join(left, "a").join(right, "b")
        part = F.pmod(F.xxhash64("a"), F.col("parts")).cast("int")
        crowded = pairs.join(crowds, "b").withColumn("part", part).drop("parts").join(left, "a")
        dealt = right.join(crowds, "b").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        both = both.select("a", "b", "a_set", "b_set").unionAll(crowded.join(dealt, ["b", "part"]).select("a", "b", "a_set", "b_set"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("a_set"), batch.column("b_set"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return both.select("a", "b", "a_set", "b_set").mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """Whole sets (cls, shingles) of the wanted classes, one each, and of a few others that the bit map lets through."""
    bits = bit_filter(wanted, "cls", each=64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            ids, blobs = [], []
            for _, shingles, rows in shingle_sets(data, offsets, words):
                cls = _digests(shingles, rows)[0]
                _, first = np.unique(cls, return_index=True)
                for r in first[in_filter(cls[first], *bits) & (np.diff(rows)[first] > 0)]:
                    ids.append(cls[r])
                    blobs.append(shingles[rows[r] : rows[r + 1]].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(np.array(ids, np.uint64).view(np.int64)), pa.array(blobs, pa.binary())], ["cls", "shingles"])

    # Copies of a class meet in the map task first.
    return docs.select("text").mapInArrow(run, "cls long, shingles binary").groupBy("cls").agg(F.first("shingles").alias("shingles"))


def _links(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs that link, staged. Only sets that stand in a pair are read."""
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    # All joins read one exchange of the sets.
    sets = _sets(docs, staged(wanted, "jaccard-wanted"), words)
    return staged(_verified(pairs, sets, percent), "jaccard-links")


def grouped(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, cls, component), one row for each row of docs: components of classes, 0 shingles without any."""
    spark = docs.sparkSession
    profile = staged(_profile(docs, words), "jaccard-profile")
    members = profile.where("kind = 0").select("doc_id", F.col("x").alias("cls"), F.col("y").alias("check"), F.col("n").alias("n_shingles"))
    keys, counts = frequent_shingles(profile, ORDERED)
    sizes = [(r["n_shingles"], r["count"]) for r in members.where("n_shingles between 4 and 2000").groupBy("n_shingles").count().collect()]
    light = boundary(sizes, percent, float(np.log2(counts).mean()) if len(counts) else 1.0)
    total = members.agg(F.sum("n_shingles")).first()[0] or 0
    # A prefix has a share of 1 - percent / 100 of a set, a posting 24 bytes.
    buckets = buckets_for(spark, total * (1 - percent / 100) * 24)
    live = staged(_postings(docs, keys, counts, light, words, percent, buckets), "jaccard-postings")

    # First round: each member of a list meets the list's best connected member.
    degree = live.groupBy("cls").agg(F.count("*").alias("degree"))
    hub = live.join(degree, "cls").groupBy("sig").agg(F.max(F.struct("degree", "cls", "size", "place")).alias("hub"))
    first = live.select("sig", F.col("cls").alias("a"), F.col("size").alias("a_size"), F.col("place").alias("a_place")).join(
        hub.select("sig", F.col("hub.cls").alias("b"), F.col("hub.size").alias("b_size"), F.col("hub.place").alias("b_place")), "sig"
    )
    first = staged(first.where((F.col("a") != F.col("b")) & _able(percent)).select("a", "b").distinct(), "jaccard-pairs")
    links = _links(docs, first, words, percent)
    label = components(links, "jaccard-components")

    # Second round: members of a list that are not connected yet meet each other.
    named = live.join(label.withColumnRenamed("id", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    several = named.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("sig")
    open_ = staged(named.join(several, "sig", "left_semi"), "jaccard-open")
    sides = [open_.select("sig", *[F.col(c).alias(f"{s}_{c}") for c in ("cls", "size", "place", "component")]) for s in "ab"]
    rest = sides[0].join(sides[1], "sig").where((F.col("a_cls") < F.col("b_cls")) & (F.col("a_component") != F.col("b_component")) & _able(percent))
    rest = rest.select(F.col("a_cls").alias("a"), F.col("b_cls").alias("b")).distinct()
    tried = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = _links(docs, staged(rest.join(tried, ["a", "b"], "left_anti"), "jaccard-pairs"), words, percent)
    label = components(links.union(more), "jaccard-components")

    return members.join(label.withColumnRenamed("id", "cls"), "cls", "left").select(
        "doc_id", "n_shingles", "cls", F.coalesce("component", "cls").alias("component")
    )


def similar(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of docs."""
    members = staged(grouped(docs, words, percent), "jaccard-members")
    # Written, so that the join back is one of two plain shuffles, which Spark splits where a component is large.
    smallest = staged(members.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("component_id")), "jaccard-smallest")
    out = members.join(smallest, "component", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents without their near copies, with the columns they came with: of each component the one with the smallest
    id stays (null last, then by class); of rows that repeat it one; documents without words all stay."""
    members = staged(grouped(docs, words, percent), "jaccard-members")
    some = members.where("n_shingles > 0")
    own_cls, kept_id, kept_cls, copies = fresh(docs, "_cls", "_kept_id", "_kept_cls", "_copies")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "cls")).alias("first")
    chosen = some.groupBy("component").agg(first).select(F.col("first.doc_id").alias(kept_id), F.col("first.cls").alias(kept_cls))
    rows_of = some.groupBy("doc_id", "cls").agg(F.count("*").alias(copies))
    kept = chosen.join(rows_of, F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col("cls") == F.col(kept_cls)))
    kept = staged(kept.select(kept_id, kept_cls, copies), "jaccard-kept")

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(at))
            cls, wordless = np.zeros(batch.num_rows, np.int64), np.ones(batch.num_rows, bool)
            for begin, shingles, rows in shingle_sets(data, offsets, words):
                here = slice(begin, begin + len(rows) - 1)
                cls[here], wordless[here] = _digests(shingles, rows)[0].view(np.int64), np.diff(rows) == 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cls, mask=wordless)], [*batch.schema.names, own_cls])

    at = docs.columns.index("text")
    told = docs.mapInArrow(classify, T.StructType([*docs.schema.fields, T.StructField(own_cls, T.LongType())]))
    joined = told.join(kept, F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col(own_cls) == F.col(kept_cls)), "left")
    names = [F.col(f"`{c}`") for c in docs.columns]
    out = joined.where(F.col(own_cls).isNull() | (F.col(copies) == 1)).select(*names)
    if not kept.where(F.col(copies) > 1).isEmpty():
        out = out.unionAll(joined.where(F.col(copies) > 1).dropDuplicates(["doc_id", own_cls]).select(*names))
    return out


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents."""
    return similar(table(spark, sf_dir, "documents"))
