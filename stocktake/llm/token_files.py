"""Token ids of documents in binary files of patched frame-of-reference blocks, in ascending order of document ids.

A file holds (all numbers little-endian):

    b"TKF1"
    blocks, each of up to BLOCK ids:
        u32 least id, u16 number of ids, u8 width, u16 number of exceptions
        the low `width` bits of every id less the least one, 64 ids in `width` words of 64 bits, the last group padded with zeros
        u16 place of each exception, u32 its remaining high bits
    document table: i64 id and u8 null mark of each document, then u64 number of its ids
    block index: u64 place of each block in the file
    u64 place of the table, u64 place of the index, u64 documents, u64 blocks, u64 ids, b"TKF1"

The width of a block is what its ids need at the percentile WIDTH_AT after the least one is subtracted; the ids that need more are its
exceptions. Any id can be read by way of the block index without the blocks before it. Each document's ids end with END. Which files count is
kept in a table beside them, written by Spark when all tasks are done: files of lost or repeated tasks are not in it.

Documents are dealt by ranges of (doc_id, hash of the text) and sorted, so files of ascending number hold ascending ids, and
many rows of one id do not meet in one task. A task holds one batch of texts and the blocks of the moment, not its file.

Words are looked up in a bounded table of what the tokenizer made of them before. For byte-level tokenizers with the usual pattern (contractions, then
letters, digits, other characters, each with the space before, then white space) this gives the ids of the whole text; for any
other, `whole=True` hands over whole texts.

Defined results: null ids come first; rows of one id are in the order of the 64-bit hash of their texts, then the texts; rows repeated in
full are documents of their own; a null or empty text has END alone; an empty table gives no file and reads back empty. Other columns are
not written. A text without any white space is tokenized in one piece.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stocktake.llm.common import bounded_batches, new_folder, table

MAGIC, END = b"TKF1", 0
HEAD, FOOT = "<IHBH", "<QQQQQ4s"
HEAD_SIZE, FOOT_SIZE = struct.calcsize(HEAD), struct.calcsize(FOOT)
BLOCK, LANES, WIDTH_AT = 1024, 64, 0.9
#: Blocks packed or read at once; ids after which a file ends with the document; characters tokenized at once.
GROUP, FILE_IDS, CHARS = 256, 1 << 25, 1 << 20
#: Words kept with their ids (up to twice as many), and the length up to which a word is kept.
KEPT_WORDS, KEPT_CHARS = 250_000, 64
MANIFEST = "part int, file int, path string, n_docs long, n_ids long, n_bytes long"
#: Latin letters, which every version of Unicode knows as such.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
#: ASCII characters that are no letter, digit, white space or apostrophe (which may begin a contraction), for a character class.
MARKS = r"!-&(-/:-@\[-`{-~"
#: Pieces of text that end where byte-level pre-tokenization always ends a token too: words of plain letters before white space or one of these
#: marks, runs of the marks before white space, a line end or tab before something else, else all up to a certain white space. Space, tab and
#: line ends are certain; of some others not every library says that they are white space, so they end nothing.
_UNITS = re.compile(
    rf" ?[{LETTERS}]+(?=[\s{MARKS}]|\Z)|[{MARKS}]+(?=[ \t\n\r]|\Z)|[\t\n\r](?=\S)|\s*\S+(?:[^\S \t\n\r]\s*(?:\S+|\Z))*|\s+"
)


def _lanes(width: int) -> Iterator[tuple[int, int, int]]:
    """(lane, word, shift) of the 64 numbers that share `width` words."""
    for lane in range(LANES):
        yield lane, *divmod(lane * width, 64)


def packed(numbers: np.ndarray, width: int) -> np.ndarray:
    """Rows of numbers below 2^width, a multiple of 64 in each row -> rows of words."""
    lanes = np.ascontiguousarray(numbers.reshape(-1, LANES).T).astype(np.uint64)
    words = np.zeros((width, lanes.shape[1]), np.uint64)
    for lane, word, shift in _lanes(width):
        words[word] |= lanes[lane] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= lanes[lane] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).reshape(len(numbers), -1)


def unpacked(words: np.ndarray, width: int) -> np.ndarray:
    """The inverse of packed."""
    groups = np.ascontiguousarray(words.reshape(-1, width).T)
    numbers = np.empty((LANES, groups.shape[1]), np.uint64)
    for lane, word, shift in _lanes(width):
        numbers[lane] = groups[word] >> np.uint64(shift)
        if shift + width > 64:
            numbers[lane] |= groups[word + 1] << np.uint64(64 - shift)
    return (np.ascontiguousarray(numbers.T) & np.uint64((1 << width) - 1)).reshape(len(words), -1)


def _bits(numbers: np.ndarray) -> np.ndarray:
    """How many bits each number needs."""
    return np.frexp(numbers.astype(np.float64))[1]


def encoded_blocks(ids: np.ndarray, width_at: float = WIDTH_AT) -> list[bytes]:
    """Blocks of the ids; only the last may be short."""
    full = len(ids) // BLOCK * BLOCK
    parts = [ids[:full].reshape(-1, BLOCK)] if full else []
    if full < len(ids):
        parts.append(ids[None, full:])
    out = []
    for part in parts:
        n = part.shape[1]
        least = part.min(axis=1)
        over = (part - least[:, None]).astype(np.uint32)
        k = min(n - 1, int(width_at * n))
        widths = _bits(np.partition(over, k, axis=1)[:, k])
        payload: list = [None] * len(part)
        for width in np.unique(widths).tolist():
            rows = np.flatnonzero(widths == width)
            mine = over[rows]
            high = mine >> np.uint32(width) if width < 32 else np.zeros_like(mine)
            if width:
                low = np.zeros((len(rows), -(-n // LANES) * LANES), np.uint32)
                low[:, :n] = mine & np.uint32((1 << width) - 1)
                words = packed(low, width)
            row_of, place = np.nonzero(high)
            bounds = np.searchsorted(row_of, np.arange(len(rows) + 1))
            rest = high[row_of, place].astype("<u4")
            place = place.astype("<u2")
            for r, row in enumerate(rows.tolist()):
                at, end = bounds[r], bounds[r + 1]
                payload[row] = (
                    struct.pack(HEAD, int(least[row]), n, width, int(end - at)) + (words[r].tobytes() if width else b"")
                    + place[at:end].tobytes() + rest[at:end].tobytes()
                )
        out += payload
    return out


def decoded_blocks(data: bytes, starts: Iterable[int]) -> np.ndarray:
    """The ids of the blocks at these places of data."""
    heads, alike = [], {}
    for k, at in enumerate(starts):
        least, n, width, exceptions = struct.unpack_from(HEAD, data, at)
        size = -(-n // LANES) * width
        heads.append((least, n, width, exceptions, at + HEAD_SIZE, size))
        alike.setdefault((n, width), []).append(k)
    out: list = [None] * len(heads)
    for (n, width), members in alike.items():
        if width:
            words = np.stack([np.frombuffer(data, "<u8", heads[k][5], heads[k][4]) for k in members])
            numbers = unpacked(words, width)[:, :n]
        else:
            numbers = np.zeros((len(members), n), np.uint64)
        for k, row in zip(members, numbers):
            least, _, _, exceptions, at, size = heads[k]
            if exceptions:
                at += 8 * size
                place = np.frombuffer(data, "<u2", exceptions, at)
                row[place] |= np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions).astype(np.uint64) << np.uint64(width)
            out[k] = row + np.uint64(least)
    return np.concatenate(out).astype("<u4") if out else np.zeros(0, "<u4")


class Writer:
    """One file, written block by block."""

    def __init__(self, stream, width_at: float = WIDTH_AT) -> None:
        self.stream, self.width_at = stream, width_at
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.docs, self.nulls, self.lengths, self.starts = array("q"), array("B"), array("Q"), array("Q")
        self.at = len(MAGIC)
        stream.write(MAGIC)

    def _flush(self, last: bool = False) -> None:
        ids = np.concatenate(self.held)
        cut = len(ids) if last else len(ids) // BLOCK * BLOCK
        for block in encoded_blocks(ids[:cut], self.width_at):
            self.starts.append(self.at)
            self.at += len(block)
            self.stream.write(block)
        self.held, self.n_held = [ids[cut:]], len(ids) - cut

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.lengths.append(len(ids))
        self.n_ids += len(ids)
        for k in range(0, len(ids), GROUP * BLOCK):
            self.held.append(ids[k : k + GROUP * BLOCK])
            self.n_held += len(self.held[-1])
            if self.n_held >= GROUP * BLOCK:
                self._flush()

    def close(self) -> int:
        """Write what is left; the bytes of the file."""
        if self.n_held:
            self._flush(last=True)
        tables = [np.asarray(a, kind).tobytes() for a, kind in ((self.docs, "<i8"), (self.nulls, "u1"), (self.lengths, "<u8"), (self.starts, "<u8"))]
        index = self.at + sum(map(len, tables[:3]))
        foot = struct.pack(FOOT, self.at, index, len(self.docs), len(self.starts), self.n_ids, MAGIC)
        for t in (*tables, foot):
            self.stream.write(t)
        self.stream.close()
        return index + len(tables[3]) + len(foot)


class Reader:
    """A file by its document table and block index. Damage is an error."""

    def __init__(self, file) -> None:
        self.file, size = file, file.size()
        if size < FOOT_SIZE:
            raise ValueError("not a token file, or cut short")
        docs, index, n_docs, n_blocks, self.n_ids, magic = struct.unpack(FOOT, self._read(size - FOOT_SIZE, FOOT_SIZE))
        if magic != MAGIC or index != docs + 17 * n_docs or size != index + 8 * n_blocks + FOOT_SIZE or self._read(0, 4) != MAGIC:
            raise ValueError("not a token file, or cut short")
        self.docs = np.frombuffer(self._read(docs, 8 * n_docs), "<i8")
        self.nulls = np.frombuffer(self._read(docs + 8 * n_docs, n_docs), "u1") != 0
        self.lengths = np.frombuffer(self._read(docs + 9 * n_docs, 8 * n_docs), "<u8").astype(np.int64)
        self.starts = np.append(np.frombuffer(self._read(index, 8 * n_blocks), "<u8"), docs).astype(np.int64)
        if self.lengths.sum() != self.n_ids:
            raise ValueError("the document table does not fit the number of ids")

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids first..last-1 of the file; only the blocks that hold them are read."""
        if last <= first:
            return np.zeros(0, "<u4")
        a, b = first // BLOCK, -(-last // BLOCK)
        data = self._read(int(self.starts[a]), int(self.starts[b] - self.starts[a]))
        return decoded_blocks(data, (self.starts[a:b] - self.starts[a]).tolist())[first - a * BLOCK : last - a * BLOCK]

    def documents(self) -> Iterator[tuple[int | None, int, Iterator[np.ndarray]]]:
        """(id, first place, pieces of its ids) of every document, in order; the pieces must be taken before the next document."""
        at, held_from, held = 0, 0, np.zeros(0, "<u4")

        def pieces(first: int, last: int) -> Iterator[np.ndarray]:
            nonlocal held_from, held
            while first < last:
                if first >= held_from + len(held):
                    held_from = first // BLOCK * BLOCK
                    held = self.ids(held_from, min(self.n_ids, held_from + GROUP * BLOCK))
                piece = held[first - held_from : last - held_from]
                yield piece
                first += len(piece)

        for doc_id, null, n in zip(self.docs.tolist(), self.nulls.tolist(), self.lengths.tolist()):
            yield None if null else doc_id, at, pieces(at, at + n)
            at += n


class _Known(dict):
    """Token ids of the words met so far, as bytes; words that have not recurred for KEPT_WORDS new ones are forgotten."""

    def __init__(self, tokens_of) -> None:
        self.tokens_of, self.older = tokens_of, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = array("I", self.tokens_of(word)).tobytes()
            if len(word) > KEPT_CHARS:
                return ids
        if len(self) >= KEPT_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids


class Encoder:
    """Token ids of texts by a tokenizer file. Words of plain letters go straight to the tokenizer's model, in the characters its
    byte-level step would give it; anything else, and all of other tokenizers, through the tokenizer."""

    def __init__(self, path: str, whole: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.whole = Tokenizer.from_file(path), whole
        self.tokenizer.encode_special_tokens = True  # their strings in a text are text
        self.model, self.known = self.tokenizer.model, _Known(self._tokens)
        self.is_plain = None
        if isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel) and self.tokenizer.normalizer is None:
            step = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            plain = re.compile(f"[ {LETTERS}]")
            self.spelled = str.maketrans({c: step.pre_tokenize_str(c)[0][0] for c in map(chr, range(0x300)) if plain.match(c)})
            self.is_plain = re.compile(f" ?[{LETTERS}]+").fullmatch

    def _tokens(self, word: str) -> list[int]:
        if self.is_plain and self.is_plain(word):
            return [t.id for t in self.model.tokenize(word.translate(self.spelled))]
        return self.tokenizer.encode_batch_fast([word], add_special_tokens=False)[0].ids

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if self.whole:
            return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        known = self.known.__getitem__
        return [np.frombuffer(b"".join(map(known, _UNITS.findall(t))), np.uint32) for t in texts]


def _encoder(path: str, whole: bool) -> Encoder:
    """The encoder of this Python worker, which keeps it from task to task in the library's module."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_kept_encoders", {})
    if (path, whole) not in kept:
        kept[path, whole] = Encoder(path, whole)
    return kept[path, whole]


def _by_size(ids: list, texts: list[str]) -> Iterator[tuple[list, list[str]]]:
    """Rows in groups of about CHARS characters."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= CHARS):
            size += len(texts[end])
            end += 1
        yield ids[at:end], texts[at:end]
        at = end


def file_system(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a folder's address and the path in it; without a scheme it is the machine's own."""
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return pa.fs.FileSystem.from_uri(folder) if "://" in folder else (pa.fs.LocalFileSystem(), folder)


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme: without one it is on the cluster's default file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
    end: int = END, width_at: float = WIDTH_AT, file_ids: int = FILE_IDS, whole: bool = False,
) -> None:
    """Write the token ids of every text, each followed by `end`, to files in the folder (see above), and the table of files.

    `tokenizer` is the path of a tokenizer file that every executor can read; the folder is one that all executors share.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    folder = _qualified(spark, folder)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text").select("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, place = file_system(folder)
        part, number, writer, name = TaskContext.get().partitionId(), 0, None, ""
        encode, stop = None, np.array([end], np.uint32)

        def done() -> pa.RecordBatch:
            row = {"part": part, "file": number, "path": f"{folder}/{name}", "n_docs": len(writer.docs), "n_ids": writer.n_ids, "n_bytes": writer.close()}
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds)], names=list(row))

        for batch in batches:
            encode = encode or _encoder(tokenizer, whole)
            for ids, texts in _by_size(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for i, tokens in zip(ids, encode(texts)):
                    if writer is None:
                        files.create_dir(place, recursive=True)
                        name = f"{part:08d}-{number:06d}-{uuid.uuid4().hex}.tkf"
                        writer = Writer(files.open_output_stream(f"{place}/{name}"), width_at)
                    writer.add(i, np.concatenate([tokens, stop]))
                    if writer.n_ids >= file_ids:
                        yield done()
                        writer, number = None, number + 1
        if writer is not None:
            yield done()

    rows.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/files")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """The files in order, each with the number of ids before it, one to a task. The table has one row for each file."""
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/files")
    before = F.sum("n_ids").over(Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1))
    return files.withColumn("start", F.coalesce(before, F.lit(0)).cast("long")).repartition(max(1, files.count()), "path")


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Reader]]:
    for batch in batches:
        for path, start, n_ids in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "n_ids"))):
            files, place = file_system(path)
            with files.open_input_file(place) as file:
                reader = Reader(file)
                if reader.n_ids != n_ids:
                    raise ValueError(f"{path} has {reader.n_ids} ids, the table of files says {n_ids}")
                yield start, reader


def _in_batches(rows: Iterator[tuple], kinds: dict[str, pa.DataType], many: int) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= many:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds.values())], names=list(kinds))
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds.values())], names=list(kinds))


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as unsigned 32-bit numbers) of every document of the files, all ids decoded."""
    kinds = dict.fromkeys(("doc_id", "start", "n_tokens", "ids_crc32"), pa.int64())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for start, reader in _opened(batches):
                for doc_id, at, pieces in reader.documents():
                    crc = n = 0
                    for piece in pieces:
                        crc, n = zlib.crc32(piece.tobytes(), crc), n + len(piece)
                    yield doc_id, start + at, n, crc

        yield from _in_batches(rows(), kinds, 10_000)

    return _files(spark, folder).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start and ids of every document of the files."""
    kinds = {"doc_id": pa.int64(), "start": pa.int64(), "ids": pa.list_(pa.int32())}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for start, reader in _opened(batches):
                for doc_id, at, pieces in reader.documents():
                    yield doc_id, start + at, np.concatenate([*pieces, np.zeros(0, "<u4")]).astype(np.int32)

        yield from _in_batches(rows(), kinds, 200)

    return _files(spark, folder).mapInArrow(read, "doc_id long, start long, ids array<int>")


def op12_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to files and read back."""
    import public_tokenizers

    folder = new_folder(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_index(spark, folder)
