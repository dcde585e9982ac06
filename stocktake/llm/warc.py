"""Content-addressed web archive: payload bytes once by digest, record headers apart, records by joins.

An archive folder holds two tables: `payloads` (key, payload), one row for each distinct payload under its SHA-256, and
`headers` (header, key), one row for each record with the exact bytes of its WARC and HTTP header. Both lie in buckets of their key, so that
records are rebuilt by a join without a shuffle; only records of payloads that many share are dealt out, under salted keys. Reading verifies
every payload against its key and every header against its payload, both lengths that it names included, and fails on a mismatch.

Defined results: a null payload is empty; a null or empty URL leaves out the target line and reads back as null; CR and LF in
URLs are percent-encoded; rows repeated in full are records of their own, the first is the response; null ids come after
all others; ties for the smallest id go to the smallest URL. An empty table gives an empty archive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktake.llm.common import new_folder, staged, table

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n"
TABLES = {"payloads": "key string, payload binary", "headers": "header string, key string"}


def base32_of_hex(digest: Column) -> Column:
    """Base32 of a hexadecimal digest of 40 digits: five hexadecimal digits are four base32 digits."""
    parts = []
    for k in range(8):
        value = F.conv(F.substring(digest, 5 * k + 1, 5), 16, 10).cast("int")
        parts += [F.substr(F.lit(BASE32), F.shiftright(value, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*parts)


def _urn(row_id: Column, copy: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(row_id.cast("string"), F.lit("")), F.lit(":"), copy.cast("string"), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line; none for a null or empty value."""
    return F.when(value.isNull() | (value == ""), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), value, F.lit(END)))


def _bucketed(spark: SparkSession, folder: str, name: str) -> str:
    """The table's name in the session's catalog."""
    return f"llm_{name}_{hashlib.md5(folder.encode()).hexdigest()}"


def _write(df: DataFrame, folder: str, name: str, buckets: int) -> None:
    table_name = _bucketed(df.sparkSession, folder, name)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {table_name}")
    df.write.format("parquet").bucketBy(buckets, "key").sortBy("key").option("path", f"{folder}/{name}").saveAsTable(table_name)
    df.sparkSession.sql(f"DROP TABLE {table_name}")


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the archive, in its buckets if the archive says how many there are."""
    df = spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}")
    try:
        buckets = spark.read.schema("buckets int").json(f"{folder}/layout").first()["buckets"]
    except AnalysisException:  # tables copied without their layout
        return df
    table_name = _bucketed(spark, folder, name)
    spark.sql(f"DROP TABLE IF EXISTS {table_name}")
    spark.sql(
        f"CREATE TABLE {table_name} ({TABLES[name]}) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS LOCATION '{folder}/{name}'"
    )
    return spark.table(table_name)


def shared_keys(keyed: DataFrame, parts: int) -> list[str]:
    """Keys that hold more than 1/parts of the rows, so fewer than `parts` of them."""
    counts = keyed.groupBy("key").agg(F.count("*").alias("n"))
    total = keyed.count()
    return sorted(r["key"] for r in counts.where(F.col("n") * parts > total).select("key").collect())


def keyed_join(rows: DataFrame, owners: DataFrame, shared: list[str], parts: int, how: str = "inner") -> DataFrame:
    """Join on key; rows of the shared keys travel under salted keys, with a copy of their owner for each salt."""
    if not shared:
        return rows.join(owners, "key", how)
    hot = F.col("key").isin(shared)
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(parts)).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    dealt = rows.where(hot).withColumn("_salt", salt).join(owners.where(hot).withColumn("_salt", salts), ["key", "_salt"], how).drop("_salt")
    return rows.where(~hot).join(owners.where(~hot), "key", how).unionByName(dealt)


def write_archive(
    pages: DataFrame, folder: str, row_id: str = "page_id", url: str = "url", payload: str = "html",
    min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write a record for each row. Equal payloads of at least min_bytes are stored by the response with the smallest
    id, the other records revisit it; shorter ones are all responses."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(row_id).cast("long").alias("id"),
        F.regexp_replace(F.regexp_replace(F.col(url).cast("string"), "\r", "%0D"), "\n", "%0A").alias("url"),
        body.alias("payload"),
    ).withColumn("key", F.sha2("payload", 256))
    spark = pages.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Equal rows meet in the map task first, so a hot payload is shuffled once by each task. What is shuffled by key is in its bucket.
    _write(rows.select("key", "payload").groupBy("key").agg(F.first("payload").alias("payload")), folder, "payloads", buckets)
    same = staged(rows.groupBy("id", "url", "key", F.octet_length("payload").alias("n"), base32_of_hex(F.sha1("payload")).alias("digest")).agg(
        F.count("*").alias("copies")
    ), "warc-rows")
    order = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("first_id"), F.coalesce("url", F.lit("")).alias("first_url"))
    first = same.groupBy("key").agg(F.min(order).alias("first"))
    records = keyed_join(same, first, shared_keys(same, buckets), buckets).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    revisit = (F.col("n") >= min_bytes) & ~((order == F.col("first")) & (F.col("copy") == 1))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("n").cast("string"), F.lit(END * 2)
    )
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n"))
    header = F.concat(
        F.lit(f"WARC/1.1{END}"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _urn(F.col("id"), F.col("copy"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _line("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _line("WARC-Refers-To", F.when(revisit, _urn(F.col("first.first_id"), F.lit(1)))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", length.cast("string")),
        F.lit(END), http,
    )
    _write(records.select(header.alias("header"), "key").repartition(buckets, "key"), folder, "headers", buckets)
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.json(f"{folder}/layout")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """All records with their exact header and full payload, and the fields of their headers. A payload's digests and length come from its
    stored bytes."""
    stored = _read(spark, folder, "payloads").select(
        "key", "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_of_hex(F.sha1("payload")).alias("payload_digest"),
        (F.sha2("payload", 256) == F.col("key")).alias("sound"),
    )

    def field(pattern: str) -> Column:
        found = F.regexp_extract("header", pattern, 1)
        return F.when(found != "", found)

    parts, headers = int(spark.conf.get("spark.sql.shuffle.partitions")), _read(spark, folder, "headers")
    joined = keyed_join(headers, stored, shared_keys(headers, parts), parts, "left")
    kept = F.coalesce(F.col("sound") & (field(r"\r\nWARC-Payload-Digest: sha1:(\w+)\r\n") == F.col("payload_digest")), F.lit(False))
    # The HTTP header names the payload's length, the WARC header that of the block: all of it, or of a revisit the HTTP header only.
    http = field(r"(?s)\r\n\r\n(HTTP/.*)$")
    block = F.octet_length(http) + F.when(field(r"\r\nWARC-Type: (\w+)\r\n") == "revisit", 0).otherwise(F.col("payload_bytes"))
    fits = F.coalesce(
        (field(r"\r\nContent-Length: (\d+)\r\n\r\nHTTP/").cast("long") == block)
        & (F.regexp_extract(http, r"\r\nContent-Length: (\d+)\r\n", 1).cast("long") == F.col("payload_bytes")), F.lit(False),
    )
    return joined.select(
        field(r"\r\nWARC-Record-ID: <urn:page:(-?\d*):\d+>\r\n").cast("long").alias("page_id"),
        field(r"\r\nWARC-Target-URI: ([^\r\n]*)\r\n").alias("url"),
        F.when(~kept, F.raise_error(F.concat(F.lit("payload does not fit its digest: "), "key")))
        .when(~fits, F.raise_error(F.concat(F.lit("header does not fit the length of its payload: "), "key")))
        .otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(kept & fits, F.col("payload_digest")).alias("payload_digest"),
        field(r"\r\nWARC-Type: (\w+)\r\n").alias("record_type"),
        field(r"\r\nWARC-Refers-To: <urn:page:(-?\d*):\d+>\r\n").cast("long").alias("refers_to"),
        "header", "payload",
    )


def export_warc(records: DataFrame, path: str, codec: str = "gzip") -> None:
    """Records as WARC files. Two line ends close a record, so they are the text writer's line separator."""
    block = F.when(F.col("record_type") == "revisit", F.lit("")).otherwise(F.col("payload").cast("string"))
    records.select(F.concat("header", block).alias("value")).write.option("lineSep", END * 2).option("compression", codec).text(path)


def import_warc(spark: SparkSession, path: str, max_bytes: int = 1 << 30) -> DataFrame:
    """Records (header, block) of WARC files as export_warc writes them, uncompressed; a file above max_bytes is an error.

    A record ends where its Content-Length says, so payloads may hold anything.
    """
    files = spark.read.format("binaryFile").load(path).where(F.col("length") > 0)
    sound = F.when(F.col("length") <= max_bytes, F.col("content")).otherwise(F.raise_error(F.concat(F.lit("file too large: "), "path")))

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                at, found = 0, []
                while at < len(data):
                    head_end = data.index(b"\r\n\r\n", at) + 4
                    length = int(re.search(rb"\r\nContent-Length: (\d+)\r\n", data[at:head_end])[1])
                    block = data[head_end : head_end + length]
                    cut = block.index(b"\r\n\r\n") + 4
                    found.append((data[at:head_end] + block[:cut], block[cut:]))
                    at = head_end + length + 4
                yield pd.DataFrame(found, columns=["header", "block"])

    return files.select(sound.alias("content")).mapInPandas(records, "header binary, block binary")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages and rebuild every record from the archive: its fields, and the digest of header and payload together."""
    folder = new_folder(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), folder)
    record = F.sha2(F.concat(F.encode("header", "UTF-8"), F.col("payload")), 256).alias("record_sha256")
    return read_archive(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", record)
