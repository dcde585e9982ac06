"""Read archive tables, configuration files and file listings."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Mapping, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from stocktake import model as m

CONFIG_FILES = {
    "mappings": (m.MAPPINGS, "\t"),
    "collections": (m.COLLECTIONS, "\t"),
    "sites": (m.AMS_SITES, "\t"),
    "namespaces": (m.NAMESPACES, ","),
    "si_sites": (m.SI_SITES, ","),
}


def conform(
    df: DataFrame, schema: StructType, names: Mapping[str, str] | None = None, extra: bool = False
) -> DataFrame:
    """Rename and cast to ``schema``; a bad value fails when run.

    Source names are matched without regard to case; two columns for one name are an
    error. ``extra`` keeps the columns the schema does not name, under their own
    names, for the null-usage audit. Every column remembers what its source calls it.
    """
    names = m.names_for(schema) if names is None else names
    aliases = {old.lower(): new for old, new in names.items()}
    found: dict[str, list[str]] = {}
    for column in df.columns:
        found.setdefault(aliases.get(column.lower(), column.lower()), []).append(column)
    clashes = [", ".join(columns) for columns in found.values() if len(columns) > 1]
    if clashes:
        raise ValueError(f"columns of one meaning: {'; '.join(clashes)}")
    missing = [f.name for f in schema if f.name not in found]
    if missing:
        raise ValueError(f"columns not found: {', '.join(missing)}")
    wanted = [
        F.col(f"`{found[f.name][0]}`").cast(f.dataType).alias(f.name, metadata={"source": found[f.name][0]})
        for f in schema
    ]
    if extra:
        others = [columns[0] for name, columns in found.items() if name not in schema.names]
        wanted += [F.col(f"`{old}`").alias(old, metadata={"source": old}) for old in others]
    return df.select(*wanted)


def read_table(
    spark: SparkSession,
    location: str,
    schema: StructType,
    format: str = "parquet",
    names: Mapping[str, str] | None = None,
    extra: bool = False,
    **options: str,
) -> DataFrame:
    """A table from files or, with ``format='table'``, from the catalog.

    Text formats are read as strings and cast, never inferred.
    """
    if format == "table":
        return conform(spark.table(location), schema, names, extra)
    if format in ("csv", "tsv"):
        separator = "\t" if format == "tsv" else ","
        reader = spark.read.options(header=True, sep=separator, inferSchema=False)
        return conform(reader.options(**options).csv(location), schema, names, extra)
    return conform(spark.read.format(format).options(**options).load(location), schema, names, extra)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    schema: StructType,
    partition_column: str,
    lower: str,
    upper: str,
    partitions: int,
    names: Mapping[str, str] | None = None,
    **options: str,
) -> DataFrame:
    """A database table, read in parallel ranges of ``partition_column``; filters are pushed down."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=partition_column, lowerBound=lower,
        upperBound=upper, numPartitions=str(partitions), **options,
    )
    return conform(reader.load(), schema, names)


def read_sites(
    spark: SparkSession, locations: Mapping[str, str], schema: StructType, format: str = "parquet"
) -> DataFrame:
    """The same table from several sites in one DataFrame, with the ``site`` each row is from."""
    if not locations:
        raise ValueError("no site given")
    columns = StructType([f for f in schema if f.name != "site"])
    parts = [
        read_table(spark, place, columns, format).withColumn("site", F.lit(site))
        for site, place in locations.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def read_config(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A configuration file: mappings, collections and sites are TSV, the others CSV."""
    schema, separator = CONFIG_FILES[name]
    return read_table(spark, path, schema, "tsv" if separator == "\t" else "csv")


#: Files up to this size are read for their checksum; a larger one has none.
CHECKSUM_BYTES = 256 << 20


#: Bytes of a large file that one row stands for while its digest is computed, and bytes read at once.
CHUNK_BYTES, READ_BYTES = 64 << 20, 1 << 20


def tree_digests(files: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(path, digest) of files given by (path, length): the MD5 of the MD5s of their chunks, in order.

    Each chunk is a row of its own, so one file is read by many tasks, a piece of READ_BYTES at a time. Two files have
    one digest, for one ``chunk_bytes``, if their contents are equal.
    """
    count = F.floor((F.col("length") + (chunk_bytes - 1)) / chunk_bytes).cast("long")
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(count - 1, F.lit(0)))).alias("no"))

    # Inner functions travel with the task, so executors need no copy of this package.
    def opened(path):
        if path.startswith("file:"):
            path = "/" + path.removeprefix("file:").lstrip("/")
        if "://" not in path:
            return fs.LocalFileSystem().open_input_file(path)
        system, place = fs.FileSystem.from_uri(quote(path, safe=":/"))
        return system.open_input_file(place)

    def digest(batches):
        for batch in batches:
            out = []
            for path, length, no in zip(*(batch.column(c).to_pylist() for c in ("path", "length", "no"))):
                found, at, end = hashlib.md5(), no * chunk_bytes, min(length, (no + 1) * chunk_bytes)
                with opened(path) as file:
                    file.seek(at)
                    while at < end:
                        data = file.read(min(READ_BYTES, end - at))
                        if not data:
                            raise OSError(f"{path} became shorter while it was read")
                        found.update(data)
                        at += len(data)
                out.append(found.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("no"), pa.array(out, pa.string())], names=["path", "no", "part"])

    # Ranges are few bytes, so adaptive execution would put all of them into one task unless told how many there are.
    tasks = max(1, math.ceil(ranges.count() / 8))
    parts = ranges.repartition(tasks, "path", "no").mapInArrow(digest, "path string, no long, part string")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("no", "part"))), lambda p: p["part"])
    return parts.groupBy("path").agg(F.md5(F.concat_ws("", ordered)).alias("digest"))


def _root(spark: SparkSession, path: str) -> str:
    """The path as Spark lists files below it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.makeQualified(place).toString().rstrip("/")


def read_manifest(
    spark: SparkSession, path: str, checksum: bool = False, checksum_bytes: int = CHECKSUM_BYTES,
    chunk_bytes: int | None = None,
) -> DataFrame:
    """Files below ``path`` as (dir, name, modified, owner, length, checksum).

    ``dir`` is relative to ``path``, empty for files right below it. Contents are read
    only if the checksum is asked for. A file up to ``checksum_bytes`` is one row; larger ones
    have a digest of their chunks, marked with the chunks' size, if ``chunk_bytes`` is given, else none. ``owner`` is null; file
    systems do not tell Spark.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    inner = F.substring("path", len(_root(spark, path)) + 2, 1 << 20)
    name = F.substring_index(inner, "/", -1)

    def listed(rows: DataFrame, digest) -> DataFrame:
        return rows.select(
            F.rtrim(F.expr("left(_inner, length(_inner) - length(_name))"), F.lit("/")).alias("dir"),
            F.col("_name").alias("name"),
            F.col("modificationTime").cast("timestamp_ntz").alias("modified"),
            F.lit(None).cast("string").alias("owner"), "length", digest.alias("checksum"),
        )

    files = files.withColumns({"_inner": inner, "_name": name})
    nothing = F.lit(None).cast("string")
    if not checksum:
        return listed(files, nothing)
    small = listed(files.where(F.col("length") <= checksum_bytes), F.md5("content"))
    large = files.where(F.col("length") > checksum_bytes)
    if chunk_bytes is None:
        return small.unionByName(listed(large, nothing))
    of = tree_digests(large.select("path", "length"), chunk_bytes).withColumnRenamed("path", "_of")
    found = large.join(of, F.col("path") == F.col("_of"), "left")
    return small.unionByName(listed(found, F.concat(F.lit(f"chunks-{chunk_bytes}:"), "digest")))


def _written(spark: SparkSession, path: str, format: str) -> DataFrame:
    """A table that ``sinks`` wrote."""
    if format in ("csv", "tsv"):
        return spark.read.options(header=True, sep="\t" if format == "tsv" else ",").csv(path)
    return spark.read.format(format).load(path)


def read_site_counts(spark: SparkSession, path: str, format: str = "tsv") -> DataFrame:
    """Counts that earlier runs wrote, one folder for all namespaces and sites; durations are optional."""
    counts = _written(spark, path, format)
    wanted = [f for f in m.SITE_COUNTS if f.name != "duration" or "duration" in counts.columns]
    return conform(counts, StructType(wanted))


def read_summaries(spark: SparkSession, paths: Sequence[str], format: str = "tsv") -> list[DataFrame]:
    """The summary of every report, as it was written."""
    return [_written(spark, path, format) for path in paths]
