"""Extendible hashing: shards are hash prefixes, and only those above the byte limit split on another bit.

A document's hash is 60 bits of the MD5 of its id and text. The directory starts from the histogram of a prefix that is fine
for the average; a prefix still too large is split bit by bit, and prefixes that fit are merged upwards while their
parent fits: what remains is the shallowest prefix of each document whose bytes fit. The directory is made from rows (hash, bytes); then
the documents move once, all of a shard's part to one task, which writes them to a folder of their own. Shards are read back, measured
and checked against the limit; their sizes are those of the stored texts.

Defined results: null and empty texts have 0 bytes and still get a shard; a document larger than the limit ends up alone
and is marked oversized; rows that all bits leave together (repeated rows) are dealt into overflow parts in turn, as
many to a part as fit; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktake.llm.common import buckets_for, new_folder, staged, table

#: Bytes of text in a shard at most.
LIMIT = 16 << 20
BITS = 60
#: Bits counted beyond those that the average needs, and bits added where that is too coarse.
SPARE, STEP = 6, 6
#: Cells of the directory, a few for each shard, that are sent to all tasks at most; more are joined.
BROADCAST_ROWS = 100_000


def shard_key(doc_id: Column, text: Column) -> Column:
    joined = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(joined), 1, BITS // 4), 16, 10).cast("long")


def _prefix(key: Column, depth: Column | int) -> Column:
    """The first bits of the key; the depth may be a column."""
    depth = depth if isinstance(depth, Column) else F.lit(depth)
    return F.call_function("shiftright", key, (F.lit(BITS) - depth).cast("int"))


def directory(keyed: DataFrame, limit: int) -> DataFrame:
    """keyed (key, n_bytes) -> (prefix, depth, shard_bytes): the leaves.

    The histogram has a few cells for each shard, so it is small against the rows; every level of it is an aggregate of the one
    below, all in one pass over its cells.
    """
    total = keyed.agg(F.sum("n_bytes")).first()[0] or 0
    depth = min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + SPARE)
    cells = staged(keyed.groupBy(_prefix(F.col("key"), depth).alias("cell")).agg(F.sum("n_bytes").alias("cell_bytes"), F.count("*").alias("n")).withColumn("bits", F.lit(depth)), "shard-cells")
    done = cells
    while depth < BITS:
        large = cells.where((F.col("cell_bytes") > limit) & (F.col("n") > 1)).select(F.col("cell").alias("large"))
        if large.isEmpty():
            break
        below = min(BITS, depth + STEP)
        # Only rows of cells that do not fit are counted again.
        inside = keyed.withColumn("large", _prefix(F.col("key"), depth)).join(large, "large", "left_semi")
        finer = staged(inside.groupBy(_prefix(F.col("key"), below).alias("cell")).agg(F.sum("n_bytes").alias("cell_bytes"), F.count("*").alias("n")).withColumn("bits", F.lit(below)), "shard-cells")
        done = done.join(large, (F.col("cell") == F.col("large")) & (F.col("bits") == depth), "left_anti").unionByName(finer)
        cells, depth = finer, below
    # Each cell counts towards all prefixes above it; a leaf is the shallowest prefix that fits.
    at = F.explode(F.sequence(F.lit(0), F.col("bits"))).alias("depth")
    levels = done.select("cell", "cell_bytes", "n", "bits", at).select(
        F.call_function("shiftright", F.col("cell"), F.col("bits") - F.col("depth")).alias("prefix"), "depth", "cell_bytes", "n", "cell", "bits"
    )
    nodes = levels.groupBy("prefix", "depth").agg(F.sum("cell_bytes").alias("shard_bytes"), F.sum("n").alias("n"), F.max("bits").alias("bits"))
    fits = nodes.where((F.col("shard_bytes") <= limit) | (F.col("depth") == F.col("bits")))
    leaf = levels.join(fits.select("prefix", "depth", "shard_bytes"), ["prefix", "depth"]).groupBy("cell", "bits").agg(
        F.min(F.struct("depth", "prefix", "shard_bytes")).alias("leaf")
    )
    return leaf.select("cell", "bits", "leaf.depth", "leaf.prefix", "leaf.shard_bytes")


def _located(keyed: DataFrame, leaves: DataFrame) -> DataFrame:
    """keyed with depth, prefix and shard_bytes of its leaf."""
    depths = [r[0] for r in leaves.select("bits").distinct().limit(BITS + 1).collect()]
    # A cell is found at each of the few depths that the histogram has; the join keys are equalities.
    found = keyed.withColumn("bits", F.explode(F.array(*[F.lit(d) for d in depths] or [F.lit(0)])))
    return found.withColumn("cell", _prefix(F.col("key"), F.col("bits"))).join(leaves, ["cell", "bits"]).drop("cell", "bits")


def write_shards(docs: DataFrame, folder: str, limit: int = LIMIT, broadcast_rows: int = BROADCAST_ROWS) -> None:
    """Write the documents (row, with all their columns) into a folder for each shard and part: shard=b<prefix bits>/part=<number>.

    part numbers the overflow of a shard that no bit splits.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), shard_key(F.col("doc_id"), F.col("text")).alias("key"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
    )
    light = staged(keyed.select("key", "n_bytes"), "shard-keys")
    leaves = staged(directory(light, limit), "shard-leaves")
    if leaves.count() <= broadcast_rows:
        found = _located(keyed, F.broadcast(leaves))
    else:
        found = keyed.join(_located(light.select("key").distinct(), leaves), "key")
    name = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.lpad(F.bin("prefix"), F.col("depth"), F.lit("0")))
    found = found.withColumn("shard", F.concat(F.lit("b"), name))
    out = found.where(F.col("shard_bytes") <= limit).select("row", "shard", F.lit(0).cast("long").alias("part"))
    if not leaves.where(F.col("shard_bytes") > limit).isEmpty():
        # Beyond all bits only equal rows are left (or one row): a part takes as many as fit, at least one. Rows equal in all columns
        # are counted first.
        over = found.where(F.col("shard_bytes") > limit).groupBy("row", "key", "n_bytes", "shard").agg(F.count("*").alias("n"))
        before = F.sum("n").over(Window.partitionBy("key").orderBy("row").rowsBetween(Window.unboundedPreceding, -1))
        each = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("n_bytes"))).cast("long")
        dealt = over.withColumn("before", F.coalesce(before, F.lit(0))).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
        out = out.unionByName(dealt.select("row", "shard", F.floor((F.col("before") + F.col("i")) / each).cast("long").alias("part")))
    total = light.agg(F.sum("n_bytes")).first()[0] or 0
    out.repartition(buckets_for(spark, total), "shard", "part").write.partitionBy("shard", "part").parquet(folder)


def read_shards(spark: SparkSession, folder: str, row: T.StructType) -> DataFrame:
    """The documents of all shards: row, shard as a string of bits, part."""
    kinds = T.StructType([T.StructField("row", row), T.StructField("shard", T.StringType()), T.StructField("part", T.LongType())])
    return spark.read.schema(kinds).parquet(folder).withColumn("shard", F.expr("substring(shard, 2)"))


def shards(docs: DataFrame, limit: int = LIMIT, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, n_bytes, depth, shard, part, shard_bytes, oversized), one row for each row of docs, from the written shards.

    shard is the prefix as a string of bits; part numbers the overflow of a shard that no bit splits. shard_bytes counts a
    shard's part. More than one document in a part above the limit is an error.
    """
    folder = new_folder(docs.sparkSession, "shards")
    write_shards(docs, folder, limit, broadcast_rows)
    stored = read_shards(docs.sparkSession, folder, docs.schema).select(
        F.col("row.doc_id").alias("doc_id"), F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("long").alias("n_bytes"), "shard", "part"
    )
    stored = staged(stored, "shard-rows")
    parts = stored.groupBy("shard", "part").agg(F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("n"))
    fits = (F.col("shard_bytes") <= limit) | (F.col("n") == 1)
    checked = F.when(fits, F.col("shard_bytes")).otherwise(F.raise_error(F.concat(F.lit("shard above the limit: "), "shard")).cast("long"))
    return stored.join(parts.select("shard", "part", checked.alias("shard_bytes")), ["shard", "part"]).select(
        "doc_id", "n_bytes", F.length("shard").alias("depth"), "shard", "part", "shard_bytes", (F.col("shard_bytes") > limit).alias("oversized")
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents into shards and say where each is."""
    return shards(table(spark, sf_dir, "documents"))


OP5_SQL = f"""
WITH keyed AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, {BITS // 4}) AS BIGINT) AS key
  FROM documents
), levels AS (
  SELECT k.*, CAST(d.depth AS INTEGER) AS depth, key >> (60 - d.depth) AS prefix FROM keyed k, (SELECT unnest(range(0, {BITS + 1})) AS depth) d
), nodes AS (
  SELECT depth, prefix, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes FROM levels GROUP BY depth, prefix
), leaves AS (
  SELECT l.doc_id, l.n_bytes, l.depth, l.prefix, n.shard_bytes,
    row_number() OVER (PARTITION BY l.doc_id, l.key ORDER BY l.depth) AS r
  FROM levels l JOIN nodes n ON l.depth = n.depth AND l.prefix = n.prefix WHERE n.shard_bytes <= {LIMIT}
)
SELECT doc_id, n_bytes, depth, CASE WHEN depth = 0 THEN '' ELSE right(repeat('0', 60) || bin(prefix), depth) END AS shard,
  CAST(0 AS BIGINT) AS part, shard_bytes, false AS oversized
FROM leaves WHERE r = 1
"""
