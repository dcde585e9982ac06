"""Listings stored for repeated audits: one row for each key, bucketed by key and sorted.

Two listings stored with the same keys and number of buckets are reconciled without a shuffle, because rows of one key lie in
buckets of one number. A day's changes are merged into a stored listing by shuffling the changes alone.

A listing is a folder: ``data`` holds a file for each bucket, ``layout`` one row that says how they were written, so
that another session finds them without a metastore.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from stocktake.functions.dedupe import dedupe_first, newest_first

LAYOUT = "keys array<string>, buckets int, schema string"
SHUFFLE = "spark.sql.shuffle.partitions"


@contextmanager
def _partitions(spark: SparkSession, number: int) -> Iterator[None]:
    before = spark.conf.get(SHUFFLE)
    spark.conf.set(SHUFFLE, number)
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE, before)


def write_listing(
    listing: DataFrame, path: str, keys: Sequence[str], buckets: int | None = None,
    order: Sequence[Column] | None = None, unique: bool = False,
) -> None:
    """Store the first row of each key under ``order`` (the newest by default).

    Copies are dropped before the shuffle that makes the buckets, which is the only
    one. ``unique`` says that each key has one row already. The folder must not exist.
    """
    spark, keys = listing.sparkSession, list(keys)
    buckets = buckets or int(spark.conf.get(SHUFFLE))
    with _partitions(spark, buckets):
        if unique:
            rows = listing.repartition(buckets, *keys)
        else:
            rows = dedupe_first(listing, keys, order or newest_first())
        name = _name(path)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        rows.write.format("parquet").mode("error").bucketBy(buckets, *keys).sortBy(*keys).option(
            "path", f"{path}/data"
        ).saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")
    layout = spark.createDataFrame([(keys, buckets, listing.schema.json())], LAYOUT)
    layout.coalesce(1).write.json(f"{path}/layout")


def _name(path: str) -> str:
    return f"stocktake_listing_{hashlib.md5(path.encode()).hexdigest()}"


def _layout(spark: SparkSession, path: str) -> tuple[list[str], int, StructType]:
    row = spark.read.schema(LAYOUT).json(f"{path}/layout").first()
    return row["keys"], row["buckets"], StructType.fromJson(json.loads(row["schema"]))


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """A stored listing; Spark knows its buckets."""
    keys, buckets, schema = _layout(spark, path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    spark.sql(
        f"CREATE TABLE {_name(path)} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
        f"INTO {buckets} BUCKETS LOCATION '{path}/data'"
    )
    return spark.table(_name(path))


def with_changes(
    stored: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None,
    deleted: str | None = None,
) -> DataFrame:
    """A stored listing after a batch of changed rows: for each key the first of the stored row and the changes under ``order``.

    ``deleted`` names a boolean column of the changes; a key whose first row is marked is left out. Stored rows without
    a change stay where they are; only the others and the changes are shuffled. A null key is one that nothing changes.
    """
    keys, columns = list(keys), stored.columns
    marked = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    changes = changes.select(*columns, marked.alias("_deleted"))
    touched = changes.select(*keys).distinct()
    old = stored.join(touched, keys, "left_semi").withColumn("_deleted", F.lit(False))
    new = dedupe_first(old.unionByName(changes), keys, order or newest_first()).where("NOT _deleted").select(*columns)
    return stored.join(touched, keys, "left_anti").select(*columns).unionByName(new)
