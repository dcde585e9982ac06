"""Tables between two steps of an audit, in the folder all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from stocktake.functions import skew
from stocktake.plans.session import ensure_checkpoint_dir, shuffles_removed

#: The folder of stage tables inside ``passing``.
_FOLDER: ContextVar[str | None] = ContextVar("_FOLDER", default=None)


def _place(spark: SparkSession, name: str) -> str:
    return f"{_FOLDER.get() or ensure_checkpoint_dir(spark)}/stocktake-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written once and read back, and where; a lost executor costs none of it, and its shuffle files go."""
    spark = df.sparkSession
    path = _place(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stage_large(df: DataFrame, name: str) -> tuple[DataFrame, str | None]:
    """``df`` staged, and where, if it is made from large files; else ``df`` itself."""
    return stage(df, name) if skew.source_bytes(df) >= skew.STAGED_BYTES else (df, None)


def drop(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def kept(df: DataFrame, name: str = "table"):
    """``df`` as a stage table while several outputs are written from it; it goes afterwards."""
    table, path = stage(df, name)
    try:
        yield table
    finally:
        drop(df.sparkSession, path)


@contextmanager
def passing(spark: SparkSession):
    """Tables staged inside go at the end."""
    path = _place(spark, "passing")
    before = _FOLDER.set(path)
    try:
        yield
    finally:
        _FOLDER.reset(before)
        drop(spark, path)


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The frame that ``make`` returns, written and read back; tables staged for it go, as do its shuffle files."""
    path = _place(spark, name)
    with passing(spark):
        df = make()
        with shuffles_removed(spark):
            df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
