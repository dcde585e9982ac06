"""What the operators share: the shared folder, staged tables, words."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: Rows that a Python worker gets at once: texts are long, and numpy needs a few times their bytes.
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000
#: Bytes that one task may gather of packed records.
BUCKET_BYTES = 64 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. A local session without it gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def buckets_for(spark: SparkSession, n_bytes: float) -> int:
    """How many buckets what a task gathers in memory is dealt to: those of the session, more if one would exceed BUCKET_BYTES."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_bytes / BUCKET_BYTES))


def bounded_batches(spark: SparkSession) -> None:
    """Hold the session's Arrow batches at BATCH_ROWS rows or fewer; for results that are not staged here but written by others."""
    now = int(spark.conf.get(BATCH_SETTING))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def staged(df: DataFrame, name: str) -> DataFrame:
    """df, written once to the shared folder and read back: lineage ends there and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    bounded_batches(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, nothing else."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def word_list(text: Column) -> Column:
    """Words of the text; null counts as empty."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.transform(F.array(value), body)[0]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until df has no such column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out
