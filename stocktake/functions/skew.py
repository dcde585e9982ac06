"""Give every row its group's values when few groups hold most rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stocktake.plans.session import shuffles_removed

# Groups sent to all executors. A group outside the largest N holds under 1/N of the rows.
LARGEST_GROUPS = 1000


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on all keys."""
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def attach_group_values(
    rows: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    size: str,
    largest: int = LARGEST_GROUPS,
) -> DataFrame:
    """Inner join of ``rows`` with ``groups`` (one row per key) that no hot key can stall.

    ``groups[size]`` is the number of rows in the group. Rows are read once: they
    meet the ``largest`` groups, a fixed number, which are broadcast. Then all take
    one shuffle join; rows that have their values already travel under a salted key,
    the others under one that no more than 1/``largest`` of all rows share.
    """
    values = [c for c in groups.columns if c not in keys and c != size]
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Ties are broken by the keys, so that the same groups are found in a rerun.
    head = groups.orderBy(F.desc(size), *[F.col(c).asc_nulls_first() for c in (*keys, *values)])
    head = head.limit(largest).select(
        *[F.col(k).alias(f"_head_{k}") for k in keys],
        F.struct(F.lit(True).alias("known"), *values).alias("_head"),
    )
    own = F.broadcast(head)
    found = rows.join(own, reduce(lambda a, b: a & b, (rows[k].eqNullSafe(own[f"_head_{k}"]) for k in keys)), "left")
    salt = F.pmod(F.xxhash64(*[rows[c] for c in rows.columns]), F.lit(spread)) + 1
    found = found.withColumn("_salt", F.when(F.col("_head.known"), salt).otherwise(F.lit(0).cast("long")))
    group = groups.select(
        *[F.col(k).alias(f"_group_{k}") for k in keys], F.lit(0).cast("long").alias("_zero"),
        F.struct(F.lit(True).alias("known"), *values).alias("_group"),
    )
    same = reduce(lambda a, b: a & b, (rows[k].eqNullSafe(group[f"_group_{k}"]) for k in keys))
    joined = found.join(group, same & (F.col("_salt") == F.col("_zero")), "left")
    held = F.coalesce("_head", "_group")
    return joined.withColumn("_held", held).where("_held.known").select(
        *[rows[c] for c in rows.columns], *[F.col(f"_held.`{c}`").alias(c) for c in values]
    )


# Limits of what is broadcast; beyond either a table is joined by a shuffle, with the same result.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
# What is made from files of more bytes than this is not broadcast on Spark's estimate, which goes by compressed columns and takes
# exploded rows for one: a table of 5 MB can be a broadcast of 155 MB, its copies one of 2 GB.
ESTIMATED_BYTES = 1 << 20
# Parts that a key is spread over at least; as many as the session has shuffle partitions if that is more.
SPREAD = 64


def measured(table: DataFrame, rows: int = BROADCAST_ROWS) -> tuple[int, int]:
    """Rows of a table, counted up to one more than ``rows``, and the bytes of their values as text."""
    text = F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in table.columns])
    with shuffles_removed(table.sparkSession):
        size = table.select(F.octet_length(text).alias("size")).limit(rows + 1).agg(
            F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")
        ).first()
    return size["rows"], size["bytes"] or 0


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    spread_by: Sequence[str] = (),
    broadcast_rows: int = BROADCAST_ROWS,
    small: bool | None = None,
) -> DataFrame:
    """Join many ``rows`` with a configuration table whose keys may each match a large share of them.

    The table is measured first, unless the caller already did and tells whether it
    is ``small``. If so it is broadcast. Otherwise it is an ``owner_join``: only heavy keys are
    spread over parts, by a hash of the row, and only they are copied.
    """
    on = list(on)
    if small is None:
        count, size = measured(table, broadcast_rows)
        small = count <= broadcast_rows and size <= BROADCAST_BYTES
    if small:
        return rows.join(F.broadcast(table), on, how)
    return owner_join(rows, table.hint("merge"), on, how, spread_by=spread_by)


# Rows made from less than this meet their owners by a plain join; the largest group is then no burden for one task.
PROBE_BYTES = 1 << 30
# Keys that a sketch of the rows' keys keeps track of.
TRACKED_KEYS = 10_000
# Rows made from more than this are staged between two joins: the first one's shuffle files go before the second one's are written,
# and a sketch of keys reads a table instead of running all that the rows are made of once more.
STAGED_BYTES = 64 << 20
SALT = "_salt"


def source_bytes(df: DataFrame) -> int:
    """Bytes of the tables that a result is made from, as Spark knows them before it reads them."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))


def apart(table: DataFrame) -> DataFrame:
    """The table, to be joined by a shuffle unless the files it is made from are few and small."""
    return table.hint("merge") if source_bytes(table) > ESTIMATED_BYTES else table


def heavy_keys(rows: DataFrame, on: Sequence[str], parts: int, largest: int = LARGEST_GROUPS) -> list[int]:
    """Hashes of keys that hold about ``1 / parts`` of all rows or more, at most ``largest``, by one pass with a sketch.

    The sketch is a fixed number of counters for each task. A count may be off by a small
    share of the rows; a key more or less changes where rows go, not what comes out.
    """
    known = reduce(lambda a, b: a & b, (F.col(f"`{c}`").isNotNull() for c in on))
    key = F.xxhash64(*[F.col(f"`{c}`") for c in on])
    with shuffles_removed(rows.sparkSession):
        found = rows.where(known).select(key.alias("key")).agg(
            F.expr(f"approx_top_k(key, {largest}, {TRACKED_KEYS})").alias("top"), F.count(F.lit(1)).alias("rows")
        ).first()
    return sorted(k["item"] for k in found["top"] or [] if k["count"] * parts >= found["rows"])


def owner_join(
    rows: DataFrame, owners: DataFrame, on: Sequence[str], how: str = "inner",
    probe: DataFrame | None = None, probe_bytes: int | None = None, parts: int | None = None, spread_by: Sequence[str] = (),
    dealt: int = 0,
) -> DataFrame:
    """Join rows with the few ``owners`` of each key, where one key may hold a large share of the rows.

    ``how`` is inner, left or left_semi. The heavy keys are found first, in ``probe`` if that has
    the same keys and costs less than ``rows``; only their rows travel
    under salted keys (a hash of ``spread_by``, all of the row by default), and only their owners are copied, once
    for each of ``parts`` salts. With ``dealt`` the rows lie in that many partitions, which are not merged, and the result
    keeps the column of the salts (``SALT``) if there are any.
    """
    on, owners = list(on), apart(owners)
    deal = (lambda df, *by: df.repartition(dealt, *by)) if dealt else (lambda df, *by: df)
    if source_bytes(rows) < (PROBE_BYTES if probe_bytes is None else probe_bytes):
        return deal(rows, *on).join(owners, on, how)
    parts = parts or max(SPREAD, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    heavy = heavy_keys(rows if probe is None else probe, on, parts)
    if not heavy:
        return deal(rows, *on).join(owners, on, how)
    is_heavy = F.xxhash64(*[F.col(f"`{c}`") for c in on]).isin(heavy)
    own = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in spread_by or rows.columns]), F.lit(parts)).cast("int")
    spread = rows.withColumn(SALT, F.when(is_heavy, own).otherwise(0))
    salts = F.when(is_heavy, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    copies = apart(owners.withColumn(SALT, F.explode(salts)))
    joined = deal(spread, *on, SALT).join(copies, [*on, SALT], how)
    return joined if dealt else joined.drop(SALT)
