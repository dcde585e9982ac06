"""Share of nulls in every metadata field, per collection or collection and instrument."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stocktake.functions.numbers import percent
from stocktake.functions.skew import owner_join, same_keys
from stocktake.plans.stages import stage

OBSERVATION, PLANE = "Observation", "Plane"
COLLECTION = ("collection",)
COLLECTION_INSTRUMENT = ("collection", "instrument_name")
_BITS = 62


def _fields_of(table: str, df: DataFrame) -> dict[str, str]:
    """``table.column`` as the source spells it -> the column here."""
    return {f"{table}.{f.metadata.get('source', f.name)}": f.name for f in df.schema}


def field_catalog(observation: DataFrame, plane: DataFrame) -> list[str]:
    """All fields as ``table.column`` in their source's spelling, in order; read from the schemas, not the data."""
    return sorted([*_fields_of(OBSERVATION, observation), *_fields_of(PLANE, plane)])


def field_names(columns: DataFrame, tables: Sequence[str] = (OBSERVATION, PLANE)) -> DataFrame:
    """The same from a service's own (table_name, column_name) list; order by it when writing."""
    return columns.where(F.col("table_name").isin(*tables)).select(
        F.concat_ws(".", "table_name", "column_name").alias("field_name")
    )


def field_range(fields: Sequence[str], start: str | None = None, end: str | None = None) -> list[str]:
    """The fields from ``start`` to ``end`` inclusive, found without regard to case; an unknown one is an error."""
    places = {f.lower(): k for k, f in enumerate(fields)}
    for field in (start, end):
        if field is not None and field.lower() not in places:
            raise ValueError(f"unknown field {field}")
    first = places[start.lower()] if start is not None else 0
    last = places[end.lower()] if end is not None else len(fields) - 1
    return list(fields[first : last + 1])


def _names_of(table: str, fields: Sequence[str]) -> list[str]:
    for field in fields:
        if not field.startswith((f"{OBSERVATION}.", f"{PLANE}.")):
            raise ValueError(f"unknown field {field}")
    return [f for f in fields if f.startswith(f"{table}.")]


def _columns_of(table: str, df: DataFrame, fields: Sequence[str]) -> dict[str, str]:
    """The fields of the table, with their columns."""
    known = _fields_of(table, df)
    missing = [f for f in _names_of(table, fields) if f not in known]
    if missing:
        raise ValueError(f"unknown field {missing[0]}")
    return {f: known[f] for f in _names_of(table, fields)}


def usable_instrument() -> Column:
    """Rows that count at all, at both granularities."""
    return F.col("instrument_name").isNotNull() & (F.col("instrument_name") != "NULL")


def obs_totals(observation: DataFrame, by: Sequence[str] = COLLECTION_INSTRUMENT) -> DataFrame:
    return observation.where(usable_instrument()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("num_instances")
    )


def plane_totals(
    observation: DataFrame, plane: DataFrame, by: Sequence[str] = COLLECTION_INSTRUMENT
) -> DataFrame:
    """Planes of usable observations; planes are counted per observation before the join."""
    owners = observation.where(usable_instrument()).select("obs_id", *by)
    per_observation = plane.groupBy("obs_id").agg(F.count(F.lit(1)).alias("n"))
    return per_observation.join(owners, "obs_id").groupBy(*by).agg(F.sum("n").alias("num_instances"))


def _long(counts: DataFrame, table: str, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per group and field from one wide row per group."""
    fields = F.array(*[
        F.struct(F.lit(field).alias("field"), F.col(f"_null_{i}").alias("num_null"))
        for i, field in enumerate(columns)
    ])
    return counts.select(F.lit(table).alias("table_name"), *by, "num_instances", F.inline(fields))


def _finish(long: DataFrame, by: Sequence[str]) -> DataFrame:
    return long.select(
        "table_name", "field", *by, "num_null", "num_instances",
        percent("num_null", "num_instances").alias("percentage_null"),
    )


def null_usage_obs(
    observation: DataFrame, fields: Sequence[str], by: Sequence[str] = COLLECTION_INSTRUMENT
) -> DataFrame:
    """Null counts of the Observation fields: one scan and one aggregate for all of them."""
    columns = _columns_of(OBSERVATION, observation, fields)
    usable = observation.where(usable_instrument())
    counts = usable.groupBy(*by).agg(
        F.count(F.lit(1)).alias("num_instances"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_null_{i}") for i, c in enumerate(columns.values())],
    )
    return _finish(_long(counts, OBSERVATION, columns, by), by) if columns else _no_usage(counts, by)


def null_usage_plane(
    observation: DataFrame,
    plane: DataFrame,
    fields: Sequence[str],
    by: Sequence[str] = COLLECTION_INSTRUMENT,
) -> DataFrame:
    """Null counts of the Plane fields, one scan and one join for all of them.

    Before the join each plane shrinks to one bit per field, and planes of one
    observation with the same bits to one row with their number. Wide planes do
    not travel through the shuffle, nor do all planes of a crowded observation.
    """
    columns = _columns_of(PLANE, plane, fields)
    names, words = list(columns.values()), []
    for start in range(0, len(names), _BITS):
        bits = [
            F.shiftleft(F.col(f"`{c}`").isNull().cast("long"), i)
            for i, c in enumerate(names[start : start + _BITS])
        ]
        words.append(reduce(Column.bitwiseOR, bits).alias(f"_word_{len(words)}"))
    owners = observation.where(usable_instrument()).select("obs_id", *by)
    bits = plane.select("obs_id", *words)
    masks = bits.groupBy(*bits.columns).agg(F.count(F.lit(1)).alias("_planes")).join(owners, "obs_id")
    zero = F.lit(0).cast("long")

    def is_null(i):
        return F.col(f"_word_{i // _BITS}").bitwiseAND(F.lit(1 << (i % _BITS))) != 0

    counts = masks.groupBy(*by).agg(
        F.sum("_planes").alias("num_instances"),
        *[
            F.sum(F.when(is_null(i), F.col("_planes")).otherwise(zero)).alias(f"_null_{i}")
            for i in range(len(columns))
        ],
    )
    return _finish(_long(counts, PLANE, columns, by), by) if columns else _no_usage(counts, by)


def _no_usage(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    empty = counts.where(F.lit(False)).select(
        F.lit("").alias("table_name"), F.lit("").alias("field"), *by,
        F.lit(0).cast("long").alias("num_null"), "num_instances",
    )
    return _finish(empty, by)


def null_usage(
    observation: DataFrame,
    plane: DataFrame,
    fields: Sequence[str],
    by: Sequence[str] = COLLECTION_INSTRUMENT,
) -> DataFrame:
    """Every field and group, also those without nulls; the base of all reports below."""
    return null_usage_obs(observation, fields, by).unionByName(
        null_usage_plane(observation, plane, fields, by)
    )


# --- counts from file footers ----------------------------------------------------------------

_FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def write_for_footers(observation: DataFrame, plane: DataFrame, path: str) -> None:
    """Store the rows that count as Parquet, by collection and instrument, planes by those of their observation.

    Every file then belongs to one group, and its footer knows the nulls of every column.
    """
    by = list(COLLECTION_INSTRUMENT)
    observation.where(usable_instrument()).write.partitionBy(*by).parquet(f"{path}/{OBSERVATION}")
    owners = observation.where(usable_instrument()).select("obs_id", *[F.col(c).alias(f"_{c}") for c in by])
    owned = owner_join(plane, owners, ["obs_id"]).select(*plane.columns, *[f"_{c}" for c in by])
    owned.write.partitionBy(*[f"_{c}" for c in by]).parquet(f"{path}/{PLANE}")


def counts_by_folder(stored: DataFrame) -> DataFrame:
    """Rows and non-null values of every column, for each value of the folders' columns."""
    own = [c for c in (f"_{c}" for c in COLLECTION_INSTRUMENT) if c in stored.columns]
    folders = own or list(COLLECTION_INSTRUMENT)
    columns = [c for c in stored.columns if c not in folders]
    return stored.groupBy(*folders).agg(
        F.count(F.lit(1)).alias("num_instances"), *[F.count(F.col(f"`{c}`")).alias(f"_known_{c}") for c in columns]
    ).withColumnsRenamed({c: c.removeprefix("_") for c in own})


@contextmanager
def footers_count(spark: SparkSession) -> Iterator[None]:
    """Counts of Parquet tables that are read and computed meanwhile come from the files' footers."""
    before = {key: spark.conf.get(key, None) for key in _FOOTERS}
    try:
        for key, value in _FOOTERS.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def footer_counts(spark: SparkSession, path: str) -> DataFrame:
    """``counts_by_folder`` of a stored table, without reading a column; a staged table of one row for each group."""
    with footers_count(spark):
        return stage(counts_by_folder(spark.read.parquet(path)), "footers")[0]


def null_usage_from_footers(
    observation: DataFrame, plane: DataFrame, path: str, fields: Sequence[str], by: Sequence[str] = COLLECTION_INSTRUMENT
) -> DataFrame:
    """``null_usage`` from what ``write_for_footers`` stored of these tables; only their schemas are used."""
    parts = []
    for table, df in ((OBSERVATION, observation), (PLANE, plane)):
        columns = _columns_of(table, df, fields)
        counts = footer_counts(df.sparkSession, f"{path}/{table}")
        # A folder's column is not in its files: it is null in all rows of a group or in none.
        known = lambda c: F.col(f"_known_{c}") if f"_known_{c}" in counts.columns else F.when(F.col(f"`{c}`").isNull(), 0).otherwise(F.col("num_instances"))
        summed = counts.withColumns({f"_null_{i}": F.col("num_instances") - known(c) for i, c in enumerate(columns.values())})
        summed = summed.groupBy(*by).agg(
            F.sum("num_instances").alias("num_instances"), *[F.sum(f"_null_{i}").alias(f"_null_{i}") for i in range(len(columns))]
        )
        parts.append(_finish(_long(summed, table, columns, by), by) if columns else _no_usage(summed, by))
    return parts[0].unionByName(parts[1])


def with_nulls(usage: DataFrame) -> DataFrame:
    """Rows as reported per field: only groups that have a null."""
    return usage.where("num_null > 0")


def null_usage_rollup(usage: DataFrame) -> DataFrame:
    """Both granularities from the collection-and-instrument result, without a second scan."""
    keys = ["table_name", "field", "collection"]
    sums = usage.groupingSets([[*keys, "instrument_name"], keys], *keys, "instrument_name").agg(
        F.when(F.grouping("instrument_name") == 1, "collection")
        .otherwise("collection_instrument").alias("granularity"),
        F.sum("num_null").alias("num_null"),
        F.sum("num_instances").alias("num_instances"),
    )
    return sums.select(
        "granularity", "table_name", "field", "collection", "instrument_name", "num_null",
        "num_instances", percent("num_null", "num_instances").alias("percentage_null"),
    )


def fields_by_group(
    usage: DataFrame, groups: DataFrame, by: Sequence[str] = COLLECTION_INSTRUMENT
) -> DataFrame:
    """The fields with nulls of each group in ``groups`` (from ``obs_totals``).

    A group without any nulls keeps one row with a null field.
    """
    known = groups.select(*by)
    found = with_nulls(usage).drop("table_name")
    joined = known.join(found, same_keys(known, found, by), "left")
    return joined.select(
        *[known[k] for k in by], "field", "num_null", "num_instances", "percentage_null"
    )


def usage_by_field(usage: DataFrame) -> DataFrame:
    """Per field: groups, groups with nulls, instances, null instances, and both shares."""
    sums = usage.groupBy("table_name", "field").agg(
        F.count(F.lit(1)).alias("num_groups"),
        F.count_if(F.col("num_null") > 0).alias("groups_with_null"),
        F.sum("num_instances").alias("num_instances"),
        F.sum("num_null").alias("instances_with_null"),
    )
    return sums.select(
        "field", "num_groups", "groups_with_null",
        percent("groups_with_null", "num_groups").alias("percentage_groups"),
        "num_instances", "instances_with_null",
        percent("instances_with_null", "num_instances").alias("percentage_instances"),
    )


def usage_by_group(
    usage: DataFrame,
    fields: Sequence[str],
    all_fields: Sequence[str],
    by: Sequence[str] = COLLECTION_INSTRUMENT,
    totals: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Per table and group: fields, fields with nulls, field instances, null instances, shares.

    ``usage`` has a row for every group and each of ``fields``, so it knows the groups
    and their sizes. A table with none of ``fields`` takes them from ``totals`` and has
    its rows too, without nulls.
    """
    zero = F.lit(0).cast("long")

    def num_fields(table: str) -> Column:
        return F.lit(len(_names_of(table, all_fields))).cast("long")

    rows = usage.groupBy("table_name", *by).agg(
        F.max("num_instances").alias("group_size"),
        F.count_if(F.col("num_null") > 0).alias("fields_with_null"),
        F.sum("num_null").alias("instances_with_null"),
    ).withColumn("num_fields", F.when(F.col("table_name") == OBSERVATION, num_fields(OBSERVATION)).otherwise(num_fields(PLANE)))
    for table, sizes in (totals or {}).items():
        if not _names_of(table, fields):
            rows = rows.unionByName(sizes.select(
                F.lit(table).alias("table_name"), *by, F.col("num_instances").alias("group_size"),
                num_fields(table).alias("num_fields"), zero.alias("fields_with_null"), zero.alias("instances_with_null"),
            ))
    return rows.withColumn("num_instances", F.col("group_size") * F.col("num_fields")).select(
        "table_name", *by, "num_fields", "fields_with_null",
        percent("fields_with_null", "num_fields").alias("percentage_fields"),
        "num_instances", "instances_with_null",
        percent("instances_with_null", "num_instances").alias("percentage_instances"),
    )
