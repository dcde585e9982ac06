"""Match URIs to the namespaces they live under.

A URI is under a namespace when it starts with ``namespace + '/'``, taken
literally: ``_`` and ``%`` in a namespace are not wildcards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stocktake.functions.longest import first_elements, prefix_index
from stocktake.functions.skew import BROADCAST_BYTES, BROADCAST_ROWS, SALT, apart, lookup_join, measured, owner_join, source_bytes
from stocktake.plans.session import shuffles_removed


def under(uri, namespace: str) -> Column:
    """Filter for one fixed namespace; pushed down to Parquet."""
    return (F.col(uri) if isinstance(uri, str) else uri).startswith(namespace + "/")


def _slashes(uri: Column) -> Column:
    return F.length(uri) - F.length(F.translate(uri, "/", ""))


def path_prefixes(uri, depths: Sequence[int] | None = None) -> Column:
    """Every leading path of ``uri`` that ends just before a slash.

    ``depths`` limits them to prefixes of 1, 2, ... path elements. The
    expression then stays inside generated code, without a lambda.
    """
    uri = F.col(uri) if isinstance(uri, str) else uri
    slashes = _slashes(uri)
    if depths is None:
        every = F.sequence(F.lit(1), slashes)
        wanted = F.when(slashes > 0, every).otherwise(F.array().cast("array<int>"))
        return F.transform(wanted, lambda d: F.call_function("substring_index", uri, F.lit("/"), d))
    return F.array(*[F.when(slashes >= d, F.substring_index(uri, "/", d)) for d in depths])


# With more distinct depths than this, a URI is looked up instead of forming its prefixes.
MOST_DEPTHS = 16


def match_namespaces(
    df: DataFrame,
    namespaces: DataFrame,
    uri: str = "uri",
    namespace: str = "namespace",
    also_on: Sequence[str] = (),
    depths: Sequence[int] | None = None,
) -> DataFrame:
    """Rows of ``df`` with the columns of every namespace they live under.

    An equi-join on the URI's own path prefixes instead of a ``startswith``
    nested loop; overlapping namespaces give one row per match. The namespaces
    are measured first, unless the caller has their ``few_depths``. Few of them, of few depths, are broadcast and every URI forms its prefixes of
    these depths. Otherwise every URI is looked up in an index for the longest namespace it is under, stays one row until
    then, and meets the others through that one.
    """
    depths = few_depths(namespaces, namespace) if depths is None else depths
    if depths is None:
        return match_namespaces_indexed(df, namespaces, uri, namespace, also_on)
    prefixes = path_prefixes(uri, depths) if depths else F.array().cast("array<string>")
    candidates = df.withColumn(namespace, F.explode(prefixes)).where(F.col(namespace).isNotNull())
    return lookup_join(candidates, namespaces, [namespace, *also_on], spread_by=[uri], small=True)


def few_depths(namespaces: DataFrame, namespace: str = "namespace") -> list[int] | None:
    """Depths of namespaces that can be broadcast and have few of them, else nothing."""
    name = F.col(namespace)
    size = F.octet_length(F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in namespaces.columns]))
    with shuffles_removed(namespaces.sparkSession):
        found = namespaces.select(name, size.alias("size")).limit(BROADCAST_ROWS + 1).agg(
            F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), F.collect_set(_slashes(name) + 1).alias("depths")
        ).first()
    small = found["rows"] <= BROADCAST_ROWS and (found["bytes"] or 0) <= BROADCAST_BYTES
    return sorted(found["depths"]) if small and len(found["depths"]) <= MOST_DEPTHS else None


# With more depths than this that cannot be broadcast, URIs are looked up in an index, a shuffle for each halving of the depths.
SHUFFLED_DEPTHS = 2
# Bytes of files for each partition that rows are dealt over, so that a task holds as much however large the tables are.
DEALT_BYTES = 8 << 20
MOST_PARTS = 10_000
#: Where rows of ``match_namespaces_by_depth`` lie together, each following from the URI and ``also_on``.
PLACE = "_place"


def match_namespaces_by_depth(
    df: DataFrame, namespaces: DataFrame, uri: str = "uri", namespace: str = "namespace", also_on: Sequence[str] = ()
) -> DataFrame:
    """``match_namespaces`` for many namespaces, which have no columns but ``namespace`` and ``also_on`` and are distinct.

    Depths with few namespaces are broadcast; each of the others takes one shuffle of the rows, by their beginning of that depth. A row
    becomes one for each match after the last shuffle, and then lies with all rows of its URI and ``also_on``: the
    columns ``PLACE`` and ``SALT`` are left in, if there are any, so that grouping by them too needs no other shuffle.
    """
    also_on, name, text = list(also_on), F.col(namespace), F.col(uri)
    size = F.octet_length(F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in namespaces.columns]))
    depth = _slashes(name) + 1
    with shuffles_removed(namespaces.sparkSession):
        found = namespaces.where(name.isNotNull()).groupBy(depth.alias("depth")).agg(
            F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes")
        ).collect()
    few, many, rows, size = [], [], 0, 0
    for d in sorted(found, key=lambda d: (d["rows"], d["depth"])):
        rows, size = rows + d["rows"], size + d["bytes"]
        (few if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else many).append(d["depth"])
    if len(few) > MOST_DEPTHS or len(many) > SHUFFLED_DEPTHS:
        return match_namespaces_indexed(df, namespaces, uri, namespace, also_on)
    matches = [F.struct(begin.alias(namespace), F.lit(False).alias("_known")) for begin in (_beginning(text, d) for d in few)]
    kept, found = df.columns, df
    # Of tables that are no files Spark knows no size.
    due = source_bytes(df) // DEALT_BYTES
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), due if due <= MOST_PARTS else 0)
    for d in many:
        # A URI without that many elements lies by itself.
        placed = found.withColumn(PLACE, F.coalesce(_beginning(text, d), text))
        listed = namespaces.where(depth == d).select(*also_on, name.alias(PLACE), F.lit(True).alias(f"_hit_{d}"))
        found = owner_join(placed.select(*kept, PLACE), listed, [*also_on, PLACE], "left", spread_by=[uri], dealt=parts)
        hit = F.when(F.col(f"_hit_{d}"), _beginning(text, d)).alias(namespace)
        kept = [*kept, f"_hit_{d}"]
        matches.append(F.struct(hit, F.lit(True).alias("_known")))
    if not matches:
        return match_namespaces_indexed(df, namespaces, uri, namespace, also_on)
    lies = [c for c in (PLACE, SALT) if c in found.columns]
    each = found.select(*df.columns, *lies, F.inline(F.array(*matches))).where(name.isNotNull())
    listed = namespaces.where(depth.isin(few)).select(*also_on, namespace, F.lit(True).alias("_listed"))
    matched = each.join(F.broadcast(listed), [*also_on, namespace], "left").where("_known OR _listed")
    return matched.select(namespace, *also_on, *[c for c in df.columns if c not in also_on], *lies)


def _beginning(uri: Column, depth: int) -> Column:
    return F.when(_slashes(uri) >= depth, F.substring_index(uri, "/", depth))


def match_namespaces_indexed(
    df: DataFrame, namespaces: DataFrame, uri: str = "uri", namespace: str = "namespace",
    also_on: Sequence[str] = (), **options
) -> DataFrame:
    """``match_namespaces`` by look-ups in an index, for any number and depth of namespaces."""
    also_on = list(also_on)
    index = prefix_index(namespaces, namespace, first_elements, lambda name: _slashes(name) + 1, **options)
    found = index.longest(df, uri, "_longest").where("_longest IS NOT NULL")
    chain = index.chain.select(F.col("longest").alias("_longest"), F.col("text").alias(namespace))
    matches = chain.join(apart(namespaces), namespace)
    rows, size = measured(matches, options.get("broadcast_rows", BROADCAST_ROWS))
    on = ["_longest", *also_on]
    if rows <= options.get("broadcast_rows", BROADCAST_ROWS) and size <= BROADCAST_BYTES:
        joined = found.join(F.broadcast(matches), on)
    else:
        joined = owner_join(found, matches.hint("merge"), on)
    others = [c for c in namespaces.columns if c not in (namespace, *also_on)]
    return joined.select(namespace, *also_on, *[c for c in df.columns if c not in also_on], *others)
