"""Which collections must be audited together because they share namespaces."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stocktake.functions.skew import BROADCAST_ROWS, attach_group_values
from stocktake.plans.stages import drop, stage


def _relink(edges: DataFrame, hub: str, spoke: str, small: bool) -> DataFrame:
    """Each edge with ``low``, the smallest node among its hub and the hub's neighbours."""
    lows = edges.groupBy(hub).agg(
        F.least(F.col(hub), F.min(spoke)).alias("low"), F.count(F.lit(1)).alias("degree")
    )
    if small:
        return edges.join(F.broadcast(lows.drop("degree")), hub)
    return attach_group_values(edges, lows, [hub], "degree")


def connected_components(edges: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(node, component) for an undirected graph given as ``a``, ``b`` string pairs.

    ``component`` is the smallest node of the component. Alternating large-star
    and small-star steps (Kiveris et al., SoCC 2014): every step only moves
    edges towards smaller nodes, and the number of rounds grows with the
    logarithm of the graph, not with its longest chain. Each round is written
    to the shared folder, so a lost executor repeats one round only, and goes when
    the next one is there.
    """
    start, _ = stage(
        edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to")).distinct(), "links"
    )
    links, before = start.where("node <> to"), None
    size, unfinished = _progress(links)
    while unfinished:
        # A graph of this many edges has no more hubs than that, so they may be broadcast.
        small = 2 * size <= broadcast_rows
        both = links.unionByName(links.select(F.col("to").alias("node"), F.col("node").alias("to")))
        large = _relink(both, "node", "to", small).where("to > node")
        large = large.select(F.col("to").alias("node"), F.col("low").alias("to"))
        near = _relink(large, "node", "to", small)
        near = near.select(F.col("to").alias("node"), F.col("low").alias("to")).unionByName(
            near.select("node", F.col("low").alias("to"))
        )
        links, written = stage(near.where("node <> to").distinct(), "links")
        if before:
            drop(edges.sparkSession, before)
        before = written
        size, unfinished = _progress(links)
    loops = start.where("node = to").select("node", F.col("to").alias("component"))
    centres = links.select(F.col("to").alias("node"), F.col("to").alias("component"))
    leaves = links.select("node", F.col("to").alias("component"))
    # A node with a link to itself and to others is a leaf or a centre already.
    alone = loops.join(centres.unionByName(leaves), "node", "left_anti")
    return centres.distinct().unionByName(leaves).unionByName(alone)


def _progress(links: DataFrame) -> tuple[int, int]:
    """Number of links, and of nodes that point at two centres or are centre and leaf at once."""
    ends = links.select("node", "to").unionByName(
        links.select(F.col("to").alias("node"), F.lit(None).cast("string").alias("to"))
    )
    nodes = ends.groupBy("node").agg(
        F.count("to").alias("out"), F.count_if(F.col("to").isNull()).alias("in"),
        F.min("to").alias("first"), F.max("to").alias("last"),
    )
    unfinished = (F.col("first") != F.col("last")) | ((F.col("out") > 0) & (F.col("in") > 0))
    row = nodes.agg(F.sum("out").alias("size"), F.count_if(unfinished).alias("unfinished")).first()
    return row["size"] or 0, row["unfinished"]


def audit_groups(mappings: DataFrame) -> DataFrame:
    """(group_id, member_type, member): collections that share a namespace, directly
    or through other collections, with all their namespaces.

    One row per member rather than one array per group, because a group may hold
    a large share of all members. ``group_id`` is its first collection's name.
    """
    edges = mappings.where("collection IS NOT NULL AND si_namespace IS NOT NULL").select(
        F.concat(F.lit("c:"), "collection").alias("a"),
        F.concat(F.lit("n:"), "si_namespace").alias("b"),
    )
    found = connected_components(edges)
    return found.select(
        F.expr("substring(component, 3)").alias("group_id"),
        F.when(F.col("node").startswith("c:"), "collection").otherwise("namespace").alias("member_type"),
        F.expr("substring(node, 3)").alias("member"),
    )


def groups_with(members: DataFrame, collections: DataFrame) -> DataFrame:
    """Members of the groups that contain at least one of ``collections``."""
    wanted = collections.select(
        F.lit("collection").alias("member_type"), F.col("collection").alias("member"),
        F.lit(True).alias("wanted"),
    ).distinct()
    groups = members.join(wanted, ["member_type", "member"], "left").groupBy("group_id").agg(
        F.count(F.lit(1)).alias("size"), F.max("wanted").alias("wanted")
    )
    return attach_group_values(members, groups.where("wanted").drop("wanted"), ["group_id"], "size")


def namespaces_per_collection(mappings: DataFrame) -> DataFrame:
    """The distinct namespaces of each collection, one row each."""
    return mappings.where("collection IS NOT NULL AND si_namespace IS NOT NULL").select(
        "collection", F.col("si_namespace").alias("namespace")
    ).distinct()
