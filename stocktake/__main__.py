"""Command line, for spark-submit or ``python -m stocktake``.

    stocktake reconcile  --tables DIR --config DIR --out DIR [COLLECTION ...]
    stocktake reconcile  ... --state DIR [--previous DIR]   (again, taking over what did not change)
    stocktake duplicates | profiles | previews   (same options)
    stocktake copies     --site NAME=PATH ... --config DIR --out DIR [NAMESPACE ...]
    stocktake usage      --tables DIR --out DIR [--start FIELD] [--end FIELD]
    stocktake harvest    --tables DIR --site NAME=PATH ... --out DIR --collection NAME
                         --source TEXT --namespace NAME --asof TIME
    stocktake merge      --counts DIR --site NAME ... --out DIR
    stocktake summary    --report DIR ... --out DIR
    stocktake uploads    --listing FILE --owner NAME --out DIR
    stocktake compare    --source DIR --target DIR --out DIR
    stocktake expected   --source DIR --out DIR
    stocktake listed     --source DIR --contents FILE --out DIR

``--tables`` holds one folder per table: observation, plane, artifact, inventory,
harvest_skip, in ``--table-format``. With ``--sites FILE --site-tables`` every
collection's observations, planes and artifacts are read below the location that
the file gives for its site.
``--config`` holds mappings.tsv, collections.tsv, namespaces.csv. ``--format`` is what
reports are written in, and what ``merge`` and ``summary`` read.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from stocktake import model as m
from stocktake.functions.skew import lookup_join
from stocktake.operators import config, copies, manifests, reports
from stocktake.plans import audits
from stocktake.plans.session import configure
from stocktake.sources import sinks, tables

AUDITS = {
    "reconcile": audits.reconcile_audit,
    "duplicates": audits.duplicate_audit,
    "profiles": audits.profile_audit,
    "previews": audits.preview_audit,
}


def _arguments(argv):
    parser = argparse.ArgumentParser(prog="stocktake")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in AUDITS:
        audit = commands.add_parser(name)
        audit.add_argument("--config", required=True)
        audit.add_argument("--sites", help="sites.tsv; every collection's site must be in it")
        audit.add_argument(
            "--site-tables", action="store_true", help="read each collection's records at its site's location"
        )
        audit.add_argument("--skip-site", help="leave out collections of this site")
        audit.add_argument("names", nargs="*", metavar="COLLECTION")
    again = commands.choices["reconcile"]
    again.add_argument("--state", help="new folder to keep this run's digests and result in, for the next run")
    again.add_argument("--previous", help="folder that an earlier run kept")
    copy = commands.add_parser("copies")
    copy.add_argument("--config", required=True)
    copy.add_argument("names", nargs="*", metavar="NAMESPACE")
    use = commands.add_parser("usage")
    use.add_argument("--start")
    use.add_argument("--end")
    daily = commands.add_parser("harvest")
    for option in ("--collection", "--source", "--namespace"):
        daily.add_argument(option, required=True)
    daily.add_argument("--asof", type=datetime.fromisoformat, required=True)
    for command in (copy, daily):
        command.add_argument("--site", action="append", required=True, metavar="NAME=PATH")
    for name in [*AUDITS, "usage", "harvest"]:
        commands.choices[name].add_argument("--tables", required=True)
        commands.choices[name].add_argument(
            "--table-format", default="parquet", choices=["parquet", "orc", "json", "csv", "tsv", "table"]
        )
    uploads = commands.add_parser("uploads")
    uploads.add_argument("--listing", required=True, help="CSV with dir, name, modified, owner")
    uploads.add_argument("--owner", required=True, help="the service's own account")
    compare = commands.add_parser("compare")
    compare.add_argument("--source", required=True)
    compare.add_argument("--target", required=True)
    expected = commands.add_parser("expected")
    expected.add_argument("--source", required=True)
    listed = commands.add_parser("listed")
    listed.add_argument("--source", required=True, help="folder of the contributions' directories")
    listed.add_argument("--contents", required=True, help="the table of contents, a text file")
    merge = commands.add_parser("merge")
    merge.add_argument("--counts", required=True, help="counts that the copies command wrote")
    merge.add_argument("--site", action="append", required=True, metavar="NAME")
    total = commands.add_parser("summary")
    total.add_argument("--report", action="append", required=True, help="output folder of one audit")
    for command in commands.choices.values():
        command.add_argument("--out", required=True)
        command.add_argument("--format", default="tsv", choices=["tsv", "csv", "parquet", "orc", "json"])
    return parser.parse_args(argv)


def _archive(spark, args) -> audits.Archive:
    places = [(None, args.tables)]
    archive = audits.Archive()
    if args.command in AUDITS:
        archive.collections = tables.read_config(spark, "collections", f"{args.config}/collections.tsv")
        if args.sites:
            archive.sites = tables.read_config(spark, "sites", args.sites)
            if args.site_tables:
                located = config.collection_site(archive.collections, archive.sites).where("site_url IS NOT NULL")
                # As many rows as services are configured.
                places = sorted(map(tuple, located.select("ams_site", "site_url").distinct().collect()))

    def table(name, schema, extra=False):
        parts = []
        for site, place in places:
            part = tables.read_table(spark, f"{place}/{name}", schema, args.table_format, extra=extra)
            if site is not None and name == "observation":
                # A site answers for its own collections only.
                own = archive.collections.where(F.col("ams_site") == site).select("collection")
                part = lookup_join(part, own, ["collection"], "left_semi", spread_by=["obs_id"])
            parts.append(part)
        return reduce(DataFrame.unionByName, parts)

    extra = args.command == "usage"
    archive.observation, archive.plane = table("observation", m.OBSERVATION, extra), table("plane", m.PLANE, extra)
    if args.command != "usage":
        archive.artifact = table("artifact", m.ARTIFACT)
    if args.command in ("reconcile", "duplicates"):
        archive.mappings = tables.read_config(spark, "mappings", f"{args.config}/mappings.tsv")
    if args.command == "reconcile":
        archive.inventory = tables.read_table(
            spark, f"{args.tables}/inventory",
            m.StructType([f for f in m.INVENTORY if f.name != "site"]), args.table_format,
        )
    return archive


def run(spark: SparkSession, argv=None) -> None:
    args = _arguments(argv)
    requested = None
    if getattr(args, "names", None):
        key = "namespace" if args.command == "copies" else "collection"
        requested = spark.createDataFrame([(n,) for n in args.names], f"{key} string")
    places = {}
    if args.command in ("copies", "harvest"):
        places = dict(site.split("=", 1) for site in args.site)
    if args.command in ("profiles", "previews"):
        AUDITS[args.command](_archive(spark, args), args.out, requested, args.skip_site, args.format)
    elif args.command == "reconcile" and args.state:
        audits.repeated_reconcile_audit(
            _archive(spark, args), args.out, args.state, args.previous, requested, args.format
        )
    elif args.command in AUDITS:
        AUDITS[args.command](_archive(spark, args), args.out, requested, args.format)
    elif args.command == "copies":
        inventory = tables.read_sites(spark, places, m.StructType([m.INVENTORY["site"], m.INVENTORY["uri"]]))
        namespaces = tables.read_config(spark, "namespaces", f"{args.config}/namespaces.csv")
        stamp = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H-%M-%S")
        audits.copies_audit(inventory, namespaces, list(places), stamp, args.out, requested, args.format)
    elif args.command == "usage":
        audits.usage_audit(_archive(spark, args), args.out, args.start, args.end, args.format)
    elif args.command == "harvest":
        everywhere = tables.read_sites(spark, places, m.StructType([m.OBSERVATION["collection"]]))
        skip = tables.read_table(spark, f"{args.tables}/harvest_skip", m.HARVEST_SKIP, args.table_format)
        audits.harvest_in_one_pass(
            _archive(spark, args), everywhere, skip, args.collection, args.source, list(places),
            args.namespace, args.asof, args.out, format=args.format,
        )
    elif args.command == "merge":
        counts = tables.read_site_counts(spark, args.counts, args.format)
        sinks.write_table(copies.merge_site_counts(counts, args.site), args.out, ["namespace"], args.format)
    elif args.command == "summary":
        found = reports.collect_summaries(
            tables.read_summaries(spark, [f"{place}/summary" for place in args.report], args.format)
        )
        sinks.write_table(found, args.out, [found.columns[0]], args.format)
    elif args.command == "uploads":
        schema = m.StructType([f for f in m.MANIFEST if f.name in ("dir", "name", "modified", "owner")])
        listing = tables.read_table(spark, args.listing, schema, "csv")
        chosen = manifests.newest_upload(manifests.listing_filter(listing, args.owner))
        sinks.write_table(chosen, args.out, ["dir", "modified", "name"], args.format)
    elif args.command == "compare":
        source, target = (
            tables.read_manifest(spark, side, checksum=True, chunk_bytes=tables.CHUNK_BYTES)
            for side in (args.source, args.target)
        )
        sinks.write_table(manifests.manifest_diff(source, target), args.out, ["dir", "name"], args.format)
    elif args.command == "expected":
        files = manifests.unexpected_files(tables.read_manifest(spark, args.source))
        sinks.write_table(files.select("dir", "name"), args.out, ["dir", "name"], args.format)
    elif args.command == "listed":
        files = tables.read_manifest(spark, args.source).where("dir <> ''")
        directories = files.select(F.substring_index("dir", "/", 1).alias("name")).distinct()
        contents = spark.read.text(args.contents).withColumnRenamed("value", "line")
        sinks.write_table(manifests.not_listed(directories, contents), args.out, ["name"], args.format)


if __name__ == "__main__":
    run(configure(SparkSession.builder.appName("stocktake").getOrCreate()))
