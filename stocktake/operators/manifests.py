"""Decide what to copy, from listings of directories."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stocktake import model as m
from stocktake.functions.dedupe import dedupe_first
from stocktake.functions.longest import first_characters, prefix_index
from stocktake.functions.skew import attach_group_values


def is_bundle(name="name") -> Column:
    return reduce(
        lambda a, b: a | b, (F.col(name).endswith(ending) for ending in m.BUNDLE_ENDINGS)
    )


def _matches(text: Column, patterns: Sequence[str]) -> Column:
    """Any of the patterns occurs, tested in one go."""
    return text.rlike("|".join(f"(?:{p})" for p in patterns)) if patterns else F.lit(False)


def newest_upload(listing: DataFrame, name: str = "name") -> DataFrame:
    """Which uploads of each directory to take.

    If the newest is a bundle, only it is taken. Otherwise all plain files are
    taken and bundles are orphans. Of equally new uploads the first name counts as
    newest; an upload without a time is older than any with one. Rows with one
    directory, name and time are one upload and leave one row.
    """
    upload = ["dir", name, "modified"]
    others = [F.col(c).asc_nulls_first() for c in listing.columns if c not in upload]
    files = dedupe_first(listing, upload, others or [F.col("dir")]).withColumn("is_bundle", is_bundle(name))
    age = F.negate(F.unix_micros(F.col("modified").cast("timestamp")))
    newest = files.groupBy("dir").agg(
        F.min(F.struct(
            F.col("modified").isNull().alias("timeless"), age.alias("age"), F.col(name).alias("name"), "is_bundle"
        )).alias("newest"),
        F.count(F.lit(1)).alias("num_files"),
    )
    judged = attach_group_values(files, newest, ["dir"], "num_files")
    first = age.eqNullSafe(F.col("newest.age")) & F.col(name).eqNullSafe(F.col("newest.name"))
    outcome = (
        F.when(~F.col("newest.is_bundle") & ~F.col("is_bundle"), "FILE_TAKEN")
        .when(~F.col("newest.is_bundle"), "ORPHAN_BUNDLE")
        .when(first, "BUNDLE_TAKEN")
        .when(F.col("is_bundle"), "OLDER_BUNDLE")
        .otherwise("OLDER_FILE")
    )
    return judged.withColumn("outcome", outcome).select(*listing.columns, "outcome")


def listing_filter(
    listing: DataFrame,
    owner: str,
    extra_names: Sequence[str] = (),
    parts: Sequence[str] = m.UNWANTED_PARTS,
    parts_any_case: Sequence[str] = m.UNWANTED_PARTS_ANY_CASE,
) -> DataFrame:
    """Uploads worth considering: not the service's own, not slides or media, not ``<dir>.pdf``.

    A name is the last word of its line in the listing.
    """
    name = F.col("name")
    exact = [re.escape(part) for part in (*parts, *extra_names)]
    loose = [f"(?i:{re.escape(part)})" for part in parts_any_case]
    unwanted = (
        (F.col("owner") == owner)
        | name.contains(F.concat("dir", F.lit(".pdf")))
        | _matches(name, [*exact, *loose])
    )
    keep = ~F.coalesce(unwanted, F.lit(False))
    return listing.where(keep).withColumn("name", F.element_at(F.split("name", " "), -1))


def manifest_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """(dir, name, action): COPY, DIFFERS, SAME, or STALE for a file only the target has.

    Archives are passed over on the source side. A target directory the source
    does not have is left alone. Files without a checksum on either side are
    DIFFERS if their lengths say so, else UNCHECKED.
    """
    # A file name, as listed from inside its directory, carries the directory in front.
    path = F.concat_ws("/", "dir", "name")
    archive = path.contains("tar") | F.col("name").endswith(".rar") | F.col("name").endswith(".zip")

    def content(side: DataFrame, prefix: str) -> list[Column]:
        length = F.col("length") if "length" in side.columns else F.lit(None)
        return [F.col("checksum").alias(f"{prefix}checksum"), length.cast("long").alias(f"{prefix}length")]

    shared = target.groupBy("dir").agg(F.count(F.lit(1)).alias("num_files")).join(
        source.select("dir").distinct(), "dir", "left_semi"
    )
    # Directories are decided before the files meet, so that they meet once.
    held = attach_group_values(target, shared, ["dir"], "num_files")
    left = source.select("dir", "name", *content(source, ""), archive.alias("archive"), F.lit(True).alias("in_source"))
    right = held.select("dir", "name", *content(held, "target_"), F.lit(True).alias("in_target"))
    same = F.col("checksum") == F.col("target_checksum")
    action = (
        F.when(F.col("in_source").isNull(), "STALE")
        .when(F.col("in_target").isNull(), "COPY")
        .when(same, "SAME")
        .when(same.isNotNull() | (F.col("length") != F.col("target_length")), "DIFFERS")
        .otherwise("UNCHECKED")
    )
    pairs = left.join(right, ["dir", "name"], "full_outer").where("in_source IS NULL OR NOT archive")
    return pairs.select("dir", "name", action.alias("action"))


def not_listed(
    directories: DataFrame, contents: DataFrame, letters: Sequence[str] = m.CONTRIBUTION_LETTERS
) -> DataFrame:
    """Contribution directories whose name occurs nowhere in the table of contents.

    Occurring means as part of any line. Every piece of a line that starts with one of the ``letters``, as long as the
    longest name, is looked up in an index of the names; it stays one row, however many lengths names have.
    """
    names = directories.where(F.substring("name", 1, 1).isin(*letters)).select("name").distinct()
    index = prefix_index(names, "name", first_characters, F.length)
    if not index.levels:
        return names
    starts = "".join(re.escape(letter) for letter in letters)
    # A lookahead also finds pieces that overlap.
    window = f"(?s)(?=([{starts}].{{0,{index.levels[-1] - 1}}}))"
    pieces = contents.select(F.explode(F.regexp_extract_all("line", F.lit(window), F.lit(1))).alias("piece")).distinct()
    longest = index.longest(pieces, "piece").select("longest").distinct()
    # A name that begins a longer one that occurs does occur too.
    occurring = index.chain.join(longest, "longest", "left_semi").select(F.col("text").alias("name")).distinct()
    return names.join(occurring, "name", "left_anti")


def unexpected_files(listing: DataFrame, expected: Sequence[str] = m.EXPECTED_KINDS) -> DataFrame:
    """Files of no expected kind."""
    path = F.concat_ws("/", "dir", "name")
    return listing.where(~_matches(path, expected))


def unexpected_extensions(listing: DataFrame, expected: Sequence[str] = m.EXPECTED_KINDS) -> DataFrame:
    """The distinct extensions of those files."""
    extension = F.regexp_extract("name", r"\.([^.]*)$", 1)
    files = unexpected_files(listing, expected).where(F.col("name").contains("."))
    return files.select(extension.alias("extension")).distinct()
