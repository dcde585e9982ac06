from pyspark.sql import functions as F

from conftest import rows
from stocktake.operators import manifests

UPLOAD = "dir string, name string, modified int"


def test_newest_upload(frame):
    uploads = frame([
        ("d1", "a.tar.gz", 3), ("d1", "b.tex", 2), ("d1", "c.zip", 1),
        ("d2", "a.tex", 3), ("d2", "b.rar", 2), ("d2", "c.tex", 1),
        ("d3", "x.7z", 1), ("d4", "x.tgz", 1), ("d5", "a.tar", 5), ("d5", "b.tex", 5),
        ("d6", "a.tex", 5), ("d6", "b.tar", 5), ("d7", "only.zip", None), ("d8", "late.tar", None), ("d8", "a.tex", 1),
        ("d9", "twice.tar", 2), ("d9", "twice.tar", 2), ("d9", "twice.tar", 1),
    ], UPLOAD)
    assert rows(manifests.newest_upload(uploads), "dir", "name", "outcome") == [
        ("d1", "a.tar.gz", "BUNDLE_TAKEN"), ("d1", "b.tex", "OLDER_FILE"), ("d1", "c.zip", "OLDER_BUNDLE"),
        ("d2", "a.tex", "FILE_TAKEN"), ("d2", "b.rar", "ORPHAN_BUNDLE"), ("d2", "c.tex", "FILE_TAKEN"),
        ("d3", "x.7z", "BUNDLE_TAKEN"), ("d4", "x.tgz", "FILE_TAKEN"),
        ("d5", "a.tar", "BUNDLE_TAKEN"), ("d5", "b.tex", "OLDER_FILE"),
        ("d6", "a.tex", "FILE_TAKEN"), ("d6", "b.tar", "ORPHAN_BUNDLE"), ("d7", "only.zip", "BUNDLE_TAKEN"),
        ("d8", "a.tex", "FILE_TAKEN"), ("d8", "late.tar", "ORPHAN_BUNDLE"),
        ("d9", "twice.tar", "BUNDLE_TAKEN"), ("d9", "twice.tar", "OLDER_BUNDLE"),
    ]


def test_listing_filter(frame):
    listing = frame([
        ("P1", "good.tex", "me"), ("P1", "P1.pdf", "me"), ("P1", "P2.pdf", "me"), ("P1", "My SLIDES.pdf", "me"),
        ("P1", "talk.pptx", "me"), ("P1", "TALK.PPTX", "me"), ("P1", "auto.tex", "robot"),
        ("P1", "two words.tex", "me"), ("P1", "exact.pdf", None), ("P1", "skip-me.pdf", "me"),
    ], "dir string, name string, owner string")
    got = manifests.listing_filter(listing, "robot", extra_names=["skip-me.pdf"])
    assert rows(got, "name") == [("P2.pdf",), ("TALK.PPTX",), ("exact.pdf",), ("good.tex",), ("words.tex",)]


def test_manifest_diff(frame):
    columns = "dir string, name string, checksum string"
    source = frame([
        ("a", "same", "1"), ("a", "new", "1"), ("a", "changed", "1"), ("a", "x.tar.gz", "1"), ("a", "target", "1"),
        ("b", "only.zip", "1"), ("a", "z.rar", "1"), ("a", "nosum", None),
    ], columns)
    target = frame([
        ("a", "same", "1"), ("a", "changed", "2"), ("a", "old", "1"), ("a", "old.zip", "1"), ("b", "old", "1"),
        ("c", "kept", "1"), ("a", "z.rar", "9"), ("a", "nosum", "1"),
    ], columns)
    assert rows(manifests.manifest_diff(source, target)) == [
        ("a", "changed", "DIFFERS"), ("a", "new", "COPY"), ("a", "nosum", "UNCHECKED"), ("a", "old", "STALE"),
        ("a", "old.zip", "STALE"), ("a", "same", "SAME"), ("b", "old", "STALE"),
    ]
    sized = "dir string, name string, checksum string, length long"
    source = frame([("", "big", None, 5), ("", "same", None, 5), ("", "unknown", None, None)], sized)
    target = frame([("", "big", None, 6), ("", "same", None, 5), ("", "unknown", "1", 1)], sized)
    assert rows(manifests.manifest_diff(source, target)) == [
        ("", "big", "DIFFERS"), ("", "same", "UNCHECKED"), ("", "unknown", "UNCHECKED")]


def test_not_listed(frame):
    names = frame([("P1",), ("P10",), ("P2",), ("X9",), ("B",), ("I07",), ("I07",), ("T1.x",)], "name string")
    contents = frame([("see P10 there",), ("B",), ("a", ), ("",), (None,), ("T1xx",)], "line string")
    assert rows(manifests.not_listed(names, contents)) == [("I07",), ("P2",), ("T1.x",)]
    assert rows(manifests.not_listed(names, contents.where("false"))) == [
        ("B",), ("I07",), ("P1",), ("P10",), ("P2",), ("T1.x",)]


def test_unexpected_files(frame):
    files = frame([
        ("P1", "a.tex"), ("P1", "a.bib"), ("P1", "a.eps"), ("P1", "makedefs"), ("P1", "makedefs2"),
        ("P1", "COPYRIGHT.pdf"), ("P1", "a.tar.gz"), ("P1", "a.doc"), ("P1", "b.doc"), ("P1", "noext"),
        ("P1", "b.PNG"),
    ], "dir string, name string")
    assert rows(manifests.unexpected_files(files), "name") == [
        ("a.doc",), ("b.PNG",), ("b.doc",), ("makedefs2",), ("noext",)]
    assert rows(manifests.unexpected_extensions(files)) == [("PNG",), ("doc",)]
    assert manifests.unexpected_files(files, []).count() == 11


def test_hot_directory_is_whole(frame, spark):
    many = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("d"), F.col("id") % 1500)).alias("dir"),
        F.concat(F.col("id").cast("string"), F.when(F.col("id") % 7 == 0, ".zip").otherwise(".tex")).alias("name"),
        F.col("id").alias("modified"),
    )
    got = manifests.newest_upload(many)
    assert got.count() == 3000 and got.select("dir", "name").distinct().count() == 3000
    newest = {}
    for r in many.collect():
        newest[r.dir] = max(newest.get(r.dir, (-1, "")), (r.modified, r.name))
    for r in got.collect():
        top = newest[r.dir]
        bundle, top_bundle = r.name.endswith(".zip"), top[1].endswith(".zip")
        expected = (
            ("BUNDLE_TAKEN" if r.name == top[1] else "OLDER_BUNDLE" if bundle else "OLDER_FILE")
            if top_bundle else ("ORPHAN_BUNDLE" if bundle else "FILE_TAKEN"))
        assert r.outcome == expected
