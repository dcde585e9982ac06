"""Readers, writers and the command line, end to end on small files."""

import hashlib
from datetime import datetime
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import rows
from stocktake import model as m
from stocktake.__main__ import run
from stocktake.operators import manifests
from stocktake.plans import audits
from stocktake.plans.session import ensure_checkpoint_dir
from stocktake.plans.stages import kept
from stocktake.sources import sinks, tables


def test_conform_renames_casts_and_checks(frame):
    df = frame([("1", "9", "x", "7")], "planeID string, OBSID string, colour string, contentLength string")
    schema = m.StructType([m.PLANE["plane_id"], m.PLANE["obs_id"], m.ARTIFACT["content_length"]])
    assert tables.conform(df, schema).dtypes == [
        ("plane_id", "string"), ("obs_id", "string"), ("content_length", "bigint")]
    assert tables.conform(df, schema, extra=True).columns == ["plane_id", "obs_id", "content_length", "colour"]
    with pytest.raises(ValueError, match="quality_flag"):
        tables.conform(df, m.PLANE)
    bad = df.withColumn("contentLength", F.lit("many"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.conform(bad, schema).collect()


def test_read_formats_and_sites(spark, frame, tmp_path):
    schema = m.StructType([m.INVENTORY["uri"], m.INVENTORY["content_length"]])
    df = frame([("u/1", 5), ("u/2", None)], "uri string, contentLength long")
    for format in ("parquet", "orc", "json"):
        df.write.format(format).save(str(tmp_path / format))
        assert rows(tables.read_table(spark, str(tmp_path / format), schema, format)) == [("u/1", 5), ("u/2", None)]
    for format, sep in (("csv", ","), ("tsv", "\t")):
        df.write.options(header=True, sep=sep).csv(str(tmp_path / format))
        assert rows(tables.read_table(spark, str(tmp_path / format), schema, format)) == [("u/1", 5), ("u/2", None)]
    df.createOrReplaceTempView("inventory_view")
    assert tables.read_table(spark, "inventory_view", schema, "table").count() == 2
    places = {"x": str(tmp_path / "parquet"), "y": str(tmp_path / "parquet")}
    everywhere = tables.read_sites(spark, places, m.StructType([m.INVENTORY["site"], *schema]))
    assert rows(everywhere, "site", "uri") == [("x", "u/1"), ("x", "u/2"), ("y", "u/1"), ("y", "u/2")]


def test_conform_rejects_columns_of_one_meaning(frame):
    schema = m.StructType([m.INVENTORY["uri"], m.INVENTORY["last_modified"]])
    for columns in ("uri string, lastModified string, contentLastModified string", "uri string, contentLastModified string, lastModified string"):
        one, two = ("2024-01-01", "2024-01-02") if columns.index("lastM") < columns.index("contentL") else ("2024-01-02", "2024-01-01")
        got = tables.conform(frame([("u", one, two)], columns), schema, extra=True)
        assert str(got.first()["last_modified"]).startswith("2024-01-02") and got.columns[2] == "lastModified"
    kept = tables.conform(
        frame([("u", "p", "2024-01-01", "2024-01-02")], "uri string, planeID string, lastModified string, contentLastModified string"),
        m.StructType([m.ARTIFACT["uri"], m.ARTIFACT["plane_id"], m.ARTIFACT["last_modified"]]), extra=True)
    assert str(kept.first()["last_modified"]).startswith("2024-01-01") and kept.columns[3] == "contentLastModified"
    with pytest.raises(ValueError, match="URI, uri|uri, URI"):
        tables.conform(frame([("u", "v")], "a string, b string").toDF("uri", "URI"), m.StructType([m.ARTIFACT["uri"]]))
    with pytest.raises(ValueError, match="obsID"):
        tables.conform(frame([("u", "v")], "obsID string, obs_id string"), m.StructType([m.PLANE["obs_id"]]))


def test_manifest_of_files(spark, tmp_path):
    for side in ("x", "y"):
        for path, text in (("P1/a.tex", "hello"), ("P1/sub/a.tex", "hello"), ("P2/sub/a.tex", "longer"), ("top.bib", "t")):
            (tmp_path / side / path).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / side / path).write_text(text)
    got = tables.read_manifest(spark, str(tmp_path / "x"), checksum=True, checksum_bytes=5)
    hello = "5d41402abc4b2a76b9719d911017c592"
    assert rows(got, "dir", "name", "length", "checksum") == [
        ("", "top.bib", 1, "e358efa489f58062f10dd7316b65649e"), ("P1", "a.tex", 5, hello), ("P1/sub", "a.tex", 5, hello),
        ("P2/sub", "a.tex", 6, None)]
    both = [tables.read_manifest(spark, str(tmp_path / side), checksum=True, checksum_bytes=5) for side in "xy"]
    assert rows(manifests.manifest_diff(*both), "dir", "action") == [("", "SAME"), ("P1", "SAME"), ("P1/sub", "SAME"), ("P2/sub", "UNCHECKED")]
    plan = tables.read_manifest(spark, str(tmp_path / "x"))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_large_files_are_compared_by_chunks(spark, tmp_path, monkeypatch):
    big = bytes(range(256)) * 40
    files = {"d/same.bin": (big, big), "d/end.bin": (big, big[:-1] + b"!"), "d/cut.bin": (big, big[:-1]), "d/small": (b"abc", b"abc"),
             "d/a b%.bin": (big[:1000], big[:1000]), "d/swap.bin": (big[:200] + big[100:200], big[100:200] + big[:200])}
    for path, sides in files.items():
        for side, content in zip("xy", sides):
            (tmp_path / side / path).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / side / path).write_bytes(content)
    monkeypatch.setattr(tables, "READ_BYTES", 33)
    for chunk in (100, 999, 10_240, 1 << 20):
        both = [tables.read_manifest(spark, str(tmp_path / s), checksum=True, checksum_bytes=100, chunk_bytes=chunk) for s in "xy"]
        assert dict(rows(manifests.manifest_diff(*both), "name", "action")) == {
            "same.bin": "SAME", "end.bin": "DIFFERS", "cut.bin": "DIFFERS", "small": "SAME", "a b%.bin": "SAME", "swap.bin": "DIFFERS"}
    found = dict(rows(both[0], "name", "checksum"))
    assert found["small"] == hashlib.md5(b"abc").hexdigest()
    assert found["same.bin"] == f"chunks-{1 << 20}:" + hashlib.md5(hashlib.md5(big).hexdigest().encode()).hexdigest()
    # One file is read by many tasks.
    listed = spark.read.format("binaryFile").load(str(tmp_path / "x" / "d" / "same.bin")).select("path", "length")
    assert tables.tree_digests(listed, 100)._jdf.queryExecution().optimizedPlan().toString().count("Repartition") >= 1
    assert tables.tree_digests(listed.where("false"), 100).count() == 0


def test_sections(spark, frame, tmp_path):
    df = frame([("A", "u2", 1), ("B", "u1", None), ("A", "u1", 2)], "category string, uri string, n int")
    sinks.write_sections(df, str(tmp_path / "s"), ["uri"])
    files = sorted((tmp_path / "s" / "category=A").glob("*.csv"))
    assert [line for f in files for line in f.read_text().splitlines() if line != "uri\tn"] == ["u1\t2", "u2\t1"]
    assert rows(sinks.section_counts(df, ["A", "B", "C"])) == [("A", 2), ("B", 1), ("C", 0)]
    with pytest.raises(Exception, match="already exists"):
        sinks.write_sections(df, str(tmp_path / "s"))


def test_stage_tables_stand_in_the_folder_named_and_go(spark, tmp_path):
    place = ensure_checkpoint_dir(spark)
    assert place == spark.conf.get("spark.checkpoint.dir")
    with kept(spark.range(3), "numbers") as numbers:
        path = Path("/" + numbers.inputFiles()[0].removeprefix("file:").lstrip("/"))
        assert str(path).startswith(place.removeprefix("file://")) and path.exists() and numbers.count() == 3
    assert not path.exists()


def test_checkpoint_folder_must_be_named_on_a_cluster():
    def session(master, named):
        used = []
        conf = SimpleNamespace(get=lambda key, default: named, set=lambda key, value: used.append(value))
        return SimpleNamespace(sparkContext=SimpleNamespace(master=master), conf=conf), used

    for master in ("spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(session(master, None)[0])
    cluster, used = session("yarn", "/shared/here")
    assert ensure_checkpoint_dir(cluster) == "/shared/here" and not used
    alone, used = session("local[4]", None)
    assert [ensure_checkpoint_dir(alone)] == used


@pytest.fixture
def archive(spark, frame, tmp_path):
    at = "2024-01-14 12:00:00"
    put = lambda name, data, columns: frame(data, columns).write.parquet(str(tmp_path / "tables" / name))
    put("observation", [("1", "o1", "A", "cam", "science", None, at, "x"), ("2", "o2", "B", "cam", None, at, at, None)],
        "obsID string, observationID string, collection string, instrument_name string, intent string,"
        " metaRelease string, maxLastModified string, target string")
    put("plane", [("10", "1", "image", None, at), ("11", "1", "image", None, at), ("12", "1", "image", "junk", at)],
        "planeID string, obsID string, dataProductType string, quality_flag string, maxLastModified string")
    put("artifact", [
        ("a", "10", "n/1", "science", "c", 5, "t", at), ("b", "10", "n/1p", "preview", "c", 5, "t", at),
        ("c", "11", "n/2", "science", "c", 5, "t", at), ("d", "11", "n/1", "science", "c", 5, "t", at)],
        "artifactID string, planeID string, uri string, productType string, contentChecksum string,"
        " contentLength long, contentType string, lastModified string")
    put("inventory", [("n/1", "c", 5, "t", at), ("n/2", "x", 5, "t", at), ("n/9", "x", 5, "t", at)],
        "uri string, contentChecksum string, contentLength long, contentType string, contentLastModified string")
    put("harvest_skip", [(1, "Observation", "s/A", at, "bad")],
        "skipID long, cname string, source string, tryAfter string, errorMessage string")
    conf = tmp_path / "config"
    conf.mkdir()
    (conf / "mappings.tsv").write_text("collection\tsi_namespace\nA\tn\n")
    (conf / "collections.tsv").write_text("collection\tin_si\tams_site\nA\tTrue\ts1\nB\tFalse\ts2\n")
    (conf / "sites.tsv").write_text("site_name\tsite_url\ns1\t/one\n")
    (conf / "namespaces.csv").write_text("namespace\nn\nq\n")
    return tmp_path


def _tsv(spark, path):
    return spark.read.options(header=True, sep="\t").csv(str(path))


def _run(spark, archive, command, *args):
    out = archive / "out" / command
    options = []
    if command not in ("copies",):
        options += ["--tables", str(archive / "tables")]
    if command not in ("usage", "harvest"):
        options += ["--config", str(archive / "config")]
    run(spark, [command, *options, "--out", str(out), *args])
    return out


def test_reconcile_command(spark, archive):
    out = _run(spark, archive, "reconcile", "--sites", str(archive / "config" / "sites.tsv"))
    assert rows(_tsv(spark, out / "files"), "category", "uri") == [
        ("DIFF_CHECKSUMS", "n/2"), ("MISSING_IN_CATALOG", "n/9"), ("MISSING_IN_INVENTORY", "n/1p")]
    assert rows(_tsv(spark, out / "summary"), "group_id", "num_catalog", "num_inventory", "num_consistent") == [
        ("A", "3", "3", "1")]
    with pytest.raises(Exception, match="unknown collection: B"):
        run(spark, ["reconcile", "--tables", str(archive / "tables"), "--config", str(archive / "config"),
                    "--out", str(archive / "no"), "B"])


def test_repeated_reconcile_command(spark, archive):
    sites = ["--sites", str(archive / "config" / "sites.tsv")]
    state = [str(archive / "state" / day) for day in ("1", "2")]
    first = _run(spark, archive, "reconcile", *sites, "--state", state[0])
    assert rows(_tsv(spark, first / "files"), "category", "uri") == [
        ("DIFF_CHECKSUMS", "n/2"), ("MISSING_IN_CATALOG", "n/9"), ("MISSING_IN_INVENTORY", "n/1p")]
    assert rows(_tsv(spark, first / "summary"), "group_id", "num_catalog", "num_inventory", "num_consistent", "num_diff_checksums") == [
        ("A", "3", "3", "1", "1")]
    # The next day the missing file is in storage, another one is too long.
    stored = spark.read.parquet(str(archive / "tables" / "inventory"))
    longer = stored.withColumn("contentLength", F.expr("IF(uri = 'n/1', 6L, contentLength)"))
    longer.unionByName(stored.where("uri = 'n/1'").withColumn("uri", F.lit("n/1p"))).write.parquet(str(archive / "next" / "inventory"))
    for name in ("observation", "plane", "artifact"):
        spark.read.parquet(str(archive / "tables" / name)).write.parquet(str(archive / "next" / name))
    run(spark, ["reconcile", "--tables", str(archive / "next"), "--config", str(archive / "config"), "--out", str(archive / "out2"),
                *sites, "--state", state[1], "--previous", state[0]])
    assert rows(_tsv(spark, archive / "out2" / "files"), "category", "uri") == [
        ("DIFF_CHECKSUMS", "n/2"), ("DIFF_LENGTHS", "n/1"), ("MISSING_IN_CATALOG", "n/9")]
    assert rows(_tsv(spark, archive / "out2" / "summary"), "num_consistent", "num_diff_lengths", "num_missing_in_inventory") == [("1", "1", "0")]


def test_records_of_each_collection_come_from_its_site(spark, archive, frame):
    at = "2024-01-14 12:00:00"
    (archive / "config" / "collections.tsv").write_text("collection\tin_si\tams_site\nA\tTrue\ts1\nB\tTrue\ts2\n")
    (archive / "config" / "sites.tsv").write_text(f"site_name\tsite_url\ns1\t{archive}/tables\ns2\t{archive}/other\n")
    other = {
        "observation": ([("b1", "B", at), ("a9", "A", at)], "obs_id string, collection string, max_last_modified string"),
        "plane": ([("b1p", "b1"), ("a9p", "a9")], "plane_id string, obs_id string"),
        "artifact": ([("b1p", "n/5"), ("b1p", "n/5"), ("a9p", "n/6")], "plane_id string, uri string"),
    }
    for name, (data, columns) in other.items():
        table, whole = frame(data, columns), {"observation": m.OBSERVATION, "plane": m.PLANE, "artifact": m.ARTIFACT}[name]
        table.select("*", *[F.lit("science" if f.name == "product_type" else None).cast("string").alias(f.name) for f in whole if f.name not in table.columns]).write.orc(str(archive / "other" / name))
        spark.read.parquet(str(archive / "tables" / name)).write.orc(str(archive / "tables_orc" / name))
    (archive / "config" / "mappings.tsv").write_text("collection\tsi_namespace\nA\tn\nB\tn\n")
    sites = (archive / "config" / "sites.tsv").read_text().replace(f"{archive}/tables", f"{archive}/tables_orc")
    (archive / "config" / "sites.tsv").write_text(sites)
    out = _run(spark, archive, "duplicates", "--sites", str(archive / "config" / "sites.tsv"), "--site-tables", "--table-format", "orc")
    # The other site's record of collection A does not count.
    assert rows(_tsv(spark, out / "summary"), "collection", "num_uris", "num_duplicate_uris") == [("A", "4", "1"), ("B", "2", "1")]


def test_duplicate_command(spark, archive):
    out = _run(spark, archive, "duplicates", "A")
    assert rows(_tsv(spark, out / "uris"), "collection", "uri", "science", "n_known") == [("A", "n/1", "2", "2")]
    assert rows(_tsv(spark, out / "summary"), "num_uris", "num_duplicate_uris") == [("4", "1")]


def test_summary_command(spark, archive):
    out = _run(spark, archive, "duplicates")
    run(spark, ["summary", "--report", str(out), "--report", str(out), "--out", str(archive / "all")])
    assert rows(_tsv(spark, archive / "all"), "collection", "num_uris") == [("A", "4")]


def test_profile_and_preview_commands(spark, archive):
    out = _run(spark, archive, "profiles")
    assert rows(_tsv(spark, out / "summary"), "collection", "num_planes", "num_no_planes", "num_junk_planes") == [
        ("A", "2", "0", "1"), ("B", "0", "1", "0")]
    assert _tsv(spark, out / "types").count() == 2 and _tsv(spark, out / "no_artifacts").count() == 1
    out = _run(spark, archive, "previews", "--skip-site", "s2")
    assert rows(_tsv(spark, out / "planes"), "category", "plane_id") == [("INCONSISTENT_FOR_PREVIEW_ONLY", "11")]
    assert rows(_tsv(spark, out / "combinations"), "category", "num_planes") == [("CONSISTENT_FOR_PREVIEW_ONLY", "1")]


def test_copies_command(spark, archive):
    site = str(archive / "tables" / "inventory")
    out = _run(spark, archive, "copies", "--site", f"x={site}", "--site", f"y={site}", "n")
    assert rows(_tsv(spark, out / "merged"), "namespace", "x_count", "y_count") == [("n", "3", "3")]
    _run(spark, archive, "copies", "--site", f"x={site}", "--out", str(archive / "again"))
    run(spark, ["merge", "--counts", str(archive / "again" / "counts"), "--site", "x", "--site", "z",
                "--out", str(archive / "merged")])
    assert rows(_tsv(spark, archive / "merged"), "namespace", "x_count", "z_count") == [
        ("n", "3", None), ("q", "0", None)]


def test_usage_command(spark, archive):
    out = _run(spark, archive, "usage", "--format", "csv")
    read = lambda *p: spark.read.options(header=True, recursiveFileLookup=False).csv(str(out.joinpath(*p)))
    by_field = read("collection_instrument", "by_field")
    assert rows(by_field.where("field = 'Observation.target'"), "collection", "num_null") == [("B", "1")]
    assert read("collection", "summary_by_field").count() == 8 + 5
    assert read("collection", "summary_by_group").count() == 3
    one = _run(spark, archive, "usage", "--format", "csv", "--start", "plane.QUALITY_flag", "--out",
               str(archive / "range"))
    assert spark.read.options(header=True).csv(str(archive / "range" / "collection" / "summary_by_field")).count() == 1


def test_harvest_command(spark, archive):
    site = str(archive / "tables" / "observation")
    out = _run(spark, archive, "harvest", "--site", f"here={site}", "--collection", "A", "--source", "s/",
               "--namespace", "n", "--asof", "2024-01-15T00:00:00")
    assert rows(_tsv(spark, out / "retry_queue")) == [("1", "1", "0", "1")]
    assert rows(_tsv(spark, out / "counts_by_site")) == [("here", "1")]
    assert rows(_tsv(spark, out / "volume"), "num_files") == [("4",)]
    assert rows(_tsv(spark, out / "harvested")) == [("1",)]


def test_harvest_reads_each_table_once(spark, frame, tmp_path):
    read = {name: spark.sparkContext.accumulator(0) for name in ("observation", "skip")}

    def counted(df, name):
        counter = read[name]

        def pass_on(batches):
            for batch in batches:
                counter.add(batch.num_rows)
                yield batch

        return df.mapInArrow(pass_on, df.schema)

    at = datetime(2024, 1, 15)
    observation = frame([("1", "A", None, at), ("2", "A", at, at), ("3", "B", None, at), ("4", "A", at, datetime(2023, 1, 1))],
                        "obs_id string, collection string, meta_release timestamp_ntz, max_last_modified timestamp_ntz")
    skip = frame([(k, "Observation", "s/A", at if k % 3 else None, f"bad {k % 2}" if k % 4 else None) for k in range(20)] + [(99, "Plane", "s/A", at, "bad")],
                 "skip_id long, cname string, source string, try_after timestamp_ntz, error_message string")
    plane = frame([("p", "1")], "plane_id string, obs_id string")
    artifact = frame([("p", "n/1", 5), ("p", "m/1", 5)], "plane_id string, uri string, content_length long")
    everywhere = frame([("here", "A"), ("here", "A"), ("there", "B")], "site string, collection string")
    archive = audits.Archive(observation=observation, plane=plane, artifact=artifact)
    arguments = (everywhere, skip, "A", "s/", ["here", "there"], "n", at)
    audits.harvest_audit(audits.harvest_figures(archive, *arguments), str(tmp_path / "many"))
    archive.observation = counted(observation, "observation")
    audits.harvest_in_one_pass(archive, everywhere, counted(skip, "skip"), *arguments[2:], str(tmp_path / "one"))
    assert {name: counter.value for name, counter in read.items()} == {"observation": 4, "skip": 21}
    names = sorted(p.name for p in (tmp_path / "many").iterdir())
    assert names == sorted(p.name for p in (tmp_path / "one").iterdir()) and len(names) == 7
    for name in names:
        many, one = (_tsv(spark, tmp_path / side / name) for side in ("many", "one"))
        assert many.columns == one.columns and rows(many) == rows(one)


def test_file_commands(spark, tmp_path):
    for side, names in (("src", ["a.tex", "b.tex", "c.zip"]), ("dst", ["a.tex", "old.doc"])):
        (tmp_path / side / "P1").mkdir(parents=True)
        for name in names:
            (tmp_path / side / "P1" / name).write_text(name)
    run(spark, ["compare", "--source", str(tmp_path / "src"), "--target", str(tmp_path / "dst"),
                "--out", str(tmp_path / "diff")])
    assert rows(_tsv(spark, tmp_path / "diff")) == [
        ("P1", "a.tex", "SAME"), ("P1", "b.tex", "COPY"), ("P1", "old.doc", "STALE")]
    (tmp_path / "toc.txt").write_text("p. 3 see P10\n")
    (tmp_path / "dst" / "P2").mkdir()
    (tmp_path / "dst" / "P2" / "sub").mkdir()
    (tmp_path / "dst" / "P2" / "sub" / "a.tex").write_text("x")
    run(spark, ["listed", "--source", str(tmp_path / "dst"), "--contents", str(tmp_path / "toc.txt"), "--out", str(tmp_path / "absent")])
    assert rows(_tsv(spark, tmp_path / "absent")) == [("P2",)]
    run(spark, ["expected", "--source", str(tmp_path / "dst"), "--out", str(tmp_path / "odd")])
    assert rows(_tsv(spark, tmp_path / "odd")) == [("P1", "old.doc")]
    (tmp_path / "uploads.csv").write_text(
        "dir,name,modified,owner\nP1,a.tar,2024-01-02 00:00:00,me\nP1,b.tex,2024-01-01 00:00:00,me\n"
        "P1,poster.pdf,2024-01-03 00:00:00,me\n")
    run(spark, ["uploads", "--listing", str(tmp_path / "uploads.csv"), "--owner", "robot",
                "--out", str(tmp_path / "chosen")])
    assert rows(_tsv(spark, tmp_path / "chosen"), "name", "outcome") == [
        ("a.tar", "BUNDLE_TAKEN"), ("b.tex", "OLDER_FILE")]
