import hashlib
import os

import pytest
from pyspark.sql import functions as F

from carrel.functions import names, paths
from carrel.operators import manifest as m
from carrel.plans import transfer
from carrel.sources import files, tables

HELLO = "2cf24dba5fb0a30e26e83b2ac5b9e29e1b161e5c1fa7425e73043362938b9824"


def tree(root, **content):
    """Files by name; '__' stands for '/', a leading 'dot' for '.'."""
    for name, data in content.items():
        put(root, name, data)
    return str(root)


def put(root, path, data=b"x"):
    target = root / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_bytes(data)


def manifest_of(spark, root, pattern=None):
    return transfer.take_manifest(spark, str(root), pattern)


def test_digest_of_hello(spark, tmp_path):
    put(tmp_path, "a/hello.txt", b"hello")
    row = manifest_of(spark, tmp_path).head()
    assert (row.path, row.size, row.sha256) == ("a/hello.txt", 5, HELLO)
    assert row.source_root == str(tmp_path)
    listing = files.inventory(spark, str(tmp_path))
    md5 = files.hash_files(listing, str(tmp_path), "md5").head().md5
    assert md5 == hashlib.md5(b"hello").hexdigest()


@pytest.mark.parametrize(
    "pattern, kept",
    [
        (None, {"visible.tif", "_kept/_x", "sub/Thumbs.db.txt"}),
        (r"^(visible\.tif|\.(.*))$", {"Thumbs.db", "sub/THUMBS.DB", "_kept/_x", "sub/Thumbs.db.txt"}),
        (r"umb", {"visible.tif", ".hidden.txt", ".hidden/nested.txt", ".DS_Store", "_kept/_x", "sub/THUMBS.DB"}),
    ],
)
def test_exclusion_looks_at_every_component(spark, tmp_path, pattern, kept):
    for path in (
        "visible.tif", ".hidden.txt", ".hidden/nested.txt", ".DS_Store", "Thumbs.db",
        "sub/THUMBS.DB", "_kept/_x", "sub/Thumbs.db.txt",
    ):
        put(tmp_path, path)
    assert {r.path for r in manifest_of(spark, tmp_path, pattern).collect()} == kept


def test_empty_source_is_an_error(spark, tmp_path):
    put(tmp_path, ".only/hidden")
    with pytest.raises(ValueError, match="no files found"):
        manifest_of(spark, tmp_path)


def test_missing_root_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="No such file or directory"):
        files.walk(spark, str(tmp_path / "none")).count()


def test_linked_folder_is_not_entered(spark, tmp_path):
    put(tmp_path, "a/b")
    os.symlink(tmp_path, tmp_path / "a" / "loop")
    assert {r.path for r in files.inventory(spark, str(tmp_path)).collect()} == {"a/b"}


def destination(tmp_path, source):
    """A destination with one of each fault."""
    for path, data in source.items():
        put(tmp_path / "src", path, data)
    put(tmp_path / "dst", "same", source["same"])
    put(tmp_path / "dst", "short", b"s")
    put(tmp_path / "dst", "edited", b"E" + source["edited"][1:])
    put(tmp_path / "dst", "folder/inner", b"?")
    return tmp_path / "src", tmp_path / "dst"


SOURCE = {n: n.encode() * 9 for n in ("same", "short", "edited", "folder", "absent", "deep/er")}


def test_every_entry_gets_the_first_fault(spark, tmp_path):
    src, dst = destination(tmp_path, SOURCE)
    manifest = manifest_of(spark, src)
    report = transfer.verify_destination(spark, manifest, str(dst))
    assert {r.path: r.status for r in report.collect()} == {
        "same": "verified", "short": "size_mismatch", "edited": "checksum_mismatch",
        "folder": "not_a_file", "absent": "missing", "deep/er": "missing",
    }
    totals = {r.status: (r.files, r.bytes) for r in m.status_totals(report).collect()}
    assert totals["missing"] == (2, len(SOURCE["absent"]) + len(SOURCE["deep/er"]))
    with pytest.raises(ValueError, match="missing|mismatch|not_a_file"):
        transfer.verify_destination(spark, manifest, str(dst), strict=True)


def test_plan_copies_skips_and_reports(spark, tmp_path):
    src, dst = destination(tmp_path, SOURCE)
    manifest = manifest_of(spark, src)
    (src / "absent").unlink()
    plan = transfer.plan_transfer(spark, manifest, str(src), str(dst))
    assert {r.path: r.action for r in plan.collect()} == {
        "same": "skip", "short": "copy", "edited": "copy", "folder": "destination_not_a_file",
        "absent": "missing_source", "deep/er": "copy",
    }
    with pytest.raises(FileNotFoundError, match="missing_source|destination_not_a_file"):
        transfer.transfer(spark, manifest, str(src), str(dst))


def test_copy_resumes_where_it_stopped(spark, tmp_path):
    src, dst = tmp_path / "src", tmp_path / "dst"
    for name in "abc":
        put(src, f"d/{name}.bin", os.urandom(3000))
    os.utime(src / "d" / "a.bin", (1_000_000_000, 1_000_000_000))
    manifest = manifest_of(spark, src)
    kept = (src / "d" / "b.bin").read_bytes()
    (src / "d" / "b.bin").unlink()
    with pytest.raises(FileNotFoundError, match="missing_source: d/b.bin"):
        transfer.transfer(spark, manifest, str(src), str(dst))
    put(src, "d/b.bin", kept)
    copied = transfer.transfer(spark, manifest, str(src), str(dst)).collect()
    assert [(r.path, r.bytes, r.error) for r in copied] == [("d/b.bin", 3000, None)]
    assert transfer.transfer(spark, manifest, str(src), str(dst)).count() == 0
    transfer.verify_destination(spark, manifest, str(dst), strict=True)
    assert (dst / "d" / "a.bin").stat().st_mtime == 1_000_000_000
    assert {p.name for p in (dst / "d").iterdir()} == {"a.bin", "b.bin", "c.bin"}


def test_failed_copy_leaves_nothing_behind(spark, tmp_path):
    put(tmp_path / "src", "a", b"1")
    put(tmp_path / "src", "b/c", b"2")
    manifest = manifest_of(spark, tmp_path / "src")
    put(tmp_path / "dst", "b", b"a file where a folder is needed")
    with pytest.raises(OSError, match="b/c"):
        transfer.transfer(spark, manifest, str(tmp_path / "src"), str(tmp_path / "dst"))
    assert {p.name for p in (tmp_path / "dst").iterdir()} == {"a", "b"}


def test_names_by_extension(spark, tmp_path):
    for path in ("a.jpg", "b.JPG", ".c.jpg", "_d.jpg", "plain", "sub/e.jpg"):
        put(tmp_path, path)
    (tmp_path / "dir.jpg").mkdir()

    def listed(*extension):
        return {r.filename for r in files.list_names(spark, str(tmp_path), *extension).collect()}

    assert listed("jpg") == {"a.jpg", ".c.jpg", "_d.jpg"}
    assert listed() == {"a.jpg", "b.JPG", ".c.jpg", "_d.jpg"}


def test_keys_by_prefix_and_ending(spark):
    keys = spark.createDataFrame(
        [("data/file.wav",), ("data/file2.wav",), ("data/file.mp3",), ("data/image.png",), ("data/readme.txt",)],
        "key string",
    )

    def kept(*rule):
        return [r.key for r in keys.where(paths.key_matches(F.col("key"), *rule)).collect()]

    assert kept(" data/ ", " .wav") == ["data/file.wav", "data/file2.wav"]
    assert kept("data/f", ".MP3") == ["data/file.mp3"]
    assert len(kept(None, None)) == 5
    assert kept("DATA/", None) == []


def test_objects_below_a_prefix(spark, tmp_path):
    for path in ("data/a.wav", "data/b.WAV", "data2/c.wav", "other/d.wav", "data/x/_e.wav"):
        put(tmp_path, path)
    got = files.list_objects(spark, f"file://{tmp_path}", "data/", "wav")
    assert {r.key for r in got.collect()} == {"data/a.wav", "data/b.WAV", "data/x/_e.wav"}
    assert files.list_objects(spark, str(tmp_path), "none/").count() == 0


def test_download_by_base_name_reports_clashes(spark, tmp_path):
    for path, data in (("p/a", b"1"), ("q/a", b"2"), ("q/b", b"33")):
        put(tmp_path / "store", path, data)
    keys = files.list_objects(spark, str(tmp_path / "store"))
    put(tmp_path / "to", "b", b"older")
    got = files.download_objects(keys, str(tmp_path / "store"), str(tmp_path / "to")).collect()
    assert {(r.key, r.bytes, r.error) for r in got} == {
        ("p/a", 1, None), ("q/a", None, "p/a has the name a"), ("q/b", None, "b exists")
    }
    assert {p.name: p.read_bytes() for p in (tmp_path / "to").iterdir()} == {"a": b"1", "b": b"older"}
    assert [(r.basename, r.keys) for r in m.name_clashes(keys).collect()] == [("a", 2)]


def test_manifest_json_and_totals(spark, tmp_path):
    put(tmp_path / "src", "é ü/1", b"12")
    put(tmp_path / "src", "2", b"")
    manifest = manifest_of(spark, tmp_path / "src")
    tables.write_manifest(manifest, str(tmp_path / "json"))
    back = tables.read_manifest(spark, str(tmp_path / "json"))
    assert sorted(back.collect()) == sorted(manifest.collect())
    assert tuple(m.manifest_totals(back).head()) == (2, 2)


def test_large_files_are_lots_of_their_own(spark):
    rows = [(f"f{i}", 100) for i in range(400)] + [("big", 20_000), ("huge", 40_000)]
    spread = files._spread(spark.createDataFrame(rows, "path string, size bigint"))
    loads = spread.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.sum("size").alias("n"), F.collect_set("path").alias("f"))
    homes = {name: r.n for r in loads.collect() for name in r.f}
    assert len(homes) == 402 and spread.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert len(loads.collect()) > 1


def test_repeated_checksums_must_agree(spark):
    files_ = spark.createDataFrame([("a", "1")], "file string, md5 string")
    twice = spark.createDataFrame([("a", "1"), ("a", "1")], "file string, checksum string")
    assert m.check_declared(files_, twice).count() == 1
    other = spark.createDataFrame([("a", "1"), ("a", "2")], "file string, checksum string")
    with pytest.raises(Exception, match="several checksums for a"):
        m.check_declared(files_, other).collect()


def test_declared_checksum_is_only_marked(spark):
    files_ = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "file string, md5 string")
    catalog = spark.createDataFrame([("a", "1"), ("b", "x")], "file string, checksum string")
    got = {r.file: r.checksum_ok for r in m.check_declared(files_, catalog).collect()}
    assert got == {"a": True, "b": False, "c": False}


@pytest.mark.parametrize(
    "header, name",
    [
        ('attachment; filename="got.tgz"', "got.tgz"),
        ("attachment; filename=got.tgz", "file"),
        ('inline; attachment; filename="got.tgz"', "file"),
        ('attachment; filename=""', "file"),
        (None, "file"),
    ],
)
def test_download_name(spark, header, name):
    df = spark.createDataFrame([(header,)], "h string")
    assert df.select(names.download_name(F.col("h"), F.lit("file"))).head()[0] == name


def test_volume_prefix(spark):
    df = spark.createDataFrame([("/SRV/archive4/x",), ("/srv/da",)], "p string")
    rows = df.select(paths.under_volume(F.col("p"), "/srv/archive")).collect()
    assert [r[0] for r in rows] == [True, False]


def test_files_are_written_out_of_arrow_batches(spark, tmp_path):
    """No pandas copy of a batch's bytes; a folder is made once by a task."""
    rows = [("a/x", b"one"), ("a/y", b""), ("z", b"\x00\xff")]
    written = files.write_files(spark.createDataFrame(rows, "path string, content binary").coalesce(1), str(tmp_path))
    plan = written._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "MapInPandas" not in plan
    assert sorted(map(tuple, written.collect())) == [("a/x", 3), ("a/y", 0), ("z", 2)]
    assert [(tmp_path / path).read_bytes() for path, _ in rows] == [data for _, data in rows]


def test_a_written_file_has_its_room_before_it_replaces_another(tmp_path, monkeypatch):
    local, taken = files.arrow_fs.LocalFileSystem(), []
    take = os.posix_fallocate

    def noted(descriptor, start, size):
        taken.append((start, size))
        take(descriptor, start, size)

    monkeypatch.setattr(os, "posix_fallocate", noted)
    for data in (b"first", b"second one", b""):
        files.publish_bytes(local, str(tmp_path / "f"), [data], set(), len(data))
        assert (tmp_path / "f").read_bytes() == data
    assert taken == [(0, 5), (0, 10)] and os.listdir(tmp_path) == ["f"]

    def refused(*args):
        raise OSError("not here")

    monkeypatch.setattr(os, "posix_fallocate", refused)
    files.publish_bytes(local, str(tmp_path / "f"), [b"third"], set(), 5)
    assert (tmp_path / "f").read_bytes() == b"third"
