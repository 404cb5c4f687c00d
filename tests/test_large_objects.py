import bisect
import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from carrel.sources import files
from carrel.sources.keyranges import split_rest, walk_keys


class Store:
    """Pages of a key space in memory; notes each page that it gives."""

    def __init__(self, keys, notes=None):
        self.keys, self.notes = sorted(keys), notes

    def page(self, prefix, after, limit):
        at = bisect.bisect_right(self.keys, after) if after is not None else 0
        at = max(at, bisect.bisect_left(self.keys, prefix))
        rows = [(k, len(k), 0) for k in self.keys[at : at + limit] if k.startswith(prefix)]
        if self.notes:
            with open(os.path.join(self.notes, str(os.getpid())), "a") as out:
                out.write(f"{len(rows)}\n")
        return rows


def keys_of(kind, n):
    draw = random.Random(n)
    if kind == "numbers":
        return [f"scans/2024/page-{i:07d}.tif" for i in range(n)]
    if kind == "words":
        return list({"".join(draw.choice("abcdefgé💡 ~") for _ in range(draw.randrange(1, 12))) for _ in range(n)})
    if kind == "nested":
        return [f"a/{'x' * (i % 50)}/{i}" for i in range(n)]
    return [f"{hashlib.md5(str(i).encode()).hexdigest()}.jpg" for i in range(n)]


@pytest.mark.parametrize("kind", ["numbers", "words", "nested", "hashes"])
def test_ranges_leave_nothing_out(spark, tmp_path, kind):
    keys = keys_of(kind, 2000)
    found = walk_keys(spark, lambda: Store(keys, str(tmp_path)), pages=2, page=100, fan=8)
    assert sorted(r.path for r in found.collect()) == sorted(keys)


def test_many_tasks_list_a_flat_prefix(spark):
    keys = keys_of("hashes", 10_000) + [f"other-{i}" for i in range(100)]
    listed = files.list_objects(spark, "s3://bucket", "a", ".JPG", lister_factory=lambda: Store(keys))
    assert sorted(r.key for r in listed.collect()) == sorted(k for k in keys if k.startswith("a"))
    # Rows of a step lie in a part file for each range that had any.
    every = walk_keys(spark, lambda: Store(keys), pages=2, page=100, fan=16)
    tasks = every.groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(tasks) > 20 and max(r["count"] for r in tasks) <= 3 * 200
    assert walk_keys(spark, lambda: Store([]), "x").count() == 0


def test_split_rest_is_a_partition():
    for seen, upto in ((["a", "b"], None), (["k-100", "k-199"], "k-9"), (["x", "x"], "y"), (["é", "ü"], None), (["~~~~~~~~", "~~~~~~~~~"], None)):
        ranges = split_rest(seen, upto, 8)
        assert ranges[0][0] == seen[-1] and ranges[-1][1] == upto
        assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))
        inner = [a for a, _ in ranges]
        assert inner == sorted(set(inner)) and (upto is None or inner[-1] < upto)


def test_a_large_file_is_copied_by_ranges_and_resumed(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    (source / "deep").mkdir(parents=True)
    target.mkdir()
    data = random.Random(3).randbytes(20_000)
    (source / "deep" / "large.bin").write_bytes(data)
    (source / "small.bin").write_bytes(b"s" * 10)
    plan = spark.createDataFrame(
        [("deep/large.bin", 20_000, "copy"), ("small.bin", 10, "copy"), ("gone.bin", 5_000, "copy"), ("x", 1, "skip")], "path string, size long, action string"
    )
    large = plan.where("path = 'deep/large.bin'").select("path", "size")
    first = files.copy_ranges(large, str(source), str(target), 1000).collect()
    assert len(first) == 20 and not any(r.kept for r in first)
    assert {r.part: r.sha256 for r in first} == {i: hashlib.sha256(data[i * 1000 : i * 1000 + 1000]).hexdigest() for i in range(20)}
    assert files.copy_ranges(large, str(source), str(target), 1000).select(F.spark_partition_id()).distinct().count() > 1
    # A range is lost: its note is missing and its bytes are not right.
    (folder,) = (target / "deep").iterdir()
    (folder / "00000007").unlink()
    with open(folder / "data", "r+b") as out:
        out.seek(7_000)
        out.write(b"\0" * 1000)
    again = files.copy_ranges(large, str(source), str(target), 1000).collect()
    assert {r.part for r in again if not r.kept} == {7}
    assert not (target / "deep" / "large.bin").exists()

    done = {r.path: r for r in files.copy_files(plan, str(source), str(target), 1000).collect()}
    assert (done["deep/large.bin"].bytes, done["deep/large.bin"].sha256) == (20_000, hashlib.sha256(data).hexdigest())
    assert done["small.bin"].bytes == 10 and done["gone.bin"].error and "x" not in done
    assert (target / "deep" / "large.bin").read_bytes() == data
    assert [p.name for p in (target / "deep").iterdir()] == ["large.bin"]
    assert os.stat(target / "deep" / "large.bin").st_mtime_ns == os.stat(source / "deep" / "large.bin").st_mtime_ns


def test_a_source_that_changed_is_copied_anew(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    target.mkdir()
    (source / "f").write_bytes(b"a" * 3000)
    plan = spark.createDataFrame([("f", 3000, "copy")], "path string, size long, action string")
    files.copy_ranges(plan, str(source), str(target), 1000).collect()
    (source / "f").write_bytes(b"b" * 3000)
    os.utime(source / "f", ns=(1, 1))
    row = files.copy_files(plan, str(source), str(target), 1000).head()
    assert row.sha256 == hashlib.sha256(b"b" * 3000).hexdigest() and (target / "f").read_bytes() == b"b" * 3000
