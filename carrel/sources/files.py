"""Files and objects: complete listings, hashing, copying.

Spark's own file listing leaves out every name that starts with '_' or '.',
which an inventory must not do. So directories are listed by tasks, one level
per step, through ``pyarrow.fs``, which serves mounts and object stores alike.
Bytes are read in chunks, so the size of one file does not matter.
"""

import contextlib
import hashlib
import itertools
import os
import posixpath
import uuid

import pandas as pd
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carrel.functions import names, paths
from carrel.session import new_folder, stage
from carrel.sources.keyranges import walk_keys

CHUNK_BYTES = 8 * 1024 * 1024
ROWS_PER_BATCH = 10_000
TASK_BYTES = 1024 * 1024 * 1024

LISTING = "path string, kind string, size bigint, modified timestamp"
MANIFEST = "source_root string, path string, size bigint, sha256 string"
COPIED = "path string, bytes bigint, sha256 string, error string"


def open_root(root):
    """(filesystem, base path) of a mount path or URI; runs inside tasks."""
    if "://" not in root and not root.startswith("file:"):
        return arrow_fs.LocalFileSystem(), root.rstrip("/") or "/"
    uri = root.replace("s3a://", "s3://", 1)
    if uri.startswith("file:"):
        return arrow_fs.LocalFileSystem(), "/" + uri[len("file:"):].strip("/")
    filesystem, base = arrow_fs.FileSystem.from_uri(uri)
    return filesystem, base.rstrip("/")


def _relevant(folder, prefix):
    return folder.startswith(prefix) or prefix.startswith(folder + "/")


def _scan_mount(folder):
    """(name, kind, size, modified) of a mounted folder, one entry at a time."""
    with os.scandir(folder) as entries:
        for entry in entries:
            if entry.is_dir():
                # A linked folder is listed but not entered.
                yield entry.name, "link" if entry.is_symlink() else "dir", None, None
            elif entry.is_file():
                stat = entry.stat()
                yield entry.name, "file", stat.st_size, stat.st_mtime_ns // 1000
            else:
                yield entry.name, "other", None, None


def _scan_store(filesystem, folder):
    kinds = {arrow_fs.FileType.File: "file", arrow_fs.FileType.Directory: "dir"}
    for info in filesystem.get_file_info(arrow_fs.FileSelector(folder)):
        kind = kinds.get(info.type, "other")
        if kind == "file":
            yield info.base_name, kind, info.size, info.mtime_ns // 1000
        else:
            yield info.base_name, kind, None, None


def _list_folders(root, prefix, missing_ok):
    """Task body: the direct children of each folder in the batch."""

    def children(filesystem, base, folder):
        at = posixpath.join(base, folder) if folder else base
        if not folder and missing_ok:
            if filesystem.get_file_info(at).type == arrow_fs.FileType.NotFound:
                return
        if isinstance(filesystem, arrow_fs.LocalFileSystem):
            found = _scan_mount(at)
        else:
            found = _scan_store(filesystem, at)
        for name, kind, size, modified in found:
            path = posixpath.join(folder, name)
            if _relevant(path, prefix) if kind in ("dir", "link") else path.startswith(prefix):
                yield path, kind, size, modified

    # Times in microseconds since the epoch.
    types = [pa.string(), pa.string(), pa.int64(), pa.timestamp("us", tz="UTC")]

    def run(batches):
        filesystem, base = open_root(root)
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                rows = children(filesystem, base, folder)
                while part := list(itertools.islice(rows, ROWS_PER_BATCH)):
                    columns = [pa.array(c, t) for c, t in zip(zip(*part), types)]
                    yield pa.RecordBatch.from_arrays(
                        columns, names=["path", "kind", "size", "modified"]
                    )

    return run


def walk(spark, root, prefix="", recursive=True, missing_ok=False):
    """Everything below ``root`` as (path relative to it, kind, size, modified).

    One job per directory level; each level is written to the shared folder
    and feeds the next one. A missing root fails unless ``missing_ok``.
    """
    folder = new_folder(spark, "listing")
    width = spark.sparkContext.defaultParallelism
    # AQE would merge these few small rows into one listing task, hence the
    # explicit number of partitions.
    level, frontier = 0, spark.createDataFrame([("",)], "path string").repartition(1)
    while True:
        target = f"{folder}/level={level:04d}"
        frontier.mapInArrow(_list_folders(root, prefix, missing_ok), LISTING).write.parquet(target)
        listed = spark.read.schema(LISTING).parquet(target)
        folders = listed.where("kind = 'dir'").select("path")
        if not recursive or folders.isEmpty():
            break
        level, frontier = level + 1, folders.repartition(width, "path")
    return spark.read.schema(LISTING).parquet(*[f"{folder}/level={i:04d}" for i in range(level + 1)])


def existing(paths_, root):
    """Those of the given paths (column ``path``) that are there below ``root``, without listing it."""

    def run(batches):
        filesystem, base = open_root(root)
        for batch in batches:
            full = [posixpath.join(base, path) for path in batch["path"]]
            there = [info.type != arrow_fs.FileType.NotFound for info in filesystem.get_file_info(full)]
            yield batch[there]

    return paths_.select("path").mapInPandas(run, "path string")


def inventory(spark, root):
    """Regular files below ``root`` with their path relative to it."""
    return walk(spark, root).where("kind = 'file'").drop("kind")


def list_names(spark, folder, extension="*"):
    """Names of the regular files directly in a folder, by extension."""
    files = walk(spark, folder, recursive=False).where("kind = 'file'")
    return files.where(paths.has_extension(F.col("path"), extension)).select(
        F.col("path").alias("filename")
    )


def list_objects(spark, uri, prefix=None, extension=None, lister_factory=None):
    """Object keys below ``uri`` by prefix and, without regard to case, ending.

    Folders that cannot hold the prefix are never listed. With a lister of the
    store's pages (see ``walk_keys``) its flat key space is listed by ranges of
    keys instead, by many tasks; its keys are then relative to ``uri``.
    """
    prefix = (prefix or "").strip()
    if lister_factory:
        files = walk_keys(spark, lister_factory, prefix)
    else:
        files = walk(spark, uri.strip(), prefix=prefix).where("kind = 'file'")
    return files.where(paths.key_matches(F.col("path"), prefix, extension)).select(
        F.col("path").alias("key"), "size", "modified"
    )


def _spread(files, size="size"):
    """Files over as many tasks as their bytes ask for, not as their rows do.

    Files are gathered into lots of about ``TASK_BYTES``; one that is larger is
    a lot of its own. The running sums that cut the lots are over groups of
    files by name, so none of them spans the listing.
    """
    files = stage(files, "spread")
    spark = files.sparkSession
    total, rows = files.agg(F.coalesce(F.sum(size), F.lit(0)), F.count(F.lit(1))).head()
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    lot = max(1, min(TASK_BYTES, total // (4 * tasks)))
    group = F.pmod(F.xxhash64("path"), F.lit(max(1, rows // 10_000)))
    before = Window.partitionBy("_group").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    cut = files.withColumn("_group", group).withColumn(
        "_lot", F.floor(F.coalesce(F.sum(size).over(before), F.lit(0)) / F.lit(lot))
    )
    return cut.repartition(tasks, "_group", "_lot").drop("_group", "_lot")


def _read_chunks(filesystem, path):
    with filesystem.open_input_stream(path) as stream:
        while chunk := stream.read(CHUNK_BYTES):
            yield chunk


def hash_files(files, root, algorithm="sha256", needed=None):
    """Adds the hex digest of each file's bytes, null where not ``needed``.

    ``needed`` is a boolean column; files that are not needed are not opened.
    """
    needed = F.lit(True) if needed is None else F.coalesce(needed, F.lit(False))
    marked = _spread(files).withColumn("_needed", needed)
    schema = T.StructType(files.schema.fields + [T.StructField(algorithm, T.StringType())])
    columns = files.columns

    def run(batches):
        filesystem, base = open_root(root)

        def digest(path):
            state = hashlib.new(algorithm)
            for chunk in _read_chunks(filesystem, posixpath.join(base, path)):
                state.update(chunk)
            return state.hexdigest()

        for batch in batches:
            digests = [digest(p) if n else None for p, n in zip(batch["path"], batch["_needed"])]
            yield batch[columns].assign(**{algorithm: digests})

    return marked.mapInPandas(run, schema)


def hashed_inventory(spark, root, pattern=None):
    """Manifest of ``root``: excluded paths are dropped before any file is read."""
    files = inventory(spark, root).where(~paths.is_excluded(F.col("path"), pattern))
    return hash_files(files.select("path", "size"), root).select(
        F.lit(root).alias("source_root"), "path", "size", "sha256"
    )


def _staged_stream(filesystem, staged, size):
    """Where the bytes of a staged file go; on a mount its room is taken first if its ``size`` is known.

    A file system that allocates late would do so when the file replaces
    another one, and hold the folder for all tasks meanwhile.
    """
    if not size or not isinstance(filesystem, arrow_fs.LocalFileSystem):
        return filesystem.open_output_stream(staged)
    out = open(staged, "wb")
    # Not every mount can; what lacks room fails as it is written.
    with contextlib.suppress(OSError):
        os.posix_fallocate(out.fileno(), 0, size)
    return out


def publish_bytes(filesystem, target, chunks, made=None, size=None):
    """Write under a temporary name, then rename: no reader sees half a file.

    ``made`` is a set of folders that are there, which a task keeps for its files;
    ``size`` is that of all chunks, where it is known.
    """
    folder, name = posixpath.split(target)
    if made is None or folder not in made:
        filesystem.create_dir(folder, recursive=True)
        if made is not None:
            made.add(folder)
    staged = posixpath.join(folder, f".{name}.{uuid.uuid4().hex}.part")
    try:
        with _staged_stream(filesystem, staged, size) as out:
            for chunk in chunks:
                out.write(chunk)
        filesystem.move(staged, target)
    except BaseException:
        if filesystem.get_file_info(staged).is_file:
            filesystem.delete_file(staged)
        raise


RANGE_BYTES = 256 * 1024 * 1024


def _staged_at(filesystem, origin, copied):
    """Where a file is put together: its name says which state of the source it is of."""
    info = filesystem.get_file_info(origin)
    state = hashlib.md5(f"{info.size}:{info.mtime_ns}".encode()).hexdigest()[:16]
    folder, name = posixpath.split(copied)
    return posixpath.join(folder, f".{name}.{state}.ranges")


def copy_ranges(files, source_root, target_root, range_bytes=RANGE_BYTES):
    """Copy files by ranges of bytes, each by whichever task takes it, into ``.<name>.<state>.ranges/data``.

    Returns one row per range: path, part, sha256 of its bytes, ``kept`` (it was
    there already) and error. A range is noted by a file of its own when its
    bytes are written; a range that is noted is not copied again, so a copy
    that broke off goes on with what is missing. If the source has changed
    meanwhile, all of it is copied anew. The target must be a mount.
    """
    parts = F.ceil(F.col("size") / range_bytes).cast("int")
    ranges = files.select("path", "size", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    ranges = ranges.repartition(max(files.sparkSession.sparkContext.defaultParallelism, 1), "path", "part")

    def run(batches):
        source, source_base = open_root(source_root)
        target, target_base = open_root(target_root)

        def copy(path, part):
            origin = posixpath.join(source_base, path)
            folder = _staged_at(source, origin, posixpath.join(target_base, path))
            note = os.path.join(folder, f"{part:08d}")
            if os.path.exists(note):
                with open(note) as noted:
                    return noted.read(), True
            os.makedirs(folder, exist_ok=True)
            state, at, left = hashlib.sha256(), part * range_bytes, range_bytes
            fd = os.open(os.path.join(folder, "data"), os.O_WRONLY | os.O_CREAT, 0o644)
            try:
                with source.open_input_file(origin) as data:
                    data.seek(at)
                    while left and (chunk := data.read(min(CHUNK_BYTES, left))):
                        view = memoryview(chunk)
                        while view:
                            written = os.pwrite(fd, view, at)
                            at, view = at + written, view[written:]
                        state.update(chunk)
                        left -= len(chunk)
                os.fsync(fd)
            finally:
                os.close(fd)
            # Written aside and renamed, so that a note is whole or not there.
            aside = f"{note}.{uuid.uuid4().hex}"
            with open(aside, "w") as out:
                out.write(state.hexdigest())
            os.rename(aside, note)
            return state.hexdigest(), False

        for batch in batches:
            rows = []
            for path, part in zip(batch["path"], batch["part"]):
                try:
                    rows.append((path, part, *copy(path, part), None))
                except OSError as error:
                    rows.append((path, part, None, False, str(error)))
            yield pd.DataFrame(rows, columns=["path", "part", "sha256", "kept", "error"])

    return ranges.mapInPandas(run, "path string, part int, sha256 string, kept boolean, error string")


def _finish_ranges(files, source_root, target_root):
    """Publish files whose ranges are all there: one pass over the bytes for the digest, then a rename."""

    def run(batches):
        source, source_base = open_root(source_root)
        _, target_base = open_root(target_root)

        def finish(path, size, error):
            if error:
                return path, None, None, error
            origin, copied = posixpath.join(source_base, path), posixpath.join(target_base, path)
            try:
                folder = _staged_at(source, origin, copied)
                data, state = os.path.join(folder, "data"), hashlib.sha256()
                if os.path.exists(data):
                    if os.path.getsize(data) != size:
                        return path, None, None, f"{path} has changed while it was copied"
                    info = source.get_file_info(origin)
                    os.utime(data, ns=(info.mtime_ns, info.mtime_ns))
                    os.rename(data, copied)
                # Else a try before this one has come as far as the rename.
                with open(copied, "rb") as written:
                    while chunk := written.read(CHUNK_BYTES):
                        state.update(chunk)
                if os.path.isdir(folder):
                    for name in os.listdir(folder):
                        os.remove(os.path.join(folder, name))
                    os.rmdir(folder)
            except OSError as failure:
                return path, None, None, str(failure)
            return path, size, state.hexdigest(), None

        for batch in batches:
            rows = [finish(*r) for r in zip(batch["path"], batch["size"], batch["error"])]
            yield pd.DataFrame(rows, columns=["path", "bytes", "sha256", "error"]).astype({"bytes": "Int64"})

    return _spread(files).mapInPandas(run, COPIED)


def copy_files(plan, source_root, target_root, range_bytes=RANGE_BYTES):
    """Copy the entries whose ``action`` is 'copy'; one result row each.

    A file that cannot be copied gives a row with its error. The digest is of
    the bytes that were written. Run it once per plan (write the result). To a
    mount, files larger than ``range_bytes`` are copied by ranges, each of a
    task, see ``copy_ranges``.
    """
    todo = plan.where(F.col("action") == "copy").select("path", "size")
    if not isinstance(open_root(target_root)[0], arrow_fs.LocalFileSystem):
        return _copy_whole(todo, source_root, target_root)
    todo = stage(todo, "to-copy")
    large = todo.where(F.col("size") > range_bytes)
    small = _copy_whole(todo.where(~(F.col("size") > range_bytes) | F.col("size").isNull()), source_root, target_root)
    if large.isEmpty():
        return small
    ranges = stage(copy_ranges(large, source_root, target_root, range_bytes), "copied-ranges")
    faults = ranges.groupBy("path").agg(F.min("error").alias("error"))
    return small.unionByName(_finish_ranges(large.join(faults, "path"), source_root, target_root))


def _copy_whole(todo, source_root, target_root):
    """Copy files, each by one task."""

    def run(batches):
        source, source_base = open_root(source_root)
        target, target_base = open_root(target_root)

        def copy(path):
            state, size = hashlib.sha256(), 0

            def chunks():
                nonlocal size
                for chunk in _read_chunks(source, origin):
                    state.update(chunk)
                    size += len(chunk)
                    yield chunk

            origin = posixpath.join(source_base, path)
            copied = posixpath.join(target_base, path)
            try:
                publish_bytes(target, copied, chunks())
                if isinstance(target, arrow_fs.LocalFileSystem) and isinstance(
                    source, arrow_fs.LocalFileSystem
                ):
                    stat = os.stat(origin)
                    os.utime(copied, ns=(stat.st_atime_ns, stat.st_mtime_ns))
            except OSError as error:
                return path, None, None, str(error)
            return path, size, state.hexdigest(), None

        for batch in batches:
            rows = [copy(path) for path in batch["path"]]
            yield pd.DataFrame(rows, columns=["path", "bytes", "sha256", "error"]).astype(
                {"bytes": "Int64"}
            )

    return _spread(todo).mapInPandas(run, COPIED)


def download_objects(keys, uri, target_root):
    """Copy objects into one folder under their base name.

    Of keys that share a base name the first in the order of keys is copied,
    the others are reported with an error. A file that is there already is
    never replaced: its key is reported as well.
    """
    base = names.key_basename(F.col("key"))
    firsts = keys.groupBy(base.alias("basename")).agg(F.min("key").alias("_first"))
    marked = keys.withColumn("basename", base).join(firsts, "basename")

    def run(batches):
        source, source_base = open_root(uri)
        target, target_base = open_root(target_root)

        def fetch(key, name, first):
            if key != first:
                return key, name, None, f"{first} has the name {name}"
            if target.get_file_info(posixpath.join(target_base, name)).type != arrow_fs.FileType.NotFound:
                return key, name, None, f"{name} exists"
            origin = posixpath.join(source_base, key)
            size = 0

            def chunks():
                nonlocal size
                for chunk in _read_chunks(source, origin):
                    size += len(chunk)
                    yield chunk

            try:
                publish_bytes(target, posixpath.join(target_base, name), chunks())
            except OSError as error:
                return key, name, None, str(error)
            return key, name, size, None

        for batch in batches:
            rows = [fetch(*r) for r in zip(batch["key"], batch["basename"], batch["_first"])]
            yield pd.DataFrame(rows, columns=["key", "filename", "bytes", "error"]).astype(
                {"bytes": "Int64"}
            )

    spread = marked.withColumn("path", F.col("key"))
    return _spread(spread).mapInPandas(
        run, "key string, filename string, bytes bigint, error string"
    )


def write_files(df, root, path="path", content="content"):
    """One file per row; returns (path, size) of what was written.

    A row's bytes are taken out of the Arrow batch one at a time, so a task
    holds a batch once and one file.
    """

    def run(batches):
        filesystem, base = open_root(root)
        made = set()
        for batch in batches:
            names, contents, sizes = batch.column(0), batch.column(1), []
            for name, data in zip(names, contents):
                whole = bytes(data.as_py())
                publish_bytes(filesystem, posixpath.join(base, name.as_py()), [whole], made, len(whole))
                sizes.append(len(whole))
            yield pa.RecordBatch.from_arrays([names, pa.array(sizes, pa.int64())], names=["path", "size"])

    return df.select(path, content).mapInArrow(run, "path string, size bigint")
