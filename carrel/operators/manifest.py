"""Manifests: building, comparing, planning copies, counting."""

from pyspark.sql import functions as F

from carrel.functions import names, paths

VERIFIED = "verified"


def exclude_paths(files, pattern=None):
    return files.where(~paths.is_excluded(F.col("path"), pattern))


def build_manifest(files, source_root, pattern=None):
    """Manifest rows of (path, size, sha256) files that are not excluded."""
    return exclude_paths(files, pattern).select(
        F.lit(source_root).alias("source_root"), "path", "size", "sha256"
    )


def manifest_totals(manifest):
    return manifest.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")
    )


def require_files(manifest):
    """An empty manifest is an error."""
    if manifest.isEmpty():
        raise ValueError("no files found in source")


def compare(manifest, actual):
    """Manifest entries next to what is at the destination.

    ``actual``: path, kind ('file' or other), size and optionally sha256. Adds
    ``status`` by size alone where the destination has no hash column yet, in
    which case a size match is ``size_ok``.
    """
    hashed = "sha256" in actual.columns
    there = actual.select(
        "path",
        F.col("kind").alias("_kind"),
        F.col("size").alias("_size"),
        *([F.col("sha256").alias("_sha256")] if hashed else []),
    )
    status = (
        F.when(F.col("_kind").isNull(), "missing")
        .when(F.col("_kind") != "file", "not_a_file")
        .when(F.col("_size") != F.col("size"), "size_mismatch")
    )
    if hashed:
        same = F.col("_sha256") == F.col("sha256")
        status = status.when(same, VERIFIED).otherwise("checksum_mismatch")
    else:
        status = status.otherwise("size_ok")
    joined = manifest.join(there, "path", "left").withColumn("status", status)
    return joined.drop("_kind", "_size", "_sha256")


def verify_manifest(manifest, actual, strict=False):
    """A status for every manifest entry.

    The checks run in the order missing, not a file, size, checksum, and the
    first that fails gives the status. ``strict`` raises on any failure.
    """
    report = compare(manifest, actual).select("path", "status", "size", "sha256")
    if strict:
        bad = report.where(F.col("status") != VERIFIED).select("path", "status").head(1)
        if bad:
            raise ValueError(f"{bad[0]['status']}: {bad[0]['path']}")
    return report


def copy_plan(manifest, destination, source):
    """``action`` per manifest entry: skip, copy, missing_source or an error kind.

    An entry whose destination file is equal in size and hash is skipped
    without looking at the source; a destination that is not a file is an
    error before the source is looked at.
    """
    state = compare(manifest, destination).withColumnRenamed("status", "_state")
    origin = source.select("path", F.col("kind").alias("_source_kind"))
    action = (
        F.when(F.col("_state") == VERIFIED, "skip")
        .when(F.col("_state") == "not_a_file", "destination_not_a_file")
        .when(F.col("_source_kind").isNull(), "missing_source")
        .when(F.col("_source_kind") != "file", "source_not_a_file")
        .otherwise("copy")
    )
    return (
        state.join(origin, "path", "left")
        .select("path", "size", "sha256", action.alias("action"))
    )


def status_totals(df, by="status"):
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")
    )


def check_declared(files, catalog, key="file"):
    """Downloaded files with their declared checksum; a mismatch is only marked.

    A catalog may list a key several times only with one and the same checksum;
    different ones are an error, as it would be open which of them holds.
    Without a declared checksum nothing is confirmed.
    """
    given = catalog.groupBy(key).agg(F.min("checksum").alias("declared_md5"), F.max("checksum").alias("_other"))
    unclear = F.raise_error(F.concat(F.lit("several checksums for "), F.col(key))).cast("string")
    declared = given.select(
        key, F.when(F.col("_other") != F.col("declared_md5"), unclear).otherwise(F.col("declared_md5")).alias("declared_md5")
    )
    return files.join(declared, key, "left").withColumn(
        "checksum_ok", F.coalesce(F.col("md5") == F.col("declared_md5"), F.lit(False))
    )


def name_clashes(keys, key="key"):
    """Base names that several keys share, with how often."""
    return (
        keys.groupBy(names.key_basename(F.col(key)).alias("basename"))
        .agg(F.count(F.lit(1)).alias("keys"))
        .where("keys > 1")
    )
