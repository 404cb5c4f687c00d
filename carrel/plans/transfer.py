"""File manifest and transfer: inventory, plan, copy, verify.

A file is read only where size alone cannot decide.
"""

from pyspark.sql import functions as F

from carrel.operators import manifest as m
from carrel.session import stage
from carrel.sources.files import copy_files, hash_files, hashed_inventory, walk


def take_manifest(spark, source_root, pattern=None):
    """Manifest of a source, written once; an empty one is an error."""
    manifest = stage(hashed_inventory(spark, source_root, pattern), "manifest")
    m.require_files(manifest)
    return manifest


def destination_state(spark, manifest, root):
    """What is at the destination, hashed only where the size is as expected."""
    there = walk(spark, root, missing_ok=True).select("path", "kind", "size")
    candidates = (
        manifest.select("path", "size")
        .join(there.where("kind = 'file'"), ["path", "size"])
        .select("path", "size")
    )
    digests = hash_files(stage(candidates, "same-size"), root).select("path", "sha256")
    return stage(there.join(digests, "path", "left"), "destination")


def plan_transfer(spark, manifest, source_root, target_root):
    """What to skip and what to copy; the basis of a first run and of a resume."""
    destination = destination_state(spark, manifest, target_root)
    source = walk(spark, source_root).select("path", "kind")
    return stage(m.copy_plan(manifest, destination, source), "copy-plan")


def transfer(spark, manifest, source_root, target_root):
    """Copy what is missing or different; returns one row per copied file."""
    plan = plan_transfer(spark, manifest, source_root, target_root)
    bad = plan.where(~F.col("action").isin("skip", "copy")).select("action", "path").head(1)
    copied = stage(copy_files(plan, source_root, target_root), "copied")
    if bad:
        raise FileNotFoundError(f"{bad[0]['action']}: {bad[0]['path']}")
    failed = copied.where("error is not null").select("path", "error").head(1)
    if failed:
        raise OSError(f"{failed[0]['path']}: {failed[0]['error']}")
    return copied


def verify_destination(spark, manifest, root, strict=False):
    """A status per manifest entry against the files below ``root``."""
    return m.verify_manifest(manifest, destination_state(spark, manifest, root), strict)
