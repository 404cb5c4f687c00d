"""Session set-up and the shared folder for staged tables."""

import importlib
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cores="*", shuffle_partitions=8, app="carrel"):
    """A session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_root(spark):
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="carrel-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_folder(spark, label):
    """A fresh, not yet existing folder name below the shared root."""
    return f"{shared_root(spark)}/carrel/{label}-{uuid.uuid4().hex}"


def stage(df, label):
    """Write ``df`` once to the shared folder and read it back.

    Used after external calls and before a table is read several times: a
    lost executor or a second action then re-reads files instead of calling
    or parsing again.
    """
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


_shipped = set()


def ship_package(spark, *packages):
    """Send packages to the workers, for a cluster that does not have them installed."""
    context = spark.sparkContext
    if (context.applicationId, packages) in _shipped:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="carrel-"), "-".join(packages) + ".zip")
    with zipfile.ZipFile(archive, "w") as out:
        for package in packages:
            root = os.path.dirname(importlib.import_module(package).__file__)
            for folder, _, files in os.walk(root):
                for name in files:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _shipped.add((context.applicationId, packages))
