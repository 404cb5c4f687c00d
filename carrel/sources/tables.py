"""Stage tables: CSV, JSON manifests, reports, shards, run snapshots."""

import re

from pyspark.sql import functions as F

from carrel import schemas
from carrel.functions import names
from carrel.operators.reconcile import in_reading_order
from carrel.sources.csvrecords import csv_records, parsed
from carrel.sources.files import MANIFEST
from carrel.sources.versions import Versions, new_data

CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark, path, schema):
    """CSV with a header; an empty field is the empty string.

    Fields may hold line breaks; a file is read by as many tasks as it has
    splits (``csv_records``).
    """
    ddl = schema if isinstance(schema, str) else schema.toDDL()
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    return parsed(csv_records(spark, path), ddl, options).na.fill("")


def write_csv(df, path, mode="errorifexists"):
    """CSV with a header, also for zero rows."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_stage(df, path, headings, mode="errorifexists"):
    """A stage table under its export headings."""
    write_csv(schemas.with_headings(df, headings), path, mode)


def read_stage(spark, path, headings):
    """A stage table back under the names used inside the library."""
    table = read_csv(spark, path, schemas.strings_of(headings))
    return table.toDF(*headings)


def write_manifest(manifest, path):
    """One JSON object per entry and line."""
    manifest.write.json(path)


def read_manifest(spark, path):
    return spark.read.schema(MANIFEST).json(path)


def write_report(lines, path):
    """Report rows as text; the part files in name order are the report."""
    in_reading_order(lines).write.text(path)


def write_shards(df, path, record_id="record_id"):
    """Records under ``shard`` = the first two characters of their id.

    Range partitioning on shard and id cuts a large shard into several files
    and keeps a small one in few.
    """
    (
        df.withColumn("shard", names.shard_key(F.col(record_id)))
        .repartitionByRange("shard", record_id)
        .write.partitionBy("shard")
        .parquet(path)
    )


def _run(spark, root, run_id):
    """A run's tables; its id becomes a folder name and must be a plain word."""
    if not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError(f"not a plain name: {run_id!r}")
    return Versions(spark, f"{root}/run_id={run_id}")


def publish_run(tables, root, run_id):
    """Replace these stage tables of a run, and nothing else, at once; also by no rows.

    All tables are written aside; then one switch makes them the run's. A reader
    that began before it goes on with the old rows, and a writer that dies
    leaves them as they are. ``tables``: frames by stage name.
    """
    spark = next(iter(tables.values())).sparkSession
    run, written = _run(spark, root, run_id), {}
    for name, df in tables.items():
        written[name] = new_data(name)
        df.drop("run_id").write.parquet(f"{run.root}/{written[name]}")
    run.update(lambda content: {"tables": {**(content or {}).get("tables", {}), **written}})
    run.forget(lambda content: content["tables"].values())


def publish(df, root, stage_name, run_id):
    """Replace this run's rows of one stage table, see ``publish_run``."""
    publish_run({stage_name: df}, root, run_id)


def read_run(spark, root, stage_name, run_id, schema):
    """One run's rows of a stage table as they were published last; none if it has no such table."""
    run = _run(spark, root, run_id)
    folder = ((run.current()[1] or {}).get("tables") or {}).get(stage_name)
    if folder is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{run.root}/{folder}")


def export_name(stage_name, timestamp):
    """Name of a final copy; ``timestamp`` is a datetime in UTC."""
    # Fixed value: how the name begins.
    return f"imagedesc_{stage_name}_{timestamp:%Y%m%d_%H%M%S}.csv"
