"""Catalog enrichment: records to routed, fetched, described and summed up."""

import json
from dataclasses import asdict, dataclass

from pyspark.sql import functions as F

from carrel import schemas
from carrel.functions import marc
from carrel.operators import enrich, routing
from carrel.operators.dedupe import last_wins
from carrel.operators.summary import job_summary
from carrel.session import stage
from carrel.sources.tables import export_name, publish_run, write_stage


@dataclass(frozen=True)
class Settings:
    """What a run is told; nothing is read from the clock or the environment."""

    link_template: str
    output_link_template: str
    prompt: str
    prompt_version: str
    model_id: str
    model_label: str
    run_date: str
    job: str = "image-description"
    namespace: str = "carrel"
    max_width: int = 8000
    max_height: int = 8000
    max_parallel: int | None = None


def route(records, settings, predicate=marc.is_single_image):
    """Routed records, written once; an accepted record without URL is an error."""
    placed = records.select(F.struct("source_file", "block_start", "seq").alias("at"), "record")
    routed = routing.route_records(placed, settings.link_template, predicate, keep=["at"])
    routed = stage(routed, "routed")
    routing.require_none(routing.missing_urls(routed))
    return routed


def fetch(routed, client_factory, settings, **options):
    """Accepted records with their image; the calls are made exactly here."""
    wanted = last_wins(routing.to_process(routed), ["record_id"], ["at"])
    statuses = enrich.fetch_records(
        wanted,
        client_factory,
        max_width=settings.max_width,
        max_height=settings.max_height,
        **{"max_parallel": settings.max_parallel} | options,
    )
    statuses = stage(statuses, "fetch-status")
    return enrich.attach_status(wanted, statuses, ["at"]).drop("at")


def describe(fetched, model_factory, settings, **options):
    """Output rows of the fetched images; the calls are made exactly here."""
    rows = fetched.where(F.col("status") == enrich.FETCHED)
    described = enrich.describe(
        rows, model_factory, settings.prompt, max_parallel=settings.max_parallel, **options
    )
    return enrich.to_output(
        stage(described, "described"),
        settings.output_link_template,
        settings.model_label,
        settings.model_id,
        settings.job,
        settings.namespace,
        settings.prompt_version,
        settings.run_date,
    )


def run(
    records, client_factory, model_factory, settings, root, run_id, timestamp=None, fetch_options=None, describe_options=None
):
    """The whole job; returns one summary row per stage.

    The options go to ``fetch`` and ``describe``. ``records`` come from ``read_checked``, so that a faulty collection fails
    before anything is fetched.
    Stage tables go below ``root`` by run; with ``timestamp`` they are also
    exported as CSV under their final names.
    """
    spark = records.sparkSession
    routed = route(records, settings)
    skipped = routing.skipped(routed).drop("at")
    fetched = stage(fetch(routed, client_factory, settings, **fetch_options or {}), "fetched")
    processed = describe(fetched, model_factory, settings, **describe_options or {})
    tables = {
        "processed": (processed, schemas.PROCESSED_HEADINGS),
        "fetched": (fetched, schemas.FETCHED_HEADINGS),
        "skipped": (skipped, schemas.SKIPPED_HEADINGS),
    }
    params = spark.createDataFrame([(json.dumps(asdict(settings)),)], "params string")
    publish_run({"params": params} | {name: table for name, (table, _) in tables.items()}, root, run_id)
    if timestamp:
        for name, (table, headings) in tables.items():
            write_stage(table, f"{root}/exports/{run_id}/{export_name(name, timestamp)}", headings)
    return job_summary(fetched, processed, skipped)
