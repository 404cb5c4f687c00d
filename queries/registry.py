"""Every operator as a query over the test tables: name -> (spark, sf_dir) -> DataFrame."""

import datetime
import functools

from pyspark.sql import functions as F

from carrel import schemas
from carrel.functions import images, marc, names, paths
from carrel.operators import batches, corpora, dedupe, enrich, manifest, orders, reconcile, routing
from carrel.operators import summary
from carrel.plans import corpora as corpus_plan
from carrel.plans import enrichment, reconciliation, transfer
from carrel.plans import orders as order_plan
from carrel.session import new_folder, stage
from carrel.sources import files, html, marc21, marcxml, tables
from carrel.streaming.orders import order_stream
from queries import inputs as i

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def t(spark, sf_dir, name):
    return i.table(spark, sf_dir, name)


# Names against the catalog


def _reconciled(spark, sf_dir, mode, order=None):
    pages = t(spark, sf_dir, "pages")
    return reconcile.reconcile(i.local_names(pages), reconcile.catalog_names(pages), mode, order)


@query
def reconcile_both(spark, sf_dir):
    return _reconciled(spark, sf_dir, reconcile.BOTH)


@query
def reconcile_in(spark, sf_dir):
    return _reconciled(spark, sf_dir, reconcile.IN).select("filename")


@query
def reconcile_not_in(spark, sf_dir):
    return _reconciled(spark, sf_dir, reconcile.NOT_IN, order="position").select(
        "filename", "first_seen"
    )


@query
def reconcile_report(spark, sf_dir):
    result = stage(_reconciled(spark, sf_dir, reconcile.BOTH), "reconciled")
    return reconcile.report_lines(result, reconcile.BOTH)


@query
def reconcile_report_text(spark, sf_dir):
    """The report written as text, read back with the number of each line over all part files."""
    result = stage(_reconciled(spark, sf_dir, reconcile.NOT_IN, order="position"), "reconciled")
    folder = new_folder(spark, "report")
    tables.write_report(reconcile.report_lines(result, reconcile.NOT_IN, label="Archive"), folder)
    lines = spark.read.text(folder).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )
    return batches.with_row_index(lines, ["file", "block", "at"], "line_no").select("line_no", "line")


@query
def reconcile_folder(spark, sf_dir):
    """Real files against a real MARCXML collection."""
    folder = i.mounted(spark, "names")
    pages = t(spark, sf_dir, "pages")
    safe = F.regexp_replace(names.url_basename(F.col("url")), "/", "_")
    named = pages.select(
        F.concat(F.when(safe == "", "none").otherwise(safe), F.lit(".f")).alias("path"),
        F.col("html").cast("binary").alias("content"),
    ).union(
        pages.select(
            F.when(safe == "", "none").otherwise(safe).alias("path"),
            F.col("html").cast("binary").alias("content"),
        )
    )
    stage(files.write_files(named, folder), "written")
    return reconciliation.reconcile_folder(
        spark, folder, i.collection_folder(spark, sf_dir), reconcile.BOTH
    )


@query
def url_names(spark, sf_dir):
    return t(spark, sf_dir, "pages").select(
        "page_id",
        names.url_basename(F.col("url")).alias("url_name"),
        names.path_basename(F.col("url")).alias("path_name"),
        names.key_basename(F.col("url")).alias("key_name"),
    )


# MARCXML


def _records(spark, sf_dir):
    return marcxml.read_marcxml(spark, i.collection_folder(spark, sf_dir))


@query
def marcxml_fields(spark, sf_dir):
    rec = F.col("record")
    return _records(spark, sf_dir).select(
        marc.subfield_first(rec, "035", "a").alias("local_id"),
        marc.control_field(rec, "001").alias("record_id"),
        F.md5(marc.subfield_first(rec, "520", "a").cast("binary")).alias("text_md5"),
        F.size(marc.link_urls(rec)).cast("bigint").alias("links"),
        F.array_join(marc.link_urls(rec), "|").alias("urls"),
        marc.is_single_image(rec).alias("single_image"),
        marc.subfield_first(rec, "999", "z").alias("absent"),
    )


def _routed(spark, sf_dir):
    return routing.route_records(_records(spark, sf_dir), i.LINK)


@query
def marcxml_route(spark, sf_dir):
    return _routed(spark, sf_dir)


@query
def marcxml_prefixed(spark, sf_dir):
    """Records with a namespace prefix, next to a file without records' prefix; found without being told."""
    folder = new_folder(spark, "prefixed")
    made = i.catalog_records(t(spark, sf_dir, "pages"))
    marcxml.write_marcxml(made, f"{folder}/a", prefix="marc:")
    marcxml.write_marcxml(made, f"{folder}/b")
    rec = F.col("record")
    records = marcxml.read_checked(spark, f"{folder}/*")
    return records.groupBy(
        marc.subfield_first(rec, "035", "a").alias("local_id"),
        F.array_join(marc.link_urls(rec), "|").alias("urls"),
    ).agg(F.count(F.lit(1)).alias("records"))


@query
def routing_counts(spark, sf_dir):
    return routing.routing_counts(_routed(spark, sf_dir))


@query
def marcxml_urls(spark, sf_dir):
    values = marcxml.explode_subfield(_records(spark, sf_dir), "856", "4", " ", "u")
    return values.select(
        F.col("value").alias("url"), names.url_basename(F.col("value")).alias("filename")
    )


@query
def missing_urls(spark, sf_dir):
    """A filter that accepts every image, also those without a link."""
    accept = lambda rec: marc.subfield_first(rec, "336", "a") == "Image"
    routed = routing.route_records(_records(spark, sf_dir), i.LINK, accept)
    return routing.missing_urls(routed).select("local_id", "violation")


# Order files


@query
def order_files_listed(spark, sf_dir):
    listed = marc21.order_files(spark, i.order_folder(spark, sf_dir))
    return listed.select(F.col("path").alias("filename"))


@query
def marc21_records(spark, sf_dir):
    records = marc21.read_marc21(spark, i.order_folder(spark, sf_dir), record_index=True)
    routed = orders.with_provider(records)
    rec = F.col("record")
    return routed.select(
        names.url_basename(F.col("source_file")).alias("filename"),
        "record_index",
        marc.control_field(rec, "001").alias("record_id"),
        marc.subfield_first(rec, "245", "a").alias("title"),
        "provider",
        "parse_error",
    )


def _routed_orders(spark, sf_dir):
    """The order job once, with some outputs already there."""

    def make():
        root = new_folder(spark, "orders")
        pieces = marc21.read_pieces(spark, i.order_folder(spark, sf_dir))
        existing = i.existing_outputs(t(spark, sf_dir, "orders"))
        order_plan.route_orders(pieces, root, i.YEAR, "first", "/archive", existing)
        return root

    return i.once(spark, sf_dir, "routed-orders", make)


@query
def marc21_route(spark, sf_dir):
    root = _routed_orders(spark, sf_dir)
    return order_plan.published_records(spark, root).select(
        "output_name", marc.control_field(F.col("record"), "001").alias("record_id"),
        F.octet_length("raw").cast("bigint").alias("bytes"),
    )


@query
def marc21_flat_outputs(spark, sf_dir):
    """The outputs as flat files, read again in file order."""
    root = _routed_orders(spark, sf_dir)
    folder = i.mounted(spark, "flat")
    plain = root[len("file:"):] if root.startswith("file:") else root
    order_plan.export_outputs(spark, plain, folder)
    records = marc21.read_marc21(spark, folder, record_index=True)
    return records.select(
        names.url_basename(F.col("source_file")).alias("output_name"),
        F.col("record_index").alias("position"),
        marc.control_field(F.col("record"), "001").alias("record_id"),
    )


def _flat_stats(stats):
    outputs = F.transform(
        F.map_entries("output_files"),
        lambda e: F.concat(e["key"], F.lit("="), names.path_basename(e["value"])),
    )
    return stats.select(
        names.url_basename(F.col("source_file")).alias("filename"),
        names.path_basename(F.col("archive_file")).alias("archived_as"),
        "records_read",
        "records_written",
        "records_skipped",
        F.array_join(outputs, ",").alias("outputs"),
        F.array_join("skipped_providers", ",").alias("skipped_providers"),
    )


@query
def marc21_stats(spark, sf_dir):
    return _flat_stats(order_plan.stats(spark, _routed_orders(spark, sf_dir)))


@query
def marc21_rejects(spark, sf_dir):
    rejects = order_plan.rejects(spark, _routed_orders(spark, sf_dir))
    return rejects.select(names.url_basename(F.col("source_file")).alias("filename"), "reason")


@query
def order_stream_stats(spark, sf_dir):
    """The streaming intake in several steps, with an empty file; run again, and once more with a new checkpoint."""
    folder = i.write_order_files(spark, sf_dir)
    nothing = spark.createDataFrame([("ebook-nothing.ord", b"")], "path string, content binary")
    stage(files.write_files(nothing, folder), "written")
    root, archive = i.mounted(spark, "stream-out"), i.mounted(spark, "archive")
    existing = i.existing_outputs(t(spark, sf_dir, "orders"))
    first, second = new_folder(spark, "stream-state"), new_folder(spark, "stream-state")
    for checkpoint in (first, first, second):
        order_stream(
            spark, folder, root, archive, checkpoint, i.YEAR, max_files=3, existing=existing
        ).awaitTermination()
    left = files.list_names(spark, folder, "ord").withColumn("left_behind", F.lit(True))
    kept = files.list_names(spark, archive, "ord").withColumn("archived", F.lit(True))
    stats = _flat_stats(order_plan.stats(spark, root))
    both = stats.join(left, "filename", "full").join(kept, "filename", "full")
    return both.select(
        "filename",
        "records_read",
        "records_written",
        "records_skipped",
        "outputs",
        F.coalesce("left_behind", F.lit(False)).alias("left_behind"),
        F.coalesce("archived", F.lit(False)).alias("archived"),
    )


@query
def output_names(spark, sf_dir):
    name = i.order_file(F.col("o_orderkey"))
    return t(spark, sf_dir, "orders").select(
        "o_orderkey",
        names.output_name(
            F.concat(name, F.lit("-ebook")), F.substring("o_orderpriority", 1, 1), i.YEAR
        ).alias("output_name"),
    )


# Manifests


def _virtual(spark, sf_dir):
    return i.document_files(t(spark, sf_dir, "documents"))


def _virtual_manifest(spark, sf_dir):
    return manifest.build_manifest(i.as_listing(_virtual(spark, sf_dir)), "/source")


@query
def manifest_build(spark, sf_dir):
    return _virtual_manifest(spark, sf_dir)


@query
def manifest_custom_pattern(spark, sf_dir):
    listing = i.as_listing(_virtual(spark, sf_dir))
    return manifest.exclude_paths(listing, r"^_|^src1[0-9]$").select("path", "size")


@query
def manifest_totals(spark, sf_dir):
    return manifest.manifest_totals(_virtual_manifest(spark, sf_dir))


def _virtual_verified(spark, sf_dir):
    found = i.as_listing(i.damaged(_virtual(spark, sf_dir)))
    return manifest.verify_manifest(_virtual_manifest(spark, sf_dir), found)


@query
def manifest_verify(spark, sf_dir):
    return _virtual_verified(spark, sf_dir)


@query
def manifest_summary(spark, sf_dir):
    return manifest.status_totals(_virtual_verified(spark, sf_dir))


@query
def copy_plan(spark, sf_dir):
    virtual = _virtual(spark, sf_dir)
    there = i.as_listing(i.damaged(virtual))
    gone = F.col("doc_id") % 19 == 0
    source = virtual.select("path", F.when(gone, "dir").otherwise("file").alias("kind"))
    return manifest.copy_plan(_virtual_manifest(spark, sf_dir), there, source)


def _source_manifest(spark, sf_dir):
    folder = i.source_folder(spark, sf_dir)
    return folder, i.once(
        spark, sf_dir, "source-manifest", lambda: transfer.take_manifest(spark, folder)
    )


@query
def files_inventory(spark, sf_dir):
    """Every file of a real folder, hidden names included."""
    return files.inventory(spark, i.source_folder(spark, sf_dir)).select("path", "size")


@query
def files_manifest(spark, sf_dir):
    """A manifest of real files, through its JSON form."""
    folder = new_folder(spark, "manifest-json")
    tables.write_manifest(_source_manifest(spark, sf_dir)[1], folder)
    return tables.read_manifest(spark, folder).select("path", "size", "sha256")


@query
def files_verify(spark, sf_dir):
    """A damaged destination against the manifest, files hashed where sizes match."""
    _, entries = _source_manifest(spark, sf_dir)
    return transfer.verify_destination(spark, entries, i.damaged_folder(spark, sf_dir))


@query
def files_copy(spark, sf_dir):
    """Copy into an empty folder, then resume: the second run has nothing to do."""
    folder, entries = _source_manifest(spark, sf_dir)
    target = i.mounted(spark, "copy")
    copied = transfer.transfer(spark, entries, folder, target)
    again = transfer.plan_transfer(spark, entries, folder, target)
    verified = transfer.verify_destination(spark, entries, target)
    return (
        verified.join(copied.select("path", F.col("bytes").alias("copied")), "path", "left")
        .join(again.select("path", F.col("action").alias("resume")), "path", "left")
        .select("path", "status", "copied", "resume", "sha256")
    )


@query
def object_keys(spark, sf_dir):
    """Objects below a prefix, ending in any case."""
    return files.list_objects(spark, i.source_folder(spark, sf_dir), " src1 ", " .Txt").select(
        "key", "size"
    )


@query
def object_download(spark, sf_dir):
    """Objects into one folder: the first of equal names is copied, a file that is there stays."""
    uri, target = i.mounted(spark, "store"), i.mounted(spark, "download")
    documents = i.document_files(t(spark, sf_dir, "documents"))
    name = names.key_basename(F.col("path"))
    again = documents.where(F.col("doc_id") % 17 == 0).withColumn("path", F.concat(F.lit("zz/"), name))
    stage(files.write_files(documents.unionByName(again), uri), "written")
    older = documents.where(F.col("doc_id") % 23 == 0).withColumn("path", name).withColumn("content", F.lit(b"older"))
    stage(files.write_files(older, target), "written")
    keys = files.list_objects(spark, uri).select("key", "size")
    return stage(files.download_objects(keys, uri, target), "downloads")


@query
def name_clashes(spark, sf_dir):
    return manifest.name_clashes(
        t(spark, sf_dir, "pages").select(F.col("url").alias("key"))
    ).select("basename", "keys")


@query
def key_filter(spark, sf_dir):
    keys = t(spark, sf_dir, "pages").select(
        F.concat(F.lit("data/"), F.regexp_replace("url", r"^(https?)://", "$1/")).alias("key")
    )
    return keys.where(paths.key_matches(F.col("key"), " data/https/ ", " .HTML"))


@query
def listing_by_extension(spark, sf_dir):
    name = F.element_at(F.split("path", "/"), -1)
    listed = _virtual(spark, sf_dir).select("path", name.alias("filename"))
    return listed.select(
        "path",
        paths.has_extension(F.col("filename"), "txt").alias("is_txt"),
        paths.has_extension(F.col("filename")).alias("has_dot"),
        paths.under_volume(F.col("path"), "SRC1").alias("on_volume"),
    )


@query
def digests(spark, sf_dir):
    content = F.col("text").cast("binary")
    size = F.octet_length(content)
    return t(spark, sf_dir, "documents").select(
        "doc_id",
        F.sha2(content, 256).alias("sha256"),
        F.md5(content).alias("md5"),
        F.length(images.base64_text(content)).cast("bigint").alias("encoded"),
        images.base64_length(size).alias("encoded_length"),
        images.base64_estimate(size + F.lit(0.5)).alias("estimate"),
    )


@query
def declared_checksum(spark, sf_dir):
    docs = t(spark, sf_dir, "documents")
    name = F.concat("source", F.lit("-"), "doc_id", F.lit(".bin"))
    actual = F.md5(F.col("text").cast("binary"))
    catalog = docs.select(
        name.alias("file"),
        F.when(F.col("doc_id") % 10 == 0, F.reverse(actual)).otherwise(actual).alias("checksum"),
    )
    # A catalog may list a file several times.
    catalog = catalog.unionByName(catalog.where(F.substring("file", -5, 1) == "5"))
    header = (
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit('attachment; filename="'), "doc_id", F.lit('.tgz"')))
        .when(F.col("doc_id") % 3 == 1, F.concat(F.lit("attachment; filename="), "doc_id", F.lit(".tgz")))
    )
    got = docs.select(name.alias("file"), header.alias("content_disposition"), actual.alias("md5"))
    return corpus_plan.check_downloads(got, catalog).select(
        "file", "target", "md5", "declared_md5", "checksum_ok"
    )


# Image sizes


def _image(width, height, size):
    return width.cast("int"), height.cast("int"), size.cast("bigint")


def _line_images(spark, sf_dir):
    width, height, size = _image(
        F.lit(1) + (F.col("l_partkey") * 37 + F.col("l_linenumber")) % 12000,
        F.lit(1) + (F.col("l_orderkey") * 53 + F.col("l_suppkey")) % 9000,
        F.floor(F.col("l_extendedprice") * 100),
    )
    return t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        width.alias("width"), height.alias("height"), size.alias("size"),
    )


def _fitted(spark, sf_dir):
    fitted = images.fit(
        F.col("width"), F.col("height"), images.base64_estimate(F.col("size")),
        8000, 8000, images.FETCH_SIZE_LIMIT,
    )
    return _line_images(spark, sf_dir).withColumn("f", fitted)


@query
def image_fit(spark, sf_dir):
    return _fitted(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("f.width").cast("bigint").alias("fit_width"),
        F.col("f.height").cast("bigint").alias("fit_height"),
        F.col("f.resize").alias("resize"),
    )


@query
def image_refit(spark, sf_dir):
    new_size = F.col("size") * (F.col("l_linenumber") % 3 + 1)
    again = images.refit(
        F.col("f.width"), F.col("f.height"), images.base64_estimate(new_size),
        images.FETCH_SIZE_LIMIT,
    )
    return _fitted(spark, sf_dir).withColumn("r", again).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("r.width").cast("bigint").alias("refit_width"),
        F.col("r.height").cast("bigint").alias("refit_height"),
        F.col("r.resize").alias("again"),
    )


# Enrichment


def _fetch_status(spark, sf_dir):
    def make():
        catalog = i.order_catalog(t(spark, sf_dir, "orders"))
        return stage(
            enrich.fetch_records(
                catalog, i.ImageService, first_delay=0.0, max_parallel=i.tasks(spark)
            ),
            "fetch-status",
        )

    return i.once(spark, sf_dir, "fetch-status", make)


@query
def fetch_status(spark, sf_dir):
    return _fetch_status(spark, sf_dir).select(
        "record_id",
        "status",
        "description",
        "path",
        F.col("width").cast("bigint").alias("width"),
        F.col("height").cast("bigint").alias("height"),
    )


def _fetched(spark, sf_dir):
    catalog = i.order_catalog(t(spark, sf_dir, "orders"))
    older = catalog.withColumn("collection", F.lit("older")).withColumn("at", F.col("at") - 1000000)
    both = catalog.unionByName(older)
    return enrich.attach_status(both, _fetch_status(spark, sf_dir), ["at"])


@query
def fetched(spark, sf_dir):
    return _fetched(spark, sf_dir).select(*schemas.FETCHED_HEADINGS)


@query
def unknown_ids(spark, sf_dir):
    """Outcomes whose record is not in the catalog of one-time customers' orders."""
    catalog = t(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    known = i.order_catalog(catalog)
    return enrich.unknown_ids(known, _fetch_status(spark, sf_dir))


def _described(spark, sf_dir):
    def make():
        rows = i.document_images(t(spark, sf_dir, "documents"))
        return stage(
            enrich.describe(
                rows, i.CaptionModel, "Describe.", content="content", size_limit=i.DESCRIBE_LIMIT,
                max_parallel=i.tasks(spark),
            ),
            "described",
        )

    return i.once(spark, sf_dir, "described", make)


@query
def describe(spark, sf_dir):
    return _described(spark, sf_dir).select(
        "record_id", "status", "status_description", "description"
    )


@query
def output_rows(spark, sf_dir):
    return _output(spark, sf_dir)


def _output(spark, sf_dir):
    return enrich.to_output(
        _described(spark, sf_dir), "https://catalog.example.org/r/{id}", "Model One", "model-1",
        "image-description", "carrel", 7, "2026-02-03",
    )


@query
def job_summary(spark, sf_dir):
    return summary.job_summary(
        _fetch_status(spark, sf_dir),
        _described(spark, sf_dir),
        routing.skipped(_routed(spark, sf_dir)),
    )


def _enrichment(spark, sf_dir):
    """The whole job on the MARCXML collection, once: scan, route, fetch, describe, publish, export."""
    settings = enrichment.Settings(
        link_template=i.LINK,
        output_link_template="https://catalog.example.org/r/{id}",
        prompt="Describe.",
        prompt_version="7",
        model_id="model-1",
        model_label="Model One",
        run_date="2026-02-03",
    )
    moment = datetime.datetime(2026, 2, 3, 4, 5, 6)

    def make():
        root, folder = new_folder(spark, "run"), i.mounted(spark, "stored-images")
        records = marcxml.read_checked(spark, i.collection_folder(spark, sf_dir))
        done = enrichment.run(
            records, functools.partial(i.StoredImages, folder), i.CaptionModel, settings, root, "run-1", moment,
            fetch_options={"first_delay": 0.0}, describe_options={"root": folder},
        )
        return root, stage(done, "summary")

    root, done = i.once(spark, sf_dir, "enrichment", make)

    def exported(name, headings):
        return tables.read_stage(spark, f"{root}/exports/run-1/{tables.export_name(name, moment)}", headings)

    return exported, done


@query
def enrichment_run(spark, sf_dir):
    """What the whole job has described, from its export."""
    return _enrichment(spark, sf_dir)[0]("processed", schemas.PROCESSED_HEADINGS)


@query
def enrichment_fetched(spark, sf_dir):
    """What the whole job has fetched, from its export."""
    return _enrichment(spark, sf_dir)[0]("fetched", schemas.FETCHED_HEADINGS)


@query
def enrichment_summary(spark, sf_dir):
    """The counts of the whole job's stages."""
    return _enrichment(spark, sf_dir)[1]


@query
def status_summary(spark, sf_dir):
    return summary.status_summary(t(spark, sf_dir, "events"), "purchase", "event_type")


@query
def prompt_lookup(spark, sf_dir):
    """Each customer with the attributes of its nation."""
    nations = t(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey"
    )
    return enrich.with_lookup(t(spark, sf_dir, "customer"), nations, ["c_nationkey"]).select(
        "c_custkey", "n_name", F.col("n_regionkey").cast("bigint").alias("n_regionkey")
    )


@query
def mime_types(spark, sf_dir):
    path = F.col("image_path")
    kind = names.mime_type(path)
    ending = F.get(F.array(*[F.lit(x) for x in ("", ".tiff", ".unknown", ".mp4", "/plain")]), (F.col("doc_id") % 5).cast("int"))
    rows = i.document_images(t(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id") * 3))
    rows = rows.withColumn("doc_id", (F.col("record_id").cast("bigint") / 3).cast("bigint"))
    rows = rows.withColumn("image_path", F.concat("image_path", ending))
    return rows.select("image_path", kind.alias("mime"), images.is_supported(kind).alias("supported"))


@query
def stamps(spark, sf_dir):
    return t(spark, sf_dir, "events").select(
        "event_id",
        names.day_stamp(F.col("ts")).alias("day"),
        names.second_stamp(F.col("ts")).alias("second"),
        names.shard_key(F.concat(F.lit("0"), F.col("event_id").cast("string"))).alias("shard"),
        names.provenance(
            F.col("event_type"), F.lit("m"), F.lit("ns"), F.col("user_id").cast("string")
        ).alias("provenance"),
        names.review_note(F.col("event_type")).alias("note"),
        names.record_link(
            F.when(F.col("user_id") % 10 != 0, F.col("user_id").cast("string")).otherwise(""), i.LINK
        ).alias("link"),
    )


# Keys, order, batches


@query
def assigned_batches(spark, sf_dir):
    rows = t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    numbered = batches.assign_batches(rows, ["o_orderdate", "o_orderkey"])
    return numbered.select("o_orderkey", "row_index", "batch_id")


_EVENT_KEYS = ["user_id", "event_type"]


@query
def first_seen(spark, sf_dir):
    events = t(spark, sf_dir, "events").select(*_EVENT_KEYS, "event_id", "value", "props")
    return dedupe.first_seen(events, _EVENT_KEYS, ["event_id"])


@query
def last_wins(spark, sf_dir):
    events = t(spark, sf_dir, "events").select(*_EVENT_KEYS, "event_id", "value", "props")
    return dedupe.last_wins(events, _EVENT_KEYS, ["event_id"])


@query
def latest_invoice(spark, sf_dir):
    rows = t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return dedupe.latest_per_group(rows, ["o_custkey"], "o_orderdate").select(
        "o_custkey", "o_orderkey", names.day_stamp(F.col("o_orderdate")).alias("day")
    )


# HTML


_COLUMNS = {"corpus_id": 0, "file": 1, "invoice_date": 2, "checksum": 4}


def _corpora(spark, sf_dir):
    """The pages parsed once, for all queries on them."""

    def make():
        # Dealt out before the pages are made: the rows they are made from are much smaller.
        rows = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        pages = i.corpus_pages(rows.repartition(i.tasks(spark), "o_orderkey"))
        return corpus_plan.read_catalog(pages, ["page"], _COLUMNS)

    return i.once(spark, sf_dir, "corpora", make)


@query
def html_table(spark, sf_dir):
    rows = _corpora(spark, sf_dir)
    return rows.select(
        "page", "row_no", "corpus_id", "file",
        F.date_format("invoice_date", "yyyy-MM-dd").alias("invoice"),
        "checksum", "download_link",
    )


@query
def html_rows(spark, sf_dir):
    """Items of the navigation list of each page."""
    rows = html.extract_html_rows(
        t(spark, sf_dir, "pages"), ["page_id"],
        container="nav", container_id=None, body=None, row="li", cells=("a",),
    )
    cell = F.get("cells", F.lit(0))
    return rows.select("page_id", "row_no", cell["text"].alias("text"), cell["href"].alias("href"))


@query
def corpus_latest(spark, sf_dir):
    """The latest archives of every corpus."""
    wanted = corpora.filter_corpora(_corpora(spark, sf_dir), file_pattern=r"\.tgz$")
    return wanted.select("corpus_id", "file", "download_link")


@query
def corpus_available(spark, sf_dir):
    """The downloads of the corpus of the customer with the smallest number."""
    least = t(spark, sf_dir, "orders").agg(F.min("o_custkey")).head()[0]
    wanted = corpus_plan.available(_corpora(spark, sf_dir), f"C{least}")
    return wanted.select("corpus_id", "file", "download_link")


@query
def corpus_download(spark, sf_dir):
    """The latest archives of every corpus, fetched, named and checked."""

    def make():
        wanted = corpora.filter_corpora(_corpora(spark, sf_dir), file_pattern=r"\.tgz$")
        return corpus_plan.download(wanted, i.CorpusServer, i.mounted(spark, "corpora"))

    got = i.once(spark, sf_dir, "corpus-download", make)
    return got.select("file", "target", "bytes", "md5", "checksum_ok", "error")


# Stage tables


@query
def run_snapshot_emptied(spark, sf_dir):
    """A run that is published again without rows, next to one that stays."""
    root = new_folder(spark, "snapshots")
    rows = t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    for run, part in (("run-1", rows), ("run-2", rows), ("run-1", rows.limit(0))):
        tables.publish(part, root, "skipped", run)
    schema = "o_orderkey bigint, o_orderpriority string"
    kept = [tables.read_run(spark, root, "skipped", run, schema).withColumn("run", F.lit(run)) for run in ("run-1", "run-2")]
    return kept[0].unionByName(kept[1])


@query
def run_snapshot(spark, sf_dir):
    """Two runs published, the first one twice; one run read back."""
    root = new_folder(spark, "snapshots")
    rows = t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    tables.publish(rows.withColumn("o_orderpriority", F.lit("stale")), root, "skipped", "run-1")
    tables.publish(rows.withColumn("o_orderpriority", F.lit("other")), root, "skipped", "run-2")
    tables.publish(rows, root, "skipped", "run-1")
    return tables.read_run(
        spark, root, "skipped", "run-1", "o_orderkey bigint, o_orderpriority string"
    )


@query
def csv_round_trip(spark, sf_dir):
    """Whole texts through CSV, line breaks and quotes included."""
    folder = new_folder(spark, "csv")
    docs = t(spark, sf_dir, "documents")
    wrapped = F.concat(F.lit(' "'), "text", F.lit('",\n '))
    tables.write_csv(
        docs.select(F.col("doc_id").cast("string").alias("doc_id"), wrapped.alias("text"), F.lit("").alias("none")),
        folder,
    )
    back = tables.read_csv(spark, folder, "doc_id string, text string, none string")
    return back.select("doc_id", F.md5(F.col("text").cast("binary")).alias("md5"), "none")


@query
def record_shards(spark, sf_dir):
    """Records stored by shard and counted from the shards' folders."""
    folder = new_folder(spark, "shards")
    rows = t(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("record_id"), "o_totalprice"
    )
    tables.write_shards(rows, folder)
    stored = spark.read.schema("record_id string, o_totalprice double, shard string").parquet(folder)
    return stored.groupBy("shard").agg(
        F.count(F.lit(1)).alias("records"), F.min("record_id").alias("first_id")
    )
