"""Corpus catalog: downloads listed in an HTML page, latest ones, checksums."""

import hashlib
import posixpath

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import functions as F

from carrel.functions import names
from carrel.functions.names import announced_name
from carrel.operators.corpora import filter_corpora
from carrel.operators.manifest import check_declared
from carrel.session import stage
from carrel.sources.files import open_root, publish_bytes
from carrel.sources.html import corpus_rows, extract_html_rows


def read_catalog(pages, keys, columns, date_format="yyyy-MM-dd", html="html", tasks=None, strict=True):
    """Catalog rows of saved pages; ``columns`` maps column name to cell position.

    ``columns`` names at least corpus_id, file, invoice_date and checksum. The
    rows are written once, because parsing is dear and they are used several
    times. A date that is given but can't be read fails the job; without
    ``strict`` it is null, and the row never counts as the latest.
    """
    rows = corpus_rows(extract_html_rows(pages, keys, html=html, tasks=tasks), columns)
    read = F.try_to_date("invoice_date", date_format)
    unread = (F.trim("invoice_date") != "") & read.isNull()
    rows = stage(rows.withColumn("_unread", unread).withColumn("_given", F.col("invoice_date")).withColumn("invoice_date", read), "corpora")
    if strict and (bad := rows.where("_unread").head(1)):
        raise ValueError(f"not a date as {date_format}: {bad[0]['_given']!r}")
    return rows.drop("_unread", "_given")


def available(corpora, corpus_id, file_pattern=None):
    """The downloads to fetch for one corpus."""
    return filter_corpora(corpora, corpus_id, file_pattern)


def check_downloads(downloads, corpora, key="file"):
    """Downloads (file, content_disposition, md5) with target name and checksum test.

    ``key`` names the column that tells downloads apart, such as the download
    link where a catalog lists a file several times.
    """
    named = downloads.withColumn(
        "target", names.download_name(F.col("content_disposition"), F.col("file"))
    )
    return check_declared(named, corpora, key)


def download(wanted, client_factory, target_root, max_parallel=None):
    """Fetch the rows of a filtered catalog into a folder; one result row each.

    The client has ``get(download_link)``, which returns (content disposition,
    bytes in chunks), and is built once per task. A file is named by its header,
    else by the catalog; one that is there already is not replaced. Adds
    ``target``, ``bytes``, ``md5`` (of what was written), ``checksum_ok`` (null
    without a declared checksum) and ``error``. Run it once (the result is
    staged).
    """
    rows = wanted.select("file", "download_link", "checksum")
    tasks = max_parallel or wanted.sparkSession.sparkContext.defaultParallelism

    def run(batches):
        client = client_factory()
        filesystem, base = open_root(target_root)

        def fetch(file, link):
            state, size = hashlib.md5(), 0
            try:
                header, chunks = client.get(link)
                name = announced_name(header) or file
                place = posixpath.join(base, name)
                if filesystem.get_file_info(place).type != arrow_fs.FileType.NotFound:
                    return name, None, None, f"{name} exists"

                def counted():
                    nonlocal size
                    for chunk in chunks:
                        state.update(chunk)
                        size += len(chunk)
                        yield chunk

                publish_bytes(filesystem, place, counted())
            except Exception as error:  # a failure belongs to its row
                return None, None, None, str(error)
            return name, size, state.hexdigest(), None

        for batch in batches:
            got = [fetch(*row) for row in zip(batch["file"], batch["download_link"])]
            done = pd.DataFrame(got, columns=["target", "bytes", "md5", "error"]).astype({"bytes": "Int64"})
            yield pd.concat([batch.reset_index(drop=True), done], axis=1)

    schema = "file string, download_link string, checksum string, target string, bytes bigint, md5 string, error string"
    got = stage(rows.repartition(tasks, "download_link").mapInPandas(run, schema), "downloads")
    return got.withColumn("checksum_ok", F.col("md5") == F.lower("checksum"))
