"""Files in a folder against the file names in catalog links."""

from carrel.operators import reconcile as r
from carrel.session import stage
from carrel.sources.files import list_names
from carrel.sources.marcxml import explode_subfield, read_checked
from carrel.sources.tables import write_report


def catalog_file_names(records):
    """File names in the links (856, indicators '4' and blank, $u) of records."""
    urls = explode_subfield(records, "856", "4", " ", "u").withColumnRenamed("value", "url")
    return r.catalog_names(urls)


def reconcile_folder(
    spark, folder, collection, mode=r.IN, extension="*", report=None, label="Catalog"
):
    """(filename, in_catalog); with ``report`` also written as text there.

    A collection that is not well-formed fails the job.
    """
    local = list_names(spark, folder, extension or "*")
    catalog = catalog_file_names(read_checked(spark, collection))
    result = stage(r.reconcile(local, catalog, mode), "reconciled")
    if report:
        write_report(r.report_lines(result, mode, label), report)
    return result
