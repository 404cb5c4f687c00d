"""Selecting downloads from a corpus catalog."""

from pyspark.sql import functions as F

from carrel.operators.dedupe import latest_per_group


def filter_corpora(corpora, corpus_id=None, file_pattern=None, keys=("corpus_id",)):
    """Downloads of one corpus (or of all), by file name, of the latest invoice.

    ``keys`` says among which rows the latest invoice date is sought.
    """
    wanted = corpora
    if corpus_id is not None:
        wanted = wanted.where(F.col("corpus_id") == corpus_id)
    if file_pattern:
        wanted = wanted.where(F.col("file").rlike(file_pattern))
    return latest_per_group(wanted, list(keys), "invoice_date")
