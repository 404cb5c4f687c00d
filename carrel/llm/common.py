"""Small helpers shared by the corpus operators."""

from pyspark.sql import functions as F

from carrel.session import new_folder, stage  # noqa: F401  (used by the operators)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column="text"):
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def row_key(id_col="doc_id", text_col="text"):
    """Tells rows apart that share an id; rows that are equal in both share the key.

    The two hashes and the length make a clash of different texts under one id
    practically impossible.
    """
    text = whole_text(text_col)
    return F.concat_ws(
        ":",
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")),
        F.hex(F.xxhash64(text)),
        F.crc32(F.encode(text, "UTF-8")),
        F.octet_length(text),
    )


def share_of(spark, rows, per_task, least=None):
    """Number of tasks for ``rows`` rows at ``per_task`` each, no fewer than the cores."""
    least = least or spark.sparkContext.defaultParallelism
    return int(max(least, -(-rows // per_task)))
