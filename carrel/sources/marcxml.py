"""MARCXML collections as one row per record."""

import functools

from pyspark.sql import functions as F

from carrel.functions import marc, marcxml
from carrel.operators.once import compute_once


def _cut(spark, path, row_tag):
    """Pieces between the end tags, with the text from a record's start on."""
    start = F.regexp_extract("value", rf"(?s)(<{row_tag}[\s>].*)\z", 1)
    return (
        spark.read.option("lineSep", f"</{row_tag}>")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.col("_metadata.file_size").alias("file_size"),
            F.octet_length("value").alias("bytes"),
            start.alias("_start"),
        )
    )


def record_tags(spark, path):
    """Names of the record element in a collection, with their namespace prefixes.

    Elements other than records and collections without any record mean that
    the records have not been recognised, which is an error.
    """
    pieces = spark.read.option("lineSep", ">").text(path)
    tag = r"<([A-Za-z_][\w.-]*:)?([A-Za-z_][\w.-]*)(?:\s[^<]*)?\z"
    named = pieces.select(F.regexp_extract("value", tag, 1).alias("prefix"), F.regexp_extract("value", tag, 2).alias("name"))
    kinds = named.where(~F.col("name").isin("", "collection")).groupBy(
        F.when(F.col("name") == "record", F.col("prefix")).alias("prefix")
    )
    found = [row.prefix for row in kinds.agg(F.count(F.lit(1))).collect()]
    tags = sorted(f"{prefix}record" for prefix in found if prefix is not None)
    if found and not tags:
        raise ValueError(f"no record element in {path}")
    return tags or ["record"]


def read_marcxml(spark, path, row_tag=None, strict=False):
    """Columns source_file, block_start, seq, record and parse_error.

    Without ``row_tag`` the record element is found with whatever prefix it has.

    The file is cut at the end tag of a record, so that one large collection
    is read by many tasks. A record that is not well-formed has a null
    ``record`` and its text as ``parse_error``; with ``strict`` it fails the
    job. (source_file, block_start, seq) sorts the records as they are in the
    file.
    """
    if row_tag is None:
        parts = [read_marcxml(spark, path, tag, strict) for tag in record_tags(spark, path)]
        return functools.reduce(lambda a, b: a.unionByName(b), parts)
    pieces = (
        _cut(spark, path, row_tag)
        .drop("file_size", "bytes")
        .withColumn("seq", F.monotonically_increasing_id())
        .where(F.col("_start") != "")
    )
    parsed = pieces.withColumn(
        "_xml", marcxml.from_text(F.concat(F.col("_start"), F.lit(f"</{row_tag}>")))
    )
    broken = F.col("_xml").isNull() | F.col("_xml._corrupt_record").isNotNull()
    fault = F.when(broken, F.concat(F.lit("not well-formed: "), F.col("_start")))
    record = F.when(~broken, marcxml.record_of(F.col("_xml")))
    if strict:
        # In the record itself, as a column that is not read is not evaluated.
        record = record.otherwise(F.raise_error(fault))
    return compute_once(parsed, record=record, parse_error=fault).drop("_start", "_xml")


def truncated_files(spark, path, row_tag="record"):
    """Files that end within a record, which reading by end tags cannot tell.

    Only the last piece of a file may lack an end tag, and then it must not
    hold the start of a record.
    """
    pieces = _cut(spark, path, row_tag)
    end = len(f"</{row_tag}>")
    files = pieces.groupBy("source_file").agg(
        F.sum(F.col("bytes") + end).alias("bytes"),
        F.max("file_size").alias("file_size"),
        F.count_if(F.col("_start") == "").alias("without_record"),
    )
    open_end = (F.col("bytes") != F.col("file_size")) & (F.col("without_record") == 0)
    return files.where(open_end).select("source_file")


def read_checked(spark, path, row_tag=None):
    """``read_marcxml`` that fails on any fault, a file cut short included."""
    parts = []
    for tag in [row_tag] if row_tag else record_tags(spark, path):
        cut_short = truncated_files(spark, path, tag).head(1)
        if cut_short:
            raise ValueError(f"file ends within a record: {cut_short[0][0]}")
        parts.append(read_marcxml(spark, path, tag, strict=True))
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


def explode_subfield(records, tag, ind1, ind2, code, record="record"):
    """One row per field that has the subfield: its first value, not empty."""
    values = marc.first_per_field(F.col(record), tag, ind1, ind2, code)
    return records.select(F.explode(values).alias("value"))


def write_marcxml(records, path, record="record", prefix=""):
    """One ``<record>`` element per line, readable by ``read_marcxml``; ``prefix`` is one like ``marc:``."""
    records.select(marcxml.to_text(F.col(record), prefix).alias("value")).write.text(path)
