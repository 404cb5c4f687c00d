"""Two-way routing of catalog records."""

from pyspark.sql import functions as F

from carrel.functions import marc, names

TO_PROCESS = "to_process"
SKIPPED = "skipped"


def route_records(
    records, link_template, predicate=marc.is_single_image, record="record", keep=()
):
    """One row per record with its route; both outputs are filters of this table.

    ``predicate`` maps the record column to a boolean column; ``keep`` names
    columns that stay in front.
    """
    rec = F.col(record)
    picked = records.select(
        *keep,
        marc.control_field(rec, "001").alias("record_id"),
        marc.subfield_first(rec, "035", "a").alias("local_id"),
        marc.subfield_first(rec, "982", "b").alias("collection"),
        F.coalesce(predicate(rec), F.lit(False)).alias("_accepted"),
        marc.link_urls(rec).alias("_urls"),
    )
    return picked.select(
        *keep,
        "record_id",
        "local_id",
        "collection",
        F.when(F.col("_accepted"), TO_PROCESS).otherwise(SKIPPED).alias("status"),
        names.record_link(F.col("record_id"), link_template).alias("record_link"),
        F.when(F.col("_accepted"), F.get(F.col("_urls"), F.lit(0))).alias("image_url"),
    )


def to_process(routed):
    return routed.where(F.col("status") == TO_PROCESS)


def skipped(routed):
    return routed.where(F.col("status") == SKIPPED).drop("image_url")


def routing_counts(routed):
    return routed.groupBy("status").agg(F.count(F.lit(1)).alias("records"))


def missing_urls(routed):
    """Accepted records without any URL, with the message for each."""
    return violations(
        routed,
        (F.col("status") == TO_PROCESS) & F.col("image_url").isNull(),
        F.concat(
            F.lit("Record "), F.col("record_id"), F.lit(" accepted by filter but has no 856 URLs")
        ),
    )


def violations(df, condition, message):
    """Rows that break a rule, with a ``violation`` column."""
    return df.where(condition).withColumn("violation", message)


def require_none(broken, column="violation"):
    """Raise with one example if there is any row."""
    first = broken.select(column).head(1)
    if first:
        raise ValueError(first[0][0])
