"""File names against catalog names."""

from pyspark.sql import functions as F

from carrel.functions import names

IN, NOT_IN, BOTH = "in", "not_in", "both"
MODES = (IN, NOT_IN, BOTH)


def catalog_names(urls, url="url"):
    """Distinct file names of the catalog's URLs; empty URLs are dropped."""
    return (
        urls.where(F.col(url).isNotNull() & (F.col(url) != ""))
        .select(names.url_basename(F.col(url)).alias("filename"))
        .distinct()
    )


def reconcile(local, catalog, mode=IN, order=None):
    """Distinct local names with ``in_catalog``, limited to what ``mode`` asks.

    ``order`` names a column of ``local``; each name then carries its smallest
    value as ``first_seen``. Both sides are made distinct before the join, so a
    name with very many copies is one row there, and the join uses the
    partitioning of the two aggregates.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}: {mode}")
    if order is None:
        mine = local.select("filename").distinct()
    else:
        mine = local.groupBy("filename").agg(F.min(order).alias("first_seen"))
    theirs = catalog.select("filename").distinct()
    if mode == IN:
        return mine.join(theirs, "filename", "left_semi").withColumn("in_catalog", F.lit(True))
    if mode == NOT_IN:
        return mine.join(theirs, "filename", "left_anti").withColumn("in_catalog", F.lit(False))
    marked = theirs.withColumn("_found", F.lit(True))
    return mine.join(marked, "filename", "left").select(
        *mine.columns, F.coalesce("_found", F.lit(False)).alias("in_catalog")
    )


def report_lines(result, mode, label="Catalog"):
    """The report as rows (section, ord, line), to be sorted by the first two.

    ``ord`` is the file name within a name section, and its first position
    where ``reconcile`` was given an order. An empty section is left out.
    """
    spark = result.sparkSession
    # The wording and the rulers of the report.
    ruler = "=" * 40
    title = f"{label.upper()} FILE COMPARISON REPORT"
    indent = " " * max(0, (40 - len(title) + 1) // 2)
    title = (indent + title).ljust(40)

    shown = [m for m in (IN, NOT_IN) if mode in (m, BOTH)]
    total_text = {IN: "Total files found in ", NOT_IN: "Total files not found in "}
    heading = {IN: "--- FILES FOUND IN ", NOT_IN: "--- FILES NOT FOUND IN "}
    is_in = F.col("in_catalog")

    totals = result.agg(
        F.count_if(is_in).alias(IN), F.count_if(~is_in).alias(NOT_IN)
    )

    def lines(section, values):
        return [
            F.struct(
                F.lit(section).alias("section"),
                F.lit(f"{i:03d}").alias("ord"),
                value.alias("line"),
                keep.alias("keep"),
            )
            for i, (value, keep) in enumerate(values)
        ]

    yes = F.lit(True)
    fixed = lines(0, [(F.lit(ruler), yes), (F.lit(title), yes), (F.lit(ruler), yes)])
    fixed += lines(
        1,
        [(F.concat(F.lit(f"{total_text[m]}{label.capitalize()}: "), F.col(m)), yes) for m in shown]
        + [(F.lit(ruler), yes)],
    )
    for m, section in ((IN, 2), (NOT_IN, 5)):
        if m in shown:
            some = F.col(m) > 0
            title = F.lit(f"{heading[m]}{label.upper()} ---")
            fixed += lines(section, [(F.lit(""), some), (title, some)])
            fixed += lines(section + 2, [(F.lit(ruler), some)])
    frame = totals.select(F.explode(F.array(*fixed)).alias("l")).where("l.keep")
    frame = frame.select("l.section", "l.ord", "l.line")

    if "first_seen" in result.columns:
        position = F.lpad(F.col("first_seen").cast("string"), 20, "0")
    else:
        position = F.col("filename")
    named = result.where(is_in | F.lit(NOT_IN in shown)).where(~is_in | F.lit(IN in shown))
    entries = named.select(
        F.when(is_in, 3).otherwise(6).alias("section"),
        position.alias("ord"),
        F.col("filename").alias("line"),
    )
    return frame.unionByName(entries)


def in_reading_order(lines):
    """Report rows sorted over all partitions, ready for a text sink."""
    return lines.orderBy("section", "ord").select(F.col("line").alias("value"))
