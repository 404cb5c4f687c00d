"""Fixed-size batches in row order."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from carrel.session import shared_root, stage


def with_row_index(df, order, name="row_index"):
    """0-based position of every row in the given total order.

    A range sort, a count per sorted partition, and the running total of those
    counts as offsets: no window spans the whole table. The sorted rows are
    checkpointed to the shared folder, because their partition numbers are
    used twice and must not change in between.
    """
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    ordered = df.orderBy(*order).checkpoint()
    tagged = ordered.withColumn("_part", F.spark_partition_id()).withColumn(
        "_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    )
    # One row per partition, so this window stays small.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        tagged.join(stage(offsets, "row-offsets"), "_part")
        .withColumn(name, F.col("_row") + F.col("_before"))
        .drop("_part", "_row", "_before")
    )


def assign_batches(df, order, size=10):
    """``batch_id``: position in the order divided by the batch size."""
    return with_row_index(df, order).withColumn(
        "batch_id", F.floor(F.col("row_index") / F.lit(size)).cast("bigint")
    )
