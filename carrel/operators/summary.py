"""Status counts per stage of a run."""

from functools import reduce

from pyspark.sql import functions as F


def status_summary(df, success, status="status"):
    """Total, successes and failures; whatever is not the given word failed."""
    hit = F.col(status).eqNullSafe(F.lit(success))
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(hit).alias("successes"),
        F.count_if(~hit).alias("failures"),
    )


def job_summary(fetched, processed, skipped):
    """One row per stage; skipped records are neither successes nor failures."""
    stages = [
        status_summary(fetched, "fetched").select(F.lit("fetched").alias("stage"), "*"),
        status_summary(processed, "success").select(F.lit("processed").alias("stage"), "*"),
        skipped.agg(F.count(F.lit(1)).alias("total")).select(
            F.lit("skipped").alias("stage"),
            "total",
            F.lit(None).cast("bigint").alias("successes"),
            F.lit(None).cast("bigint").alias("failures"),
        ),
    ]
    return reduce(lambda a, b: a.unionByName(b), stages)
