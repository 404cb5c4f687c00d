"""Evaluating costly columns once, and building their expressions once."""

import functools

from pyspark import SparkContext
from pyspark.sql import functions as F


def built_once(function):
    """For a function that gives columns from plain arguments: they are built once in a session.

    A column is a description and can be used in any number of frames, but a
    long one takes hundreds of calls to the JVM to build, which a job that runs
    every few seconds would spend most of its time on.
    """
    built = {}

    @functools.wraps(function)
    def run(*args):
        context = SparkContext._active_spark_context
        if built.get("context") is not context:
            built.clear()
            built["context"] = context
        if args not in built:
            built[args] = function(*args)
        return built[args]

    return run


def compute_once(df, **columns):
    """Adds columns that are evaluated once per row, however they are used.

    The optimizer copies the expression of a column into every filter on it,
    and an expression built on others multiplies that way. Nothing is pushed
    through a generator, so the values come out of one that makes one row.
    """
    packed = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.select(*df.columns, packed.alias("_once")).select(
        *df.columns, *[F.col("_once")[name].alias(name) for name in columns]
    )
