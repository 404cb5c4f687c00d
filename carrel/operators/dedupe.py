"""One or several rows per key, safe when one key holds most rows.

All of them are aggregates with a partial step before the shuffle, so a hot
key reaches the final task as one row per upstream task.
"""

from pyspark.sql import functions as F


def _pick(df, keys, order, best):
    # min_by and max_by leave out rows with a null order; a struct is never null.
    # A null counts as smaller than any value.
    order = F.struct(*[part for c in order for part in (F.col(c).isNotNull(), F.col(c))])
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(best(F.struct(*rest), order).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def first_seen(df, keys, order):
    """First row of each key in the given order."""
    return _pick(df, keys, order, F.min_by)


def last_wins(df, keys, order):
    """Last row of each key in the given order."""
    return _pick(df, keys, order, F.max_by)


def latest_per_group(df, keys, order):
    """All rows of each key that share its latest ``order`` value.

    Ties are kept. The latest value is joined back on the keys and the value,
    so no task has to hold a whole group; a hot key that ties on one value is
    split by the skew handling of the join.
    """
    latest = (
        df.where(F.col(order).isNotNull())
        .groupBy(*keys)
        .agg(F.max(order).alias(order))
    )
    return df.join(latest, [*keys, order], "left_semi").select(*df.columns)
