"""Mixing sources to target weights by Sainte-Laguë apportionment.

Every source is laid out as a stream of its documents in a seeded order and
cut into blocks of equal numbers of words. Blocks are seats: they are handed
out to the sources by highest quotient ``votes / (2 * seats + 1)``, then in
the same way to the shards of a source, which gives whole quotas per (source,
shard). A quota of more than all blocks of its shard repeats them; the rest is
a run of blocks from a seeded start, and since the documents lie in seeded
order, that run is a seeded choice.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from carrel.llm.common import stage

WORD = r"[^\x20\x09-\x0D]+"  # fixed value
WEIGHTS = (3, 1, 2)  # fixed value: weights of the sources in code point order, repeating


def with_sizes(docs, text="text", pattern=WORD):
    """Adds ``size``, the number of words; a null text has none."""
    count = F.coalesce(F.regexp_count(F.col(text), F.lit(pattern)), F.lit(0)).cast("long")
    return docs.withColumn("size", count)


def source_targets(sizes, ratio=1.5, cap=2.0, weights=WEIGHTS):
    """One row per source: ``source_size``, ``weight`` and ``target``.

    The targets share ``ratio`` of all words by weight. No target exceeds
    ``cap`` times its source; what is cut off goes to the others by weight. In
    order of ``cap * size / weight`` the capped sources come first, so one
    running sum finds them. The windows run over one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % F.lit(len(weights))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    level = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    after = level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = (
        totals.withColumn("weight", F.element_at(listed, (place + 1).cast("int")))
        .withColumn("most", F.lit(cap) * F.col("source_size"))
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("share", F.lit(ratio) * F.sum("source_size").over(every))
        .withColumn("used", F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(after))
        .withColumn("level", (F.col("share") - F.col("used")) / F.col("open"))
        .withColumn("full", F.col("ratio") <= F.col("level"))
    )
    common = F.max(F.when(~F.col("full"), F.col("level"))).over(every)
    target = F.when(F.col("full"), F.col("most")).otherwise(F.col("weight") * common)
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def apportion(votes, seats, by=(), order=("source",)):
    """Adds whole ``seats`` to rows with ``votes`` by highest quotients.

    ``seats`` names the column with the number of seats of the group ``by``.
    Seats are given one at a time to the row with the largest
    ``votes / (2 * seats + 1)``, ties in the given order. A divisor slightly
    too large gives each row a prefix of its seats at once, one slightly too
    small bounds them; only the seats between (at most two per row) are ranked
    by quotient. Rows without votes get none.
    """
    group = Window.partitionBy(*by)
    rows = (
        votes.withColumn("_all", F.sum("votes").over(group))
        .withColumn("_n", F.sum((F.col("votes") > 0).cast("long")).over(group))
        .withColumn("_id", F.row_number().over(group.orderBy(*[F.col(c).asc_nulls_last() for c in order])))
    )
    seats_of = F.col(seats)
    half = F.col("_n") / 2 + 1
    few = F.greatest(seats_of - half, F.lit(0.0))
    count = lambda n: F.floor(F.col("votes") * n / F.col("_all") + F.lit(0.5))
    some = F.col("votes") > 0
    rows = rows.withColumn("_low", F.when(some & (few > 0), count(few)).otherwise(F.lit(0)).cast("long"))
    rows = rows.withColumn("_high", F.when(some, count(seats_of + half) + 1).otherwise(F.lit(0)).cast("long"))
    rows = rows.withColumn("_rest", seats_of - F.sum("_low").over(group))
    open_seats = rows.where(F.col("_high") > F.col("_low")).withColumn(
        "_seat", F.explode(F.sequence(F.col("_low"), F.col("_high") - 1))
    )
    quotient = F.col("votes") / (2 * F.col("_seat") + 1)
    ranked = open_seats.withColumn("_rank", F.row_number().over(group.orderBy(quotient.desc(), "_id", "_seat")))
    keys = [*by, "_id"]
    won = (
        ranked.where(F.col("_rank") <= F.col("_rest"))
        .groupBy(*keys)
        .agg(F.count("*").alias("_won"))
        .select(*[F.col(k).alias(f"_w{k}") for k in keys], "_won")
    )
    same = [rows[k].eqNullSafe(won[f"_w{k}"]) for k in keys]
    on = same[0]
    for condition in same[1:]:
        on = on & condition
    kept = [c for c in votes.columns]
    return rows.join(won, on, "left").select(
        *[rows[c] for c in kept], (F.col("_low") + F.coalesce(F.col("_won"), F.lit(0))).alias("quota")
    )


def _drawn(*parts):
    """60 seeded bits of the parts' digest, as a long."""
    return F.conv(F.substring(F.md5(F.encode(F.concat_ws(":", *parts), "UTF-8")), 1, 15), 16, 10).cast("long")


def mix(docs, ratio=1.5, cap=2.0, weights=WEIGHTS, block=8, shard_words=500_000, seed=7, id_col="doc_id"):
    """How many words the mix takes of each document.

    Returns one row per document: id, ``source``, ``size``, ``source_size``,
    ``target``, ``taken``. ``block`` is the number of words of a block,
    ``shard_words`` about the words of a shard, so the window that lays out a
    (source, shard) is bounded however large a source is; ``seed`` sets the
    order. No document is taken more than ``cap`` times, rounded up to a whole
    number. Null texts have size 0 and take 0; a null source is a source of its
    own, the last; repeated rows are documents of their own, equal ids are
    laid out by size; an empty table gives an empty table. Columns beside id,
    text and source are not read, so their names don't matter.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col("text"), F.col("source").cast("string").alias("source"))
    sizes = stage(with_sizes(slim).drop("text"), "mix-sizes")
    words = sizes.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-words // shard_words))
    targets = stage(source_targets(sizes, ratio, cap, weights), "mix-targets")
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    place = _drawn(text_id, F.lit(str(seed)))
    laid = sizes.withColumn("_place", place).withColumn("_shard", F.pmod("_place", F.lit(shards)))

    # Seats of the sources, then of their shards.
    total = F.sum("target").over(Window.partitionBy())
    sources = targets.withColumn("votes", F.col("target")).withColumn("seats", F.round(total / block).cast("long"))
    quotas = apportion(sources, "seats", (), ("source",)).select("source", "source_size", "target", F.col("quota").alias("seats"))
    cells = laid.groupBy("source", "_shard").agg(F.sum("size").alias("votes"))
    cells = cells.join(quotas.select(F.col("source").alias("_s"), "seats"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    cells = apportion(cells.withColumnRenamed("votes", "cell").withColumn("votes", F.col("cell").cast("double")), "seats", ("source",), ("_shard",))
    blocks = F.ceil(F.col("cell") / block)
    quota = F.least(F.col("quota"), F.lit(int(-(-cap // 1))) * blocks)
    times = F.when(blocks > 0, F.floor(quota / blocks)).otherwise(F.lit(0))
    begin = _drawn(F.coalesce(F.col("source"), F.lit("")), F.col("_shard").cast("string"), F.lit(str(seed + 1)))
    start = F.pmod(begin, F.greatest(blocks, F.lit(1)))
    cells = stage(
        cells.select(
            "source", "_shard", "cell", times.alias("_times"), (quota - times * blocks).alias("_extra"),
            start.alias("_start"), blocks.alias("_blocks"),
        ),
        "mix-cells",
    )

    cell = Window.partitionBy("source", "_shard").orderBy("_place", "doc_id", "size")
    ends = laid.withColumn("_end", F.sum("size").over(cell.rowsBetween(Window.unboundedPreceding, 0)))
    c = cells.select(F.col("source").alias("_s"), F.col("_shard").alias("_h"), "_times", "_extra", "_start", "_blocks", "cell")
    both = ends.join(c, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_shard") == F.col("_h")))

    def overlap(first, last):
        low, high = F.col("_end") - F.col("size"), F.col("_end")
        return F.greatest(F.lit(0), F.least(high, last * block) - F.greatest(low, first * block))

    stop = F.col("_start") + F.col("_extra")
    extra = overlap(F.col("_start"), F.least(stop, F.col("_blocks"))) + overlap(F.lit(0), stop - F.col("_blocks"))
    taken = (F.col("_times") * F.col("size") + F.when(F.col("_extra") > 0, extra).otherwise(F.lit(0))).cast("long")
    q = targets.select(F.col("source").alias("_q"), "source_size", "target")
    return both.join(q, F.col("source").eqNullSafe(F.col("_q"))).select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken")
    )


def apply_mix(docs, **options):
    """The documents of the mix, each as often as it is taken in full or in part.

    A document whose blocks are taken ``n`` times its size on average appears
    ``round(n)`` times, at least once if any of its words is taken.
    """
    taken = mix(docs, **options).groupBy("doc_id", "size").agg(F.max("taken").alias("_taken"))
    taken = taken.select(F.col("doc_id").alias("_id"), F.col("size").alias("_size"), "_taken")
    sized = with_sizes(docs.withColumn("_keep", F.struct("*")), "text").select("_keep", F.col("size").alias("_words"))
    on = F.col("_keep.doc_id").eqNullSafe(F.col("_id")) & (F.col("_words") == F.col("_size"))
    copies = F.greatest(F.lit(1), F.round(F.col("_taken") / F.greatest(F.col("_size"), F.lit(1)))).cast("int")
    joined = sized.join(taken.where(F.col("_taken") > 0), on)
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).select("_keep.*")
