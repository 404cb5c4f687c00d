"""Connected components by alternating stars, on links only."""

from pyspark.sql import functions as F

from carrel.llm.common import stage


def _star(pairs, larger):
    """Links each neighbour (all that are larger, or all that aren't) to the least of a node's neighbourhood."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not larger:
        both = both.where(F.col("b") <= F.col("a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    joined = both.join(least, "a")
    if larger:
        linked = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        linked = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return linked.where(F.col("a") != F.col("b")).distinct()


def components(pairs, rounds=60):
    """``node``, ``component`` (the least node it reaches) for every node in a link.

    ``pairs`` has columns ``a``, ``b``. Each round writes the links to the
    shared folder, which cuts the lineage; a few numbers per round reach the
    driver. The number of rounds grows with the logarithm of the longest chain.
    """
    links = stage(pairs.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "links")
    mark = None
    for _ in range(rounds):
        links = stage(_star(_star(links, True), False), "links")
        state = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first()
        if state == mark:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        mark = state
    raise RuntimeError(f"no fixed point after {rounds} rounds")
