"""Sharding by minimax contiguous partition of ordered atomic groups.

Equal texts form a group that is never cut. Groups are ordered by digest; of
all ways to cut that order into ``shards`` runs, the one whose largest run is
smallest is taken: its capacity is found by search over whole numbers, each
candidate checked greedily (fill a run as far as it goes, then cut), and the
cuts are those of the smallest feasible capacity. The sums of digest buckets
settle the search but for a few narrow gaps; one job looks into all of them.
"""

import bisect

from pyspark.sql import Window
from pyspark.sql import functions as F

from carrel.llm.common import stage, whole_text


def group_rows(docs, text="text", id_col="doc_id", buckets=1024, salts=1):
    """Narrow rows: id, ``size``, ``text_crc32``, ``digest``, its bucket and a salt."""
    data = F.encode(whole_text(text), "UTF-8")
    slim = docs.select(F.col(id_col).alias("doc_id"), data.alias("_data"))
    digest = F.unhex(F.sha2("_data", 256))
    rows = slim.select(
        "doc_id",
        (F.octet_length("_data") + 1).cast("long").alias("size"),
        F.crc32("_data").alias("text_crc32"),
        digest.alias("digest"),
    )
    head = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    return rows.withColumn("bucket", F.floor(head * buckets / F.lit(2**32)).cast("int")).withColumn(
        "salt", F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(salts)).cast("int")
    )


class Ends:
    """What is known of the sorted ends of groups: some of them, and between which of these others may lie."""

    def __init__(self, known, open_after):
        self.known, self.open_after = known, open_after

    def reach(self, bound):
        """The largest end up to ``bound``: what is known for sure, and what it can be at most."""
        at = bisect.bisect_right(self.known, bound) - 1
        low = self.known[at]
        return low, bound if self.open_after[at] else low

    def walk(self, capacity, runs, most):
        """Ends of greedy runs of at most ``capacity``: at least, or at most (``most``)."""
        at, out = 0, []
        for _ in range(runs):
            at = self.reach(at + capacity)[most]
            out.append(at)
        return out

    def smallest(self, low, high, runs, most):
        """The smallest capacity in the range that takes everything in, as far as it is known."""
        total = self.known[-1]
        while low < high:
            middle = (low + high) // 2
            if self.walk(middle, runs, most)[-1] >= total:
                high = middle
            else:
                low = middle + 1
        return low

    def open_in(self, low, high):
        """Places of the gaps in which an end between ``low`` and ``high`` may lie unknown."""
        first = max(0, bisect.bisect_right(self.known, low) - 1)
        last = bisect.bisect_right(self.known, high)
        return [i for i in range(first, min(last, len(self.known) - 1)) if self.open_after[i]]

    def refine(self, groups, gaps, bins):
        """Looks into the gaps in one job: least and largest end, and their number, of each bin."""
        runs = []
        for i in sorted(gaps):
            if runs and runs[-1][1] == self.known[i]:
                runs[-1][1] = self.known[i + 1]
            else:
                runs.append([self.known[i], self.known[i + 1]])
        wide = max(1, -(-sum(b - a for a, b in runs) // bins))
        end, inside, number = F.col("end"), F.lit(False), F.lit(None).cast("long")
        for place, (a, b) in enumerate(runs):
            within = (end > a) & (end <= b)
            inside = inside | within
            number = F.when(within, F.floor((end - a) / wide) * len(runs) + place).otherwise(number)
        seen = groups.where(inside).groupBy(number.alias("bin")).agg(F.min("end"), F.max("end"), F.count("*"))
        closed = {self.known[i] for i in gaps}
        both = {end: way and end not in closed for end, way in zip(self.known, self.open_after)}
        found = [tuple(r)[1:] for r in seen.collect()]
        for least, most, _ in found:
            both.setdefault(least, False)
            both.setdefault(most, False)
        self.known = sorted(both)
        self.open_after = [both[end] for end in self.known]
        for least, most, count in found:
            if count > 2:  # others may lie behind each known end of the bin but its last
                at, to = bisect.bisect_left(self.known, least), bisect.bisect_left(self.known, most)
                self.open_after[at:to] = [True] * (to - at)


def minimax_cuts(groups, ends, largest, shards, bins=16_384):
    """Smallest feasible capacity and the cuts (byte offsets) it gives.

    ``groups`` has ``end``; ``ends`` is what the sums of buckets tell of them,
    ``largest`` the size of the largest group. The search runs on what is known;
    where the capacity or a cut still depends on ends that are not, one job looks
    into those gaps of all shards, and the search goes on. A round leaves a gap
    ``bins`` times as narrow, so there are two or three of any table.
    """
    total = ends.known[-1]
    low = max(largest, -(-total // shards))
    high = largest + low
    while True:
        low, high = ends.smallest(low, high, shards, 1), ends.smallest(low, high, shards, 0)
        first, last = ends.walk(low, shards - 1, 0), ends.walk(high, shards - 1, 1)
        if low == high and first == last:
            return high, first
        gaps = {i for a, b in zip(first, last) for i in ends.open_in(a, b)}
        ends.refine(groups, gaps, bins)


def shard(docs, shards=8, id_col="doc_id", text="text", rows_per_cell=20_000, max_buckets=16_384):
    """One row per document: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    ``size`` is the number of UTF-8 bytes plus 1; the law is ``bytes``. Shards
    are runs of groups, slots count the rows of a shard from 0 in the order of
    group, salt and id. Null texts count as empty and are one group with empty
    ones; equal rows get slots of their own; a group larger than a fair shard
    stays whole, so its shard is as large as it is; an empty table gives an
    empty table and shards may stay empty where there are fewer groups.

    Every window is bounded: a hot group is counted in salted cells of about
    ``rows_per_cell`` rows, and byte offsets run within one bucket of digests.
    What reaches the driver is one row per bucket (``max_buckets`` at most) and
    one per bin of a round (16,384 at most).
    """
    spark = docs.sparkSession
    n = docs.count()
    parts = max(1, -(-n // rows_per_cell))
    buckets = 1
    while buckets < min(max_buckets, parts * 4):
        buckets *= 2
    rows = stage(group_rows(docs, text, id_col, buckets, parts), "shard-rows")
    cells = stage(
        rows.groupBy("bucket", "digest", "salt").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")),
        "shard-cells",
    )
    sums = {
        r.bucket: (r.bytes, r.n)
        for r in cells.groupBy("bucket").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).collect()
    }
    starts, firsts, at, first = [], [], 0, 0
    for bucket in range(buckets):
        starts.append(at)
        firsts.append(first)
        size, count = sums.get(bucket, (0, 0))
        at, first = at + size, first + count
    total = at
    offsets = spark.createDataFrame(list(zip(range(buckets), starts, firsts)), "at int, start long, first long")

    group = cells.groupBy("bucket", "digest").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    upto = Window.partitionBy("bucket").orderBy("digest").rowsBetween(Window.unboundedPreceding, 0)
    groups = stage(
        group.withColumn("_b", F.sum("bytes").over(upto))
        .withColumn("_n", F.sum("n").over(upto))
        .join(F.broadcast(offsets), F.col("bucket") == F.col("at"))
        .select(
            "bucket", "digest", (F.col("start") + F.col("_b")).alias("end"), "bytes",
            (F.col("first") + F.col("_n") - F.col("n")).alias("first"),
        ),
        "shard-groups",
    )
    largest = groups.agg(F.max("bytes")).first()[0] or 0
    filled = [b for b in range(buckets) if sums.get(b, (0, 0))[1]]
    known = [0] + [starts[b] + sums[b][0] for b in filled]
    ends = Ends(known, [sums[b][1] > 1 for b in filled] + [False])
    _, cuts = minimax_cuts(groups, ends, largest, shards)

    begin = F.col("end") - F.col("bytes")
    number = F.lit(0)
    for cut in cuts:
        number = number + (begin >= F.lit(cut)).cast("int")
    placed = groups.withColumn("shard", number.cast("int"))
    opened = {r.shard: r.first for r in placed.groupBy("shard").agg(F.min("first").alias("first")).collect()}
    base = F.lit(0)
    for number, first in sorted(opened.items()):
        base = F.when(F.col("shard") == number, F.lit(first)).otherwise(base)
    placed = placed.select("digest", "shard", (F.col("first") - base).alias("_from"))

    salted = Window.partitionBy("digest").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    cell = cells.withColumn("_skip", F.coalesce(F.sum("n").over(salted), F.lit(0))).select("digest", "salt", "_skip")
    cell = cell.join(placed, "digest").withColumn("_from", F.col("_from") + F.col("_skip")).drop("_skip")
    within = Window.partitionBy("digest", "salt").orderBy("doc_id")
    numbered = rows.drop("bucket").withColumn("_nr", F.row_number().over(within) - 1)
    return numbered.join(cell, ["digest", "salt"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_from") + F.col("_nr")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
