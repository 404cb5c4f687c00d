"""Near duplicates among embeddings by hashing to points of the E8 lattice.

Each table projects a vector at random to eight coordinates (or several times
eight), moves them by a random offset and decodes them to the nearest point of
E8: its cell. A vector lies in its own cell and looks into the ``probes`` cells
around it that it is nearest to. Vectors of one cell, of which one at least lies
in it, are compared by cosine. A pair that meets in several cells is counted in
the first of them only, so links are numbers that add up and never pairs.
"""

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from carrel.llm.common import share_of, stage
from carrel.llm.graph import components

CHUNK = 1024


def lattice_roots():
    """The 240 shortest vectors of E8: the steps from a cell to its neighbours."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            step = np.zeros(8)
            step[[i, j]] = a, b
            out.append(step)
    halves = np.array(list(itertools.product((0.5, -0.5), repeat=8)))
    return np.concatenate([np.array(out), halves[(halves < 0).sum(1) % 2 == 0]])


def _nearest_even(y):
    """Nearest whole points with an even sum."""
    near = np.rint(y)
    off = y - near
    worst = np.abs(off).argmax(1)
    odd = np.flatnonzero(near.sum(1) % 2 != 0)
    near[odd, worst[odd]] += np.where(off[odd, worst[odd]] >= 0, 1, -1)
    return near


def nearest_points(y):
    """The nearest point of E8 for each row: whole coordinates of even sum, or all of them moved by a half."""
    whole, half = _nearest_even(y), _nearest_even(y - 0.5) + 0.5
    nearer = ((y - whole) ** 2).sum(1) <= ((y - half) ** 2).sum(1)
    return np.where(nearer[:, None], whole, half)


class Hashing:
    """``tables`` random projections of vectors of ``size`` numbers, each to ``blocks`` points of E8.

    A wider cell (``width``), more ``probes`` and more ``tables`` find more; more
    ``blocks`` make cells smaller, for more vectors in a label.
    """

    def __init__(self, size, tables, probes, width, blocks, seed):
        draw = np.random.default_rng([seed, size])
        self.tables, self.probes, self.blocks = tables, probes, blocks
        self.turn = draw.normal(size=(size, tables * blocks * 8)) / width
        self.move = draw.uniform(0, 2, tables * blocks * 8)
        self.roots = lattice_roots()

    def keys(self, unit):
        """Cells of unit vectors: (rows, tables, 1 + probes), the own cell first."""
        n, blocks, probes = len(unit), self.blocks, self.probes
        places = unit @ self.turn + self.move
        out = np.empty((n, self.tables, 1 + probes), np.int64)
        for number in range(self.tables):
            own = places[:, number * blocks * 8 : (number + 1) * blocks * 8]
            points = np.concatenate([nearest_points(own[:, b * 8 : b * 8 + 8]) for b in range(blocks)], 1)
            gain = np.concatenate([(own - points)[:, b * 8 : b * 8 + 8] @ self.roots.T for b in range(blocks)], 1)
            steps = np.argsort(-gain, axis=1, kind="stable")[:, :probes]
            twice = np.rint(points * 2).astype(np.int32)
            cells = np.repeat(twice[:, None, :], 1 + probes, axis=1)
            roots = np.rint(self.roots * 2).astype(np.int32)
            for p in range(probes):
                block, root = np.divmod(steps[:, p], len(roots))
                for b in range(blocks):
                    rows = np.flatnonzero(block == b)
                    cells[rows, 1 + p, b * 8 : b * 8 + 8] += roots[root[rows]]
            flat = np.ascontiguousarray(cells).reshape(n * (1 + probes), -1)
            hashed = [xxhash.xxh32_intdigest(x.tobytes(), number) for x in flat]
            out[:, number] = (np.array(hashed, np.int64) + (number << 32)).reshape(n, 1 + probes)
        return out


def units_of(vectors):
    """Rows of unit length, in double precision."""
    rows = np.asarray(vectors, np.float64)
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def _keyed(options):
    def run(batches):
        made = {}
        for batch in batches:
            for low in range(0, batch.num_rows, 2000):
                part = batch.slice(low, 2000)
                size = part.column("size").to_numpy()
                for own in np.unique(size):
                    rows = np.flatnonzero(size == own)
                    hashing = made.get(own)
                    if hashing is None:
                        hashing = made[own] = Hashing(int(own), **options)
                    taken = part.take(pa.array(rows))
                    keys = hashing.keys(units_of(taken.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, own)))
                    flat = pa.array(keys.reshape(-1))
                    offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * keys[0].size)
                    yield pa.RecordBatch.from_arrays(
                        [*taken.columns, pa.ListArray.from_arrays(offsets, flat)], [*taken.schema.names, "keys"]
                    )

    return run


def _first_meeting(keys, key, a, b, probes):
    """Of the pairs those that meet in no cell before ``key``; keys: (rows, cells), own cells at the start of a table."""
    wide = 1 + probes
    table = key >> 32
    keep = np.ones(len(a), bool)
    for number in range(table + 1):
        x, y = keys[a, number * wide : (number + 1) * wide], keys[b, number * wide : (number + 1) * wide]
        left = (y == x[:, :1]).any(1)  # the one's own cell is seen by the other
        right = (x == y[:, :1]).any(1)
        if number < table:
            keep &= ~(left | right)
        else:
            none = np.iinfo(np.int64).max
            keep &= np.minimum(np.where(left, x[:, 0], none), np.where(right, y[:, 0], none)) == key
    return keep


def _links(units, own, keys, chunk, cell, key, threshold, probes):
    """Index pairs of a cell that are linked and counted here."""
    m = len(units)
    diagonal = cell[0] == cell[1]
    for low in range(0, m, 512):
        likeness = units[low : low + 512] @ units.T
        a, b = np.nonzero(likeness >= threshold)
        a = a + low
        good = (a < b) & (own[a] | own[b])
        if not diagonal:
            good &= chunk[a] != chunk[b]
        a, b = a[good], b[good]
        if len(a):
            good = _first_meeting(keys, key, a, b, probes)
            a, b = a[good], b[good]
        if len(a):
            yield a, b


def _forest(m, first, second):
    """For each row the least row of its component."""
    label = np.arange(m)
    while True:
        low = np.minimum(label[first], label[second])
        after = label.copy()
        np.minimum.at(after, first, low)
        np.minimum.at(after, second, low)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def _compared(threshold, probes):
    """Links within cells, from rows sorted by (label, key, low, high): for each node that has any, a node of its
    component and the number of vectors that it is linked to here."""

    def of_group(part):
        m = part.num_rows
        if m < 2:
            return None
        own = part.column("own").to_numpy(zero_copy_only=False).astype(bool)
        node, many = part.column("node").to_numpy(), part.column("many").to_numpy()
        size = part.column("size").to_numpy()
        keys = part.column("keys").combine_chunks().flatten().to_numpy().reshape(m, -1)
        key = int(part.column("key")[0].as_py())
        cell = (part.column("low")[0].as_py(), part.column("high")[0].as_py())
        chunk = part.column("chunk").to_numpy()
        firsts, seconds, counts = [], [], np.zeros(m, np.int64)
        for length in np.unique(size):
            rows = np.flatnonzero(size == length)
            if len(rows) < 2:
                continue
            vectors = part.column("vector").combine_chunks().take(pa.array(rows))
            units = units_of(vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, length))
            for a, b in _links(units, own[rows], keys[rows], chunk[rows], cell, key, threshold, probes):
                a, b = rows[a], rows[b]
                firsts.append(a)
                seconds.append(b)
                np.add.at(counts, a, many[b])
                np.add.at(counts, b, many[a])
        if not firsts:
            return None
        label = _forest(m, np.concatenate(firsts), np.concatenate(seconds))
        hit = np.flatnonzero(counts)
        return pa.record_batch({"a": node[hit], "b": node[label[hit]], "n": counts[hit]})

    def run(batches):
        held = []
        last = None
        for batch in batches:
            marks = [batch.column(c) for c in ("label", "key", "low", "high")]
            changed = np.zeros(max(0, batch.num_rows - 1), bool)
            for column in marks:
                values = column.dictionary_encode().indices.to_numpy()
                changed |= values[1:] != values[:-1]
            edges = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
            for low, high in zip(edges[:-1], edges[1:]):
                if low == high:
                    continue
                now = tuple(column[low].as_py() for column in marks)
                if now != last and held:
                    found = of_group(pa.Table.from_batches(held).combine_chunks())
                    if found is not None:
                        yield found
                    held = []
                last = now
                held.append(batch.slice(low, high - low))
        if held:
            found = of_group(pa.Table.from_batches(held).combine_chunks())
            if found is not None:
                yield found

    return run


def _usable(vector, label):
    """Vectors that can be compared: a label, numbers only, and not all zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(label.isNotNull() & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(
    vectors, threshold=0.93, tables=5, probes=4, width=1.5, blocks=1, seed=23, chunk=CHUNK,
    id_col="vec_id", vector="embedding", label="label",
):
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``.

    Vectors of one label are linked where they are found to have a cosine of at
    least ``threshold``. ``n_links`` is the number of other vectors that a vector
    is linked to, ``component_id`` the least id that it reaches over links, itself
    included, ``kept`` whether that is its own.

    Null labels, null, empty or zero vectors and those with null or non-finite
    numbers link with nothing; vectors of different lengths don't link; equal
    vectors of a label are one node and always linked; rows without an id take
    part, get the id of their component (null if no row of it has one) and are
    kept if that is null; repeated rows are reported each; an empty table gives
    none. Other columns are not read.

    A cell with more than ``chunk`` vectors is dealt to pairs of chunks, each pair
    of vectors to one of them.
    """
    spark = vectors.sparkSession
    options = {"tables": tables, "probes": probes, "width": width, "blocks": blocks, "seed": seed}
    v = F.col(vector)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label).alias("label"), v.alias("vector"), _usable(v, F.col(label)).alias("good"))
    rows = rows.select("*", F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(7), "vector").alias("h2"), F.size("vector").alias("size"))
    same = ["label", "h1", "h2", "size"]
    distinct = rows.where("good").groupBy(*same).agg(F.first("vector").alias("vector"), F.count("*").alias("many"), F.min("id").alias("least"))
    kind = rows.schema["vector"].dataType.simpleString()
    names = rows.schema["label"].dataType.simpleString()
    numbered = distinct.withColumn("node", F.monotonically_increasing_id())
    layout = f"label {names}, h1 long, h2 long, size int, vector {kind}, many long, least {rows.schema['id'].dataType.simpleString()}, node long, keys array<long>"
    nodes = stage(numbered.mapInArrow(_keyed(options), layout), "vectors")

    keyed = nodes.select("node", "label", F.posexplode("keys").alias("at", "key"))
    keyed = keyed.select("node", "label", "key", (F.col("at") % (1 + probes) == 0).alias("own"))
    counts = keyed.groupBy("label", "key").agg(F.count("*").alias("n"), F.max("own").alias("lived"))
    counts = counts.where("n > 1 and lived").select("label", "key", F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))
    shared = keyed.join(counts, ["label", "key"])
    shared = shared.withColumn("chunk", F.pmod(F.xxhash64("node", "key"), F.col("chunks")).cast("int"))
    shared = shared.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    placed = shared.select(
        "node", "key", "own", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high")
    )
    cells = placed.join(nodes.select("node", "label", "vector", "size", "many", "keys"), "node")
    tasks = share_of(spark, nodes.count(), 4_000)
    dealt = cells.repartition(tasks, "label", "key", "low", "high").sortWithinPartitions("label", "key", "low", "high")
    found = stage(dealt.mapInArrow(_compared(threshold, probes), "a long, b long, n long"), "vector-links")

    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    groups = components(found.select("a", "b"))
    member = nodes.select(*same, "node", "many", "least").join(groups, "node", "left").join(links, "node", "left")
    member = member.withColumn("group", F.coalesce("component", "node"))
    ids = member.groupBy("group").agg(F.min("least").alias("component_id"))
    member = member.join(ids, "group").select(
        *same, (F.col("many") - 1 + F.coalesce("n", F.lit(0))).cast("long").alias("n_links"), "component_id", F.lit(True).alias("good")
    )
    slim = rows.select("id", *same, "good")
    linked = slim.where("good").join(member.drop("good"), same)
    alone = slim.where("not good").select("id", *same, "good", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    every = linked.select("id", "n_links", "component_id").unionByName(alone.select("id", "n_links", "component_id"))
    return every.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
