"""SimHash near duplicates, pruned by pivot distance tables.

Every fingerprint carries a table row: its Hamming distances to a fixed set of
reference fingerprints (pivots). Two fingerprints that differ in ``bits`` bits
have distances to any pivot that differ by at most ``bits``, so a pair whose
largest coordinate difference is more is discarded without a look at the
fingerprints; survivors are verified.

Pairs are looked for among fingerprints that share a key: two equal blocks of
the fingerprint. A key with many fingerprints is dealt to cells of at most two
chunks, so each pair of its chunks meets in one cell of bounded size; a cell
returns a spanning forest of its links, never all of them.

Near copies of texts are linked in two steps. The first is a short cut: texts
that share a least shingle hash and have near fingerprints are verified and
grouped. The second leaves no pair out: two sets that are similar share one of
their first shingles in any common order, so all pairs of different groups that
do are tested, by bounds that hold for every similar pair, and then verified.
"""

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from pyspark.sql import Window

from carrel.llm.common import row_key, share_of, stage, whole_text
from carrel.llm.graph import components

PIVOTS = 32
CHUNK = 1024


def pivots(count=PIVOTS, seed=11):
    return np.random.default_rng(seed).integers(0, 2**64, count, dtype=np.uint64)


def shingle_hashes(data, width, seed=42):
    """XXH64 of every run of ``width`` words; A-Z lower-cased; fewer words are one run."""
    words = data.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    ends = (starts + lengths)[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], seed) for a, b in zip(starts.tolist(), ends)], np.uint64)


def fingerprint_of(hashes):
    """A bit is 1 if it is set in over half the hashes; no hash gives 0."""
    if not len(hashes):
        return 0
    ones = np.unpackbits(hashes.view(np.uint8).reshape(len(hashes), 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def bins_of(shingles, bins=256):
    """The least value of a shingle set in each of ``bins`` parts of its range: an estimate of the set."""
    mixed = shingles * np.uint32(0x9E3779B1)
    out = np.full(bins, 0xFFFF, np.uint16)
    np.minimum.at(out, (mixed >> np.uint32(24)).astype(np.int64) % bins, (mixed & np.uint32(0x7FFF)).astype(np.uint16))
    return out


def least_of(hashes, count):
    """The least hash under each of ``count`` orders; two sets agree in one with the chance of their similarity."""
    odd = np.random.default_rng(5).integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = []
    for number, factor in enumerate(odd):
        mixed = hashes * factor
        mixed ^= mixed >> np.uint64(31)
        out.append((int(mixed.min()) ^ number) & 0x7FFFFFFFFFFFFFFF if len(hashes) else 0)
    return out


SKETCH = 512  # bits, at least
SKETCH_MOST = 1 << 15


def prefix_of(shingles, similarity, common=None):
    """The first shingles of a set, of which two sets share one if they are that similar.

    The order is the same for all sets: those in ``common`` (sorted hashes and
    how often each was seen) come last, the most frequent at the very end; all
    others lie by their hash.
    """
    size = len(shingles)
    if not size:
        return shingles
    rank = np.zeros(size, np.int64)
    if common is not None and len(common[0]):
        at = np.minimum(np.searchsorted(common[0], shingles), len(common[0]) - 1)
        rank = np.where(common[0][at] == shingles, common[1][at], 0)
    # A similar set shares at least this many; it can't if it lacks one more than all the others.
    shared = int(np.ceil(similarity * size - 1e-9))
    return shingles[np.lexsort((shingles, rank))[: size - shared + 1]]


def sketch_of(shingles):
    """Parity of the number of shingles in each of as many places as the set has shingles (a power of two, within
    ``SKETCH`` and ``SKETCH_MOST``): two sketches differ in no more bits than their sets differ in shingles.

    With fewer places large sets that share next to nothing look alike. The halves of a sketch xored are the
    sketch of half as many places.
    """
    bits = SKETCH
    while bits < min(len(shingles), SKETCH_MOST):
        bits *= 2
    mixed = shingles * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
    counts = np.bincount((mixed & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(counts & 1, bitorder="little")


_PRINT = pa.struct(
    [
        ("fingerprint", pa.int64()),
        ("table", pa.binary()),
        ("set", pa.int64()),
        ("least", pa.list_(pa.int64())),
        ("prefix", pa.list_(pa.int64())),
        ("sketch", pa.binary()),
        ("n", pa.int32()),
    ]
)


def _signed(value):
    return value - 2**64 if value >= 2**63 else value


def fingerprints(docs, shingle=3, seed=42, orders=0, text="text", into="print", similarity=None, common=None):
    """Adds ``into``: ``fingerprint`` (64 bits, as a long), its pivot distance ``table`` and, with
    ``orders``, ``least``, a hash of its shingle ``set``, the set's size ``n``, ``sketch`` and ``prefix``; the
    fingerprint is then that of the set. Null counts as empty: fingerprint 0."""
    points = pivots()

    @F.arrow_udf("struct<fingerprint:long,table:binary,set:long,least:array<long>,prefix:array<long>,sketch:binary,n:int>")
    def print_of(texts: pa.Array) -> pa.Array:
        # A few at a time: the rows of a whole batch would be held twice.
        parts = [pa.array(rows_of(texts.slice(low, 500)), type=_PRINT) for low in range(0, len(texts), 500)]
        return pa.concat_arrays(parts) if parts else pa.array([], type=_PRINT)

    def rows_of(texts):
        rows = []
        for t in texts:
            hashes = shingle_hashes(t.as_buffer().to_pybytes(), shingle, seed)
            if orders:
                hashes = np.unique(hashes)
            value = fingerprint_of(hashes)
            row = {"fingerprint": _signed(value), "table": np.bitwise_count(points ^ np.uint64(value)).tobytes()}
            if orders:
                row |= {
                    "set": _signed(xxhash.xxh64_intdigest(hashes.tobytes())),
                    "least": least_of(hashes, orders),
                    "prefix": prefix_of(hashes, similarity, common).view(np.int64),
                    "sketch": sketch_of(hashes).tobytes(),
                    "n": len(hashes),
                }
            rows.append(row)
        return rows

    return docs.withColumn(into, print_of(whole_text(text)))


def shingle_sets(docs, shingle, seed, text="text", into="shingles"):
    """Adds ``into``: the sorted set of shingle hashes, 32 bits each, as bytes."""

    @F.arrow_udf("binary")
    def set_of(texts: pa.Array) -> pa.Array:
        parts = []
        for low in range(0, len(texts), 500):
            hashes = (shingle_hashes(t.as_buffer().to_pybytes(), shingle, seed) for t in texts.slice(low, 500))
            sets = [np.unique((h >> np.uint64(32)).astype(np.uint32)).tobytes() for h in hashes]
            parts.append(pa.array(sets, type=pa.binary()))
        return pa.concat_arrays(parts) if parts else pa.array([], type=pa.binary())

    return docs.withColumn(into, set_of(whole_text(text)))


def block_keys(fingerprint, bits):
    """Keys of which two fingerprints share one if they differ in at most ``bits`` bits.

    Of ``bits + 2`` blocks at least two are equal; each pair of blocks is a key.
    """
    blocks = bits + 2
    edges = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for number, (i, j) in enumerate(itertools.combinations(range(blocks), 2)):
        mask = sum(1 << b for k in (i, j) for b in range(edges[k], edges[k + 1]))
        signed = mask - 2**64 if mask >= 2**63 else mask
        keys.append(F.xxhash64(F.lit(number), fingerprint.bitwiseAND(F.lit(signed))))
    return F.array(*keys)


def _alike(rows, bits, similarity):
    """Index pairs of one cell that are linked; rows: dict of arrays."""
    prints, tables = rows["fingerprint"], rows["table"]
    m = len(prints)
    first, second = np.triu_indices(m, 1) if m < 64 else (None, None)
    if first is None:
        # In order of one coordinate only a window can hold partners.
        order = np.argsort(tables[:, 0], kind="stable")
        lead = tables[order, 0].astype(np.int64)
        upto = np.searchsorted(lead, lead + bits, side="right")
        counts = upto - np.arange(m) - 1
        first = np.repeat(np.arange(m), counts)
        second = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + first + 1
        first, second = order[first], order[second]
    for column in range(tables.shape[1]):
        if not len(first):
            return first, second
        near = np.abs(tables[first, column] - tables[second, column]) <= bits
        first, second = first[near], second[near]
    near = np.bitwise_count(prints[first] ^ prints[second]) <= bits
    first, second = first[near], second[near]
    if similarity is not None and len(first):
        first, second = _verified(rows["shingles"], first, second, similarity)
    return first, second


def _verified(sets, first, second, similarity, many=500):
    """Of the pairs those that link components not linked yet and share enough shingles, exactly.

    Where there are many pairs an estimate puts the likeliest first and leaves
    out what is more than four standard errors below.
    """
    if len(first) > many:
        bins = np.array([bins_of(s) for s in sets])
        alike = np.empty(len(first))
        for at in range(0, len(first), 20_000):
            a, b = bins[first[at : at + 20_000]], bins[second[at : at + 20_000]]
            used = ((a != 0xFFFF) | (b != 0xFFFF)).sum(1)
            alike[at : at + 20_000] = ((a == b) & (a != 0xFFFF)).sum(1) / np.maximum(used, 1)
            # Few bins in use make a coarse estimate.
            alike[at : at + 20_000] += 2 / np.sqrt(np.maximum(used, 1)) - 2 / np.sqrt(256)
        order = np.argsort(-alike, kind="stable")
        order = order[alike[order] >= similarity - 0.1]
        first, second = first[order], second[order]
    root, links = list(range(len(sets))), []

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in zip(first.tolist(), second.tolist()):
        x, y = find(a), find(b)
        if x == y:
            continue
        small, large = sorted((len(sets[a]), len(sets[b])))
        if small < similarity * large:
            continue
        common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
        if common >= similarity * (small + large - common):
            root[max(x, y)] = min(x, y)
            links.append((a, b))
    both = np.array(links, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _forest(m, first, second):
    """Links that hold each component of a cell together: node to the least of its component."""
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


def _link_cells(bits, similarity):
    def run(batches):
        import pyarrow.compute as pc  # noqa: F401  (loads before the first batch)

        held = None
        for batch in itertools.chain(batches, [None]):
            part = batch if held is None else pa.Table.from_batches([held, batch] if batch is not None else [held])
            if part is None:
                return
            part = part.combine_chunks() if isinstance(part, pa.Table) else pa.Table.from_batches([part])
            key = part.column("key").to_numpy()
            cell = part.column("cell").to_numpy()
            new = np.flatnonzero((key[1:] != key[:-1]) | (cell[1:] != cell[:-1])) + 1
            edges = np.concatenate([[0], new, [len(key)]])
            if batch is not None:  # the last group may go on
                edges, tail = edges[:-1], int(edges[-2])
                rest = part.slice(tail).combine_chunks().to_batches()
                held = rest[0] if rest else None
            node = part.column("node").to_numpy()
            prints = part.column("fingerprint").to_numpy().view(np.uint64)
            table = np.frombuffer(b"".join(part.column("table").to_pylist()), np.uint8).reshape(len(key), -1).astype(np.int16)
            sets = None
            if similarity is not None:
                sets = [np.frombuffer(x, np.uint32) for x in part.column("shingles").to_pylist()]
            out_a, out_b = [], []
            for low, high in zip(edges[:-1], edges[1:]):
                if high - low < 2:
                    continue
                own = {"fingerprint": prints[low:high], "table": table[low:high]}
                if sets is not None:
                    own["shingles"] = sets[low:high]
                first, second = _alike(own, bits, similarity)
                if len(first):
                    label = _forest(high - low, first, second)
                    moved = np.flatnonzero(label != np.arange(high - low))
                    out_a.append(node[low:high][moved])
                    out_b.append(node[low:high][label[moved]])
            if out_a:
                yield pa.record_batch({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})
            if batch is None:
                return

    return run


def linked(nodes, bits, similarity=None, sets_of=None, chunk=CHUNK):
    """Links among nodes that share a key: columns ``a``, ``b``.

    ``nodes`` has ``node`` (long), ``fingerprint``, ``table`` and ``keys``. A
    link needs at most ``bits`` different bits and, with ``similarity``, at
    least that share of common shingles; ``sets_of`` then gives ``node`` and
    ``shingles`` of the nodes (a frame with ``node``) that share a key with
    another one. Links that others imply are left out.
    """
    spark = nodes.sparkSession
    keyed = nodes.select("node", F.explode(F.array_distinct("keys")).alias("key"))
    counts = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    chunks = F.ceil(F.col("n") / chunk).cast("int")
    shared = keyed.join(counts, "key").select("node", "key", chunks.alias("chunks"))
    own = F.pmod(F.xxhash64("node", "key"), F.col("chunks")).cast("int")
    shared = shared.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    cell = F.least("own", "other") * F.col("chunks") + F.greatest("own", "other")
    placed = shared.select("node", "key", cell.cast("long").alias("cell"))
    if similarity is not None:
        placed = stage(placed, "shared-keys")
    rows = placed.join(nodes.select("node", "fingerprint", "table"), "node")
    if similarity is not None:
        rows = rows.join(sets_of(placed.select("node").distinct()), "node")
    tasks = share_of(spark, nodes.count(), 50_000)
    dealt = rows.repartition(tasks, "key", "cell").sortWithinPartitions("key", "cell")
    return dealt.mapInArrow(_link_cells(bits, similarity), "a long, b long")


def common_shingles(docs, shingle, seed, text="text", sample=20_000, least=4, most=200_000):
    """Hashes (sorted) and counts of the shingles that at least ``least`` texts of a sample share.

    They only set the order in which shingles are looked at, so what the sample
    misses costs time and no pair. A sample by digest takes the same texts on
    any split of the table; equal texts count once.
    """
    whole = whole_text(text)
    rows = docs.count()
    digest = F.xxhash64(whole, F.lit("common"))
    drawn = docs.where(F.pmod(digest, F.lit(max(1, -(-rows // sample)))) == 0).select(whole.alias("_t")).distinct()

    @F.arrow_udf("array<long>")
    def of(texts: pa.Array) -> pa.Array:
        hashes = (np.unique(shingle_hashes(t.as_buffer().to_pybytes(), shingle, seed)) for t in texts)
        return pa.array([h.view(np.int64) for h in hashes], type=pa.list_(pa.int64()))

    seen = drawn.select(F.explode(of("_t")).alias("s")).groupBy("s").agg(F.count("*").alias("n"))
    found = seen.where(F.col("n") >= least).orderBy(F.desc("n"), "s").limit(most).toArrow()
    hashes, counts = (found.column(c).to_numpy() for c in ("s", "n"))
    order = np.argsort(hashes.view(np.uint64))
    return hashes.view(np.uint64)[order], counts[order]


def _whole_cells(batches):
    """Tables that hold all rows of each of their cells, from rows sorted by key and cell."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        part = part if held is None else pa.concat_tables([held, part])
        key, cell = (part.column(c).to_numpy() for c in ("key", "cell"))
        before = np.flatnonzero((key != key[-1]) | (cell != cell[-1]))
        start = int(before[-1]) + 1 if len(before) else 0
        if start:
            yield part.slice(0, start)
        held = part.slice(start)
    if held is not None:
        yield held


def _fitting(part, similarity):
    """Pairs of rows of a cell, as arrays of places, that may be the first to tell of a similar pair of groups.

    Rows are sorted by key, cell and size. Two similar sets share at least
    ``least`` shingles, so the first that they share stands before what one of
    them can lack; a pair that shares the key further on has met before, or is
    not similar.
    """
    key, cell, group, size, at = (part.column(c).to_numpy() for c in ("key", "cell", "group", "n", "at"))
    block = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]) | (cell[1:] != cell[:-1]))])
    most = np.floor(size / similarity + 1e-9)
    first, step = np.arange(len(key)), 0
    while True:
        step += 1
        first = first[first + step < len(key)]
        first = first[(block[first + step] == block[first]) & (size[first + step] <= most[first])]
        if not len(first):
            return
        other = first + step
        least = np.ceil(similarity / (1 + similarity) * (size[first] + size[other]) - 1e-9)
        fits = (group[first] != group[other]) & (at[first] <= size[first] - least) & (at[other] <= size[other] - least)
        if fits.any():
            yield first[fits], other[fits]


def _meeting_rows(similarity):
    """The rows that fit any other row of their cell."""

    def run(batches):
        for part in _whole_cells(batches):
            meets = np.zeros(part.num_rows, bool)
            for first, other in _fitting(part, similarity):
                meets[first] = True
                meets[other] = True
            if meets.any():
                yield from part.filter(pa.array(meets)).combine_chunks().to_batches()

    return run


def _different_bits(words, starts, widths, first, other, most=1 << 22):
    """Bits in which the sketches of pairs differ; the larger one is folded to the width of the smaller one."""
    bits = np.empty(len(first), np.int64)
    narrow = np.minimum(widths[first], widths[other])
    for width in np.unique(narrow).tolist():
        pairs = np.flatnonzero(narrow == width)
        for low in range(0, len(pairs), max(1, most // width)):
            some = pairs[low : low + max(1, most // width)]
            rows, place = np.unique(np.concatenate([first[some], other[some]]), return_inverse=True)
            table = np.zeros((len(rows), width), np.uint64)
            for half in range(int(widths[rows].max()) // width):
                has = np.flatnonzero(widths[rows] > half * width)
                table[has] ^= words[starts[rows[has]][:, None] + (half * width + np.arange(width))]
            one, two = table[place[: len(some)]], table[place[len(some) :]]
            bits[some] = np.bitwise_count(one ^ two).sum(1, dtype=np.int64)
    return bits


def _pairs_of_cells(similarity):
    """Pairs of different groups in a cell that may be similar, from rows sorted by key, cell and size."""
    differ = (1 - similarity) / (1 + similarity)  # of both sizes together

    def tested(part, words, starts, widths, found):
        first, other = (np.concatenate(x) for x in zip(*found))
        node, size = (part.column(c).to_numpy() for c in ("node", "n"))
        bits = _different_bits(words, starts, widths, first, other)
        near = bits <= differ * (size[first] + size[other]) + 1e-9
        a, b = node[first[near]], node[other[near]]
        if len(a):
            yield pa.record_batch({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    def run(batches):
        for part in _whole_cells(batches):
            sketches = part.column("sketch").to_pylist()
            widths = np.fromiter(map(len, sketches), np.int64, len(sketches)) // 8
            starts = np.cumsum(widths) - widths
            words = np.frombuffer(b"".join(sketches), np.uint64)
            found, n = [], 0
            for pair in _fitting(part, similarity):
                found.append(pair)
                n += len(pair[0])
                if n > 100_000:
                    yield from tested(part, words, starts, widths, found)
                    found, n = [], 0
            if n:
                yield from tested(part, words, starts, widths, found)

    return run


def _verified_pairs(similarity):
    def run(batches):
        small = (batch.slice(low, 500) for batch in batches for low in range(0, batch.num_rows, 500))
        for batch in small:
            keep = []
            for x, y in zip(batch.column("first").to_pylist(), batch.column("second").to_pylist()):
                x, y = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(shared >= similarity * (len(x) + len(y) - shared))
            found = batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            if found.num_rows:
                yield found

    return run


def linked_rest(nodes, firsts, similarity, sets_of, chunk=CHUNK):
    """Links of similar nodes of different groups, all that there are: columns ``a``, ``b``.

    ``nodes`` has ``node``, ``group``, ``n`` and ``sketch``; ``firsts`` has
    ``node``, ``group``, ``key``, a shingle of the node's prefix, and ``at``, its
    place there (0 if not given, which fits all). A key that
    one group has to itself links nothing. Of any other the nodes outside of its
    largest group, in chunks, meet all its nodes, in chunks, so a cell holds at
    most two chunks and a large group doesn't meet itself. Cells are gone through
    twice: narrow rows first, and with sketches those that fit another one.
    """
    spark = nodes.sparkSession
    all_of = Window.partitionBy("key")
    low, high = F.min("group").over(all_of), F.max("group").over(all_of)
    at = F.col("at") if "at" in firsts.columns else F.lit(0)
    mixed = firsts.select("key", "node", "group", at.alias("at"), (low != high).alias("_m")).where("_m").drop("_m").distinct()
    mixed = stage(mixed, "mixed-keys")
    sizes = mixed.groupBy("key", "group").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("key").agg(F.sum("n").alias("all"), F.max(F.struct("n", "group")).alias("top"))
    sizes = sizes.select(
        "key",
        F.col("top.group").alias("top"),
        F.ceil(F.col("all") / chunk).cast("int").alias("wide"),
        F.ceil((F.col("all") - F.col("top.n")) / chunk).cast("int").alias("high"),
    )
    both = mixed.join(sizes, "key")
    mark = F.xxhash64("node", "key")
    column = F.pmod(mark, F.col("wide")).cast("long")
    row = F.pmod(F.shiftright(mark, 20), F.col("high")).cast("long")
    down = F.transform(F.sequence(F.lit(0), F.col("high") - 1), lambda r: r * F.col("wide") + column)
    across = F.transform(F.sequence(F.lit(0), F.col("wide") - 1), lambda c: row * F.col("wide") + c)
    cells = F.when(F.col("group") == F.col("top"), down).otherwise(F.array_union(down, across))
    placed = both.select("key", F.explode(cells).alias("cell"), "node", "group", "at")
    rows = placed.join(nodes.select("node", "n"), "node").select("key", "cell", "node", "group", "n", "at")
    dealt = rows.repartition(share_of(spark, mixed.count(), 200_000), "key", "cell")
    dealt = dealt.sortWithinPartitions("key", "cell", "n")
    kinds = "key long, cell long, node long, group long, n int, at int"
    meeting = stage(dealt.mapInArrow(_meeting_rows(similarity), kinds), "meeting")
    dealt = meeting.join(nodes.select("node", "sketch"), "node")
    dealt = dealt.repartition(share_of(spark, meeting.count(), 50_000), "key", "cell")
    dealt = dealt.sortWithinPartitions("key", "cell", "n")
    pairs = stage(dealt.mapInArrow(_pairs_of_cells(similarity), "a long, b long").distinct(), "pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    sets = stage(sets_of(wanted), "pair-sets")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("first")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("second")), "b")
    return both.select("a", "b", "first", "second").mapInArrow(_verified_pairs(similarity), "a long, b long")


def near_groups(docs, shingle=3, bits=2, similarity=None, orders=6, seed=42, id_col="doc_id", text="text"):
    """One row per document: id, ``fingerprint`` (16 hex digits), ``component_id``, ``class_id``.

    Documents whose fingerprints differ in at most ``bits`` bits are linked;
    ``component_id`` is the least id reachable over links, itself included.
    Without ``similarity`` fingerprints meet by equal blocks. With it, documents
    that share that part of their shingles (as sets) are linked, whatever their
    fingerprints, which are then those of the sets; ``bits`` and ``orders`` only
    say which pairs are found by the short cut. Both ways leave no pair out.

    Equal fingerprints (with ``similarity``: equal shingle sets) are one node.
    Null and empty texts have fingerprint 0 and are linked like any other; rows
    without an id take part and get the id of their component, null if no row
    of it has one; repeated rows are reported each; an empty table gives none.
    """
    return _grouped(docs, shingle, bits, similarity, orders, seed, id_col, text).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id", "class_id"
    )


def _grouped(docs, shingle, bits, similarity, orders, seed, id_col, text):
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"), row_key(id_col, text).alias("key"))
    if similarity is None:
        printed = fingerprints(slim, shingle, seed).drop("text")
        printed = printed.select("doc_id", "key", "print.fingerprint", "print.table", F.col("print.fingerprint").alias("node"))
    else:
        common = common_shingles(slim, shingle, seed)
        printed = fingerprints(slim, shingle, seed, orders, similarity=similarity, common=common).drop("text")
        parts = [f"print.{c}" for c in ("fingerprint", "table", "least", "prefix", "sketch", "n")]
        printed = printed.select("doc_id", "key", *parts, F.col("print.set").alias("node"))
    printed = stage(printed, "prints")
    firsts = [F.first(c).alias(c) for c in printed.columns if c not in ("doc_id", "key", "node", "prefix")]
    nodes = printed.groupBy("node").agg(F.min("doc_id").alias("least_id"), F.min("key").alias("key"), *firsts)
    keys = block_keys(F.col("fingerprint"), bits) if similarity is None else F.col("least")
    nodes = stage(nodes.withColumn("keys", keys), "nodes")

    def sets_of(wanted):
        keyed = wanted.join(nodes.select("node", "key"), "node")
        texts = slim.select("key", "text").join(keyed, "key").select("node", "text")
        return shingle_sets(texts, shingle, seed).drop("text")

    links = linked(nodes, bits, similarity, sets_of)
    groups = components(links)
    if similarity is not None:
        known = nodes.join(groups, "node", "left").select("node", "key", "n", "sketch", F.coalesce("component", "node").alias("group"))
        known = stage(known, "groups")
        # One row stands for its node: rows that share its key are equal.
        own = printed.select("key", "prefix").join(known.select("key", "node", "group"), "key")
        rest = linked_rest(known, own.select("node", "group", F.posexplode("prefix").alias("at", "key")), similarity, sets_of)
        kept = known.select(F.col("node").alias("a"), F.col("group").alias("b")).where("a != b")
        groups = components(kept.unionByName(rest))
    member = nodes.select("node", "least_id").join(groups, "node", "left")
    member = member.select("node", "least_id", F.coalesce("component", "node").alias("class_id"))
    ids = member.groupBy("class_id").agg(F.min("least_id").alias("component_id"))
    member = member.join(ids, "class_id").select("node", "class_id", "component_id")
    return printed.select("doc_id", "key", "fingerprint", "node").join(member, "node")


def keep_one(docs, shingle=5, bits=18, similarity=0.8, orders=6, seed=42, id_col="doc_id", text="text"):
    """The documents with one of each group of near duplicates: the one with the least id, null ids last.

    Groups are those of ``near_groups``. All columns are kept; of repeated rows
    one is kept, like of any copies.
    """
    rows = _grouped(docs, shingle, bits, similarity, orders, seed, id_col, text)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("_z"), F.col("doc_id"), F.col("key")))
    chosen = rows.groupBy("class_id").agg(first.alias("_first")).select(F.col("_first.key").alias("_chosen"))
    packed = docs.select(F.struct("*").alias("_row"), row_key(id_col, text).alias("_key"))
    kept = packed.join(chosen, F.col("_key") == F.col("_chosen"), "left_semi")
    number = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))
    return kept.withColumn("_number", number).where("_number = 1").select("_row.*")
