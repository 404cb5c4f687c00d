"""Removal of long repeats by suffix sorting of shards, whole corpus at once.

Which places begin with the same ``length`` bytes as another place? Every
window of that length is owned by one of its short grams, the one with the
least hash, so equal windows have equal owners. The windows a gram owns in a
text are a run; the bytes of a run are its slice. Grams that occur once can be
left out, equal slices are repeats as a whole, and only grams with several
different slices go on: the slices of a gram form part of a shard, and each
shard's suffixes are sorted by external induced sorting, where suffixes that
share ``length`` bytes with a neighbour are repeats.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from carrel.llm.common import stage, whole_text
from carrel.llm.induced import repeated_starts

GRAM = 64
SEGMENT = 1 << 22  # windows handled at once
HOT = 4_000  # slices of a gram, from which they are dealt out by their place in the run as well
BAND = 48

_KEYS = ("_r1", "_r2")


class Owners:
    """Runs of windows of a text by owning gram."""

    def __init__(self, length, gram=GRAM):
        draw = np.random.default_rng(17)
        self.length, self.gram = length, min(gram, length)
        self.values = draw.integers(0, 2**64, 256, dtype=np.uint64)
        self.factor = int(draw.integers(0, 2**62)) * 4 + 3
        self.inverse = pow(self.factor, -1, 2**64)
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def _grown(self, n):
        if len(self.powers) < n:
            size = max(n, 2 * len(self.powers))
            for name, base in (("powers", self.factor), ("inverses", self.inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def hashes(self, data):
        """A hash of every gram of the bytes."""
        n, k = len(data), self.gram
        self._grown(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[:n], out=sums[1:])
        mixed = (sums[k:] - sums[:-k]) * self.inverses[: n - k + 1]
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(29)
        return mixed

    def runs(self, text):
        """(gram hash, its place, first window, last window) of each run, as arrays; windows of all places are covered."""
        total = len(text) - self.length + 1
        found = []
        bytes_ = np.frombuffer(text, np.uint8)
        for base in range(0, max(total, 0), SEGMENT):
            count = min(SEGMENT, total - base)
            data = bytes_[base : base + count + self.length - 1]
            hashes = self.hashes(data)
            width = self.length - self.gram + 1
            place_bits = np.uint64(max(1, int(len(hashes)).bit_length()))
            packed = (hashes >> place_bits << place_bits) | np.arange(len(hashes), dtype=np.uint64)
            # Least value of every window of ``width`` values, from running minima of blocks of that width.
            rows = -(-len(packed) // width)
            padded = np.full(rows * width, np.uint64(2**64 - 1))
            padded[: len(packed)] = packed
            block = padded.reshape(rows, width)
            ahead = np.minimum.accumulate(block, axis=1).ravel()
            behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
            least = np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])
            owner = (least & ((np.uint64(1) << place_bits) - np.uint64(1))).astype(np.int64)
            starts = np.concatenate([[0], np.flatnonzero(owner[1:] != owner[:-1]) + 1])
            ends = np.append(starts[1:], count) - 1
            grams = owner[starts]
            found.append((hashes[grams].view(np.int64), grams + base, starts + base, ends + base))
        if not found:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        return tuple(np.concatenate(part) for part in zip(*found))


def _rows_of_runs(length):
    owners = Owners(length)

    def run(batches):
        for batch in batches:
            keys = [batch.column(i).to_numpy() for i in range(2)]
            for low in range(0, batch.num_rows, 256):
                out = {n: [] for n in (*_KEYS, "gram", "slice", "at", "low", "high")}
                for row in range(low, min(low + 256, batch.num_rows)):
                    text = batch.column(2)[row].as_buffer().to_pybytes()
                    if len(text) < length:
                        continue
                    gram, at, first, last = owners.runs(text)
                    digest = hashlib.blake2b
                    out["slice"] += [
                        digest(text[a : b + length], digest_size=16).digest() for a, b in zip(first.tolist(), last.tolist())
                    ]
                    for name, value in zip(("gram", "at", "low", "high"), (gram, at, first, last)):
                        out[name].append(value)
                    for name, value in zip(_KEYS, keys):
                        out[name].append(np.full(len(gram), value[row]))
                if out["slice"]:
                    slices = pa.array(out.pop("slice"), pa.binary())
                    arrays = {n: np.concatenate(v) for n, v in out.items()}
                    yield pa.record_batch(
                        [*[pa.array(arrays[n]) for n in (*_KEYS, "gram")], slices, *[pa.array(arrays[n]) for n in ("at", "low", "high")]],
                        names=[*_KEYS, "gram", "slice", "at", "low", "high"],
                    )

    return run


def _cut_slices(length):
    """Bytes of the wanted runs of a text; places are then relative to the gram."""

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                rows = []
                part = batch.slice(low, 64)
                for text, wanted in zip(part.column("_text"), part.column("wanted").to_pylist()):
                    data = text.as_buffer()
                    for w in wanted:
                        body = data.slice(w["low"], w["high"] - w["low"] + length).to_pybytes()
                        rows.append((w["gram"], w["band"], w["slice"], w["low"] - w["at"], body))
                if rows:
                    gram, band, name, at, body = zip(*rows)
                    yield pa.record_batch(
                        [pa.array(gram, pa.int64()), pa.array(band, pa.int32()), pa.array(name, pa.binary()), pa.array(at, pa.int64()), pa.array(body, pa.binary())],
                        names=["gram", "band", "slice", "shift", "body"],
                    )

    return run


def _sort_shard(length, budget):
    """All slices of a partition are one shard."""

    def run(batches):
        names, bodies = [], []
        for batch in batches:
            names += list(zip(*[batch.column(c).to_pylist() for c in ("gram", "slice", "shift")]))
            bodies += batch.column("body").to_pylist()
        out = []
        for (gram, name, shift), marked in zip(names, repeated_starts(bodies, length, budget=budget)):
            edges = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
            out += [(gram, name, shift + int(a), shift + int(b) - 1) for a, b in zip(edges[::2], edges[1::2])]
            if len(out) > 50_000:
                yield _ranges(out)
                out = []
        if out:
            yield _ranges(out)

    return run


def _ranges(rows):
    gram, name, low, high = zip(*rows)
    return pa.record_batch(
        [pa.array(gram, pa.int64()), pa.array(name, pa.binary()), pa.array(low, pa.int64()), pa.array(high, pa.int64())],
        names=["gram", "slice", "from_", "to_"],
    )


def _keyed(docs, id_col, text):
    """Adds the two hashes that tell rows apart unless they are equal in id and text, and the text as bytes."""
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("\x00"))
    body = whole_text(text)
    return docs.select(
        F.xxhash64(name, body).alias("_r1"), F.xxhash64(body, F.lit("|"), name).alias("_r2"), "*", F.encode(body, "UTF-8").alias("_text")
    )


def repeats(docs, length=400, shard_bytes=4 << 20, budget=256 << 20, id_col="doc_id", text="text", hot=HOT):
    """Byte ranges (``low``, ``high``, end exclusive) covered by repeated strings, by row (``_r1``, ``_r2``); may overlap.

    Narrow rows (a run's gram, digest and place) are all that is dealt out of
    the whole corpus. The text of a shard is about ``shard_bytes``; a gram with
    more than ``hot`` different slices is dealt out by place within the run,
    which equal windows share, so no shard holds all of them.
    """
    texts = _keyed(docs, id_col, text).select(*_KEYS, "_text")
    runs = texts.mapInArrow(
        _rows_of_runs(length), "_r1 long, _r2 long, gram long, slice binary, at long, low long, high long"
    )
    runs = stage(runs, "runs")
    # Staged, so that the join has two plain sides, of which a hot gram's can be split.
    often = stage(runs.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "shared-grams")
    runs = stage(runs.join(often, "gram", "left_semi"), "shared-runs")
    place = F.struct(*_KEYS, "at", "low", "high")
    slices = stage(
        runs.groupBy("gram", "slice").agg(F.count("*").alias("n"), F.min(place).alias("place")), "slices"
    )
    whole = runs.join(slices.where("n > 1").select("gram", "slice"), ["gram", "slice"], "left_semi")
    whole = whole.select(*_KEYS, F.col("low"), (F.col("high") + length).alias("high"))

    several = slices.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1")
    shared = slices.join(several, "gram").select("gram", "slice", "kinds", "place.*")
    # Windows keep their place relative to the gram, from -(length - gram) to 0.
    first = F.floor((F.col("low") - F.col("at") + length) / BAND)
    last = F.floor((F.col("high") - F.col("at") + length) / BAND)
    bands = F.when(F.col("kinds") > hot, F.sequence(first, last)).otherwise(F.array(F.lit(-1).cast("long")))
    dealt = shared.withColumn("band", F.explode(bands)).withColumn(
        "low", F.when(F.col("band") < 0, F.col("low")).otherwise(F.greatest("low", F.col("band") * BAND - length + F.col("at")))
    )
    dealt = dealt.withColumn(
        "high",
        F.when(F.col("band") < 0, F.col("high")).otherwise(
            F.least("high", F.col("band") * BAND + (BAND - 1) - length + F.col("at"))
        ),
    )
    dealt = stage(dealt.withColumn("band", F.col("band").cast("int")), "dealt-slices")
    size = dealt.agg(F.sum(F.col("high") - F.col("low") + length)).first()[0] or 0
    spark = docs.sparkSession
    shards = int(max(spark.sparkContext.defaultParallelism, -(-size // shard_bytes)))
    wanted = dealt.groupBy(*_KEYS).agg(F.collect_list(F.struct("gram", "band", "slice", "at", "low", "high")).alias("wanted"))
    bodies = texts.join(wanted, list(_KEYS)).select("_text", "wanted")
    bodies = bodies.mapInArrow(_cut_slices(length), "gram long, band int, slice binary, shift long, body binary")
    found = bodies.repartition(shards, "gram", "band").mapInArrow(
        _sort_shard(length, budget), "gram long, slice binary, from_ long, to_ long"
    )
    found = stage(found, "repeats")
    # A slice that occurs once has its place with it: a second join with the runs could not be split at a hot slice.
    single = slices.where("n = 1").select("gram", "slice", "place.*")
    parts = single.join(found, ["gram", "slice"]).select(
        *_KEYS, (F.col("at") + F.col("from_")).alias("low"), (F.col("at") + F.col("to_") + length).alias("high")
    )
    return whole.unionByName(parts)


_KEPT = pa.struct([("kept", pa.binary()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def _without(texts: pa.Array, lists: pa.Array) -> pa.Array:
    rows = []
    for text, ranges in zip(texts, lists.to_pylist()):
        data, spans = text.as_buffer().to_pybytes(), []
        for r in sorted((r["low"], r["high"]) for r in ranges or ()):
            if spans and r[0] <= spans[-1]["end"]:
                spans[-1]["end"] = max(spans[-1]["end"], r[1])
            else:
                spans.append({"start": r[0], "end": r[1]})
        kept, at = [], 0
        for s in spans:
            kept.append(data[at : s["start"]])
            at = s["end"]
        rows.append({"kept": b"".join([*kept, data[at:]]), "spans": spans})
    return pa.array(rows, type=_KEPT)


def remove_repeats(docs, length=400, id_col="doc_id", text="text", **options):
    """Adds ``n_bytes``, ``kept`` (the bytes left, joined) and ``spans`` (byte ranges removed, maximal).

    A byte goes if a string of ``length`` bytes that covers it begins anywhere
    else too, in the same document or another; strings are judged on the input
    and never cross documents. Nulls count as empty, with nothing to remove;
    texts shorter than ``length`` stay; of equal texts of that length nothing
    stays; repeated rows are documents of their own; an empty table gives an
    empty table. The ranges of a document are gathered in its own row. Columns
    of these names are replaced.
    """
    found = repeats(docs, length, id_col=id_col, text=text, **options)
    lists = found.groupBy(*_KEYS).agg(F.collect_set(F.struct("low", "high")).alias("_ranges"))
    packed = docs.select(F.struct("*").alias("_row"), F.col(id_col), F.col(text))
    rows = _keyed(packed, id_col, text).select("_row", *_KEYS, "_text")
    cut = F.arrow_udf(_without, "struct<kept:binary,spans:array<struct<start:long,end:long>>>")
    both = rows.join(lists, list(_KEYS), "left").withColumn("_done", cut("_text", "_ranges"))
    rest = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c not in ("n_bytes", "kept", "spans")]
    return both.select(
        *rest,
        F.octet_length("_text").cast("long").alias("n_bytes"),
        F.col("_done.kept").alias("kept"),
        F.col("_done.spans").alias("spans"),
    )
