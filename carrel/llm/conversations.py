"""Faults of conversations and their cheapest repair.

The turns of a conversation lie by number, nulls first; turns of one number lie
by role and by a digest of their text. All turns of a table get one index in
that order, and blocks of ``segment`` indices cut conversations into segments,
so a conversation of any length is worked on by many tasks: a segment gives the
cheapest costs between all states in front and behind, these are combined over a
tree of segments, what lies behind and in front of each segment comes down that
tree, and each segment then traces its own edits (``auction``).
"""

import hashlib

import pyarrow as pa
from pyspark.sql import functions as F

from carrel.llm.auction import NEVER, STATES, WHOLE, Lattice, distances, NEEDED
from carrel.llm.common import share_of, stage
from carrel.operators.batches import with_row_index

#: What counts as white space: blank, tab, line feed, vertical tab, form feed, return.
SPACE = " \t\n\x0b\x0c\r"
OPEN_END = [0 if s in WHOLE else NEVER for s in range(STATES)]
COST = {"K": 0, "R": 2, "D": 3, "I": 2}


def damage(turns, conv="conv_id", turn="turn", role="role", text="text"):
    """Turns with known faults: by crc32 of ``conv:turn`` modulo 20, 0 drops the turn, 1 empties its text, 2 takes its
    full stops, question and exclamation marks, 3 repeats it, 4 makes it the user's. Null parts are one space; rows
    that are equal in conversation and turn share their fault; an empty table stays empty. Only the four columns
    are returned."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.encode(F.concat(name(conv), F.lit(":"), name(turn)), "UTF-8")), F.lit(20))
    rows = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), name(role).alias("role"), name(text).alias("text"), kind.alias("_kind")
    )
    changed = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    who = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    kept = rows.where(F.col("_kind") != 0)
    return kept.select("conv_id", "turn", who.alias("role"), changed.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def _conv_key(column):
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def _indexed(turns, conv, turn, role, text):
    """All turns in order, with ``row_index`` and their faults but repeats; written to the shared folder."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(" "))
    who = F.coalesce(F.col(role).cast("string"), F.lit(" "))
    rows = turns.select(
        _conv_key(F.col(conv)).alias("c"), F.col(turn).alias("turn"), who.alias("role"), body.alias("text"),
        F.xxhash64(body).alias("d1"), F.xxhash64(F.lit(1), body).alias("d2"),
    )
    # The last one tells equal rows apart, so that no task has to take all of them.
    order = ["c", F.asc_nulls_first("turn"), "role", "d1", "d2", F.monotonically_increasing_id()]
    return with_row_index(rows, order)


def _segments(rows, segment):
    """One row per conversation and block: its turns as (row_index, initial, fault), in order."""
    ends = F.rtrim(F.col("text"), F.lit(SPACE))
    first = rows.groupBy("c", "role", "d1", "d2").agg(F.min("row_index").alias("row_index")).select("row_index", F.lit(True).alias("first"))
    slim = rows.select(
        "row_index", "c", F.substring("role", 1, 1).alias("initial"), (F.length(ends) == 0).alias("blank"),
        F.right(ends, F.lit(1)).isin(".", "!", "?").alias("ended"),
    )
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(~F.col("ended"), "truncated").otherwise("")
    known = slim.join(first, "row_index", "left").select("row_index", "c", "initial", fault.alias("fault"))
    block = F.floor(F.col("row_index") / segment).cast("long").alias("block")
    return known.groupBy("c", block).agg(F.array_sort(F.collect_list(F.struct("row_index", "initial", "fault"))).alias("turns"))


_PAIRS = {"su", "ua", "au"}


def _measured(segments, segment):
    """Adds ``illegal`` (pairs inside) and, where the conversation may go on, ``value``: costs between states."""

    @F.arrow_udf("struct<illegal:long,value:array<long>>")
    def measure(turns: pa.Array, last: pa.Array) -> pa.Array:
        out = []
        for rows, end in zip(turns.to_pylist(), last.to_pylist()):
            initials = [r["initial"] for r in rows]
            own = {"illegal": sum(a + b not in _PAIRS for a, b in zip(initials, initials[1:])), "value": None}
            if rows[0]["row_index"] % segment == 0 or rows[-1]["row_index"] % segment == segment - 1:
                own["value"] = distances([(r["initial"], r["fault"]) for r in rows], end)
            out.append(own)
        return pa.array(out, pa.struct([("illegal", pa.int64()), ("value", pa.list_(pa.int64()))]))

    return segments.withColumn("_m", measure("turns", "last")).select("*", "_m.illegal", "_m.value").drop("_m")


def _both(costs):
    """Costs of several runs of rows, one behind the other."""
    whole = costs[0]
    for own in costs[1:]:
        whole = [
            min(min(whole[a * STATES + m] + own[m * STATES + b] for m in range(STATES)), NEVER)
            for a in range(STATES)
            for b in range(STATES)
        ]
    return whole


def _ahead(costs, behind):
    """What it costs from the end of each run on, in each state."""
    out = [behind]
    for own in costs[:0:-1]:
        out.append([min(min(own[a * STATES + b] + out[-1][b] for b in range(STATES)), NEVER) for a in range(STATES)])
    return out[::-1]


def _chained(maps):
    whole = maps[0]
    for own in maps[1:]:
        whole = [own[s] for s in whole]
    return whole


def _entered(maps, state):
    """The state in front of each run."""
    out = [state]
    for own in maps[:-1]:
        out.append([own[out[-1][0]]])
    return out


def _sweep(items, fold, spread, top, fan):
    """Values of runs are folded over a tree of ``fan`` children, then boundaries are spread down it.

    ``items``: ``c``, ``i`` (gapless from 0), ``value``. Gives ``c``, ``i``, ``edge``. Each level is written.
    """

    @F.arrow_udf("array<long>")
    def folded(values: pa.Array) -> pa.Array:
        return pa.array([fold([x["value"] for x in own]) for own in values.to_pylist()], pa.list_(pa.int64()))

    @F.arrow_udf("array<array<long>>")
    def spreaded(values: pa.Array, edges: pa.Array) -> pa.Array:
        both = zip(values.to_pylist(), edges.to_pylist())
        return pa.array([spread([x["value"] for x in own], edge) for own, edge in both], pa.list_(pa.list_(pa.int64())))

    levels = []
    while (items.agg(F.max("i")).first()[0] or 0) > 0:
        up = F.floor(F.col("i") / fan).cast("long").alias("i")
        groups = items.groupBy("c", up).agg(F.array_sort(F.collect_list(F.struct("i", "value"))).alias("own"))
        levels.append(stage(groups, "runs"))
        items = stage(levels[-1].select("c", "i", folded("own").alias("value")), "runs-up")
    edges = items.select("c", "i", F.array(*[F.lit(x).cast("long") for x in top]).alias("edge"))
    for groups in reversed(levels):
        below = groups.join(edges, ["c", "i"]).select("c", "own", spreaded("own", "edge").alias("edges"))
        pairs = below.select("c", F.explode(F.arrays_zip("own", "edges")).alias("x"))
        edges = stage(pairs.select("c", F.col("x.own.i").alias("i"), F.col("x.edges").alias("edge")), "runs-down")
    return edges


def _leave(costs):
    return [None if x >= NEVER else x for x in costs]


def _ends_of(turns: pa.Array, ahead: pa.Array, last: pa.Array) -> pa.Array:
    """By state in front of a segment the state its cheapest edits end in."""
    out = []
    for rows, costs, end in zip(turns.to_pylist(), ahead.to_pylist(), last.to_pylist()):
        lattice = Lattice([(r["initial"], r["fault"]) for r in rows], _leave(costs), end)
        ends = []
        for state in range(STATES):
            ends.append(lattice.trace(state)[1] if lattice.solve(state) is not None else state)
        out.append(ends)
    return pa.array(out, pa.list_(pa.int64()))


_EDIT = pa.struct([("row_index", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("before", pa.list_(pa.string())), ("after", pa.list_(pa.string()))])
_EDITED = pa.struct([("cost", pa.int64()), ("audit", pa.string()), ("edits", pa.list_(_EDIT))])
_EDITED_DDL = (
    "struct<cost:long,audit:string,edits:array<struct<row_index:long,edit:string,role:string,"
    "before:array<string>,after:array<string>>>>"
)


def _edits_of(turns: pa.Array, ahead: pa.Array, last: pa.Array, state: pa.Array) -> pa.Array:
    out = []
    for rows, costs, end, front in zip(turns.to_pylist(), ahead.to_pylist(), last.to_pylist(), state.to_pylist()):
        lattice = Lattice([(r["initial"], r["fault"]) for r in rows], _leave(costs), end)
        lattice.solve(front)
        labels, _ = lattice.trace(front)
        cost, at, before, edits = 0, 0, [], []
        for label, own in labels:
            cost += COST[label]
            if label == "I":
                before.append(NEEDED[own][0])
                continue
            row = rows[at]
            if label != "D" and row["fault"] == "truncated":
                cost += 1
            edits.append({"row_index": row["row_index"], "edit": label, "role": NEEDED[own][0] if label == "R" else None, "before": before, "after": []})
            at, before = at + 1, []
        edits[-1]["after"] = before
        out.append({"cost": cost, "audit": "".join(label for label, _ in labels), "edits": edits})
    return pa.array(out, _EDITED)


def _repaired(batches):
    """Turns after the repair, (c, row_index, role, text), from an edit row followed by its turn's row, in order."""
    edit = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == 0:
                edit = row
                continue
            for role in edit["before"]:
                yield row["c"], row["row_index"], role, ""
            if edit["edit"] != "D":
                yield row["c"], row["row_index"], edit["role"] or row["role"], row["text"]
            for role in edit["after"]:
                yield row["c"], row["row_index"], role, ""


def _digests(batches):
    """``c`` and SHA-256 of its ``role:text`` lines; a conversation is read turn by turn and never held."""
    now, digest, out = None, None, []
    for c, _, role, text in _repaired(batches):
        if c != now:
            if now is not None:
                out.append((now, digest.hexdigest()))
            now, digest = c, hashlib.sha256()
        else:
            digest.update(b"\n")
        digest.update(f"{role}:{text}".encode())
        if len(out) >= 10_000:
            yield pa.record_batch({"c": [x[0] for x in out], "sha": [x[1] for x in out]})
            out = []
    if now is not None:
        out.append((now, digest.hexdigest()))
    if out:
        yield pa.record_batch({"c": [x[0] for x in out], "sha": [x[1] for x in out]})


def _lines(batches):
    def batch_of(held):
        c, index, role, text = zip(*held)
        return pa.record_batch({"c": c, "row_index": index, "role": role, "text": text})

    held, size = [], 0
    for line in _repaired(batches):
        held.append(line)
        size += len(line[3])
        if len(held) >= 10_000 or size > 8_000_000:
            yield batch_of(held)
            held, size = [], 0
    if held:
        yield batch_of(held)


class Repair:
    """The cheapest repair of all conversations of a table: roles must read ``(s?(ua)+)?`` by their initials.

    A turn stays (0), gets the role user or assistant (2) or goes (3, and must if it is blank or a repeat), and an
    empty turn may be put anywhere (2); a truncated turn that stays costs 1. Of the cheapest edits those come first
    whose letters (K, R, D, I) are least.

    Null roles and texts are one space, so such turns are blank and go; null conversations are one of their own; null
    turns come first; equal rows are repeats; a role of no letters has no initial and stays where it is; an empty
    table gives empty frames. Other columns are not read.
    """

    def __init__(self, turns, conv="conv_id", turn="turn", role="role", text="text", segment=128, fan=256):
        self.rows = _indexed(turns, conv, turn, role, text)
        segments = stage(_segments(self.rows, segment), "segments")
        span = segments.groupBy("c").agg(F.min("block").alias("low"), F.max("block").alias("high"))
        placed = segments.join(span, "c").withColumn("last", F.col("block") == F.col("high"))
        self.segments = stage(_measured(placed, segment), "segments-measured")
        self._edit(fan)

    def _edit(self, fan):
        long = self.segments.where("low < high").withColumn("i", F.col("block") - F.col("low"))
        ahead = _sweep(long.select("c", "i", "value"), _both, _ahead, OPEN_END, fan)
        ended = long.join(ahead, ["c", "i"]).select("c", "i", F.arrow_udf(_ends_of, "array<long>")("turns", "edge", "last").alias("value"))
        front = _sweep(stage(ended, "segment-ends"), _chained, _entered, [0], fan)
        edges = ahead.select("c", "i", F.col("edge").alias("ahead")).join(front, ["c", "i"])
        edges = edges.select("c", "i", "ahead", F.get("edge", F.lit(0)).alias("state"))
        at = self.segments.withColumn("i", F.col("block") - F.col("low")).join(edges, ["c", "i"], "left")
        whole = F.array(*[F.lit(x).cast("long") for x in OPEN_END])
        edits_of = F.arrow_udf(_edits_of, _EDITED_DDL)
        own = at.select(
            "c", "block", edits_of("turns", F.coalesce("ahead", whole), "last", F.coalesce("state", F.lit(0))).alias("e")
        )
        self.edited = stage(own.select("c", "block", "e.*"), "edits")

    def _read(self, run, schema):
        edits = self.edited.select("c", F.explode("edits").alias("e")).select(
            "c", "e.row_index", F.lit(0).alias("kind"), "e.edit", "e.role", "e.before", "e.after", F.lit(None).cast("string").alias("text")
        )
        none = F.lit(None)
        texts = self.rows.select(
            "c", "row_index", F.lit(1).alias("kind"), none.cast("string").alias("edit"), "role",
            none.cast("array<string>").alias("before"), none.cast("array<string>").alias("after"), "text",
        )
        both = edits.unionByName(texts)
        tasks = share_of(both.sparkSession, self.rows.count(), 200_000)
        dealt = both.repartition(tasks, "c").sortWithinPartitions("c", "row_index", "kind")
        return dealt.mapInArrow(run, schema)

    def turns(self):
        """The repaired turns: ``c`` (the conversation's key), ``row_index`` of the turn they stand for or at, role, text."""
        return self._read(_lines, "c string, row_index long, role string, text string")

    def digests(self):
        """``c``, ``sha``: SHA-256 of the repaired ``role:text`` lines. One conversation's lines are one digest and so
        pass through one task, as a stream."""
        return self._read(_digests, "c string, sha string")

    def totals(self):
        """One row per conversation: ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``."""
        before = self.segments.select("c", (F.col("block") + 1).alias("block"), F.element_at("turns", -1)["initial"].alias("left"))
        cut = self.segments.join(before, ["c", "block"], "left")
        pair = F.concat("left", F.get("turns", F.lit(0))["initial"])
        wrong = F.when(F.col("left").isNotNull() & ~pair.isin(*_PAIRS), 1).otherwise(0)
        number = lambda kind: F.size(F.filter("turns", lambda t: t["fault"] == kind)).alias(kind)
        kinds = ("blank", "duplicate", "truncated")
        own = cut.select("c", (F.col("illegal") + wrong).alias("illegal"), *[number(k) for k in kinds])
        counts = own.groupBy("c").agg(*[F.sum(k).alias(k) for k in (*kinds, "illegal")])
        part = F.array_sort(F.collect_list(F.struct("block", "audit")))
        edits = self.edited.groupBy("c").agg(F.sum("cost").alias("cost"), part.alias("_p"))
        edits = edits.select("c", "cost", F.array_join(F.transform("_p", lambda p: p["audit"]), "").alias("audit"))
        return counts.join(edits, "c")


def report(turns, original=None, conv="conv_id", turn="turn", role="role", text="text", **sizes):
    """One row per conversation of ``original`` (``turns`` itself if none is given): what was wrong and what repair costs.

    ``gaps``: numbers missing between the least and the largest turn; the counts of first faults; ``illegal``
    pairs of neighbours; ``cost`` and ``audit`` of the cheapest edits; ``repaired_sha256``. A conversation without
    turns has zeros, an empty audit and the digest of nothing. Odd rows: see ``Repair``.
    """
    repair = Repair(turns, conv, turn, role, text, **sizes)
    every = (turns if original is None else original).select(F.col(conv).alias("conv_id")).distinct()
    every = every.withColumn("c", _conv_key(F.col("conv_id")))
    gap = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = repair.rows.groupBy("c").agg(F.coalesce(gap, F.lit(0)).cast("long").alias("gaps"))
    found = every.join(gaps, "c", "left").join(repair.totals(), "c", "left").join(repair.digests(), "c", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return found.select(
        "conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
