"""Merkle manifest of a dataset with checkpoints at every few levels.

Rows of a source, in order, are the leaves of a tree whose nodes have up to
``ARITY`` children; the tops of the sources are the leaves of one more tree. Of
each tree only every ``step``-th level is written. A proof is made by going down:
the block of written nodes below one written ancestor is read, the levels
between are hashed anew in the task, the siblings on the way to each node of the
block are put out, and the levels between are dropped again.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import functions as F

from carrel.llm.common import stage
from carrel.operators.batches import with_row_index

ARITY = 3
STEP = 4
PROOF = "array<struct<left:string,right:string>>"
_SIDES = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def leaf_of(*columns):
    """SHA-256, as lowercase hex, of all values: ``-`` for null, else UTF-8 length, ``:`` and the value."""

    def framed(column):
        value = column.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.encode(F.concat(*[framed(c) for c in columns]), "UTF-8"), 256)


def _hash(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height_of(count):
    """Levels above ``count`` leaves."""
    height = 0
    while count > 1:
        count, height = -(-count // ARITY), height + 1
    return height


def regrown(nodes, levels):
    """The levels above a block of nodes, the block first."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([_hash(below[i : i + ARITY]) for i in range(0, len(below), ARITY)])
    return out


def _tops_of(nodes: pa.Array, counts: pa.Array, step) -> pa.Array:
    rows = zip(nodes.to_pylist(), counts.to_pylist())
    return pa.array([regrown([x["node"] for x in own], min(step, height_of(n)))[-1][0] for own, n in rows], pa.string())


def _sides_of(nodes: pa.Array, counts: pa.Array, above: pa.Array, step) -> pa.Array:
    """For each node of a block its siblings on the way up, then what the block's own ancestor has."""
    out = []
    for own, count, rest in zip(nodes.to_pylist(), counts.to_pylist(), above.to_pylist()):
        levels = regrown([x["node"] for x in own], min(step, height_of(count)))[:-1]
        ways = []
        for at in range(len(own)):
            way = []
            for level in levels:
                first = at - at % ARITY
                way.append({"left": "".join(level[first:at]), "right": "".join(level[at + 1 : first + ARITY])})
                at //= ARITY
            ways.append(way + rest)
        out.append(ways)
    return pa.array(out, pa.list_(_SIDES))


def climbed(node, proof):
    """The root that a node and its proof give."""
    return F.aggregate(proof, node, lambda own, p: F.sha2(F.encode(F.concat(p["left"], own, p["right"]), "UTF-8"), 256))


class Forest:
    """Trees over the nodes of ``leaves`` (``tree``, ``pos`` gapless from 0, ``node``, ``count`` of the tree's leaves).

    ``checkpoints``: the written levels, every ``step``-th from the leaves up, as blocks of the nodes below one node
    of the next: ``tree``, ``block``, ``count`` (of the level), ``nodes`` (``pos``, ``node``, others), in order. A block
    has ``ARITY ** step`` nodes at most. ``tops``: ``tree``, ``top``.
    """

    def __init__(self, leaves, step=STEP, extra=()):
        self.step, self.checkpoints, tops = step, [], []
        below, wide = leaves, ARITY**step
        tops_of = F.arrow_udf(lambda nodes, counts: _tops_of(nodes, counts, step), "string")
        while True:
            block = F.floor(F.col("pos") / wide).cast("long").alias("block")
            members = F.array_sort(F.collect_list(F.struct("pos", "node", *(extra if below is leaves else ()))))
            blocks = stage(below.groupBy("tree", block).agg(F.first("count").alias("count"), members.alias("nodes")), "merkle")
            self.checkpoints.append(blocks)
            up = F.ceil(F.col("count") / wide).cast("long")
            # A level that is one block ends in the top.
            above = blocks.select("tree", F.col("block").alias("pos"), tops_of("nodes", "count").alias("node"), up.alias("count"))
            above = stage(above, "merkle-tops")
            tops.append(above.where("count = 1").select("tree", F.col("node").alias("top")))
            below = above.where("count > 1")
            if below.isEmpty():
                break
        self.tops = tops[0]
        for own in tops[1:]:
            self.tops = self.tops.unionByName(own)

    def _down(self, blocks, ways):
        """``tree``, ``x`` (a node with its fields) and its ``proof``, from the proofs of the blocks' ancestors."""
        step = self.step
        sides_of = F.arrow_udf(lambda nodes, counts, above: _sides_of(nodes, counts, above, step), f"array<{PROOF}>")
        own = blocks.join(ways, ["tree", "block"]).withColumn("sides", sides_of("nodes", "count", "proof"))
        own = own.select("tree", F.explode(F.arrays_zip("nodes", "sides")).alias("z"))
        return own.select("tree", F.col("z.nodes").alias("x"), F.col("z.sides").alias("proof"))

    def proofs(self, above):
        """``tree``, ``x``, ``proof`` of every leaf; ``above`` (``tree``, ``proof``): what goes on from each tree's top."""
        ways = None
        for number in range(len(self.checkpoints) - 1, -1, -1):
            blocks = self.checkpoints[number]
            # Trees that end in this level's block start here, the others come from the level above.
            ended = blocks.where(F.col("count") <= ARITY**self.step).select("tree", "block").join(above, "tree")
            ways = ended if ways is None else ways.unionByName(ended)
            found = self._down(blocks, ways)
            if number:
                ways = stage(found.select("tree", F.col("x.pos").alias("block"), "proof"), "merkle-ways")
        return found


class Manifest:
    """Manifest of ``rows``: a tree for each source, and one over the sources' tops.

    ``rows`` has ``tree_key`` columns ``source`` and ``order``, the leaf's digest ``leaf`` and ``carried`` columns, which
    come back with the proofs. Leaves lie by ``order``, nulls first, those of one order by their digest; sources lie
    by their bytes, null first. A null source is a source; equal rows are leaves of their own; no rows give no root.
    """

    def __init__(self, rows, order="doc_id", source="source", carried=(), step=STEP):
        slim = rows.select(F.col(source).alias("source"), F.col(order).alias("order"), F.col("leaf").alias("node"), F.struct(*carried).alias("own"))
        # The last one tells equal rows apart, so that no task has to take all of them.
        by = [F.asc_nulls_first("source"), F.asc_nulls_first("order"), "node", F.monotonically_increasing_id()]
        slim = stage(with_row_index(slim, by), "merkle-leaves")
        spans = slim.groupBy("source").agg(F.min("row_index").alias("first"), F.count("*").alias("count"))
        # A source's number is its place among the sources.
        spans = stage(with_row_index(spans, [F.asc_nulls_first("source")], "tree"), "merkle-sources")
        self.sources = spans
        same = F.col("s.source").eqNullSafe(F.col("l.source"))
        leaves = slim.alias("l").join(spans.alias("s"), same).select(
            "s.tree", (F.col("row_index") - F.col("first")).alias("pos"), "l.node", "s.count", "l.own"
        )
        self.trees = Forest(leaves, step, extra=("own",))
        n = spans.count()
        tops = self.trees.tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.col("top").alias("node"), F.lit(n).cast("long").alias("count"))
        self.upper = Forest(tops, step)
        last = self.upper.tops.first()
        self.root = last.top if last else None

    def proofs(self):
        """One row per leaf: ``source``, ``own`` (the carried columns), ``leaf``, ``subroot``, ``root`` and ``proof``,
        siblings left and right of the way from the leaf to the root."""
        zero = self.upper.tops.select("tree", F.expr(f"cast(array() as {PROOF})").alias("proof"))
        above = stage(self.upper.proofs(zero).select(F.col("x.pos").alias("tree"), "proof"), "merkle-ways")
        names = self.sources.select("tree", "source").join(self.trees.tops, "tree")
        own = self.trees.proofs(above).join(names, "tree")
        return own.select(
            "source", "x.own", F.col("x.node").alias("leaf"), F.col("top").alias("subroot"), F.lit(self.root).cast("string").alias("root"), "proof"
        )


#: The columns of a document that make its leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def verify_documents(docs, seed_id="doc_id"):
    """Manifest of all documents, the proof of each, and what verifying tells about tampered copies.

    Every other document (crc32 of its id is even) is tampered with: its text loses its line feeds; documents without
    an id are not. ``folded_root`` comes from the leaf of the tampered copy and the siblings of the true one. Nulls are
    part of the leaf as such; a null id comes first in its source; documents of one id lie by digest; equal rows have
    leaves of their own; no documents give no rows.
    """
    text = F.col("text")
    cut = F.when(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    true, other = leaf_of(*[F.col(c) for c in FIELDS]), leaf_of(*[cut if c == "text" else F.col(c) for c in FIELDS])
    leaves = docs.select("doc_id", "source", true.alias("leaf"), other.alias("tampered"))
    found = Manifest(leaves, carried=("doc_id", "tampered")).proofs()
    siblings = F.array_join(F.transform("proof", lambda p: F.concat(p["left"], p["right"])), "")
    return found.select(
        "own.doc_id", "leaf", "subroot", "root",
        F.sha2(F.encode(siblings, "UTF-8"), 256).alias("proof_sha256"),
        climbed(F.col("own.tampered"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
