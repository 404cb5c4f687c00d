"""CSV records with line breaks in their fields, cut by many tasks.

Whether a line break ends a record depends on how many quotes stand before it in
the file. Each split counts its own; the sums of the splits before it tell
whether a split begins inside a quoted field. With that, a split cuts its lines
into records on its own. What begins in one split and ends in another is put
together from its pieces, of which there is one for each split.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

PIECES = "file string, block long, ord long, begins boolean, ends boolean, text string"
_SCHEMA = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("ord", pa.int64()), ("begins", pa.bool_()), ("ends", pa.bool_()), ("text", pa.string())]
)


def _lines(spark, path):
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def _starts(lines):
    """By split: 1 if it begins inside of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    own = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).cast("int").alias("odd"))
    # One row per split, so these windows stay small.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return own.select("file", "block", F.coalesce(F.sum("odd").over(before) % 2, F.lit(0)).cast("int").alias("quoted"))


def _cut(batches):
    """Pieces of records from lines in file order: whole ones, and those that begin or end in another split."""
    split, inside, place, held, begins = None, 0, 0, [], True

    def piece(ends):
        return {"file": split[0], "block": split[1], "ord": place, "begins": begins, "ends": ends, "text": "\n".join(held)}

    for batch in batches:
        out = []
        file, block, value = (batch.column(c) for c in ("file", "block", "value"))
        quoted = batch.column("quoted").to_numpy()
        counts = pc.count_substring(value, '"').to_numpy()
        blocks = block.to_numpy()
        names = file.dictionary_encode().indices.to_numpy()
        edges = np.flatnonzero((blocks[1:] != blocks[:-1]) | (names[1:] != names[:-1])) + 1
        texts = value.to_pylist()
        for low, high in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
            if low == high:
                continue
            now = (file[low].as_py(), int(blocks[low]))
            if now != split:
                if held:
                    out.append(piece(False))
                split, inside, place, held, begins = now, int(quoted[low]), 0, [], not quoted[low]
            after = ((inside + np.cumsum(counts[low:high])) % 2).tolist()
            for text, inside in zip(texts[low:high], after):
                held.append(text)
                if not inside:
                    out.append(piece(True))
                    place, held, begins = place + 1, [], True
        if out:
            yield pa.RecordBatch.from_pylist(out, _SCHEMA)
    if held:
        yield pa.RecordBatch.from_pylist([piece(False)], _SCHEMA)


def csv_records(spark, path):
    """One row per record: ``file``, ``block`` and ``ord`` (which sort them), and the record's ``text``.

    A quoted field that is not closed goes on to the end of its file.
    """
    lines = _lines(spark, path)
    starts = _starts(lines)
    missing = F.raise_error(F.concat(F.lit("no count of quotes for a split of "), "file")).cast("int")
    known = lines.join(F.broadcast(starts), ["file", "block"], "left")
    known = known.select("file", "block", "value", F.coalesce("quoted", missing).alias("quoted"))
    pieces = known.mapInArrow(_cut, PIECES)
    whole = pieces.where("begins and ends").select("file", "block", "ord", "text")
    # A piece that doesn't begin a record belongs to the last one before it that did.
    cut = pieces.where("not (begins and ends)")
    upto = Window.partitionBy("file").orderBy("block", "ord").rowsBetween(Window.unboundedPreceding, 0)
    start = F.when(F.col("begins"), F.struct("block", "ord"))
    joined = cut.withColumn("start", F.last(start, ignorenulls=True).over(upto)).groupBy("file", "start")
    part = F.array_sort(F.collect_list(F.struct("block", "ord", "text")))
    joined = joined.agg(F.array_join(F.transform(part, lambda p: p["text"]), "\n").alias("text"))
    return whole.unionByName(joined.select("file", "start.block", "start.ord", "text"))


def parsed(records, schema, options):
    """The columns of the records; the first record of each file is its header and is left out."""
    text = F.regexp_replace("text", "\r$", "")
    rows = records.where("not (block = 0 and ord = 0)").select("file", "block", "ord", text.alias("text")).where("text != ''")
    return rows.select("file", "block", "ord", F.from_csv("text", schema, options).alias("r")).select("r.*")
