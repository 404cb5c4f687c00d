"""Line dedup by a log-template tree of fixed depth.

A line's way down the tree is its number of tokens and its leading tokens;
tokens with a digit count as a variable field. In a leaf, a token that enough
lines have in the same place is constant, any other is a variable field. The
line with its variable fields masked is its template; templates that are
mostly constant and recur across documents are dropped with all their lines.
A line that recurs as it is has a template without variable fields, digits or
not: it is dropped when it stands in that many documents, a long one in fewer.
"""

from pyspark.sql import functions as F

from carrel.llm.common import stage, whole_text

MARK = "\x01"  # stands for a variable field


def _field():
    return F.xxhash64(F.lit(MARK))


def _row_id(docs, id_col, text):
    """Two hashes that tell rows apart unless they are equal in id and text."""
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("\x00"))
    return docs.withColumn("_r1", F.xxhash64(name, whole_text(text))).withColumn(
        "_r2", F.xxhash64(whole_text(text), F.lit("|"), name)
    )


def _plain(text):
    """The text with blanks for white space inside of lines, which is looked for first, as most texts have none."""
    whole = whole_text(text)
    return F.when(whole.rlike(r"[\t\x0B\f\r]"), F.translate(whole, "\t\x0b\f\r", "    ")).otherwise(whole)


def _as_it_is(line):
    """Digests of a whole line, blanks at its ends aside."""
    return F.xxhash64(F.trim(line)), F.xxhash64(F.lit("|"), F.trim(line))


def whole_lines(docs, text="text"):
    """One row per line: row id, ``line`` (from 0), ``same`` and ``same2``, digests of the line as it is."""
    each = docs.select("_r1", "_r2", F.posexplode(F.split(_plain(text), "\n")).alias("line", "_l"))
    same, same2 = _as_it_is(F.col("_l"))
    return each.select("_r1", "_r2", "line", same.alias("same"), same2.alias("same2"))


def lines_of(docs, depth, text="text"):
    """One row per line: row id, ``line`` (from 0), ``words`` (fields masked), ``leaf`` and ``same``.

    Blank lines have no words. Digits are looked for before they are replaced.
    """
    plain = _plain(text)
    digits = F.regexp_replace(plain, r"(?<![^ \n])[^ \n0-9]*+[0-9][^ \n]*+", MARK)
    masked = F.when(plain.rlike("[0-9]"), digits).otherwise(plain)
    both = F.arrays_zip(F.split(masked, "\n").alias("masked"), F.split(plain, "\n").alias("plain"))
    each = docs.select("_r1", "_r2", F.posexplode(both).alias("line", "_l"))
    words = F.array_remove(F.split("_l.masked", " "), "")
    leaf = F.xxhash64(F.size(words), F.slice(words, 1, depth))
    same, _ = _as_it_is(F.col("_l.plain"))
    return each.select("_r1", "_r2", "line", words.alias("words"), leaf.alias("leaf"), same.alias("same"))


def recurring_lines(docs, depth=3, min_docs=4, constant=0.5, long=20, long_docs=2, id_col="doc_id", text="text"):
    """Rows ``_r1``, ``_r2``, ``line`` of the lines whose template recurs in at least ``min_docs`` documents.

    Besides these, lines that stand in as many documents as they are; with
    ``long`` words or more ``long_docs`` documents are enough.

    Only leaves with that many lines are looked into. What a leaf holds beyond
    its tree path are the tokens that recur in each place, so a line that a
    third of all documents have is one entry. Equal rows count as one document each
    by their number.
    """
    docs = _row_id(docs, id_col, text)
    lines = lines_of(docs, depth, text)
    # One pass counts leaves and lines as they are. The number of words is tested on the aggregate: a test of a
    # line would split it once more.
    kinds = [F.struct(F.lit(c).alias("kind"), F.col(c).alias("key"), F.size("words").alias("_k")) for c in ("leaf", "same")]
    counted = lines.select(F.explode(F.array(*kinds)).alias("_s")).groupBy("_s.kind", "_s.key")
    counted = counted.agg(F.count("*").alias("_n"), F.max("_s._k").alias("_k")).where("_k > 0")
    least = F.when((F.col("kind") == "same") & (F.col("_k") >= long), F.lit(long_docs)).otherwise(F.lit(min_docs))
    busy = stage(counted.where(F.col("_n") >= least).select("kind", "key", least.cast("long").alias("least")), "busy")
    # Tables of their own, so that Spark knows the size of each: a large one would send the words of all lines around.
    leaves = stage(busy.where("kind = 'leaf'").select(F.col("key").alias("leaf")), "leaves")
    again = stage(busy.where("kind = 'same'").select(F.col("key").alias("same"), "least"), "same-lines")
    held = lines.join(leaves, "leaf", "left_semi").drop("same")
    held = stage(held.withColumn("tokens", F.transform("words", lambda w: F.xxhash64(w))).drop("words"), "busy-lines")

    placed = held.select("leaf", F.posexplode("tokens").alias("_p", "_t")).where(F.col("_t") != _field())
    often = placed.groupBy("leaf", "_p", "_t").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_docs)
    at_place = often.groupBy("leaf", "_p").agg(F.collect_list("_t").alias("_ts"))
    known = F.map_from_entries(F.array_sort(F.collect_list(F.struct("_p", "_ts"))))
    known = stage(at_place.groupBy("leaf").agg(known.alias("_known")), "leaf-tokens")

    joined = held.join(known, "leaf")

    def constant_token(token, place):
        here = F.try_element_at(F.col("_known"), place)
        return F.when(F.array_contains(here, token), token).otherwise(_field())

    fixed = F.transform("tokens", constant_token)
    shaped = joined.select("_r1", "_r2", "line", "leaf", fixed.alias("_f"))
    parts = F.size(F.filter("_f", lambda t: t != _field()))
    shaped = shaped.where(parts >= F.lit(constant) * F.size("_f"))
    shaped = shaped.select("_r1", "_r2", "line", F.xxhash64("leaf", "_f").alias("template"), F.lit(0).cast("long").alias("same2"))
    shaped = shaped.withColumn("least", F.lit(min_docs).cast("long"))
    whole = whole_lines(docs, text).join(again, "same")
    whole = whole.select("_r1", "_r2", "line", F.col("same").alias("template"), "same2", "least")
    shaped = stage(shaped.unionByName(whole), "templates")
    # A template counts documents, not lines; equal rows, which share both hashes, count each.
    template = ["template", "same2", "least"]
    within = shaped.groupBy(*template, "_r1", "_r2", "line").agg(F.count("*").alias("_n"))
    within = within.groupBy(*template, "_r1", "_r2").agg(F.max("_n").alias("_n"))
    recurring = within.groupBy(*template).agg(F.sum("_n").alias("n_docs")).where(F.col("n_docs") >= F.col("least"))
    recurring = recurring.select("template", "same2")
    return shaped.join(recurring, ["template", "same2"], "left_semi").select("_r1", "_r2", "line").distinct()


def drop_recurring(docs, depth=3, min_docs=4, constant=0.5, long=20, long_docs=2, id_col="doc_id", text="text"):
    """The documents without the lines of recurring templates, plus ``n_lines`` and ``n_dropped``.

    Lines end at ``\\n``; blank lines have no template and stay. Nulls stay null
    and have no lines; a text that loses all its lines becomes empty; repeated
    rows are documents of their own, so enough of them drop their own lines,
    two of them those of ``long`` words; a line that recurs within one document
    only stays;
    an empty table gives an empty table. Columns named ``n_lines`` and
    ``n_dropped`` are replaced, all others are kept.
    """
    dropped = recurring_lines(docs, depth, min_docs, constant, long, long_docs, id_col, text)
    lists = dropped.groupBy("_r1", "_r2").agg(F.collect_list("line").alias("_gone"))
    lists = lists.select(F.col("_r1").alias("_d1"), F.col("_r2").alias("_d2"), "_gone")
    rows = _row_id(docs.select(F.struct("*").alias("_row"), F.col(id_col), F.col(text)), id_col, text)
    rows = rows.select("_row", "_r1", "_r2")
    both = rows.join(lists, (F.col("_r1") == F.col("_d1")) & (F.col("_r2") == F.col("_d2")), "left")
    own = F.col("_row").getField(text)
    lines = F.split(own, "\n")
    kept = F.filter(lines, lambda line, i: ~F.array_contains("_gone", i))
    cut = F.when(F.col("_gone").isNull(), own).otherwise(F.array_join(kept, "\n"))
    rest = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c not in (text, "n_lines", "n_dropped")]
    at = docs.columns.index(text)
    rest.insert(min(at, len(rest)), cut.alias(text))
    return both.select(
        *rest,
        F.when(own.isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
