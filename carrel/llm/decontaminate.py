"""Benchmark decontamination: n-grams of the test items, hashed and broadcast.

Every window of ``n`` words of an item is known by its rarest-looking (longest)
word. The words of a document are probed against those anchor words; only where
one hits is the window around it cut out and compared in full. No window of a
document is built that has no anchor word in the right place, and no column of
windows is ever shuffled.
"""

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carrel.llm.common import row_key, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed value: what separates words, before A-Z are lower-cased.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text):
    """Words of a text, case as it is."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def lowered(text):
    return F.translate(text, UPPER, LOWER)


def windows(items, n=10, id_col="item_id", text="text"):
    """One row per anchor word and distinct window: ``anchor`` (lower case),
    ``offset`` of the anchor in the window, ``length``, ``gram``, ``items``.

    An item of fewer than ``n`` words is one window; one without words has none.
    """
    words = items.select(F.col(id_col).alias("item_id"), words_of(lowered(F.col(text))).alias("_w"))
    words = words.where(F.size("_w") > 0)
    last = F.greatest(F.size("_w") - n, F.lit(0))
    cut = words.withColumn("_at", F.explode(F.sequence(F.lit(0), last)))
    cut = cut.withColumn("_g", F.slice("_w", F.col("_at") + 1, n))
    longest = F.array_max(F.transform("_g", lambda w: F.length(w)))
    cut = cut.withColumn("_max", longest)
    anchor = F.element_at(F.filter("_g", lambda w: F.length(w) == F.col("_max")), 1)
    return (
        cut.withColumn("anchor", anchor)
        .select(
            F.lower("anchor").alias("anchor"),
            (F.array_position("_g", F.col("anchor")) - 1).cast("int").alias("offset"),
            F.size("_g").alias("length"),
            F.array_join("_g", " ").alias("gram"),
            "item_id",
        )
        .groupBy("anchor", "offset", "length", "gram")
        .agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    )


#: Bytes of grams that are broadcast at once.
MOST_BYTES = 64 * 1024 * 1024


def _broadcasts(grams, most_bytes):
    """The grams in parts of about ``most_bytes`` at most, each to be broadcast."""
    grams = stage(grams, "grams")
    size = F.octet_length("gram") + F.octet_length("anchor") + F.aggregate("items", F.lit(0), lambda n, i: n + F.octet_length(i) + 16) + 64
    parts = max(1, -(-(grams.agg(F.sum(size)).first()[0] or 0) // most_bytes))
    part = F.pmod(F.xxhash64("gram", "offset"), F.lit(parts))
    return [F.broadcast(grams.where(part == number)) for number in range(parts)]


def hits(docs, items, n=10, most_bytes=MOST_BYTES, id_col="doc_id", text="text"):
    """One row per (document, occurrence of a window): ``key``, ``first``, ``last``, ``items``.

    The grams of very large sets of items are broadcast in parts, and the
    documents are read once for each: no word of a document is ever shuffled.
    """
    slim = docs.select(row_key(id_col, text).alias("key"), words_of(F.col(text)).alias("_w"))
    each = slim.select("key", "_w", F.posexplode("_w").alias("_pos", "_word"))
    first = F.col("_pos") - F.col("offset")
    inside = (first >= 0) & (first + F.col("length") <= F.size("_w"))
    found = F.when(inside, lowered(F.array_join(F.slice("_w", F.greatest(first, F.lit(0)) + 1, F.col("length")), " ")))

    def near(grams):
        joined = each.join(grams, (F.lower("_word") == F.col("anchor")) & (found == F.col("gram")))
        return joined.select("key", first.alias("first"), (first + F.col("length")).alias("last"), "items")

    return functools.reduce(DataFrame.unionByName, map(near, _broadcasts(windows(items, n), most_bytes)))


def contamination(docs, items, n=10, most_bytes=MOST_BYTES, id_col="doc_id", text="text"):
    """One row per document: id, ``n_words``, ``n_hit``, ``n_items``, ``items``, ``spans``, ``contaminated``.

    A word inside any occurrence of a window is hit; ``spans`` are the merged
    runs of hit words (first, end), ``items`` the ids whose windows occur, as
    sorted strings. Null and empty texts have no words and are clean; repeated
    rows are reported each; a null id is kept; an empty table of items leaves
    all documents clean, an empty table of documents gives an empty table.
    """
    found = hits(docs, items, n, most_bytes, id_col, text)
    spans = F.array_sort(F.collect_set(F.struct("first", "last")))
    per = found.groupBy("key").agg(
        spans.alias("_s"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("_i")
    )
    # Merge: a span that begins inside the last one extends it.
    start = F.expr("cast(array() as array<struct<first:int,last:int>>)")

    def merge(done, span):
        tail = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (span["first"] <= F.when(F.size(done) > 0, tail["last"]))
        longer = F.struct(tail["first"].alias("first"), F.greatest(tail["last"], span["last"]).alias("last"))
        head = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(joins, F.concat(head, F.array(longer))).otherwise(F.concat(done, F.array(span)))

    per = per.withColumn("_s", F.aggregate("_s", start, merge))
    covered = F.aggregate("_s", F.lit(0).cast("long"), lambda a, s: a + (s["last"] - s["first"]))
    per = per.select(F.col("key").alias("_k"), "_s", "_i", covered.alias("_n"))
    slim = docs.select(
        F.col(id_col).alias("doc_id"),
        row_key(id_col, text).alias("key"),
        F.size(words_of(F.col(text))).cast("long").alias("n_words"),
    )
    none = F.expr("cast(array() as array<string>)")
    return slim.join(per, F.col("key") == F.col("_k"), "left").select(
        "doc_id",
        "n_words",
        F.coalesce("_n", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("_i"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("_i", none).alias("items"),
        F.coalesce("_s", start).alias("spans"),
        F.coalesce(F.col("_n") > 0, F.lit(False)).alias("contaminated"),
        "key",
    )


def remove(docs, items, mode="documents", n=10, id_col="doc_id", text="text", **options):
    """The documents without contamination; all columns of ``docs`` are kept.

    Null and empty texts and rows without an id stay; repeated rows are judged
    each, alike; without items nothing goes; no documents give none.

    ``mode="documents"`` drops each contaminated document. ``mode="spans"``
    keeps every document and cuts the hit words out: what is left are the
    other words, joined by one space; untouched texts stay as they are.
    """
    report = contamination(docs, items, n, id_col=id_col, text=text, **options).where("contaminated")
    bad = report.groupBy("key").agg(F.first("spans").alias("_spans")).select(F.col("key").alias("_bad"), "_spans")
    kept = docs.select(F.struct("*").alias("_row"), row_key(id_col, text).alias("_key"))
    if mode == "documents":
        return kept.join(bad, F.col("_key") == F.col("_bad"), "left_anti").select("_row.*")
    if mode != "spans":
        raise ValueError(f"mode is documents or spans, not {mode}")
    joined = kept.join(bad, F.col("_key") == F.col("_bad"), "left")
    words = words_of(F.col("_row")[text])
    clean = F.array_join(
        F.filter(words, lambda w, i: ~F.exists("_spans", lambda s: (s["first"] <= i) & (i < s["last"]))), " "
    )
    left = F.when(F.col("_bad").isNull(), F.col("_row")[text]).otherwise(clean)
    return joined.select(F.col("_row").withField(text, left).alias("_row")).select("_row.*")
