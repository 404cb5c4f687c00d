"""SpotSigs: document fingerprints from chains of content words behind common words.

A signature is an anchor (a common word) with the next two content words
behind it; common words between are skipped. A long run without any common
word (tables, lists, names) is given an unnamed anchor every few words, counted
from the last anchor, so that such texts have signatures too. The fingerprint
is the set of signature hashes. Similar pairs are found among sets of similar
size only: sizes are cut into ranges such that partners lie in the same or the
next range, and within those by signatures in order of rarity.
"""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from carrel.llm.common import stage, whole_text
from carrel.llm.graph import components

#: Common words that serve as anchors, by language.
ANCHORS = {
    "en": "a an and are as at be by for from has have in is it of on or that the this to was were which with",
    "de": "als am an auf aus bei das dem den der des die ein eine einer es für im in ist mit nicht sich und von zu zum zur",
    "fr": "au aux avec ce dans de des du elle en est et il la le les ne on ou par pas pour que qui se sur un une",
    "es": "al como con de del el en es la las lo los más no o para pero por que se su sus un una y",
}
RUN = 4  # content words without an anchor, after which there is an unnamed one


def _anchor_pattern(anchors=None):
    """The anchors as one pattern, common beginnings taken out so that each letter is tried once."""
    words = {w for line in (anchors or ANCHORS).values() for w in line.split()}

    def branch(rests):
        heads = sorted({r[0] for r in rests if r})
        parts = [h + branch({r[1:] for r in rests if r and r[0] == h}) for h in heads]
        if not parts:
            return ""
        return (parts[0] if len(parts) == 1 and "" not in rests else f"(?:{'|'.join(parts)})") + "?" * ("" in rests)

    return branch(words)


def signatures(text, anchors=None, run=RUN):
    """The sorted set of 32-bit signature hashes of a text column, as ``array<int>``.

    Words are runs of letters and digits, in lower case. The text is written
    once with a mark before each anchor; each mark is then read together with
    the words behind it. Null and empty texts have no signature; a text of
    common words only has one, the text itself.
    """
    word, common = r" [^ \x01]++", r"(?: \x01[^ ]*+)*+"
    chain = rf"(?=(\x01[^ ]*+{common}{word}(?:{common}{word})?+))\x01"
    line = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    marked = F.regexp_replace(F.concat(F.lit(" "), line), rf" (?=(?:{_anchor_pattern(anchors)})(?: |$))", " \x01")
    marked = F.regexp_replace(F.concat(F.lit(" \x01"), marked), rf"((?:{word}){{{run}}})(?={word})", "$1 \x01")
    chains = F.regexp_extract_all(marked, F.lit(chain), F.lit(1))

    def hashed(chain):
        # Common words within a chain are skipped: only the anchor and its content words are hashed.
        plain = F.when(F.contains(chain, F.lit(" \x01")), F.regexp_replace(chain, r" \x01[^ ]*+", "")).otherwise(chain)
        return _small(plain)

    def signs(found):
        whole = F.when(F.length(line) > 0, F.array(_small(line)))
        none = F.expr("cast(array() as array<int>)")
        some = F.array_sort(F.array_distinct(F.transform(found, hashed)))
        return F.when(F.size(found) > 0, some).otherwise(F.coalesce(whole, none))

    return _let(chains, signs)


def _small(text):
    """32 bits of hash as an int."""
    return (F.crc32(F.encode(text, "UTF-8")) - F.lit(2**31)).cast("int")


def _let(value, body):
    """The body with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def as_text(signs):
    """The whole set as hex digits, eight per signature, in order."""
    return F.array_join(F.transform(signs, lambda s: F.lower(F.lpad(F.hex(s.cast("long") + F.lit(2**31)), 8, "0"))), "")


def likeness(a, b):
    """Jaccard similarity of two signature sets; two empty ones are alike, an empty and another one not."""
    common = F.size(F.array_intersect(a, b))
    joint = F.size(a) + F.size(b) - common
    return F.when(joint == 0, F.lit(1.0)).otherwise(common / F.greatest(joint, F.lit(1)))


def length_range(size, threshold):
    """Number of the range of set sizes: sets at least ``threshold`` alike lie in the same or a neighbouring range."""
    return F.when(size > 0, F.floor(F.log(size.cast("double")) / F.lit(-math.log(threshold)) + F.lit(1e-9))).otherwise(-1).cast("int")


def similar(docs, threshold=0.8, id_col="doc_id", text="text"):
    """One row per document: id, ``n_signatures``, ``length_range``, ``class_id``, ``n_links``.

    Documents whose sets are at least ``threshold`` alike are linked, and
    classes are the components. Equal sets are one node: their rows share the
    class, and ``n_links`` counts the other sets a set is linked to.

    Partners share one of the rarest ``size - ceil(threshold * size) + 1``
    signatures of both, so only those are looked up, each within its range of
    sizes and the one below; before sets are compared in full, the sizes must
    allow the threshold. Null and empty texts share the
    empty set; rows without an id are kept; an empty table gives none.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), signatures(F.col(text)).alias("signs"))
    printed = stage(slim.withColumn("node", F.xxhash64("signs")), "spots")
    sets = stage(printed.groupBy("node").agg(F.first("signs").alias("signs")).withColumn("n", F.size("signs")), "spot-sets")
    each = sets.where("n > 0").select("node", "n", F.explode("signs").alias("sign"))
    often = each.groupBy("sign").agg(F.count("*").alias("often"))
    ranked = each.join(often, "sign").groupBy("node", "n").agg(
        F.array_sort(F.collect_list(F.struct("often", "sign"))).alias("_s")
    )
    prefix = F.slice("_s", 1, F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - F.lit(1e-9)).cast("int") + 1)
    looked = ranked.select("node", "n", length_range(F.col("n"), threshold).alias("range"), F.explode(prefix).alias("_p"))
    looked = stage(looked.select("node", "n", "range", F.col("_p.sign").alias("sign")), "spot-index")
    left = looked.select(F.col("node").alias("a"), F.col("n").alias("na"), "range", "sign")
    right = looked.withColumn("range", F.explode(F.array("range", F.col("range") + 1))).select(
        F.col("node").alias("b"), F.col("n").alias("nb"), "range", "sign"
    )
    fits = (F.col("nb") >= F.lit(threshold) * F.col("na") - F.lit(1e-9)) & (
        (F.col("nb") < F.col("na")) | ((F.col("nb") == F.col("na")) & (F.col("b") < F.col("a")))
    )
    pairs = left.join(right, ["range", "sign"]).where(fits).select("a", "b").distinct()
    sa = sets.select(F.col("node").alias("a"), F.col("signs").alias("signs_a"))
    sb = sets.select(F.col("node").alias("b"), F.col("signs").alias("signs_b"))
    links = pairs.join(sa, "a").join(sb, "b").where(likeness(F.col("signs_a"), F.col("signs_b")) >= threshold)
    links = stage(links.select("a", "b"), "spot-links")
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
    counts = ends.groupBy("node").agg(F.count("*").alias("n_links"))
    return (
        printed.select("doc_id", "node", F.size("signs").alias("n_signatures"))
        .join(components(links), "node", "left")
        .join(counts, "node", "left")
        .select(
            "doc_id",
            "n_signatures",
            length_range(F.col("n_signatures"), threshold).alias("length_range"),
            F.coalesce("component", "node").alias("class_id"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        )
    )


def with_next(docs, id_col="doc_id", rows_per_task=500_000):
    """(``doc_id``, ``next_id``) of distinct ids in descending order, the first one behind the last; null ids last.

    Ids alone are put in order, in ranges; what crosses from a range to the
    next is one row per range.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col(id_col).alias("doc_id")).distinct()
    tasks = max(1, -(-docs.count() // rows_per_task))
    dealt = ids.repartitionByRange(tasks, F.col("doc_id").desc_nulls_last())
    ranges = stage(dealt.withColumn("part", F.spark_partition_id()), "id-ranges")
    down = F.col("doc_id").desc_nulls_last()
    behind = ranges.withColumn("next_id", F.lead("doc_id").over(Window.partitionBy("part").orderBy(down)))
    behind = behind.withColumn("_last", F.row_number().over(Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first())) == 1)
    heads = ranges.groupBy("part").agg(F.max("doc_id").alias("head"))  # one row per range
    around = Window.orderBy("part")
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.withColumn("_follow", F.lead(F.struct("head")).over(around)).withColumn("_top", F.first(F.struct("head")).over(whole))
    heads = heads.select(F.col("part").alias("_part"), F.coalesce("_follow", "_top")["head"].alias("_head"))
    joined = behind.join(heads, F.col("part") == F.col("_part"))
    return joined.select("doc_id", F.when(F.col("_last"), F.col("_head")).otherwise(F.col("next_id")).alias("next_id"))


def compare_edited(docs, id_col="doc_id", text="text"):
    """Each document next to its edited text and the next document, by their fingerprints.

    The edited text replaces the last third by as much of the beginning of the
    next document in descending order of ids (behind the last comes the
    first). Where an id repeats, the document before it sees the one with the
    least beginning. Null counts as empty. Returns id, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``,
    ``n_signatures``, ``length_range``; one row per row of ``docs``. An
    empty table gives none; a single document is next to itself.
    """
    # One key of both joins and the grouping, so that texts and what they hand over are dealt out once each.
    key = lambda c: (F.coalesce(F.col(c).cast("string"), F.lit("")).alias("_k"), F.col(c).isNull().alias("_z"))
    slim = docs.select(F.col(id_col).alias("doc_id"), whole_text(text).alias("text"))
    # The same columns on both sides, so that the texts are dealt out once for both joins.
    slim = slim.select(*key("doc_id"), "text")
    order = with_next(docs, id_col)
    need = slim.groupBy("_k", "_z").agg(F.max(F.floor(F.length("text") / 3)).alias("need"))
    wanted = order.select(*key("doc_id"), "doc_id", "next_id").join(need, ["_k", "_z"])
    wanted = wanted.select(*key("next_id"), F.col("_k").alias("_bk"), F.col("_z").alias("_bz"), "doc_id", "need")
    # What a document hands to the one before it: as much of its beginning as that one replaces, and its set.
    head = F.substring(F.col("text"), F.lit(1), F.col("need").cast("int"))
    given = slim.join(wanted, ["_k", "_z"]).select(
        F.col("_bk").alias("_k"),
        F.col("_bz").alias("_z"),
        "doc_id",
        F.struct(head.alias("head"), signatures(F.col("text")).alias("signs")).alias("given"),
    )
    given = given.groupBy("_k", "_z").agg(F.min("given").alias("given"), F.min("doc_id").alias("doc_id"))
    joined = slim.join(given, ["_k", "_z"])
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("given.head"), F.lit(1), third))
    both = joined.select(
        "doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"), F.col("given.signs").alias("next_signs")
    )
    signed = both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        signatures(F.col("text")).alias("signs"),
        signatures(F.col("edited")).alias("edited_signs"),
        "next_signs",
    )
    return signed.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("signs")).alias("fingerprint"),
        as_text(F.col("edited_signs")).alias("edited_fingerprint"),
        likeness(F.col("signs"), F.col("edited_signs")).alias("near_edited"),
        likeness(F.col("signs"), F.col("next_signs")).alias("near_next"),
        F.size("signs").alias("n_signatures"),
        length_range(F.size("signs"), 0.8).alias("length_range"),
    )
