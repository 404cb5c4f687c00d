"""One query per corpus operator: the operator on its whole table, digested to the agreed columns."""

from pyspark.sql import functions as F

from carrel.llm import conversations, decontaminate, lattice, merkle, mixing, secrets, sharding, simhash, spotsigs, suffix, templates, toxicity, wrappers
from carrel.llm.common import table
from carrel.llm.oracle import ORACLE  # noqa: F401  (registered with the queries)


def op1_spotsigs(spark, sf_dir):
    return spotsigs.compare_edited(table(spark, sf_dir, "documents"))


def op2_source_mix(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_secret_scan(spark, sf_dir):
    docs = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = F.filter("secrets", lambda s: s["kind"].isin("assign", "access", "hex"))

    def joined(spans):
        each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(each, ",")

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return docs.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(F.encode(joined(base), "UTF-8"), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )


def toxicity_model(spark, docs, sf_dir):
    """The model of the labelled rows that are not held out."""
    return toxicity.fit(docs, table(spark, sf_dir, "labels"), where=lambda i: ~toxicity.held_out(i))


def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir), limit=0.7)
    held = F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted", "toxic_spans")


def op5_suffix_dedup(spark, sf_dir):
    cut = suffix.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=400)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return cut.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_minimax_shards(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"), shards=8)


def op7_decontamination(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
        "contaminated",
    )


def op8_html_wrappers(spark, sf_dir):
    found = wrappers.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_simhash_groups(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return simhash.near_groups(docs, shingle=3, bits=2).select("doc_id", "fingerprint", "component_id")


def op10_line_templates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = templates.drop_recurring(docs)
    kept = F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256)
    return cut.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


def op11_auction_repair(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return conversations.report(conversations.damage(turns), turns)


def op12_merkle_manifest(spark, sf_dir):
    return merkle.verify_documents(table(spark, sf_dir, "documents"))


def op13_lattice_groups(spark, sf_dir):
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


QUERIES = {
    "op1_spotsigs": op1_spotsigs,
    "op2_source_mix": op2_source_mix,
    "op3_secret_scan": op3_secret_scan,
    "op4_toxicity": op4_toxicity,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_minimax_shards": op6_minimax_shards,
    "op7_decontamination": op7_decontamination,
    "op8_html_wrappers": op8_html_wrappers,
    "op9_simhash_groups": op9_simhash_groups,
    "op10_line_templates": op10_line_templates,
    "op11_auction_repair": op11_auction_repair,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_lattice_groups": op13_lattice_groups,
}
