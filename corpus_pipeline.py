"""A training corpus from ``documents`` in five stages, each written to the shared folder and read again."""

import functools

from carrel.llm import decontaminate, mixing, sharding, simhash, toxicity
from carrel.llm.common import stage, table
from carrel.llm.queries import toxicity_model
from carrel.session import ship_package


def _shipped(function):
    """The stage with the library sent to the workers first."""

    @functools.wraps(function)
    def run(spark, docs, sf_dir):
        ship_package(spark, "carrel")
        return function(spark, docs, sf_dir)

    return run


@_shipped
def drop_toxic(spark, docs, sf_dir):
    """Documents whose score reaches 0.7 go; the model is learned from the labelled rows of ``documents``."""
    model = toxicity_model(spark, table(spark, sf_dir, "documents"), sf_dir)
    return toxicity.score(docs, model, limit=0.7).where("predicted = 0").select(docs.columns)


@_shipped
def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group stays: five-word shingles, a similarity of 0.8 or more."""
    return simhash.keep_one(docs, shingle=5, similarity=0.8)


@_shipped
def drop_contaminated(spark, docs, sf_dir):
    """Documents that hold ten words in a row of a benchmark item go."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"), mode="documents", n=10)


@_shipped
def mix_sources(spark, docs, sf_dir):
    """Documents as often as the mix of sources takes them."""
    return mixing.apply_mix(docs)


@_shipped
def cut_shards(spark, docs, sf_dir):
    """Eight shards of near equal bytes."""
    return sharding.shard(docs, shards=8)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("source_mix", mix_sources),
    ("sharding", cut_shards),
]

#: A trained model and near duplicate groups take part, which SQL can't express.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
