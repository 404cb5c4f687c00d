import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from carrel.llm import toxicity

from .conftest import prose


def brute_marginals(evidence, ties):
    """Sum over all taggings of one line."""
    n, mass, pairs = len(evidence), np.zeros(len(evidence)), np.zeros((2, 2))
    total = 0.0
    for tags in itertools.product((0, 1), repeat=n):
        weight = np.exp(sum(e * t for e, t in zip(evidence, tags)) + sum(ties[a][b] for a, b in zip(tags, tags[1:])))
        total += weight
        mass += weight * np.array(tags)
        for a, b in zip(tags, tags[1:]):
            pairs[a, b] += weight
    return mass / total, pairs / total


def test_marginals_against_all_taggings():
    draw = np.random.default_rng(1)
    lengths = [1, 5, 3, 7, 1, 4]
    evidence, ties = draw.normal(0, 2, sum(lengths)), draw.normal(0, 1, (2, 2))
    chance, pairs, _ = toxicity.marginals(evidence, toxicity._Lines(lengths), ties, pairs=True)
    want, want_pairs, at = [], np.zeros((2, 2)), 0
    for n in lengths:
        mass, own = brute_marginals(evidence[at : at + n], ties)
        want, want_pairs, at = [*want, *mass], want_pairs + own, at + n
    assert np.allclose(chance, want) and np.allclose(pairs, want_pairs)


def test_long_lines_stay_finite():
    evidence = np.concatenate([np.full(30_000, -500.0), np.full(30_000, 500.0)])
    chance = toxicity.marginals(evidence, toxicity._Lines([60_000]), np.array([[2.0, -9.0], [-9.0, 2.0]]))
    assert np.isfinite(chance).all() and chance[0] < 1e-6 and chance[-1] > 1 - 1e-6


@pytest.fixture(scope="module")
def model():
    draw, texts, toxic = random.Random(8), [], []
    for i in range(400):
        words = prose(i, 60).split()
        if i % 4 == 0:
            for _ in range(4):
                words[draw.randrange(60)] = "blork" + draw.choice(["a", "en", "ity", "ous", "ling"])
        texts.append(" ".join(words) + "\n" + prose(1000 + i, 20))
        toxic.append(i % 4 == 0)
    return toxicity.train(texts, toxic)


def test_unseen_words_and_places(spark, model):
    text = prose(5000, 30) + " Blorkesque 💡 BLORKED\nfine"
    docs = spark.createDataFrame([(1, text), (2, prose(5001, 3000)), (3, ""), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert got[1].predicted == 1 and [got[i].predicted for i in (2, 3, 4)] == [0, 0, 0]
    assert [text[s.start : s.end] for s in got[1].toxic_spans] == ["Blorkesque 💡 BLORKED"]
    assert got[3].score == got[4].score and not got[3].toxic_spans


def test_odd_documents(odd_docs, odd_rows, no_docs, clashing, model):
    docs = clashing(odd_docs)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert toxicity.score(no_docs, model).count() == 0
    other = toxicity.score(docs.select("text").withColumn("doc_id", F.lit(0)), model)
    assert sorted(r.score for r in other.collect()) == sorted(r.score for r in rows)


def test_no_labels(spark, odd_docs):
    labels = spark.createDataFrame([(1, None), (2, 0)], "doc_id long, toxic int")
    model = toxicity.fit(odd_docs, labels)
    assert all(r.predicted == 0 for r in toxicity.score(odd_docs, model).collect())


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels, where=lambda i: ~toxicity.held_out(i))
    known = docs.join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id")))
    rows = toxicity.score(known, model).select("score", "predicted", "toxic").collect()
    bad = [r.score for r in rows if r.toxic == 1]
    good = [r.score for r in rows if r.toxic == 0]
    rank = sum(sum(b > g for g in good) + 0.5 * sum(b == g for g in good) for b in bad) / (len(bad) * len(good))
    print("auc", rank, "found", np.mean([b >= 0.7 for b in bad]), "false", np.mean([g >= 0.7 for g in good]))
    assert rank > 0.97 and np.mean([g >= 0.7 for g in good]) < 0.01 and np.mean([b >= 0.7 for b in bad]) > 0.9
