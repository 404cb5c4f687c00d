import random
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from carrel.llm import graph, simhash

from .conftest import prose


def brute_print(text, width=3):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits):
    label = {i: i for i in range(len(prints))}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(prints))]


def check(rows, texts, bits=2):
    prints = [brute_print(t) for _, t in texts]
    roots = brute_components(prints, bits)
    least = defaultdict(list)
    for (i, _), r in zip(texts, roots):
        least[r].append(i)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in least.items()}
    want = sorted(str((i, f"{p:016x}", least[r])) for (i, _), p, r in zip(texts, prints, roots))
    assert sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in rows) == want


def test_odd_documents(odd_docs, odd_rows, clashing, no_docs):
    rows = simhash.near_groups(clashing(odd_docs)).collect()
    check(rows, [(r[0], r[1]) for r in odd_rows])
    assert simhash.near_groups(no_docs).count() == 0


def test_table(spark, docs_dir):
    docs = spark.read.parquet(f"{docs_dir}/documents.parquet")
    rows = simhash.near_groups(docs).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()])


def nodes_of(spark, prints, bits):
    import numpy as np

    points = simhash.pivots()
    rows = [
        (i, p - 2**64 if p >= 2**63 else p, bytearray(np.bitwise_count(points ^ np.uint64(p)).tobytes()))
        for i, p in enumerate(prints)
    ]
    frame = spark.createDataFrame(rows, "node long, fingerprint long, table binary")
    return frame.withColumn("keys", simhash.block_keys(F.col("fingerprint"), bits))


@pytest.mark.parametrize("bits, chunk", [(2, 1024), (2, 40), (3, 40), (0, 7)])
def test_links_against_all_pairs(spark, bits, chunk):
    draw = random.Random(bits * 100 + chunk)
    centres = [draw.getrandbits(64) for _ in range(4)]
    prints = {0, 2**64 - 1, *centres}
    for _ in range(400):
        value = draw.choice(centres[: draw.randint(1, 4)])
        for _ in range(draw.randint(1, 7)):
            value ^= 1 << draw.randrange(64)
        prints.add(value)
    prints = sorted(prints)
    found = graph.components(simhash.linked(nodes_of(spark, prints, bits), bits, chunk=chunk)).collect()
    label = {r.node: r.component for r in found}
    assert [label.get(i, i) for i in range(len(prints))] == brute_components(prints, bits)


def test_near_texts_of_similarity(spark):
    rows, draw = [], random.Random(2)
    for base in range(12):
        words = prose(base, 250, 5000).split()
        rows.append((base * 10, " ".join(words)))
        for copy in range(1, 3):
            other = list(words)
            for _ in range(2):
                other[draw.randrange(len(other))] = f"changed{copy}"
            rows.append((base * 10 + copy, " ".join(other)))
        rows.append((base * 10 + 9, " ".join(words[:125]) + " " + prose(900 + base, 125, 5000)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_groups(docs, shingle=5, bits=20, similarity=0.8).collect()}
    for base in range(12):
        assert [got[base * 10 + c] for c in (0, 1, 2, 9)] == [base * 10] * 3 + [base * 10 + 9]


def test_components_of_chains(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (300, 200), (400, 400)]
    found = {r.node: r.component for r in graph.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 200: 100, 300: 100}


@pytest.mark.parametrize("chunk", [1024, 25])
def test_similarity_in_a_dense_group(spark, chunk, monkeypatch):
    """Many edits of one text: pairs on either side of the limit, in one cell and dealt to several."""
    monkeypatch.setattr(simhash.linked, "__defaults__", (None, None, chunk))
    draw, words, rows = random.Random(7), prose(77, 150, 5000).split(), []
    for i in range(90):
        other = list(words)
        for _ in range(draw.randint(1, 6)):
            other[draw.randrange(150)] = f"edit{i}"
        rows.append((i, " ".join(other)))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(146)} for _, t in rows]
    label = list(range(90))
    for i in range(90):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_groups(docs, 5, 24, 0.8, orders=12).collect()}
    assert [got[i] for i in range(90)] == label and 1 < len(set(label)) < 90


def test_similar_sets_with_other_counts(spark):
    """Lines that repeat a different number of times, and short texts just as similar as the limit, leave no pair out."""
    rows, want = [], {}
    for base in range(6):
        words, line = prose(300 + base, 104, 9000).split(), " ".join(f"line{base}x{i}" for i in range(9))
        for copy, times in enumerate((1, 40)):
            rows.append((base * 10 + copy, " ".join([*words, *[line] * times])))
            want[base * 10 + copy] = base * 10
    for base in range(400):
        words = [f"short{base}x{i}" for i in range(9)]
        for copy, text in enumerate((words[:8], words)):
            rows.append((1000 + base * 10 + copy, " ".join(text)))
            want[1000 + base * 10 + copy] = 1000 + base * 10
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_groups(docs, 5, 18, 0.8).collect()}
    assert got == want


@pytest.mark.parametrize("chunk", [1024, 6])
def test_every_pair_of_other_groups_is_met(spark, chunk):
    """The second step alone, with groups of several sizes and keys that are dealt to many cells."""
    import numpy as np

    draw, sets = random.Random(chunk), []
    for centre in range(3):
        whole = [draw.getrandbits(63) | 1 << 40 for _ in range(60)]
        sets += [sorted(set(draw.sample(whole, 57) + [draw.getrandbits(63) for _ in range(draw.randint(0, 6))])) for _ in range(30)]
    group = [i if i % 3 else i // 30 * 30 for i in range(len(sets))]
    arrays = [np.array(s, np.uint64) for s in sets]
    common = np.array(sorted({x for s in sets[:20] for x in s}), np.uint64)
    common = common, np.array([draw.randint(4, 9) for _ in common])
    small = [np.unique((a >> np.uint64(32)).astype(np.uint32)).tobytes() for a in arrays]
    nodes = [(i, group[i], len(a), bytearray(simhash.sketch_of(a).tobytes())) for i, a in enumerate(arrays)]
    firsts = [(i, group[i], int(k)) for i, a in enumerate(arrays) for k in simhash.prefix_of(a, 0.8, common)]
    nodes = spark.createDataFrame(nodes, "node long, group long, n int, sketch binary")
    firsts = spark.createDataFrame(firsts, "node long, group long, key long")
    shingles = spark.createDataFrame([(i, bytearray(s)) for i, s in enumerate(small)], "node long, shingles binary")
    links = simhash.linked_rest(nodes, firsts, 0.8, lambda wanted: wanted.join(shingles, "node"), chunk=chunk)
    want = set()
    for i in range(len(sets)):
        for j in range(i):
            shared = len(set(sets[i]) & set(sets[j]))
            if group[i] != group[j] and shared >= 0.8 * (len(sets[i]) + len(sets[j]) - shared):
                want.add((j, i))
    assert {(r.a, r.b) for r in links.collect()} == want and 20 < len(want)


def test_large_sets_that_share_a_shingle_are_no_pairs(spark, monkeypatch):
    """Sets of several sketch widths: all similar pairs are found, and few others are written for verification."""
    import numpy as np

    draw, sets = random.Random(3), []
    shared = [draw.getrandbits(63) for _ in range(3)]
    for size in (400, 560, 1100, 2300, 3000):
        for _ in range(5):
            whole = [draw.getrandbits(63) for _ in range(size)]
            for part in (0.8, 0.85, 1) if len(sets) % 2 else (1,):
                sets.append(sorted({*draw.sample(whole, int(part * size)), *shared}))
    arrays = [np.array(s, np.uint64) for s in sets]
    small = [np.unique((a >> np.uint64(32)).astype(np.uint32)).tobytes() for a in arrays]
    # The shared shingles come first for all.
    common = np.unique(np.concatenate(arrays))
    common = common[~np.isin(common, shared)], np.ones(len(common) - len(shared), np.int64)
    nodes = [(i, i, len(a), bytearray(simhash.sketch_of(a).tobytes())) for i, a in enumerate(arrays)]
    firsts = [
        (i, i, place, int(k)) for i, a in enumerate(arrays) for place, k in enumerate(simhash.prefix_of(a, 0.8, common))
    ]
    nodes = spark.createDataFrame(nodes, "node long, group long, n int, sketch binary")
    firsts = spark.createDataFrame(firsts, "node long, group long, at int, key long")
    shingles = spark.createDataFrame([(i, bytearray(s)) for i, s in enumerate(small)], "node long, shingles binary")
    written, stage = {}, simhash.stage

    def counted(df, label):
        written[label] = stage(df, label)
        return written[label]

    monkeypatch.setattr(simhash, "stage", counted)
    links = simhash.linked_rest(nodes, firsts, 0.8, lambda wanted: wanted.join(shingles, "node"))
    want = set()
    for i in range(len(sets)):
        for j in range(i):
            both = len(set(sets[i]) & set(sets[j]))
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                want.add((j, i))
    assert {(r.a, r.b) for r in links.collect()} == want and len(want) > 10
    assert written["pairs"].count() <= 2 * len(want)
