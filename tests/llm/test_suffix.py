import random
from collections import Counter

import pytest

from carrel.llm import induced, suffix


def brute_starts(strings, cap):
    count = Counter(s[i : i + cap] for s in strings for i in range(len(s) - cap + 1))
    return [[count[s[i : i + cap]] > 1 for i in range(max(0, len(s) - cap + 1))] for s in strings]


@pytest.mark.parametrize("budget", [1, 1 << 20])
def test_sorted_shards(budget):
    draw = random.Random(budget)
    for _ in range(150):
        cap, kinds = draw.choice([1, 2, 3, 5, 8, 20]), draw.choice([1, 2, 3, 26])
        strings = [bytes(draw.randrange(97, 97 + kinds) for _ in range(draw.choice([0, 1, 2, 5, 20, 60]))) for _ in range(draw.randint(0, 6))]
        if strings and draw.random() < 0.3:
            strings += [strings[0], b"x" + strings[-1][:30]]
        got = [list(map(bool, m)) for m in induced.repeated_starts(strings, cap, budget=budget)]
        assert got == brute_starts(strings, cap)


def test_queues_use_their_file():
    import numpy as np

    queues = induced.Queues(None, 1000)
    blocks = [np.arange(i, i + 50) for i in range(0, 5000, 50)]
    for i, block in enumerate(blocks):
        queues.push(i % 3, block, block.astype(np.int16))
    assert queues.spilled and queues.held <= 1000
    for value in range(3):
        taken = np.concatenate([p for p, c in queues.take(value)])
        assert (taken == np.concatenate(blocks[value::3])).all()
    queues.close()


def test_owners_of_equal_windows_are_equal():
    draw = random.Random(5)
    inner = bytes(draw.randrange(256) for _ in range(300))
    owners = suffix.Owners(60, 16)
    texts = [bytes(draw.randrange(256) for _ in range(n)) + inner + bytes(draw.randrange(256) for _ in range(40)) for n in (0, 7, 500)]
    seen = []
    for text, shift in zip(texts, (0, 7, 500)):
        gram, at, low, high = owners.runs(text)
        assert low[0] == 0 and high[-1] == len(text) - 60 and (low[1:] == high[:-1] + 1).all()
        assert (at >= high).all() and (at + 16 <= low + 60).all()
        own = {}
        for g, a, lo, hi in zip(gram, at, low, high):
            own.update({int(w) - shift: (int(g), int(a) - shift) for w in range(lo, hi + 1)})
        seen.append({w: own[w] for w in range(0, 241)})
    assert seen[0] == seen[1] == seen[2]


def brute(rows, length):
    bodies = [(r[1] or "").encode() for r in rows]
    starts = brute_starts(bodies, length)
    out = []
    for r, body, marks in zip(rows, bodies, starts):
        gone = bytearray(len(body))
        for i, hit in enumerate(marks):
            if hit:
                gone[i : i + length] = b"\x01" * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((str(r[0]), len(body), sum(gone), spans, bytes(b for b, g in zip(body, gone) if not g)))
    return sorted(out)


def rows_of(found):
    return sorted(
        (str(r.doc_id), r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in found.collect()
    )


@pytest.mark.parametrize("length", [400, 30])
def test_odd_documents(odd_docs, odd_rows, clashing, no_docs, length):
    docs = clashing(odd_docs)
    found = suffix.remove_repeats(docs, length)
    assert found.columns == [*[c for c in docs.columns if c != "spans"], "n_bytes", "kept", "spans"]
    assert rows_of(found) == brute(odd_rows, length)
    assert suffix.remove_repeats(no_docs, length).count() == 0


@pytest.mark.parametrize("hot", [4000, 1])
def test_shared_passages(spark, hot):
    draw = random.Random(9)
    word = lambda: "".join(draw.choice("abcdéfg") for _ in range(draw.randint(1, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(n) for n in (20, 45, 90)]
    rows = []
    for i in range(40):
        parts = [text(draw.randint(0, 60))]
        for _ in range(draw.randint(0, 3)):
            p = draw.choice(passages)
            parts += [p[draw.randint(0, 15) : len(p) - draw.randint(0, 15)], text(draw.randint(0, 5))]
        rows.append((i, " ".join(parts)))
    rows += [(100, "la " * 300), (101, "x" * 700), (102, rows[3][1]), (103, rows[3][1] + "!"), (104, "ab" * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = suffix.remove_repeats(docs, 100, hot=hot, shard_bytes=2000, budget=5000)
    assert rows_of(found) == brute(rows, 100)


def test_runs_are_joined_with_slices_once(spark):
    rows = [(i, "a common passage of some length " * 3 + str(i) * 40) for i in range(20)]
    found = suffix.repeats(spark.createDataFrame(rows, "doc_id long, text string"), 50)
    assert found.count() > 0
    # Spark splits a hot slice in a join of two staged sides, not in a join of a join.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join LeftSemi") == 1


def test_long_texts_in_segments(monkeypatch):
    draw = random.Random(3)
    text = bytes(draw.choice(b"ab cd") for _ in range(5000))
    whole = suffix.Owners(80).runs(text)
    monkeypatch.setattr(suffix, "SEGMENT", 700)
    parts = suffix.Owners(80).runs(text)
    cover = lambda r: [int(a) for a, lo, hi in zip(r[1], r[2], r[3]) for _ in range(lo, hi + 1)]
    assert cover(whole) == cover(parts)


def test_table(spark, docs_dir):
    docs = spark.read.parquet(f"{docs_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert rows_of(suffix.remove_repeats(docs, 400)) == brute(rows, 400)
