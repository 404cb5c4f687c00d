import random
import re
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from carrel.llm import spotsigs

from .conftest import prose

COMMON = {w for line in spotsigs.ANCHORS.values() for w in line.split()}


def brute_signs(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    marks, run = [("anchor", "")], 0
    for word in words:
        if word in COMMON:
            marks.append(("anchor", word))
            run = 0
            continue
        if run == spotsigs.RUN:
            marks.append(("anchor", ""))
            run = 0
        marks.append(("word", word))
        run += 1
    found = set()
    for i, (kind, anchor) in enumerate(marks):
        behind = [w for k, w in marks[i + 1 :] if k == "word"][:2]
        if kind == "anchor" and behind:
            found.add(" ".join(["\x01" + anchor, *behind]))
    if not found and words:
        found = {" ".join(words)}
    return {zlib.crc32(f.encode()) - 2**31 for f in found}


def text_of(signs):
    return "".join(f"{s + 2**31:08x}" for s in sorted(signs))


def alike(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute_rows(rows):
    ids = sorted({r[0] for r in rows if r[0] is not None}, reverse=True)
    ids += [None] if any(r[0] is None for r in rows) else []
    seen = {}
    for i in ids:
        before = ids[ids.index(i) - 1]
        need = max(len(r[1] or "") // 3 for r in rows if r[0] == before)
        own = [((r[1] or "")[:need], sorted(brute_signs(r[1]))) for r in rows if r[0] == i]
        seen[i] = min(own)
    out = []
    for r in rows:
        text = r[1] or ""
        head, follow = seen[ids[(ids.index(r[0]) + 1) % len(ids)]]
        third = len(text) // 3
        edited = text[: len(text) - third] + head[:third]
        own, other = brute_signs(text), brute_signs(edited)
        out.append(
            (str(r[0]), len(text), sha256(edited.encode()).hexdigest(), text_of(own), text_of(other), alike(own, other), alike(own, set(follow)))
        )
    return sorted(out)


def rows_of(found):
    names = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return sorted((str(r.doc_id), *[r[n] for n in names]) for r in found.collect())


def test_odd_documents(odd_docs, odd_rows, clashing, no_docs):
    assert rows_of(spotsigs.compare_edited(clashing(odd_docs))) == brute_rows(odd_rows)
    assert spotsigs.compare_edited(no_docs).count() == 0
    single = spotsigs.compare_edited(odd_docs.where("doc_id = 5")).collect()
    assert len(single) == 1 and single[0].near_next == 1.0


def test_table(spark, docs_dir):
    docs = spark.read.parquet(f"{docs_dir}/documents.parquet").where(F.length("text") < 1500)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got, want = rows_of(spotsigs.compare_edited(docs)), brute_rows(rows)
    assert got == want


def test_many_ranges(spark):
    docs = spark.createDataFrame([(i * i, f"t{i}") for i in range(200)], "doc_id long, text string")
    found = {r.doc_id: r.next_id for r in spotsigs.with_next(docs, rows_per_task=17).collect()}
    assert found == {i * i: ((i - 1) % 200) ** 2 for i in range(200)}


@pytest.mark.parametrize("threshold", [0.8, 0.5])
def test_similar_against_all_pairs(spark, threshold, odd_rows):
    draw, rows = random.Random(3), [(r[0], r[1]) for r in odd_rows]
    for base in range(10):
        words = prose(base, draw.randint(3, 150), 3000).split()
        for copy in range(4):
            other = [w if draw.random() > 0.02 * copy else "zzz" for w in words]
            rows.append((100 + base * 10 + copy, " ".join(other)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    signs = [frozenset(brute_signs(t)) for _, t in rows]
    sets = sorted(set(signs), key=sorted)
    links = {s: {o for o in sets if o != s and alike(s, o) >= threshold and s and o} for s in sets}
    label = {s: i for i, s in enumerate(sets)}
    for _ in sets:
        for s in sets:
            for o in links[s]:
                label[s] = label[o] = min(label[s], label[o])
    got = sorted(
        [(str(r.doc_id), r.n_signatures, r.n_links, r.class_id) for r in spotsigs.similar(docs, threshold).collect()],
        key=lambda r: r[:3],
    )
    want = sorted([(str(i), len(s), len(links[s]), label[s]) for (i, _), s in zip(rows, signs)], key=lambda r: r[:3])
    assert [r[:3] for r in got] == [r[:3] for r in want]
    classes = {}
    for g in spotsigs.similar(docs, threshold).collect():
        classes.setdefault(g.class_id, []).append(str(g.doc_id))
    brute = {}
    for (i, _), s in zip(rows, signs):
        brute.setdefault(label[s], []).append(str(i))
    assert sorted(sorted(v) for v in classes.values()) == sorted(sorted(v) for v in brute.values())
