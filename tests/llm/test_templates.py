import re
from collections import Counter, defaultdict


from carrel.llm import templates

from .conftest import prose


def tokens_of(line):
    return [0 if re.search(r"[0-9]", w) else w for w in re.findall(r"[^ \t\n\x0b\f\r]+", line)]


def as_it_is(line):
    return re.sub(r"[\t\x0b\f\r]", " ", line).strip(" ")


def brute(rows, depth=3, min_docs=4, constant=0.5, long=20, long_docs=2):
    lines = [(d, n, tokens_of(x)) for d, r in enumerate(rows) for n, x in enumerate((r[1] or "").split("\n"))]
    lines = [x for x in lines if x[2]]
    leaf = lambda t: (len(t), *t[:depth])
    seen = Counter((leaf(t), i, w) for _, _, t in lines for i, w in enumerate(t) if w)
    by_template, home = defaultdict(set), {}
    for d, n, t in lines:
        masked = tuple(w if w and seen[leaf(t), i, w] >= min_docs else 0 for i, w in enumerate(t))
        if sum(1 for w in masked if w) >= constant * len(t):
            home[d, n] = (leaf(t), masked)
            by_template[leaf(t), masked].add(d)
    same = defaultdict(set)
    for d, r in enumerate(rows):
        for x in (r[1] or "").split("\n"):
            same[as_it_is(x)].add(d)

    def again(line):
        words = len(tokens_of(line))
        return words > 0 and len(same[as_it_is(line)]) >= (long_docs if words >= long else min_docs)

    out = []
    for d, r in enumerate(rows):
        own = (r[1] or "").split("\n") if r[1] is not None else []
        gone = [n for n in range(len(own)) if len(by_template.get(home.get((d, n)), ())) >= min_docs or again(own[n])]
        text = None if r[1] is None else "\n".join(x for n, x in enumerate(own) if n not in gone)
        out.append((str(r[0]), text, len(own), len(gone)))
    return sorted(out, key=str)


def rows_of(found):
    return sorted([(str(r.doc_id), r.text, r.n_lines, r.n_dropped) for r in found.collect()], key=str)


def made():
    rows = []
    for i in range(12):
        lines = [prose(i * 10 + k, 9, 3000) for k in range(3)]
        lines.insert(1, f"Posted on 2020-01-{i:02} by user{i} in the forum")
        lines.append(f"All rights reserved to holder {'abcdefghijkl'[i]} of this work")
        if i % 3 == 0:
            lines += ["only a few have this", ""]
        rows.append((i, "\n".join(lines)))
    return rows


def test_templates_with_fields(spark):
    docs = spark.createDataFrame(made(), "doc_id long, text string")
    got = rows_of(templates.drop_recurring(docs))
    assert got == brute(made())
    assert {r[3] for r in got} == {2, 3}
    assert rows_of(templates.drop_recurring(docs.repartition(5), min_docs=5)) == brute(made(), min_docs=5)


def test_equal_lines(spark):
    """Long ones in two documents, and any in four, also where most tokens have digits; ends of lines don't matter."""
    long, digits = prose(5, 20, 900), "ISBN 978 3 16 148410 0"
    odd = "\t".join(f"{i}a" for i in range(20))
    rows = [(i, f"{prose(50 + i, 12, 3000)}\n {digits}\r\n{prose(7, 19, 900)}" if i < 3 else digits) for i in range(4)]
    rows += [(10, f"{long}\n{long}\nown words"), (11, f"  {long}\n{odd}"), (12, f"{odd}\r"), (13, f"{prose(8, 30, 900)}\n" * 3)]
    found = rows_of(templates.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string")))
    assert found == brute(rows)
    assert [r[3] for r in sorted(found, key=lambda r: int(r[0]))] == [1, 1, 1, 1, 2, 2, 1, 0]
    assert rows_of(templates.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string"), long=19)) == brute(rows, long=19)


def test_odd_documents(spark, odd_docs, odd_rows, clashing, no_docs):
    docs = clashing(odd_docs)
    found = templates.drop_recurring(docs, min_docs=2)
    assert found.columns == [*docs.columns, "n_lines", "n_dropped"]
    assert rows_of(found) == brute(odd_rows, min_docs=2)
    assert templates.drop_recurring(no_docs).count() == 0


def test_table(spark, docs_dir):
    docs = spark.read.parquet(f"{docs_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert rows_of(templates.drop_recurring(docs)) == brute(rows)


def test_no_python(spark, docs_dir):
    plan = templates.drop_recurring(spark.read.parquet(f"{docs_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("SinglePartition") == 0
