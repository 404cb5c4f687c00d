import re

from pyspark.sql import functions as F

from carrel.llm import decontaminate

ITEMS = "item_id long, text string"


def words_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(text, items, n=10):
    words, hit, found = words_of(text), set(), set()
    for item_id, item in items:
        own = words_of(item)
        grams = {tuple(own[i : i + n]) for i in range(max(1, len(own) - n + 1))} if own else set()
        for gram in grams:
            for i in range(len(words) - len(gram) + 1):
                if tuple(words[i : i + len(gram)]) == gram:
                    hit |= set(range(i, i + len(gram)))
                    found.add(str(item_id))
    return len(words), len(hit), ",".join(sorted(found))


def rows_of(docs, items):
    found = decontaminate.contamination(docs, items)
    return sorted(
        (r.doc_id is None, r.doc_id or 0, r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated)
        for r in found.collect()
    )


def expected(rows, items):
    out = []
    for r in rows:
        n, hit, ids = brute(r[1], items)
        out.append((r[0] is None, r[0] or 0, n, hit, len(ids.split(",")) if ids else 0, ids, hit > 0))
    return sorted(out)


def items_for(odd_rows):
    long = odd_rows[0][1].split()
    return [
        (1, " ".join(long[10:40]).upper()),
        (2, " ".join(long[30:55])),
        (10, "ÉTÉ one"),
        (11, "one"),
        (12, None),
        (13, " ... "),
        (14, "x " + " ".join(odd_rows[6][1].split()[3:14])),
        (15, "les étés"),
        (16, "the the the the the the the the the the the the"),
        (11, "one"),
        (17, "çà et là: été 💡"),
    ]


def test_odd_documents(spark, odd_docs, odd_rows, clashing):
    items = items_for(odd_rows)
    more = [(20, "The the THE the-the/the the the the the the the. end", "", "", 1), (21, "İstanbul ÉTÉ ONE K one", "", "", 1)]
    docs = clashing(odd_docs).drop("items").withColumn("items", F.lit(1))
    docs = docs.unionByName(clashing(spark.createDataFrame(more, odd_docs.schema)).drop("items").withColumn("items", F.lit(1)))
    frame = spark.createDataFrame(items, ITEMS).withColumn("gram", F.lit("x"))
    assert rows_of(docs, frame) == expected([*odd_rows, *more], items)


def test_broadcast_in_parts(spark, odd_docs, odd_rows):
    items = items_for(odd_rows)
    frame = spark.createDataFrame(items, ITEMS)
    size = len(decontaminate._broadcasts(decontaminate.windows(frame), 4_000))
    assert size > 1
    found = decontaminate.contamination(odd_docs, frame, most_bytes=4_000)
    assert found.agg(F.sum("n_hit")).first()[0] == sum(brute(r[1], items)[1] for r in odd_rows)


def test_very_long_text_and_other_names(spark):
    words = [f"w{i % 977}" for i in range(100_000)]
    passage = [f"test{i}" for i in range(30)]
    words[50_000:50_030] = passage
    docs = spark.createDataFrame([(1, " ".join(words), "x"), (2, " ".join(words[:40_000]), "y")], "n long, body string, text string")
    items = spark.createDataFrame([(1, " ".join(passage))], ITEMS)
    assert [r.n for r in decontaminate.remove(docs, items, id_col="n", text="body").collect()] == [2]
    cut = {r.n: r for r in decontaminate.remove(docs, items, mode="spans", id_col="n", text="body").collect()}
    assert cut[1].body == " ".join(words[:50_000] + words[50_030:]) and cut[1].text == "x"


def test_tables(spark, docs_dir):
    docs, items = (spark.read.parquet(f"{docs_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    pairs = [(r.item_id, r.text) for r in items.collect()]
    short = docs.where(F.length("text") < 1200)
    assert rows_of(short, items) == expected([(r.doc_id, r.text) for r in short.collect()], pairs)


def test_empty(spark, odd_docs, odd_rows, no_docs):
    nothing = spark.createDataFrame([], ITEMS)
    assert decontaminate.contamination(no_docs, nothing).count() == 0
    assert rows_of(odd_docs, nothing) == expected(odd_rows, [])


def test_remove(spark, odd_docs, odd_rows, clashing):
    items = spark.createDataFrame(items_for(odd_rows), ITEMS)
    docs = clashing(odd_docs)
    clean = decontaminate.remove(docs, items)
    assert clean.columns == docs.columns
    left = expected(odd_rows, items_for(odd_rows))
    assert clean.count() == sum(not r[-1] for r in left)
    cut = decontaminate.remove(docs, items, mode="spans")
    assert cut.columns == docs.columns and cut.count() == len(odd_rows)
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert len(words_of(texts[1])) == 120 - 45 and texts[5] == odd_rows[4][1]
