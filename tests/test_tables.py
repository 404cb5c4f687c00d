import random

import pytest
from pyspark.sql import functions as F

from carrel.operators import batches, corpora, dedupe, reconcile
from carrel.plans.corpora import available, download, read_catalog
from carrel.plans.reconciliation import reconcile_folder
from carrel.sources import html, tables
from tests.helpers import collection, xml_record


def names(spark, values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "filename string, position int")


def test_known_reconciliation(spark):
    local, catalog = names(spark, ["a", "a", "b", "c"]), names(spark, ["b", "d", "b"])

    def got(mode):
        rows = reconcile.reconcile(local, catalog, mode).collect()
        return sorted((r.filename, r.in_catalog) for r in rows)

    assert got("both") == [("a", False), ("b", True), ("c", False)]
    assert got("in") == [("b", True)]
    assert got("not_in") == [("a", False), ("c", False)]
    with pytest.raises(ValueError, match="mode"):
        got("all")


def report(spark, mode, found, absent):
    rows = [(n, True) for n in found] + [(n, False) for n in absent]
    df = spark.createDataFrame(rows, "filename string, in_catalog boolean")
    return [r.value for r in reconcile.in_reading_order(reconcile.report_lines(df, mode)).collect()]


def test_report_of_found_names(spark):
    lines = report(spark, "in", ["b.jpg", "a.jpg"], [])
    assert lines == [
        "=" * 40, "     CATALOG FILE COMPARISON REPORT".ljust(40), "=" * 40,
        "Total files found in Catalog: 2", "=" * 40,
        "", "--- FILES FOUND IN CATALOG ---", "a.jpg", "b.jpg", "=" * 40,
    ]


def test_report_of_absent_names(spark):
    lines = report(spark, "not_in", [], ["c.jpg"])
    assert "Total files not found in Catalog: 1" in lines
    assert "--- FILES NOT FOUND IN CATALOG ---" in lines
    assert not any("FILES FOUND" in line or "files found" in line for line in lines)


def test_report_without_names_has_no_sections(spark):
    lines = report(spark, "both", [], [])
    assert len(lines) == 6 and lines[3:5] == [
        "Total files found in Catalog: 0", "Total files not found in Catalog: 0"
    ]


def test_folder_against_collection(spark, tmp_path):
    for name in ("a.jpg", "b.jpg", "c.tif"):
        (tmp_path / "da" / name).parent.mkdir(exist_ok=True)
        (tmp_path / "da" / name).write_bytes(b"")
    (tmp_path / "c.xml").write_text(collection(xml_record(1, urls=["http://e.org/x/a.jpg"])))
    got = reconcile_folder(
        spark, str(tmp_path / "da"), str(tmp_path / "c.xml"), "both", "jpg", str(tmp_path / "report")
    )
    assert {r.filename: r.in_catalog for r in got.collect()} == {"a.jpg": True, "b.jpg": False}
    parts = sorted((tmp_path / "report").glob("part-*"))
    text = "".join(p.read_text() for p in parts)
    assert text.index("FILES FOUND") < text.index("a.jpg") < text.index("FILES NOT") < text.index("b.jpg")


def hot_rows(n=3000):
    """A third of the rows has one key, and ties on one value within it."""
    random.seed(5)
    return [
        ("hot" if random.random() < 0.34 else f"k{random.randint(0, 40)}", random.randint(0, 9), i)
        for i in range(n)
    ]


def test_one_row_per_key_against_brute_force(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k string, day int, i int").repartition(7)
    first, last = {}, {}
    for k, day, i in rows:
        first.setdefault(k, (k, day, i))
        last[k] = (k, day, i)
    assert sorted(map(tuple, dedupe.first_seen(df, ["k"], ["i"]).collect())) == sorted(first.values())
    assert sorted(map(tuple, dedupe.last_wins(df, ["k"], ["i"]).collect())) == sorted(last.values())
    by_two = {r.k: r.i for r in dedupe.last_wins(df, ["k"], ["day", "i"]).collect()}
    assert by_two == {k: max((d, i) for kk, d, i in rows if kk == k)[1] for k in last}


def test_latest_keeps_all_ties(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k string, day int, i int")
    top = {}
    for k, day, _ in rows:
        top[k] = max(day, top.get(k, -1))
    got = dedupe.latest_per_group(df, ["k"], "day")
    assert sorted(map(tuple, got.collect())) == sorted(r for r in rows if r[1] == top[r[0]])
    assert got.columns == df.columns


@pytest.mark.parametrize("n", [0, 1, 10, 1003])
def test_batches(spark, n):
    values = random.Random(n).sample(range(10 * n + 1), n)
    df = spark.createDataFrame([(v, str(v)) for v in values], "v int, s string").repartition(6)
    got = batches.assign_batches(df, ["v"]).orderBy("row_index").collect()
    assert [r.v for r in got] == sorted(values)
    assert [r.row_index for r in got] == list(range(n))
    assert [r.batch_id for r in got] == [i // 10 for i in range(n)]


PAGE = """<html><body>
<table id="other"><tbody><tr><td>no</td></tr></tbody></table>
<table id="user-corpora-download-table"><thead><tr><th>Corpus<th>File</tr></thead>
<tbody>
<tr><td>CORP1<td> f &amp; <b>1</b>.tgz <td>2020-01-02</td><td><a href="/d/1?a=1&amp;b=2">get</a><td>abc</tr>
<tr><td>CORP1</td><td>f &amp; 1.tgz</td><td>2021-01-02</td><td><a href="/d/2">get</a></td><td>def</td></tr>
<tr><td>CORP2</td><td>g<table><tbody><tr><td>.pdf</td></tr></tbody></table></td><td>2019-01-01</td><td></td><td>ghi</td></tr>
<tr></tr>
</tbody></table><p>after<table><tr><td>also no</td></tr></table></body></html>"""

CELLS = {"corpus_id": 0, "file": 1, "invoice_date": 2, "checksum": 4}


def test_download_table(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "<p>none"), (3, None)], "page int, html string")
    rows = read_catalog(pages, ["page"], CELLS).orderBy("row_no").collect()
    assert [(r.page, r.row_no, r.corpus_id, r.file, str(r.invoice_date), r.checksum, r.download_link) for r in rows] == [
        (1, 0, "CORP1", "f & 1.tgz", "2020-01-02", "abc", "/d/1?a=1&b=2"),
        (1, 1, "CORP1", "f & 1.tgz", "2021-01-02", "def", "/d/2"),
        (1, 2, "CORP2", "g.pdf", "2019-01-01", "ghi", None),
    ]
    catalog = read_catalog(pages, ["page"], CELLS)
    assert [r.download_link for r in available(catalog, "CORP1").collect()] == ["/d/2"]
    assert available(catalog, "CORP1", r"\.pdf$").count() == 0
    assert available(catalog, "none").count() == 0
    assert corpora.filter_corpora(catalog).count() == 2


def test_rows_of_a_list(spark):
    pages = spark.createDataFrame([("<nav><ul><li><a href='/x'>X</a><li><a>Y</a></ul></nav><li><a>Z",)], "html string")
    rows = html.extract_html_rows(pages, [], container="nav", container_id=None, body=None, row="li", cells=("a",))
    assert [[tuple(c) for c in r.cells] for r in rows.collect()] == [[("X", "/x")], [("Y", None)]]


def test_csv_keeps_every_character(spark, tmp_path):
    values = ['a "quoted", value', " blanks ", "line\nbreak", "", "ends with \\", 'x\\"y', "é"]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "i string, v string")
    tables.write_csv(df, str(tmp_path / "csv"))
    back = tables.read_csv(spark, str(tmp_path / "csv"), "i string, v string")
    assert [r.v for r in back.orderBy("i").collect()] == values


def test_runs_do_not_touch_each_other(spark, tmp_path):
    root = str(tmp_path)
    one = spark.createDataFrame([(1,)], "v int")
    tables.publish(one, root, "fetched", "a")
    tables.publish(one.withColumn("v", F.lit(2)), root, "fetched", "b")
    tables.publish(one.withColumn("v", F.lit(3)), root, "fetched", "a")
    assert tables.read_run(spark, root, "fetched", "a", "v int").collect() == [(3,)]
    assert tables.read_run(spark, root, "fetched", "b", "v int").collect() == [(2,)]


def test_shards(spark, tmp_path):
    df = spark.createDataFrame([(str(i),) for i in range(8, 130)], "record_id string")
    tables.write_shards(df, str(tmp_path / "s"))
    folders = {p.name for p in (tmp_path / "s").iterdir() if p.is_dir()}
    assert {"shard=8", "shard=9", "shard=10", "shard=12"} <= folders
    assert spark.read.parquet(str(tmp_path / "s")).count() == 122


def test_first_and_last_with_null_order(spark):
    rows = [("a", None, "x"), ("b", 1, "y"), ("b", None, "z"), ("b", 2, "w")]
    df = spark.createDataFrame(rows, "k string, at int, v string")
    assert {tuple(r) for r in dedupe.last_wins(df, ["k"], ["at"]).collect()} == {("a", None, "x"), ("b", 2, "w")}
    assert {tuple(r) for r in dedupe.first_seen(df, ["k"], ["at"]).collect()} == {("a", None, "x"), ("b", None, "z")}


def test_empty_rerun_leaves_no_rows(spark, tmp_path):
    rows = spark.createDataFrame([(1,), (2,)], "n int")
    tables.publish(rows, str(tmp_path), "t", "run-1")
    tables.publish(rows, str(tmp_path), "t", "run-2")
    tables.publish(rows.limit(0), str(tmp_path), "t", "run-1")
    assert tables.read_run(spark, str(tmp_path), "t", "run-1", "n int").count() == 0
    assert tables.read_run(spark, str(tmp_path), "t", "run-2", "n int").count() == 2
    with pytest.raises(ValueError, match="plain"):
        tables.publish(rows, str(tmp_path), "t", "a/b")


def test_unreadable_date_is_not_passed_over(spark):
    page = "<table id='user-corpora-download-table'><tbody><tr><td>C</td><td>f</td><td>01.02.2026</td><td>x</td><td>m</td></tr></tbody></table>"
    pages = spark.createDataFrame([(1, page)], "page int, html string")
    columns = {"corpus_id": 0, "file": 1, "invoice_date": 2, "checksum": 4}
    with pytest.raises(ValueError, match="01.02.2026"):
        read_catalog(pages, ["page"], columns)
    assert read_catalog(pages, ["page"], columns, strict=False).count() == 1
    assert read_catalog(pages, ["page"], columns, date_format="dd.MM.yyyy").first().invoice_date.year == 2026


class Corpora:
    def get(self, link):
        if link == "/broken":
            raise OSError("gone")
        header = 'attachment; filename="named.tgz"' if link == "/named" else None
        return header, [link.encode(), b"!"]


def test_download_with_checksum(spark, tmp_path):
    import hashlib

    md5 = hashlib.md5(b"/named!").hexdigest()
    rows = [("a", "/named", md5.upper()), ("b", "/plain", "0"), ("c", "/broken", "1"), ("old", "/old", "2"), ("d", "/none", None)]
    (tmp_path / "old").write_bytes(b"kept")
    wanted = spark.createDataFrame(rows, "file string, download_link string, checksum string")
    got = {r.file: r for r in download(wanted, Corpora, str(tmp_path)).collect()}
    assert (got["a"].target, got["a"].md5, got["a"].checksum_ok, got["a"].bytes) == ("named.tgz", md5, True, 7)
    assert got["b"].checksum_ok is False and got["c"].error == "gone" and got["old"].error == "old exists"
    assert got["d"].checksum_ok is None and got["d"].bytes == 6
    assert {p.name for p in tmp_path.iterdir()} == {"named.tgz", "b", "old", "d"}
    assert (tmp_path / "old").read_bytes() == b"kept"
