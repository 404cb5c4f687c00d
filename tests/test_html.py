"""The row scanner against the parser of the standard library, on made-up pages."""

import datetime
from html.parser import HTMLParser
from types import SimpleNamespace

from hypothesis import given, settings
from hypothesis import strategies as st

from carrel.plans import corpora as corpus_plan
from carrel.sources import html
from carrel.sources.html import _Rows
from queries import registry

VOID = {"br", "img"}


class Slow(HTMLParser):
    """Builds the element tree, then selects rows and cells from it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = {"tag": None, "attrs": {}, "kids": [], "up": None}

    def handle_starttag(self, tag, attrs):
        node = {"tag": tag, "attrs": dict(attrs), "kids": [], "up": self.at}
        self.at["kids"].append(node)
        if tag not in VOID:
            self.at = node

    def handle_data(self, data):
        self.at["kids"].append(data)

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node["tag"] != tag:
            node = node["up"]
        if node is not None:
            self.at = node["up"]


def text_of(node):
    if isinstance(node, str):
        return node
    if node["tag"] in ("script", "style"):
        return ""
    return "".join(text_of(k) for k in node["kids"])


def find(node, tag):
    for kid in node["kids"]:
        if not isinstance(kid, str):
            if kid["tag"] == tag:
                yield kid
            else:
                yield from find(kid, tag)


def link_of(node):
    """The cell's own link, else the first one in it outside of nested tables."""
    if "href" in node["attrs"]:
        return node["attrs"]["href"]
    for kid in node["kids"]:
        if not isinstance(kid, str) and kid["tag"] != "table":
            inside = kid if kid["tag"] == "a" else {**kid, "attrs": {}}
            link = link_of(inside)
            if link is not None:
                return link
    return None


def expected(page):
    parser = Slow()
    parser.feed(page)
    parser.close()
    rows = []
    for table in find(parser.root, "table"):
        if table["attrs"].get("id") == "t":
            for body in (k for k in table["kids"] if not isinstance(k, str) and k["tag"] == "tbody"):
                for row in (k for k in body["kids"] if not isinstance(k, str) and k["tag"] == "tr"):
                    cells = [
                        {"text": text_of(c).strip(), "href": link_of(c)}
                        for c in row["kids"]
                        if not isinstance(c, str) and c["tag"] == "td"
                    ]
                    if cells:
                        rows.append(cells)
    return rows


words = st.sampled_from(["a", "x &amp; y", "&eacute;", " ", "1 &lt; 2", "don't", '"q"', "é", "a=b"])
links = st.builds(
    lambda quote, href, other: f"<a {other} href={quote}{href}{quote}>",
    st.sampled_from(["'", '"']),
    st.sampled_from(["/x", "/y?a=1&amp;b=2", "", "/p>q"]),
    st.sampled_from(["", "class=c", "data-href='/no'", 'title="x href=/no y"', "disabled"]),
).flatmap(lambda start: words.map(lambda w: f"{start}{w}</a>"))
noise = st.sampled_from(
    ["<!-- <tr><td>no</td></tr> -->", "<script>if (a<b) '<td>'</script>", "<br>", "<img src='a>b'>", "<B>bold</B>"]
)
inner = st.lists(st.one_of(words, links, noise), max_size=4).map("".join)
nested = inner.map(lambda x: f"<table id=t2><tbody><tr><td>{x}</td></tr></tbody></table>")
cell = st.one_of(inner, st.tuples(words, nested).map("".join)).map(lambda x: f"<td class='c'>{x}</td>")
row = st.lists(cell, max_size=3).map(lambda c: f"<tr>{''.join(c)}</tr>\n")
table = st.tuples(st.sampled_from(["t", "u", "t t"]), st.lists(row, max_size=3)).map(
    lambda p: f"<table id='{p[0]}'><thead><tr><td>head</td></tr></thead><tbody>{''.join(p[1])}</tbody></table>"
)
page = st.lists(st.one_of(inner, table), max_size=5).map(
    lambda parts: f"<!DOCTYPE html><html><body><div>{'</div><div>'.join(parts)}</div></body></html>"
)


@settings(max_examples=400, deadline=None)
@given(page)
def test_rows_equal_those_of_the_element_tree(text):
    got = _Rows("table", "t", "tbody", "tr", frozenset(["td"])).read(text)
    assert got == expected(text)


def test_hostile_pages_end_quickly():
    for text in ("<a b=\"" * 20000, "<!-- " * 20000, "<table id='t'><tbody>" + "<tr><td>" * 20000, "<" * 100000):
        _Rows("table", "t", "tbody", "tr", frozenset(["td"])).read(text)


def test_cells_of_several_pages_stay_with_their_rows(spark):
    table = f'<table id="{html.DOWNLOAD_TABLE}"><tbody>%s</tbody></table>'
    page = table % "".join(f"<tr><td>{i}</td><td><a href='/{i}'>x&amp;</a></td></tr>" for i in range(3))
    pages = spark.createDataFrame([(1, page), (2, "<table></table>"), (3, page)], "id int, html string")
    made = html.extract_html_rows(pages, ["id"])
    got = [(r.id, r.row_no, [tuple(c) for c in r.cells]) for r in made.orderBy("id", "row_no").collect()]
    assert got == [(i, n, [(str(n), None), ("x&", f"/{n}")]) for i in (1, 3) for n in range(3)]


def test_catalog_pages_are_dealt_out_before_they_are_made(spark, monkeypatch, tmp_path):
    rows = [(n, n % 3, datetime.datetime(2020, 1, 1)) for n in range(50)]
    spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp").write.parquet(str(tmp_path / "orders.parquet"))
    seen = []

    def read(pages, *args, **options):
        seen.append(pages)
        return corpus_plan.read_catalog(pages, *args, **options)

    monkeypatch.setattr(registry, "corpus_plan", SimpleNamespace(read_catalog=read))
    assert registry.html_table(spark, str(tmp_path)).count() == 100
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("user-corpora-download-table") < plan.index("RepartitionByExpression")
