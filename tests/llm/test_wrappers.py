import pytest
from pyspark.sql import functions as F

from carrel.llm import wrappers


def page(title, *paragraphs, extra="", menu="Home"):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (
        f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>x='</p>';</script></head><body>"
        f"<nav><ul><li><a href=/a>{menu}</a></li><li>More</li></ul></nav><!-- <p>no</p> --><div class='ad top'>Buy</div>"
        f"<article><h1>{title}</h1>{body}{extra}</article><footer>&copy; me</footer></body></html>"
    )


def text_of(html):
    blocks, shape = wrappers.blocks_of(html)
    return "\n\n".join(wrappers.content_of(blocks, wrappers.lists(shape)))


@pytest.mark.parametrize(
    "around, text",
    [
        ("<body class='has-sidebar'>{}", "Title"),
        ("<body><div class='layout content-with-sidebar'>{}</div>", "Title"),
        ("<body><form id=aspnetForm>{}</form>", "Title"),
        ("<body id='with-header'><main>{}</main>", "Title"),
        ("<body><div id=sidebar-layout><div class='menu page'>{}</div></div>", "Title"),
    ],
)
def test_surroundings_of_the_article_are_no_rest(around, text):
    article = "<article><h1>Title</h1><p>one</p></article>"
    for rest in ("", "<aside>see</aside><div class=related><article><p>tease</p></article></div><nav>menu</nav>"):
        assert text_of(around.format(article + rest)) == "Title\n\none"


def test_parts_of_the_article_are_no_rest_by_a_word():
    extra = "<section id='search-engines'><p>two</p></section><div id='share-prices'>three</div><div class='share-links'>tweet</div>"
    assert text_of(f"<article><p>one</p>{extra}</article>") == "one\n\ntwo\n\nthree"
    thread = "<ol class=comment-list>" + "<li><article class=comment><p>a long opinion of a reader</p></article>" * 9 + "</ol>"
    assert text_of(f"<article><p>one of us</p></article>{thread}") == "one of us"


def test_a_list_of_teasers_is_not_the_article():
    teasers = "".join(f"<article><h2>teaser {i}</h2></article>" for i in range(3))
    body = f"<div><p>{'the text itself ' * 20}</p></div>"
    got = text_of(f"<body>{teasers}{body}</body>")
    assert ("the text itself " * 20).strip() in got
    assert text_of(f"<body>{teasers}<p>x</p></body>") == "teaser 0\n\nteaser 1\n\nteaser 2"


def test_blocks():
    html = "<body><p><b>A &amp;amp; b<br>c\n\t d<p>e&nbsp; f &lt; g < h<i>i</i><div>j</div>k</body>"
    assert text_of(html) == "A &amp; b c d\n\ne f < g < hi\n\nj\n\nk"
    assert text_of("") == "" and text_of("plain") == "plain" and text_of("<p>cut <a href='") == "cut"
    assert text_of("<div>x<script>var t='</div>'</script>y</div>") == "x y"
    assert text_of("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == "a\n\nb\n\nc\n\nd"
    assert text_of('<p title="a>b">x</p><p title="a>y</p>') .startswith("x")


def test_article_only():
    extra = "<aside>see</aside><section id='comments-3'><p>Nice!</p></section><form><p>mail</p></form><h2>Two</h2><p>End"
    assert text_of(page("T &quot;1&quot;", "a", "b", extra=extra)) == 'T "1"\n\na\n\nb\n\nTwo\n\nEnd'


def test_named_parts():
    page = (
        "<body><header><h1>Site</h1></header><div role=navigation>menu</div><div class='cookie-notice'>ok?</div>"
        "<div class='main-content with-sidebar'><h2>Title</h2><p>one</p><div id='ad-12'>buy</div><p>two</p>"
        "<ul class='share-links'><li>tweet</ul></div><div class='site_footer'>me</div><ol class='commentlist'><li>hm</ol></body>"
    )
    assert text_of(page) == "Title\n\none\n\ntwo"


def shape(html):
    return wrappers.blocks_of(html)[1]


def test_folding_and_alignment():
    one = shape("<body><h1>t</h1><p>a</p><p>b</p><hr><dl><dt>x<dd>y<dt>z<dd>w</dl></body>")
    assert wrappers.expression(one) == "<body> <h1> # </> (<p> # </>)+ <hr></> <dl> (<dt> # </>)+ (<dd> # </>)+ </> </>"
    other = shape("<body><h1>t</h1><div>note</div><p>a</p></body>")
    both = wrappers.merge(one, other)
    assert wrappers.expression(both).startswith("<body> <h1> # </> (<div> # </>)? (<p> # </>)+ (<hr></>)?")
    assert set(wrappers.slots(both)) == set(wrappers.slots(one)) | set(wrappers.slots(other))
    again = wrappers.merge(both, one)
    assert wrappers.expression(again) == wrappers.expression(both)


def test_order_of_alignment_keeps_every_slot():
    pages = [page("a", "1"), page("b", "1", "2", extra="<h2>x</h2><p>y</p>"), page("c"), "<body><div class=content>z</div>"]
    import itertools

    for order in itertools.permutations(pages):
        wrapper = shape(order[0])
        for p in order[1:]:
            wrapper = wrappers.folded(wrappers.merge(wrapper, shape(p)))
        for p in order:
            assert {path for path, _ in wrappers.blocks_of(p)[0]} <= set(wrappers.slots(wrapper))


@pytest.fixture(scope="module")
def hosts():
    rows = [(i, f"http://one.example.org/{i}", page(f"T{i}", f"p{i}", "same")) for i in range(9)]
    plain = "<body><div>Site name</div><div class=x><p>text {}</p></div><div class='Footer-2'>f</div></body>"
    rows += [(20 + i, f"https://two.example.org:80/{i}?q", plain.format(i)) for i in range(5)]
    rows += [(30, None, page("N", "null url")), (31, "http://one.example.org/31", None), (32, "http://one.example.org/", "")]
    rows += [(None, "strange", "<p>odd</p>"), (None, None, None), (40, "http://x.y", "<p>" + "long " * 60_000 + "</p>")]
    rows += [(0, rows[0][1], rows[0][2])]
    return rows


def test_hosts(spark, hosts):
    pages = spark.createDataFrame(hosts, "page_id long, url string, html string").repartition(4)
    got = sorted((str(r.page_id), r.text) for r in wrappers.extract(pages).collect())
    want = [(str(i), f"T{i}\n\np{i}\n\nsame") for i in range(9)] + [("0", "T0\n\np0\n\nsame")]
    want += [(str(20 + i), f"text {i}") for i in range(5)]
    want += [("30", "N\n\nnull url"), ("31", ""), ("32", ""), ("None", "odd"), ("None", ""), ("40", ("long " * 60_000).strip())]
    assert got == sorted(want)
    parted = wrappers.infer(pages, shapes_per_part=1).select("host", "lists", "fixed").collect()
    whole = wrappers.infer(pages).select("host", "lists", "fixed").collect()
    assert {r.host: (set(r.lists), set(r.fixed or ())) for r in parted} == {r.host: (set(r.lists), set(r.fixed or ())) for r in whole}


def test_empty_and_extra_columns(spark, hosts):
    pages = spark.createDataFrame(hosts, "page_id long, url string, html string")
    assert wrappers.extract(pages.limit(0)).count() == 0
    odd = pages.select("*", *[F.lit(1).alias(c) for c in ("host", "part", "shape", "paths", "text")])
    out = wrappers.extract(odd)
    assert out.columns == odd.columns and out.count() == len(hosts)


def test_many_hosts_in_one_task(spark):
    rows = [(i, f"http://h{i % 40}.example.org/{i}", page(f"T{i}", "x", extra="<h2>y</h2>" * (i % 3))) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    found = {r.host: r.wrapper for r in wrappers.infer(pages, shapes_per_part=2).collect()}
    assert len(found) == 40 and all("(<h2> # </>)" in w for w in found.values())
    texts = {r.page_id: r.text for r in wrappers.extract(pages).collect()}
    assert texts == {i: "\n\n".join([f"T{i}", "x"] + ["y"] * (i % 3)) for i in range(200)}


def test_templates_of_one_host(spark):
    bodies = ["<article><p>a{}</p></article><p>out</p>", "<main><p>m{}</p></main>", "<div class=content><p>c{}</p></div>", "<p>p{}</p>"]
    rows = [(i, u, bodies[i % 4].format(i)) for u in ("http://t.example.org/", None) for i in range(8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r.url, r.page_id): r.text for r in wrappers.extract(pages).collect()}
    assert got == {(u, i): f"{'amcp'[i % 4]}{i}" for _, u, _ in rows for i in range(8)}


def test_only_repeated_blocks_are_left_out(spark):
    rows = [(i, f"http://staff.example.org/{i}", f"<div><p>By Staff</p><p>text {i}</p><p>more {i}</p></div>") for i in range(4)]
    rows += [(10 + i, f"http://copies.example.org/{i}", "<div><p>one</p><p>two</p></div>") for i in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrappers.extract(pages).collect()}
    assert got == {i: f"text {i}\n\nmore {i}" for i in range(4)} | {10 + i: "one\n\ntwo" for i in range(4)}
